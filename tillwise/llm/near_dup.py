"""Near duplicates by a chosen-path similarity join over minwise hashes of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.operators.skew import skew_safe_join

from .common import ROW, flag_members, kept_rows, key_bitmap, losers, named, repeated, stored, text_or_empty
from .components import components

#: Minwise hashes per document.
COORDINATES = 64

_RANDOM = np.random.default_rng(20240229)
FACTOR = _RANDOM.integers(1, 1 << 63, COORDINATES, "uint64") * np.uint64(2) + np.uint64(1)
SHIFT = _RANDOM.integers(0, 1 << 63, COORDINATES, "uint64")
PLACE = _RANDOM.integers(1, 1 << 63, 64, "uint64") * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Texts to sorted distinct 64-bit hashes of their word shingles."""

    def __init__(self, size: int):
        self.size = size

    def __call__(self, text: str) -> np.ndarray:
        # bytes lower-case and split at ASCII letters and white space only
        words = text.encode().lower().split()
        if not words:
            return np.empty(0, "uint64")
        size = min(self.size, len(words))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), "uint64", len(words))
        n = len(words) - size + 1
        total = np.full(n, size, "uint64")
        for i in range(size):
            total += hashes[i : i + n] * PLACE[i]
        return np.unique(mix(total))


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The smallest of the shingles under each of the hash functions, 32 bits each."""
    least = np.full(COORDINATES, np.iinfo("uint64").max, "uint64")
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048]
        np.minimum(least, (part[None, :] * FACTOR[:, None] + SHIFT[:, None]).min(1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def children(nodes: np.ndarray, sigs: np.ndarray, similarity: float, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and child nodes: each node chooses the coordinates it branches by.

    One always, a second one with the probability that keeps the expected number of
    branches at 1 / similarity, so a pair at the threshold keeps one common branch on
    average.  Tree k begins with coordinate k.
    """
    seed = mix(nodes + np.uint64(level) * PLACE[0])
    first = (seed >> np.uint64(8)) % np.uint64(COORDINATES) if level else nodes % np.uint64(COORDINATES)
    second = (first + np.uint64(1) + (seed >> np.uint64(24)) % np.uint64(COORDINATES - 1)) % np.uint64(COORDINATES)
    rows = np.arange(len(nodes))
    more = (mix(seed) >> np.uint64(40)) < np.uint64(int((1 / similarity - 1) * (1 << 24)))
    for chosen, at in ((rows, first), (rows[more], second[more])):
        value = sigs[chosen, at.astype("int64")].astype("uint64")
        yield chosen, mix(nodes[chosen] * PLACE[1] + at * PLACE[2] + value * PLACE[3])


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first column, of batches sorted by it."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        keys = held.column(0).to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for start, end in zip([0, *cuts[:-1]], cuts):
            yield held.slice(start, end - start)
        if len(cuts):
            held = held.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held


class Sets:
    """Disjoint sets of 0 to n - 1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.top(i), self.top(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _sigs(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, COORDINATES)


def sketch(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """Rows id, n, print (128-bit fingerprint of the set), sig (its minwise hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = [shingler(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part.column(0),
                        "n": pa.array([len(s) for s in sets], pa.int64()),
                        "print": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        "sig": pa.array([minwise(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    }
                )

    read = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return read.mapInArrow(run, "id long, n long, print binary, sig binary")


def _branch(rows: DataFrame, similarity: float, level: int) -> DataFrame:
    """Rows (node, rep, sig) to rows (node, rep) one level down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                nodes, reps = batch.column(0).to_numpy().astype("uint64"), batch.column(1).to_numpy()
                for chosen, child in children(nodes, _sigs(batch.column(2)), similarity, level):
                    yield pa.RecordBatch.from_pydict({"node": pa.array(child.astype("int64")), "rep": pa.array(reps[chosen])})

    return rows.select("node", "rep", "sig").mapInArrow(run, "node long, rep long")


def _compare(rows: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """Rows (node, rep, side) to clusters of reps whose minwise hashes agree often enough.

    All pairs of a node are compared, but those of one ``side`` are known to be joined.
    Returns the members of each cluster of two or more, sorted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches):
            ids, at = np.unique(rows.column(1).to_numpy(), return_index=True)
            if len(ids) < 2:
                continue
            sigs, side = _sigs(rows.column(3).take(pa.array(at))), rows.column(2).to_numpy()[at]
            sets = Sets(len(ids))
            for i in range(len(ids) - 1):
                alike = (sigs[i + 1 :] == sigs[i]).sum(1) >= least
                alike &= side[i + 1 :] != side[i]
                for j in np.flatnonzero(alike):
                    sets.join(i, int(i + 1 + j))
            tops = np.array([sets.top(i) for i in range(len(ids))])
            found = [ids[tops == t].tolist() for t in np.unique(tops)]
            found = [f for f in found if len(f) > 1]
            if found:
                yield pa.RecordBatch.from_pydict({"members": pa.array(found, pa.list_(pa.int64()))})

    joined = rows.join(reps.select("rep", "sig"), "rep").select("node", "rep", "side", "sig")
    return joined.repartition("node").sortWithinPartitions("node").mapInArrow(run, "members array<long>")


def _confirm(clusters: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Rows (cluster, rep) to links (a, b) between reps, confirmed on their full sets.

    Pairs that other links of the cluster already join are not compared.  Only texts of
    reps that occur in a cluster move; a bitmap of bounded size picks them in the scan.
    """
    wanted = stored(clusters.select(F.col("rep").alias("id")).distinct(), "near-wanted")
    texts = flag_members(docs, F.col("id"), key_bitmap(wanted, F.col("id"), wanted.count()), "__maybe").filter("__maybe")

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = [shingler(t).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_pydict({"rep": part.column(0), "set": pa.array(sets, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches):
            ids = rows.column(1).to_pylist()
            full = [np.frombuffer(s, "uint64") for s in rows.column(2).to_pylist()]
            sets, links = Sets(len(ids)), []
            for i in range(len(ids)):
                for j in range(i + 1, len(ids)):
                    a, b = full[i], full[j]
                    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or sets.top(i) == sets.top(j):
                        continue
                    both = np.concatenate([a, b])
                    both.sort(kind="stable")
                    common = int(np.count_nonzero(both[1:] == both[:-1]))
                    if 100 * common >= percent * (len(both) - common):
                        sets.join(i, j)
                        links.append((ids[i], ids[j]))
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    found = texts.join(wanted, "id", "left_semi").select("id", "text").mapInArrow(shingles, "rep long, set binary")
    rows = clusters.join(found, "rep").select("cluster", "rep", "set")
    return rows.repartition("cluster").sortWithinPartitions("cluster", "rep").mapInArrow(run, "a long, b long")


def _blocks(n, leaf: int):
    return F.ceil(n / leaf).cast("long")


def mark_near(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    trees: int = 10,
    leaf: int = 64,
    depth: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    A document's set are its distinct shingles of ``size`` words (A-Z lower-cased; fewer
    words make one shingle).  Documents are linked where the sets' intersection is at
    least ``percent`` hundredths of their union; component_id is the smallest id that
    links reach, and the document with that id is kept.

    Equal sets are one class with one representative, grouped by a 128-bit fingerprint
    with partial minima.  Each of ``trees`` independent trees branches the
    representatives by minwise hashes that the node chooses; nodes of one representative
    end, those of at most ``leaf`` are compared exhaustively by their hashes, larger ones
    branch again.  A pair at the threshold shares a first branch with probability
    ``percent`` / 100 in each tree, so ten trees miss it with 0.15^10 at 0.85.  What
    agrees in all but five standard deviations of the hashes expected at the threshold
    is confirmed on full sets of 64-bit shingle hashes.

    Nodes that are large after the first branch may hold documents which are nearly all
    alike.  Their members are first confirmed against the hub of each node, in blocks of
    ``leaf``; from then on nodes whose members are all joined end.  Those still large
    after ``depth`` levels are compared exhaustively too: members outside the largest
    component meet every member, in cells of bounded size.  So there is no cap on
    partners, and no task holds a group.

    Words are cut at ASCII white space.  A text without words, NULL included, has the
    empty set and is linked with nothing.  Rows that repeat an id are one document, and
    linked with what any of them is linked with; rows with a NULL id are never linked
    and are kept.  Other columns are ignored, an empty table gives an empty result.
    """
    similarity = percent / 100
    least = int(COORDINATES * similarity - 5 * (COORDINATES * similarity * (1 - similarity)) ** 0.5)
    read = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    sketches = stored(sketch(docs, size, id_col, text_col), "near-sketches")
    classes = sketches.filter("n > 0 and id is not null").groupBy("print", "sig").agg(F.min("id").alias("rep"))
    classes = stored(classes, "near-classes")
    reps = classes.select("rep", "sig")

    roots = reps.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(trees - 1).cast("long"))).alias("node"), "rep", "sig")
    leaves, links, joined, large = [], None, None, None
    for level in range(depth):
        rows = stored(_branch(roots, similarity, level), "near-nodes")
        live = _unsettled(rows, joined)
        if not level and not (large := live.filter(F.col("m") > leaf)).isEmpty():
            links = stored(_linked(_stars(large, leaf), reps, least, read, size, percent), "near-links")
            joined = stored(components(links), "near-components")
            live = _unsettled(live.select("node", "rep"), joined)
        leaves.append(live.filter(F.col("m") <= leaf).select("node", "rep", "side"))
        large = live.filter(F.col("m") > leaf)
        if large.isEmpty():
            large = None
            break
        roots = skew_safe_join(large.select("node", "rep"), reps.dropDuplicates(["rep"]), ["rep"], "inner")

    rows = leaves[0]
    for other in leaves[1:]:
        rows = rows.unionByName(other)
    more = _linked(rows, reps, least, read, size, percent)
    links = stored(more if links is None else links.unionByName(more), "near-links")
    joined = stored(components(links), "near-components")
    if large is not None:
        rest = _cells(stored(_unsettled(large.select("node", "rep"), joined), "near-large"), leaf)
        if not rest.isEmpty():
            links = links.unionByName(_linked(rest, reps, least, read, size, percent))
            joined = stored(components(links), "near-components")

    known = classes.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select("print", F.coalesce("component", "rep").alias("component"))
    out = skew_safe_join(sketches.select("id", "n", "print"), known, ["print"], "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), component)
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _unsettled(rows: DataFrame, joined: DataFrame | None) -> DataFrame:
    """Rows (node, rep) to (node, rep, side, m) of the nodes that hold several components.

    ``side`` tells the components known so far apart, ``m`` is the size of the node.
    """
    side = F.col("rep")
    if joined is not None:
        rows = skew_safe_join(rows, joined.withColumnRenamed("node", "rep"), ["rep"], "left")
        side = F.coalesce("component", "rep")
    rows = rows.select("node", "rep", side.alias("side"))
    sizes = rows.groupBy("node").agg(F.count("*").alias("m"), F.min("side").alias("low"), F.max("side").alias("high"))
    return stored(skew_safe_join(rows, sizes.filter("low < high").select("node", "m"), ["node"], "inner"), "near-live")


def _stars(large: DataFrame, leaf: int) -> DataFrame:
    """Rows (node, rep, side): each large node's hub with its other members, in blocks.

    Every node draws a hub of its own, so the trees give several to a group.
    """
    hubs = large.groupBy("node").agg(F.min(F.struct(F.xxhash64("rep", "node"), "rep")).alias("h"))
    spokes = skew_safe_join(large, hubs.select("node", F.col("h.rep").alias("hub")), ["node"], "inner")
    spokes = spokes.filter("hub <> rep").select("hub", "rep").distinct()
    parts = spokes.groupBy("hub").agg(_blocks(F.count("*"), leaf).alias("parts"))
    placed = skew_safe_join(spokes, parts, ["hub"], "inner").withColumn("part", F.pmod(F.xxhash64("rep"), "parts"))
    ends = parts.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("hub").alias("rep"))
    blocks = placed.select("hub", "part", "rep").unionByName(ends)
    return blocks.select(F.xxhash64("hub", "part").alias("node"), "rep", F.col("rep").alias("side")).distinct()


def _cells(rows: DataFrame, leaf: int) -> DataFrame:
    """Cells (node, rep, side) that bring members outside a node's largest component together with all others.

    Nodes with the same largest component are taken together, as the trees find a group
    again and again.  Members of that component need not meet each other.  Both sides
    are cut into blocks, so a cell holds about ``leaf`` members of each.
    """
    counts = rows.groupBy("node", "side").agg(F.count("*").alias("k"))
    main = counts.groupBy("node").agg(F.max(F.struct("k", "side")).alias("x")).select("node", F.col("x.side").alias("main"))
    rows = skew_safe_join(rows.select("node", "rep", "side"), main, ["node"], "inner").select("main", "rep", "side").distinct()
    rows = stored(rows, "near-unreached")
    sizes = rows.groupBy("main").agg(
        _blocks(F.count_if(F.col("side") != F.col("main")), leaf).alias("lines"), _blocks(F.count("*"), leaf).alias("parts")
    )
    rows = skew_safe_join(rows, sizes, ["main"], "inner")
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    line, part = F.pmod(F.xxhash64("rep"), "lines"), F.pmod(F.xxhash64("rep"), "parts")
    members = rows.select("main", spread("lines").alias("line"), part.alias("part"), "rep", "side")
    outside = rows.filter("side <> main").select("main", line.alias("line"), spread("parts").alias("part"), "rep", "side")
    cells = members.unionByName(outside).distinct()
    return stored(cells.select(F.xxhash64("main", "line", "part").alias("node"), "rep", "side"), "near-cells")


def _linked(rows: DataFrame, reps: DataFrame, least: int, read: DataFrame, size: int, percent: int) -> DataFrame:
    """Rows (node, rep, side) to confirmed links between different sides."""
    found = _compare(rows, reps, least).distinct()
    clusters = found.select(F.xxhash64("members").alias("cluster"), F.explode("members").alias("rep"))
    return _confirm(stored(clusters, "near-clusters"), read, size, percent)


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id.

    Rows are dropped, not ids: where rows share an id or have none, each is a document of
    its own here.  A NULL id never wins against another.  Of rows equal in every column
    one stays, unless they have no words, as such rows are linked with nothing.
    """
    rows, odd = named(docs, id_col)
    marks = mark_near(rows, id_col=ROW, text_col=text_col, **options)
    if odd is None:
        return kept_rows(rows, stored(marks.filter(~F.col("kept")).select(ROW), "near-dropped")).select(docs.columns)
    marks = stored(marks.select(ROW, "n_shingles", F.col("component_id").alias("group")), "near-marks")
    worded = odd.join(marks.filter("n_shingles > 0").select(ROW).distinct(), ROW, "left_semi")
    return kept_rows(rows, stored(losers(marks, odd), "near-dropped"), repeated(worded)).select(docs.columns)
