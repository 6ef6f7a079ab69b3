"""Exact top-k search by inner product over vectors processed by descending length."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

#: Most bands the vectors are cut into by length; larger bands are split by id.
BANDS = 1024

HITS = "query_id long, vec_id long, score long"


def whole(x: Column) -> Column:
    return F.floor(x.cast("double") * 256)


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def scan(queries, ids, vectors, query_ids, floor, rotation, k: int, block: int = 1024):
    """The k best vectors of each query: query index, vector index, score.

    Vectors come by falling length, ``block`` at a time.  A query whose length times that
    of the block's longest vector stays below its k-th best score is done.  For the rest,
    the inner product of the leading rotated coordinates plus the product of the lengths
    of the remainders bounds the score; only pairs that reach the k-th best are computed,
    in whole numbers.  ``floor`` is a score that the k-th best is known to reach.
    """
    d = rotation.shape[0]
    head = max(1, d // 4)
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * d
    exact = largest < 2**53
    order = np.argsort(-np.einsum("ij,ij->i", vectors, vectors, dtype="float64"), kind="stable")
    ids, v, q = ids[order], vectors[order].astype("float64"), queries.astype("float64")
    vr, qr = v @ rotation, q @ rotation
    v_len, q_len = np.sqrt((v * v).sum(1)), np.sqrt((q * q).sum(1))
    v_rest, q_rest = np.sqrt((vr[:, head:] ** 2).sum(1)), np.sqrt((qr[:, head:] ** 2).sum(1))
    best = floor.astype("float64")
    slack = 0.5 + 1e-9 * largest  # scores are whole; far above the rounding of the bounds
    rows = np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0, "int64")
    for at in range(0, len(ids), block):
        part = slice(at, at + block)
        live = np.flatnonzero(q_len * v_len[at] >= best - slack) if exact else np.arange(len(q))
        if not len(live):
            break
        bound = qr[live, :head] @ vr[part, :head].T + np.outer(q_rest[live], v_rest[part])
        may = bound >= best[live, None] - slack if exact else np.ones(bound.shape, bool)
        may &= query_ids[live, None] != ids[None, part]
        if not exact:
            product = queries[live].astype(object) @ vectors[order[part]].astype(object).T
            score = np.clip(product, -(2**63), 2**63 - 1).astype("int64")
        elif may.mean() > 0.05:
            score = (q[live] @ v[part].T).astype("int64")
        else:
            score = None
        if score is not None and exact and may.shape[1] > k:
            shown = np.where(may, score, -np.inf)
            best[live] = np.maximum(best[live], np.partition(shown, -k, axis=1)[:, -k])
            may &= score >= best[live, None]
        i, j = np.nonzero(may)
        value = score[i, j] if score is not None else np.einsum("ij,ij->i", q[live[i]], v[at + j]).astype("int64")
        found = [np.concatenate(x) for x in zip(rows, (live[i], at + j, value))]
        keep = np.lexsort((ids[found[1]], -found[2].astype("float64") if exact else ~found[2], found[0]))
        found = [x[keep] for x in found]
        start = np.searchsorted(found[0], found[0])
        place = np.arange(len(found[0])) - start
        rows = tuple(x[place < k] for x in found)
        kth = place == k - 1
        best[found[0][kth]] = np.maximum(best[found[0][kth]], found[2][kth])
    return rows[0], order[rows[1]], rows[2]


def reach(cuts: list[float]) -> Column:
    """Last band in which a vector can score a query's ``floor``: none of the later ones is long enough.

    ``cuts`` are the largest lengths of bands 1, 2, ...; by Cauchy-Schwarz a score is at
    most the product of the lengths.  The slack is far above the rounding of both.
    """
    may = lambda c: F.col("length") * c * (1 + 1e-9) + 1 >= F.col("floor")
    return F.size(F.filter(F.array(*map(F.lit, cuts)), may)) if cuts else F.lit(0)


def query_parts(sizes: dict[int, int], bands: int, chunk: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Parts of queries by the last band they reach, those that reach least first.

    Neighbouring bands share parts until they have ``chunk`` queries; more are split by a
    hash of the id.  Returns for each band the first part that holds a query reaching it,
    after these the number of parts, and for each band the first part of its own queries
    and how many there are.
    """
    groups, rows = [[]], 0
    for band in range(bands):
        if rows and rows + sizes.get(band, 0) > chunk:
            groups.append([])
            rows = 0
        groups[-1].append(band)
        rows += sizes.get(band, 0)
    firsts, own, at = [], [], 0
    for group in groups:
        n = max(1, math.ceil(sum(sizes.get(b, 0) for b in group) / chunk))
        firsts += [at] * len(group)
        own += [(at, n)] * len(group)
        at += n
    return [*firsts, at], own


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    chunk: int = 8192,
    sample: int = 4096,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """Rows query_id, rank, vec_id, score: the k highest inner products of each query.

    Components x count as floor(256 x).  Queries are the rows whose id is divisible by
    ``every``, candidates all rows but those with the query's id; ties go to the smaller
    id.  A query with fewer than k candidates gets all of them.

    Vectors are cut by descending length into bands, large bands by a hash of the id, so
    a chunk has about ``chunk`` rows even where many vectors are equal.  The longest
    chunk gives every query a first threshold.  With it a query goes only to the leading
    bands whose longest vector times its own length reaches the threshold
    (:func:`reach`), and a vector only to the groups of queries that come to its band;
    each chunk meets each group of queries once and returns at most k rows a query.  The rotation
    comes from the singular vectors of at most ``sample`` rows, chosen by a hash of the
    id; it only decides how early a pair is discarded.

    Vectors that are NULL or hold NULL or non-finite components take no part, nor do rows
    with a NULL id.  Shorter vectors count as if zeros followed.  Of rows that repeat a
    query's id with other vectors, the query is the smallest vector; repeated candidates
    are candidates each.  Components and scores are limited to 64 bits.  Other columns
    are ignored, an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    x = F.col("x")
    ints = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("x")).filter(
        F.col("id").isNotNull() & x.isNotNull() & F.forall("x", finite)
    )
    ints = ints.select("id", F.transform("x", whole).alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c))
    ints = stored(ints.withColumn("length", length), "topk-vectors")
    n, dims = ints.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n or not dims:
        n, dims = n or 0, 1
    bands = max(1, min(BANDS, n // chunk))
    shares = [i / bands for i in range(1, bands)]
    cuts = sorted(set(ints.agg(F.percentile_approx("length", shares, 10000)).first()[0] or []) if shares else [], reverse=True)
    above = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c >= F.col("length"))) if cuts else F.lit(0)
    ints = ints.withColumn("band", above)
    sizes = dict(ints.groupBy("band").count().collect())  # BANDS rows at most
    splits = [max(1, math.ceil(sizes.get(b, 0) / (2 * chunk))) for b in range(len(cuts) + 1)]
    bases = [sum(splits[:b]) for b in range(len(splits))]
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("band") + 1)
    ints = ints.withColumn("chunk", (pick(bases) + F.pmod(F.xxhash64("id"), pick(splits))).cast("int"))
    asked = ints.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    asked = stored(asked.withColumn("length", length), "topk-queries")
    first_parts = max(1, math.ceil(asked.count() / chunk))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(first_parts)).cast("int"))

    drawn = ints.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(sample).select("v").collect()
    matrix = _matrix(pa.array([r.v for r in drawn], pa.list_(pa.int64())), dims).astype("float64")
    scale = max(1.0, float(np.abs(matrix).max(initial=0)))
    _, turn = np.linalg.eigh((matrix / scale).T @ (matrix / scale))
    rotation = spark.sparkContext.broadcast(np.ascontiguousarray(turn[:, ::-1]))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({c.split()[0]: pa.array([], pa.int64()) for c in HITS.split(", ")})
        queries, query_ids = _matrix(left["v"].combine_chunks(), dims), np.array(left["id"])
        vecs, ids = _matrix(right["v"].combine_chunks(), dims), np.array(right["id"])
        a, b, score = scan(queries, ids, vecs, query_ids, np.array(left["floor"], "float64"), rotation.value, k)
        return pa.table({"query_id": query_ids[a], "vec_id": ids[b], "score": score})

    def meet(queries: DataFrame, rows: DataFrame, last_chunk: Column, from_part: Column, parts: int) -> DataFrame:
        """Queries in the chunks up to their last one, vectors in the parts from their first one."""
        q = queries.select("id", "v", "floor", "part", F.explode(F.sequence(F.lit(0), last_chunk)).alias("chunk"))
        v = rows.filter(from_part < parts).select("id", "v", "chunk", F.explode(F.sequence(from_part, F.lit(parts - 1))).alias("part"))
        return q.groupBy("chunk", "part").cogroup(v.groupBy("chunk", "part")).applyInArrow(search, HITS)

    zero, lowest = F.lit(0), F.lit(float("-inf"))
    first = meet(asked.withColumn("floor", lowest), ints.filter("chunk = 0"), zero, zero, first_parts)
    known = first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n")).filter(F.col("n") >= k)
    known = asked.join(known.withColumnRenamed("query_id", "id"), "id", "left")
    known = known.select("id", "v", "length", F.coalesce(F.col("floor").cast("double"), lowest).alias("floor"))
    known = stored(known.withColumn("band", reach(cuts)), "topk-asked")
    firsts, per_group = query_parts(dict(known.groupBy("band").count().collect()), len(cuts) + 1, chunk)  # BANDS rows at most
    known = known.withColumn("part", (pick([a for a, _ in per_group]) + F.pmod(F.xxhash64("id"), pick([n for _, n in per_group]))).cast("int"))
    last = [b + n - 1 for b, n in zip(bases, splits)]
    hits = meet(known, ints, pick(last), pick(firsts[:-1]), firsts[-1])
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = hits.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Lists of whole numbers as rows, filled up with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = np.diff(np.array(lists.offsets))
    out = np.zeros((len(lists), dims), "int64")
    out[np.arange(dims)[None, :] < sizes[:, None]] = np.array(lists.flatten(), "int64")
    return out
