"""Document quality: classifier evidence combined with shrunken posteriors of host and path."""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.operators.skew import skew_safe_join

from .common import ROW, kept_rows, named, stored, text_or_empty

#: Signs that are rare in running text.
SIGNS = b"!#$%&*+/<=>@[\\]^_{|}~"

PAD = 30

#: Number of bins of each feature: share of signs, of capitals, of digits, of bytes that
#: are no ASCII, mean word length, share of words that repeat the one before, and length
#: together with the share of distinct words.
BINS = {"signs": 21, "capitals": 21, "digits": 21, "foreign": 21, "word_length": 32, "repeats": 21, "variety": 16 * 11}

FEATURES = ", ".join(f"{name} int" for name in BINS)


def bins_of(text: str) -> tuple[int, ...]:
    """The bins of one whole text, in whole numbers only.

    Shares are as if ``PAD`` more bytes without the trait, or words of usual length,
    were there, so a few characters don't make a short text look odd.
    """
    data = text.encode()
    n = len(data) + PAD
    count = np.bincount(np.frombuffer(data, "uint8"), minlength=256)
    words = data.split()
    length = max(1, len(words))
    return (
        20 * int(count[list(SIGNS)].sum()) // n,
        20 * int(count[65:91].sum()) // n,
        20 * int(count[48:58].sum()) // n,
        20 * int(count[128:].sum()) // n,
        min(31, (sum(map(len, words)) + PAD) // (len(words) + PAD // 6)),
        20 * sum(map(operator.eq, words, words[1:])) // length,
        11 * min(15, length.bit_length() - 1) + 10 * len(set(words)) // length,
    )


def features(docs: DataFrame, id_col: str, text_col: str, host_col: str, path_col: str) -> DataFrame:
    """id, host, path and the bins of each row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.array([bins_of(t) for t in batch.column(3).to_pylist()], "int32").reshape(-1, len(BINS))
            columns = [pa.array(bins[:, i]) for i in range(len(BINS))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names=["id", "host", "path", *BINS])

    site = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((host_col, "host"), (path_col, "path"))]
    read = docs.select(F.col(id_col).alias("id"), *site, text_or_empty(text_col).alias("text"))
    return read.mapInArrow(run, f"id {kind}, host string, path string, {FEATURES}")


def milli(x: Column) -> Column:
    return F.floor(1000 * x + 0.5).cast("long")


def learn(labelled: DataFrame) -> tuple[int, int, dict[str, list[int]]]:
    """Good and bad labelled rows, and for each feature the log odds of its bins in thousandths.

    Two rows, shared out as the classes are, are added to every bin, so a bin without rows
    speaks for neither class.  The counts are grouped in the cluster; what comes back
    has a row per bin, of which there is a fixed number.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("feature"), F.col(n).alias("bin")) for n in BINS)))
    rows = labelled.select("good", pairs.alias("x")).groupBy("x.feature", "x.bin")
    counts = rows.agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")).collect()
    good = sum(r.good for r in counts if r.feature == "signs")
    bad = sum(r.bad for r in counts if r.feature == "signs")
    odds = {}
    for name, size in BINS.items():
        by_bin = np.zeros((size, 2))
        for r in counts:
            if r.feature == name:
                by_bin[r.bin] = r.good, r.bad
        sizes = np.array([good + 1, bad + 1])
        rates = (by_bin + 2 * sizes / sizes.sum()) / sizes
        ratio = np.log(rates[:, 0]) - np.log(rates[:, 1])
        odds[name] = np.floor(1000 * ratio + 0.5).astype(int).tolist()
    return good, bad, odds


def strength(groups: DataFrame, prior: Column, least: int, most: int) -> int:
    """How many rows a group's prior counts for, by the method of moments.

    The spread of the groups' rates beyond what chance gives is the variance of their
    true rates; the smaller it is, the more a group is drawn to its prior.
    """
    rate = F.col("s") / (1000 * F.col("n"))
    total, spread, chance = groups.select(
        F.sum("n"), F.sum(F.col("n") * (rate - prior) * (rate - prior)), F.sum(prior * (1 - prior))
    ).first()
    variance = ((spread or 0) - (chance or 0)) / max(total or 0, 1)
    if variance <= 0:
        return most
    return int(min(max(round(chance / max(groups.count(), 1) / variance), least), most))


def score(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.5,
    strengths: tuple[int, int] = (2, 1000),
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    path_col: str = "lang",
    label_col: str = "quality",
) -> DataFrame:
    """One row per row of ``docs``: id, evidence, host_rate, path_rate, quality, kept.

    ``evidence`` is the log odds, in thousandths, that the text alone gives for a good
    document: the sum over binned features of log odds learned from all labelled rows.
    Every row then counts in its host and in its path within the host, with its label or
    else the probability its evidence gives.  A host's rate is drawn to the global one, a
    path's to its host's, each as if the prior were so many rows more; that number comes
    from the spread of the rates and lies within ``strengths``.  ``quality`` is the
    posterior of the document under the rate of its path; ``kept`` where it reaches
    ``threshold``.  Rates and qualities are in ten-thousandths.

    Only numbers are shuffled: labels meet bins by id, sites are grouped with partial
    sums of whole numbers and joined back with skewed sites split.

    A NULL or empty text has the bins of an empty one; a NULL host or path is the site
    ''.  A row without a label, or with a NULL one, is unlabelled; of several labels for
    an id the lowest counts.  Without any labels every text has evidence 0.  Rows with a
    NULL id are scored, repeated rows each.  Other columns are ignored, an empty table
    gives an empty result.
    """
    rows = stored(features(docs, id_col, text_col, host_col, path_col), "quality-bins")
    marks = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    marks = marks.agg(F.min(F.when(F.col(label_col) > 0, 1).otherwise(0)).cast("long").alias("good"))
    rows = stored(skew_safe_join(rows, marks, ["id"], "left"), "quality-rows")
    good, bad, odds = learn(rows.filter("good is not null"))
    evidence = sum((F.element_at(F.array(*map(F.lit, odds[n])), F.col(n) + 1) for n in BINS), F.lit(0)).cast("long")
    rows = rows.select("id", "host", "path", "good", evidence.alias("evidence"))
    base = float(np.log((good + 1) / (bad + 1)))
    chance = 1 / (1 + F.exp(-(F.col("evidence") / 1000 + base)))
    counted = rows.withColumn("s", F.coalesce(1000 * F.col("good"), milli(chance)))

    paths = stored(counted.groupBy("host", "path").agg(F.sum("s").alias("s"), F.count("*").alias("n")), "quality-sites")
    hosts = paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    whole, n = hosts.agg(F.sum("s"), F.sum("n")).first()
    rate = ((whole or 0) / 1000 + 1) / ((n or 0) + 2)
    drawn = strength(hosts, F.lit(rate), *strengths)
    hosts = hosts.select("host", ((F.col("s") / 1000 + drawn * rate) / (F.col("n") + drawn)).alias("host_rate"))
    paths = stored(paths.join(hosts, "host"), "quality-hosts")
    drawn = strength(paths, F.col("host_rate"), *strengths)
    path_rate = (F.col("s") / 1000 + drawn * F.col("host_rate")) / (F.col("n") + drawn)
    sites = stored(paths.select("host", "path", "host_rate", path_rate.alias("path_rate")), "quality-paths")

    out = skew_safe_join(rows, sites, ["host", "path"], "left")
    prior = F.log(F.col("path_rate") / (1 - F.col("path_rate")))
    quality = 1 / (1 + F.exp(-(prior + F.col("evidence") / 1000)))
    whole_number = lambda x: F.floor(10000 * x + 0.5).cast("long")
    return out.select(
        F.col("id").alias(id_col),
        "evidence",
        whole_number(F.col("host_rate")).alias("host_rate"),
        whole_number(F.col("path_rate")).alias("path_rate"),
        whole_number(quality).alias("quality"),
        (whole_number(quality) >= int(10000 * threshold)).alias("kept"),
    )


def drop_poor(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows that ``score`` rejects.

    Rows are dropped, not ids: where rows share an id or have none, each is judged by its
    own text and site.  Rows equal in every column stay or go together.
    """
    rows, odd = named(docs, id_col)
    labels = labels.withColumn(ROW, F.col(id_col))
    if odd is not None:
        shared = odd.filter("__id IS NOT NULL").distinct().withColumnRenamed(ROW, "__name")
        labels = labels.join(shared, F.col(id_col) == F.col("__id"), "left").withColumn(ROW, F.coalesce("__name", ROW))
    marks = score(rows, labels, id_col=ROW, **options)
    return kept_rows(rows, stored(marks.filter(~F.col("kept")).select(ROW).distinct(), "quality-dropped")).select(docs.columns)
