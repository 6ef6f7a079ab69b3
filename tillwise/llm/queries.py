"""The operators as queries on the given tables, with their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from public_tokenizers import path as vocabulary

from . import (
    alignment,
    bpe_codec,
    exact_dedup,
    html_text,
    line_dedup,
    near_dup,
    packing,
    piece_codec,
    quality,
    sharding,
    token_count,
    topk,
    whitening,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


#: Lower-casing of A-Z alone, as DuckDB states it.
AZ = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op10_exact_dedup",
    f"""
    WITH d AS (SELECT doc_id, sha256({AZ.format('text')}) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
    """,
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_exact(table(spark, sf_dir, "documents"), keep="largest")


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op7_bpe_round_trip")
def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op6_retrieval_packing")
def op6_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query(
    "op2_line_dedup",
    f"""
    WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (
        SELECT doc_id, i, lines[i] AS line,
               trim({AZ.format('lines[i]')}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
        FROM d, unnest(range(1, len(lines) + 1)) AS u(i)
    ),
    r AS (
        SELECT key, min(doc_id) AS first_doc FROM l WHERE length(key) >= 10
        GROUP BY key HAVING min(doc_id) < max(doc_id)
    ),
    m AS (SELECT doc_id, i, line, first_doc IS NOT NULL AND doc_id > first_doc AS gone FROM l LEFT JOIN r USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id
    """,
)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(
    "op9_exact_top_k",
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
    ),
    r AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query("op3_html_text")
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


QUALITY_SQL = r"""
WITH t AS (
    SELECT doc_id, coalesce(source, '') AS host, coalesce(lang, '') AS path, coalesce(text, '') AS text,
           strlen(coalesce(text, '')) + 30 AS n,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x09-\x0D\x20]+'), lambda w: w <> '') AS words
    FROM documents
),
bins AS (
    SELECT doc_id, host, path, unnest([
        {'f': 'signs', 'size': 21, 'bin': 20 * strlen(regexp_replace(text, '[^!#$%&*+/<=>@\[\\\]^_{|}~]', '', 'g')) // n},
        {'f': 'capitals', 'size': 21, 'bin': 20 * strlen(regexp_replace(text, '[^A-Z]', '', 'g')) // n},
        {'f': 'digits', 'size': 21, 'bin': 20 * strlen(regexp_replace(text, '[^0-9]', '', 'g')) // n},
        {'f': 'foreign', 'size': 21, 'bin': 20 * strlen(regexp_replace(text, '[\x00-\x7F]', '', 'g')) // n},
        {'f': 'word_length', 'size': 32, 'bin':
            least(31, (strlen(regexp_replace(text, '[\x09-\x0D\x20]', '', 'g')) + 30) // (len(words) + 5))},
        {'f': 'repeats', 'size': 21, 'bin':
            20 * len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1])) // greatest(1, len(words))},
        {'f': 'variety', 'size': 176, 'bin':
            11 * least(15, length(bin(greatest(1, len(words)))) - 1) + 10 * len(list_distinct(words)) // greatest(1, len(words))}
    ]) AS x FROM t
),
marks AS (
    SELECT doc_id, min(CASE WHEN quality > 0 THEN 1 ELSE 0 END) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
),
classes AS (SELECT sum(good) AS good, sum(1 - good) AS bad FROM marks JOIN documents USING (doc_id)),
counts AS (
    SELECT x.f AS f, x.bin AS bin, coalesce(sum(m.good), 0) AS good, coalesce(sum(1 - m.good), 0) AS bad
    FROM bins LEFT JOIN marks m USING (doc_id) GROUP BY ALL
),
odds AS (
    SELECT f, bin, floor(1000 * (
        ln((c.good + 2 * (k.good + 1) / (k.good + k.bad + 2)) / (k.good + 1))
        - ln((c.bad + 2 * (k.bad + 1) / (k.good + k.bad + 2)) / (k.bad + 1))) + 0.5)::BIGINT AS odds
    FROM counts c, classes k
),
rows AS (
    SELECT doc_id, host, path, sum(odds)::BIGINT AS evidence
    FROM bins b JOIN odds o ON b.x.f = o.f AND b.x.bin = o.bin GROUP BY ALL
),
scored AS (
    SELECT r.*, coalesce(1000 * m.good,
        floor(1000 / (1 + exp(-(evidence / 1000 + (SELECT ln((good + 1) / (bad + 1)) FROM classes)))) + 0.5)) AS s
    FROM rows r LEFT JOIN marks m USING (doc_id)
),
total AS (SELECT (sum(s) / 1000 + 1) / (count(*) + 2) AS rate FROM scored),
hosts AS (SELECT host, sum(s) AS s, count(*) AS n FROM scored GROUP BY host),
host_spread AS (
    SELECT sum(rate * (1 - rate)) AS chance, count(*) AS k,
           (sum(n * (s / (1000 * n) - rate) * (s / (1000 * n) - rate)) - sum(rate * (1 - rate))) / sum(n) AS variance
    FROM hosts, total
),
host_drawn AS (
    SELECT CASE WHEN variance <= 0 THEN 1000 ELSE least(greatest(round(chance / k / variance), 2), 1000) END AS m FROM host_spread
),
host_rates AS (SELECT host, (s / 1000 + m * rate) / (n + m) AS host_rate FROM hosts, total, host_drawn),
paths AS (
    SELECT host, path, host_rate, s, n
    FROM (SELECT host, path, sum(s) AS s, count(*) AS n FROM scored GROUP BY host, path) JOIN host_rates USING (host)
),
path_spread AS (
    SELECT sum(host_rate * (1 - host_rate)) AS chance, count(*) AS k,
           (sum(n * (s / (1000 * n) - host_rate) * (s / (1000 * n) - host_rate)) - sum(host_rate * (1 - host_rate))) / sum(n) AS variance
    FROM paths
),
path_drawn AS (
    SELECT CASE WHEN variance <= 0 THEN 1000 ELSE least(greatest(round(chance / k / variance), 2), 1000) END AS m FROM path_spread
),
sites AS (SELECT host, path, host_rate, (s / 1000 + m * host_rate) / (n + m) AS path_rate FROM paths, path_drawn),
final AS (
    SELECT doc_id, evidence, floor(10000 * host_rate + 0.5)::BIGINT AS host_rate, floor(10000 * path_rate + 0.5)::BIGINT AS path_rate,
           floor(10000 / (1 + exp(-(ln(path_rate / (1 - path_rate)) + evidence / 1000))) + 0.5)::BIGINT AS quality
    FROM rows JOIN sites USING (host, path)
)
SELECT *, quality >= 5000 AS kept FROM final
"""


@query("op1_quality", QUALITY_SQL)
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op5_near_duplicates",
    f"""
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(regexp_split_to_array({AZ.format('text')}, '[\\x09-\\x0D\\x20]+'), lambda x: x <> '') AS words
        FROM documents
    ),
    s AS (
        SELECT doc_id, unnest(list_distinct(CASE
            WHEN len(words) = 0 THEN []
            WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
            ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
        END)) AS shingle FROM w
    ),
    n AS (SELECT doc_id, count(shingle) AS n_shingles FROM w LEFT JOIN s USING (doc_id) GROUP BY doc_id),
    shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
        FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
    ),
    links AS (
        SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
        WHERE 100 * k >= 85 * (x.n_shingles + y.n_shingles - k)
    ),
    sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT reach.a, sides.b FROM reach JOIN sides ON reach.b = sides.a
    ),
    c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c USING (doc_id)
    """,
)
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.mark_near(table(spark, sf_dir, "documents"), size=3, percent=85)


@query("op8_hilbert_shards")
def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_curve(table(spark, sf_dir, "documents"))


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op12_piece_round_trip")
def op12_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op13_alignment")
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
