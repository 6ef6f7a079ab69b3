import math
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillwise.operators import text_model as M

SF = os.environ.get("TEST_MODEL_DIR", "/root/testdata/sf0.01")
#: share of held-out labels that is to be met
LEAST = 0.8

TEXTS = [
    ("refund please, the lamp is broken", "return"), ("broken lamp: refund!", "return"), ("send it back, refund", "return"),
    ("when does the shop open", "hours"), ("open on sunday? when", "hours"), (None, "hours"), ("the the the", None),
]


def brute(train, text, n, alpha=0.5):
    """The same model without hashing, by plain loops."""

    def grams(t):
        w = [x for x in "".join(c.lower() if c.isalnum() else " " for c in t or "").split()]
        return {" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)}

    labels = sorted({v for _, v in train if v is not None})
    counts = {v: Counter(g for t, w in train if w == v for g in grams(t)) for v in labels}
    seen = set().union(*counts.values())
    logs = {}
    for v in labels:
        total = sum(counts[v].values()) + alpha * len(seen)
        logs[v] = math.log(sum(w == v for _, w in train) / sum(w is not None for _, w in train))
        logs[v] += sum(math.log((counts[v][g] + alpha) / total) for g in grams(text) & seen)
    best = max(labels, key=lambda v: logs[v])
    return best, 1 / sum(math.exp(logs[v] - logs[best]) for v in labels)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_model_against_brute_force(spark, n):
    model = M.train(spark.createDataFrame(TEXTS, "text string, label string"), "text", "label", n=n)
    asked = ["the lamp is broken", "When is it open?", "", None, "unknown words only", "refund when open " * 400]
    df = spark.createDataFrame(list(enumerate(asked)), "id int, text string")
    got = {r["id"]: (r["label"], r["probability"]) for r in M.classify(df, ["id"], "text", model, "string").collect()}
    for i, text in enumerate(asked):
        label, sure = brute(TEXTS, text, n)
        assert got[i][0] == label and got[i][1] == pytest.approx(sure)
    assert M.classify(df.limit(0), ["id"], "text", model, "string").collect() == []


def test_model_needs_labels(spark):
    with pytest.raises(ValueError):
        M.train(spark.createDataFrame([("x", None)], "text string, label string"), "text", "label")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_labels(spark):
    """Each fifth of the labels is foretold by a model of the other four."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(5))
    found = {}
    for k in range(5):
        model = M.train(docs.filter(fold != k), "text", "quality")
        told = M.classify(docs.filter(fold == k), ["doc_id"], "text", model, "int", "told")
        found.update({r["doc_id"]: r["told"] for r in told.collect()})
    true = {r["doc_id"]: r["quality"] for r in docs.select("doc_id", "quality").collect()}
    assert found.keys() == true.keys()
    right = sum(found[i] == v for i, v in true.items()) / len(true)
    usual = max(Counter(true.values()).values()) / len(true)
    assert right > LEAST and right > usual
