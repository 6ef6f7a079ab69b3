import itertools

import pytest

from tests.conftest import rows
from tillwise.streaming import ingest as I
from tillwise.streaming import widening as W


def load(spark, landing, base, batches, header="k,v"):
    """One run per batch of lines; returns the table in its widened types."""
    for i, lines in enumerate(batches):
        landing(f"{base}/in/{i}.csv", header, *lines)
        I.ingest_files(spark, f"{landing.base}/{base}/in", f"{landing.base}/{base}/t", f"{landing.base}/{base}/cp")
    return W.read_widened(spark, f"{landing.base}/{base}/t", f"{landing.base}/{base}/cp")


def test_whole_number_then_fraction(spark, landing):
    df = load(spark, landing, "a", [["1,5"], ["2,5.5", "3,"]])
    assert dict(df.dtypes)["v"] == "double"
    assert rows(df) == [(1, 5.0, None), (2, 5.5, None), (3, None, None)]


#: per column: the three values, the type they meet in, and how it prints them
MEETINGS = {
    "wide": (["5", "12345678901", "5.5"], "double", ["5.0", "1.2345678901E10", "5.5"]),
    "long": (["5", "-12345678901", "7"], "bigint", ["5", "-12345678901", "7"]),
    "time": (["2024-01-05", "2024-01-05 10:30:00", "2024-02-01"], "timestamp", ["2024-01-05 00:00:00", "2024-01-05 10:30:00", "2024-02-01 00:00:00"]),
    "midnight": (["2024-01-05", "2024-01-05 00:00:00", "2024-02-01"], "timestamp", ["2024-01-05 00:00:00", "2024-01-05 00:00:00", "2024-02-01 00:00:00"]),
    "mixed": (["5", "2024-01-05", "unknown"], "string", ["5", "2024-01-05", "unknown"]),
    "truth": (["true", "5", "yes"], "string", ["true", "5", "yes"]),
    "same": (["1", "2", "3"], "int", ["1", "2", "3"]),
}


def test_order_of_batches_does_not_matter(spark, landing):
    header = ",".join(["k", *MEETINGS])
    lines = [",".join([str(i + 1), *(v[i] for v, _, _ in MEETINGS.values())]) for i in range(3)]
    expected = [(str(i + 1), *(p[i] for _, _, p in MEETINGS.values()), None) for i in range(3)]
    for n, order in enumerate(itertools.permutations(lines)):
        df = load(spark, landing, f"p{n}", [[line] for line in order], header)
        types = dict(df.dtypes)
        assert {c: types[c] for c in MEETINGS} == {c: t for c, (_, t, _) in MEETINGS.items()}, order
        assert rows(df.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in df.columns])) == expected, order


def test_other_rescued_fields_stay(spark, landing):
    """Ragged lines, unknown columns and columns of other types are not touched."""
    df = load(spark, landing, "r", [["1,5"], ["2,5.5,more", "3,6.5"]])
    got = dict(((r["k"], r["v"]), r["_rescued_data"]) for r in df.collect())
    assert got[(1, 5.0)] is None and got[(3, 6.5)] is None
    assert [v for v in got.values() if v is not None and "5.5,more" in v]


def test_new_column_and_wider_column(spark, landing):
    base = f"{landing.base}/n"
    for name, lines in (("0", ["k,v", "1,5"]), ("1", ["v,k,w", "5.5,2,x"]), ("2", ["w,k", "y,99999999999"])):
        landing(f"n/in/{name}.csv", *lines)
        I.ingest_files(spark, f"{base}/in", f"{base}/t", f"{base}/cp")
    df = W.read_widened(spark, f"{base}/t", f"{base}/cp")
    assert df.dtypes[:3] == [("k", "bigint"), ("v", "double"), ("w", "string")]
    assert rows(df) == [(1, 5.0, None, None), (2, 5.5, "x", None), (99999999999, None, "y", None)]


def test_notes_are_written_only_where_they_widen(spark, landing, tmp_path):
    load(spark, landing, "w", [["1,5"], ["2,5.5"], ["3,6.5"], ["4,7"]])
    assert sorted(p.name for p in (tmp_path / "w/cp/types").iterdir()) == ["batch=1"]
    with pytest.raises(ValueError):
        W.read_widened(spark, str(tmp_path / "w/t"), str(tmp_path / "none"))


def test_joining_types_is_a_semilattice():
    types = ["int", "bigint", "double", "boolean", "date", "timestamp", "string"]
    for a, b, c in itertools.product(types, repeat=3):
        assert W.join_types(a, a) == a and W.join_types(a, b) == W.join_types(b, a)
        assert W.join_types(W.join_types(a, b), c) == W.join_types(a, W.join_types(b, c))
