import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tillwise.sinks import tables as K
from tillwise.sources import files as S
from tillwise.sources import payload
from tillwise.sources.constants import PREFECTURES, geo_dim
from tillwise.streaming import ingest as I


def schema(ddl):
    return T.StructType.fromDDL(ddl)


def test_raw_csv_is_text(spark, landing):
    path = landing("in/a.csv", "id,flag,name", "1,True,", '2,False,"a, b"')
    df = S.read_csv_raw(spark, path)
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    assert rows(df) == [("1", "True", None), ("2", "False", "a, b")]


def test_typed_csv_keeps_bad_rows(spark, landing):
    path = landing("in/a.csv", "id,price", "1,2.5", "x,3")
    df = S.read_csv_typed(spark, path, schema("id int, price double"))
    assert rows(df) == [(1, 2.5, None), (None, 3.0, "x,3")]


def test_csv_by_name_with_other_order(spark, landing):
    landing("in/a.csv", "order_id,amount", "1,10.5")
    landing("in/b.csv", "discount,order_id,amount", "0.1,2,20")
    df = S.read_csv_by_name(spark, f"{landing.base}/in", ["order_id", "amount", "discount"]).select("order_id", "amount", "discount")
    assert rows(df) == [("1", "10.5", None), ("2", "20", "0.1")]


def bytes_read(spark):
    every = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in every if s.getScheme() == "file")


def test_headers_cost_first_blocks_and_rows_one_read(spark, landing):
    line = "12345,some words of a longer line to fill the file with,9\n"
    path = landing("in/large.csv", "id,words,n")
    with open(path, "a") as f:
        f.write(line * 800_000)
    landing("in/other.csv", "", "   ", "n,id", "1,2")
    size = os.path.getsize(path)
    before = bytes_read(spark)
    assert set(S.csv_headers(spark, f"{landing.base}/in")) == {"id,words,n", "n,id"}
    assert bytes_read(spark) - before < size / 10
    before = bytes_read(spark)
    n = I.ingest_files(spark, f"{landing.base}/in", f"{landing.base}/table", f"{landing.base}/cp", infer=False)
    assert n == 800_001
    # rows once, headers of the batch and of the folder
    assert bytes_read(spark) - before < 1.3 * size


def test_headers_of_odd_files(spark, landing):
    landing("in/bom.csv", "\ufeffid,n", "1,2")
    landing("in/empty.csv")
    with open(f"{landing.base}/in/latin.csv", "wb") as f:
        f.write("id,größe\n1,2\n".encode("latin-1"))
    with gzip.open(f"{landing.base}/in/packed.csv.gz", "wt") as f:
        f.write("n,id\n" + "2,1\n" * 10)
    landing("in/has space.csv", "n", "1")
    heads = S.csv_headers(spark, f"{landing.base}/in")
    got = {file.split("/")[-1]: header for header, files in heads.items() for file in files}
    assert got.pop("empty.csv", None) is None
    assert S.read_csv_by_name(spark, f"{landing.base}/in").count() == 13
    assert got == {"bom.csv": "id,n", "latin.csv": "id,gr\ufffd\ufffde", "packed.csv.gz": "n,id", "has space.csv": "n"}


def test_inferred_types(spark, landing):
    landing("in/a.csv", "store_id,location,latitude,opened,at,ok,big", '1,"Montreal, QC",45.5,2020-01-02,2020-01-02 10:00:00,true,3000000000')
    landing("in/b.csv", "store_id,location,latitude,opened,at,ok,big", "2,Laval,,2021-01-02,2021-01-02 10:00:00,false,4")
    df = S.read_files_inferred(spark, f"{landing.base}/in").drop("_rescued_data")
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    assert types == {
        "store_id": "int", "location": "string", "latitude": "double", "opened": "date", "at": "timestamp", "ok": "boolean", "big": "bigint",
    }
    assert df.filter("store_id = 1").first()["location"] == "Montreal, QC"


def test_json_lines(spark, landing):
    path = landing("c.jsonl", '{"call_id":"C1","resolved":true,"satisfaction":null}', '{"call_id":"C2","resolved":false,"satisfaction":4}')
    df = S.read_jsonl(spark, path, schema("call_id string, resolved boolean, satisfaction int"))
    assert rows(df) == [("C1", True, None), ("C2", False, 4)]


def test_rescue_keeps_failed_and_unknown(spark):
    df = spark.createDataFrame([("1", "5", "n"), ("x", "6", None), ("3", "", None)], "id string, qty string, extra string")
    out = S.rescue(df, schema("id int, qty int, missing date"))
    got = {r["qty"] if r["qty"] else r["id"]: r for r in out.collect()}
    assert json.loads(got[5]["_rescued_data"]) == {"extra": "n"}
    assert json.loads(got[6]["_rescued_data"]) == {"id": "x"}
    assert got[3]["_rescued_data"] is None and got[3]["missing"] is None


def test_audit_columns(spark, landing):
    path = landing("in/a.csv", "id", "1")
    row = S.with_audit(S.read_csv_raw(spark, path)).first()
    assert row["_source_file"].endswith("in/a.csv") and isinstance(row["_ingested_at"], dt.datetime)
    assert S.with_audit(S.read_csv_raw(spark, path), "shop").first()["_source_file"] == "shop"


PAYLOAD = {
    "statement_response": {
        "manifest": {"schema": {"columns": [{"name": "a"}, {"name": "b"}]}},
        "result": {"data_array": [["1", None], ["2", "x"]]},
    }
}


def test_payload(spark):
    df = spark.createDataFrame([(json.dumps(PAYLOAD),)], "body string")
    assert rows(payload.payload_frame(df, "body", ["a", "b"])) == [("1", None), ("2", "x")]


@pytest.mark.parametrize("part", ["columns", "rows"])
def test_empty_payload_raises(spark, part):
    body = json.loads(json.dumps(PAYLOAD))
    if part == "columns":
        body["statement_response"]["manifest"]["schema"]["columns"] = []
    else:
        body["statement_response"]["result"]["data_array"] = []
    df = spark.createDataFrame([(json.dumps(body),)], "body string")
    with pytest.raises(Exception, match="no columns or no rows"):
        payload.payload_to_rows(df, "body").collect()
    assert payload.payload_to_rows(df, "body", strict=False).count() == 0


def test_places(spark):
    assert geo_dim(spark).count() == len(PREFECTURES) == 47


# --- incremental ingest ------------------------------------------------------------------


def test_second_run_adds_nothing(spark, landing, tmp_path):
    landing("in/a.csv", "order_id,amount", "1,10", "2,20")
    args = (spark, f"{landing.base}/in", str(tmp_path / "t"), str(tmp_path / "cp"))
    assert I.ingest_new_files(*args) == 2
    assert I.ingest_new_files(*args) == 0
    landing("in/b.csv", "order_id,amount,coupon", "3,30,C")
    assert I.ingest_new_files(*args) == 1
    df = S.read_merged(spark, str(tmp_path / "t"))
    assert rows(df.select("order_id", "amount", "coupon")) == [("1", "10", None), ("2", "20", None), ("3", "30", "C")]
    assert df.filter("_source_file LIKE '%b.csv'").count() == 1 and df.filter("_ingested_at IS NULL").count() == 0


def test_new_column_widens_schema(spark, landing, tmp_path):
    src, t, cp = f"{landing.base}/in", str(tmp_path / "t"), str(tmp_path / "cp")
    landing("in/a.csv", "order_id,amount", "1,10.5")
    I.ingest_files(spark, src, t, cp)
    landing("in/b.csv", "discount,order_id,amount", "0.1,2,bad")
    I.ingest_files(spark, src, t, cp)
    df = S.read_merged(spark, t)
    assert dict(df.dtypes)["discount"] == "double" and dict(df.dtypes)["order_id"] == "int"
    assert rows(df.select("order_id", "amount", "discount", "_rescued_data")) == [
        (1, 10.5, None, None), (2, None, 0.1, '{"amount":"bad"}'),
    ]


def test_new_column_can_be_rescued(spark, landing, tmp_path):
    src, t, cp = f"{landing.base}/in", str(tmp_path / "t"), str(tmp_path / "cp")
    landing("in/a.csv", "order_id", "1")
    I.ingest_files(spark, src, t, cp, add_columns=False, rescued_col="_extra")
    landing("in/b.csv", "order_id,discount", "2,0.1")
    I.ingest_files(spark, src, t, cp, add_columns=False, rescued_col="_extra")
    df = S.read_merged(spark, t)
    assert "discount" not in df.columns
    assert rows(df.select("order_id", "_extra")) == [(1, None), (2, '{"discount":"0.1"}')]


def test_small_batches_and_flows(spark, landing, tmp_path):
    t = str(tmp_path / "t")
    for i in range(3):
        os.utime(landing(f"east/{i}.csv", "order_id", f"{i}"), (1_700_000_000 + 60 * i,) * 2)
    landing("west/0.csv", "order_id", "9")
    n = I.ingest_files(spark, f"{landing.base}/east", t, str(tmp_path / "e"), flow="east", max_files=1)
    m = I.ingest_files(spark, f"{landing.base}/west", t, str(tmp_path / "w"), flow="west")
    assert (n, m) == (3, 1)
    df = S.read_merged(spark, t)
    assert rows(df.select("flow", "batch", "order_id")) == [("east", 0, 0), ("east", 1, 1), ("east", 2, 2), ("west", 0, 9)]


RAGGED = ["id,v", "1,a", "2,b,EXTRA", "3"]


def test_ragged_lines_are_rescued(spark, landing, tmp_path):
    landing("in/a.csv", *RAGGED)
    landing("in/b.csv", "v,id,w", "c,4,x")
    want = [
        (1, "a", None, None), (2, "b", None, '{"_corrupt_record":"2,b,EXTRA"}'), (3, None, None, '{"_corrupt_record":"3"}'), (4, "c", "x", None),
    ]
    assert rows(S.read_files_inferred(spark, f"{landing.base}/in").select("id", "v", "w", "_rescued_data")) == want
    I.ingest_files(spark, f"{landing.base}/in", str(tmp_path / "t"), str(tmp_path / "cp"))
    assert rows(S.read_merged(spark, str(tmp_path / "t")).select("id", "v", "w", "_rescued_data")) == want


def test_gzip(spark, landing, tmp_path):
    import gzip

    (tmp_path / "in").mkdir()
    with gzip.open(tmp_path / "in" / "a.csv.gz", "wt") as f:
        f.write("\ufeffid,v\n1,a\n\n2,b\n")
    df = S.read_files_inferred(spark, str(tmp_path / "in"))
    assert rows(df) == [(1, "a", None), (2, "b", None)] and df.columns == ["id", "v", "_rescued_data"]


FIXED = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])


def test_fixed_schema_with_misfits(spark, landing, tmp_path):
    landing("in/a.csv", "v,id,w", "a,1,x", "b,notint,", "c,3,y,z")
    want = [(1, "a", '{"w":"x"}'), (3, "c", '{"w":"y","_corrupt_record":"c,3,y,z"}'), (None, "b", '{"id":"notint"}')]
    stream = I.stream_csv_named(spark, f"{landing.base}/in", FIXED, str(tmp_path / "t"), str(tmp_path / "cp"))
    I.append_flow(stream, str(tmp_path / "out"), str(tmp_path / "cp2"))
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("id", "v", "_rescued_data")) == want
    I.ingest_new_files(spark, f"{landing.base}/in", str(tmp_path / "n"), str(tmp_path / "cp3"), schema=FIXED)
    assert rows(S.read_merged(spark, str(tmp_path / "n")).select("id", "v", "_rescued_data")) == want


def test_fixed_order_is_checked(spark, landing, tmp_path):
    landing("in/a.csv", "v,id", "a,1")
    with pytest.raises(StreamingQueryException):
        I.append_flow(I.stream_csv_fixed(spark, f"{landing.base}/in", FIXED), str(tmp_path / "out"), str(tmp_path / "cp"))


def test_batch_size_does_not_matter(spark, landing, tmp_path):
    for i, lines in enumerate([["v", "5"], ["v", "5.5"], ["v,w", "x,1"], ["w", "y"]]):
        landing(f"in/{i}.csv", *lines)
    seen = []
    for n in (1, 10_000):
        I.ingest_files(spark, f"{landing.base}/in", str(tmp_path / f"t{n}"), str(tmp_path / f"cp{n}"), max_files=n)
        df = S.read_merged(spark, str(tmp_path / f"t{n}")).select("v", "w", "_rescued_data")
        seen.append((df.dtypes, rows(df)))
    assert seen[0] == seen[1]


def test_stream_csv_infers_once(spark, landing, tmp_path):
    landing("in/a.csv", "id,price", "1,2.5")
    stream = I.stream_csv(spark, f"{landing.base}/in", str(tmp_path / "schema"))
    assert dict(stream.dtypes) == {"id": "int", "price": "double", "_rescued_data": "string"}
    I.append_flow(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    landing("in/b.csv", "id,price", "2,3")
    I.append_flow(I.stream_csv(spark, f"{landing.base}/in", str(tmp_path / "schema")), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert rows(spark.read.parquet(str(tmp_path / "out")).drop("_rescued_data")) == [(1, 2.5), (2, 3.0)]
    landing("in/c.csv", "id,price,x", "2,3,4")
    with pytest.raises(ValueError):
        I.stream_csv(spark, f"{landing.base}/in", str(tmp_path / "other"))


# --- sinks --------------------------------------------------------------------------------


@pytest.fixture
def db(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tw")
    yield "tw"
    spark.sql("DROP DATABASE IF EXISTS tw CASCADE")


def test_replace_table_that_is_read(spark, db):
    K.overwrite(spark.range(3).toDF("id"), f"{db}.gd_a")
    K.replace_table(spark, f"{db}.gd_a", spark.table(f"{db}.gd_a").withColumn("x", F.lit(1)).filter("id > 0"))
    assert rows(S.read_table(spark, f"{db}.gd_a")) == [(1, 1), (2, 1)]


def test_reset_layer(spark, db):
    for name in ("gd_a", "gd_b", "sl_a"):
        K.overwrite(spark.range(1), f"{db}.{name}")
    assert sorted(K.reset_layer(spark, db, "gd_")) == ["gd_a", "gd_b"]
    assert [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {db}").collect()] == ["sl_a"]


def test_comments(spark, db):
    K.overwrite(spark.range(1).toDF("id"), f"{db}.t")
    K.describe(spark, f"{db}.t", "it's a table", {"id": "the row's \\ id"})
    got = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {db}.t").collect()}
    assert got["id"] == "the row's \\ id"
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {db}.t").collect()}
    assert info["Comment"] == "it's a table"


def test_export_splits_files(spark, tmp_path):
    K.export(spark.range(25).coalesce(1), str(tmp_path / "out"), "json", 10)
    files = sorted((tmp_path / "out").glob("*.json"))
    assert sorted(len(f.read_text().splitlines()) for f in files) == [5, 10, 10]


def test_partition_refresh(spark, tmp_path):
    path = str(tmp_path / "v")
    K.refresh(spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string"), path, "full", ["p"])
    K.refresh(spark.createDataFrame([(9, "b")], "x int, p string"), path, "partition_overwrite", ["p"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (9, "b")]
    with pytest.raises(ValueError):
        K.refresh(spark.range(1), path, "partition_overwrite")
