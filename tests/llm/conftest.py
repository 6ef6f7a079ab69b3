import pytest

#: Names that operators use inside, to clash with.
EXTRA = ["id", "text2", "node", "rep", "key", "keys", "size", "n", "band", "chunk", "shard", "host", "path", "hash", "good", "position"]


@pytest.fixture
def make(spark):
    """A documents table of (doc_id, text) or longer rows, with more columns whose names clash."""

    def table(rows, name="doc_id", kind="string", body="text"):
        rows = [(*r, *(None,) * (4 - len(r))) for r in rows]
        schema = f"{name} long, {body} {kind}, source string, lang string"
        df = spark.createDataFrame(rows, schema)
        return df.selectExpr("*", *(f"'x' AS `{c}`" for c in EXTRA if c != body and c != name))

    return table
