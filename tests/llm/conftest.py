import duckdb
import pytest


@pytest.fixture
def docs(spark):
    def make(rows, **extra):
        """(doc_id, text) rows with the other columns of documents; extra: constant columns."""
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        full = [(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in rows]
        frame = spark.createDataFrame(full, schema)
        for name, value in extra.items():
            frame = frame.selectExpr("*", f"'{value}' AS `{name}`")
        return frame

    return make


@pytest.fixture(scope="session")
def oracle():
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "embeddings", "conversations", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return folder, con
