import os

import duckdb
import pytest

EDGES = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, "One two three four five six seven."),
    (5, "One two three four five six seven."),
    (5, "One two three four five six seven."),
    (None, "Rows without an id are rows too, mail a.b@c.example.com."),
    (6, "é" * 30 + " 日本語 😀 " + "word " * 40_000),
    (7, "x" * 200_000),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns with names that the operators use."""
    rows = [(i, t, "en", "s", 0, 1.5, "k", [1]) for i, t in EDGES]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, key string, items array<int>"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def empty(edges):
    return edges.where("false")


@pytest.fixture(scope="session")
def texts(sf):
    import pyarrow.parquet as pq

    table = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"])
    return dict(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist()))


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for name in os.listdir(sf):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf}/{name}'")
    return con
