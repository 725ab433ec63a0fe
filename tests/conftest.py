from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master(os.environ.get("TEST_MASTER", "local[8]"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    db = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return db


def same_rows(frame, db, sql):
    """Rows of a DataFrame and of a query, as sorted lists over the columns in order of name."""
    names = sorted(frame.columns)
    out = db.execute(f"SELECT * FROM ({sql})")
    assert sorted(c[0] for c in out.description) == names
    order = [[c[0] for c in out.description].index(n) for n in names]
    key = lambda row: tuple((v is not None, str(type(v)), v) if not isinstance(v, (int, float)) or isinstance(v, bool) else (True, "number", v) for v in row)
    want = sorted((tuple(r[i] for i in order) for r in out.fetchall()), key=key)
    got = sorted((tuple(r[n] for n in names) for r in frame.collect()), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a == pytest.approx(b, rel=1e-9, abs=1e-9) if any(isinstance(v, float) for v in a) and None not in a + b and not any(isinstance(v, str) for v in a) else _equal(a, b), (a, b)


def _equal(a, b):
    return all(x == pytest.approx(y, rel=1e-9, abs=1e-9) if isinstance(x, float) and isinstance(y, float) else x == y for x, y in zip(a, b, strict=True))
