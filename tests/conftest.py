import math
import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="session")
def same():
    """Whether a Spark result and a DuckDB relation hold the same rows, whatever their order."""

    def plain(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return "null"
        if isinstance(v, (float, Decimal)):
            return f"{float(v):.6g}"
        if isinstance(v, datetime):
            return str(v.replace(tzinfo=None))
        return f"[{', '.join(map(plain, v))}]" if isinstance(v, list) else str(v)

    def rows(table):
        return sorted(tuple(map(plain, r)) for r in zip(*(table.column(c).to_pylist() for c in sorted(table.column_names))))

    def check(df, rel):
        # By Arrow, so that whole numbers stay whole beside nulls.
        a, b = df.toArrow(), rel.to_arrow_table()
        assert sorted(a.column_names) == sorted(b.column_names)
        assert rows(a) == rows(b)

    return check
