import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def equal_sql(spark, sf):
    """Checks that a query's rows equal those that DuckDB gives for its SQL on the same tables."""
    import duckdb

    c = duckdb.connect()
    for t in sorted(Path(sf).glob("*.parquet")):
        c.sql(f"CREATE VIEW {t.stem} AS SELECT * FROM read_parquet('{t}')")

    def check(query, sql):
        df = query(spark, sf)
        cols = sorted(df.columns)
        r = c.sql(sql)
        assert sorted(r.columns) == cols
        # sums may be added in another order: a rounded last digit can differ
        key = lambda row: repr([f"{v:.3f}" if isinstance(v, float) else v for v in row])
        want = sorted((tuple(x[r.columns.index(k)] for k in cols) for x in r.fetchall()), key=key)
        got = sorted((tuple(x[k] for k in cols) for x in df.collect()), key=key)
        same = lambda a, b: a == b or isinstance(a, float) and isinstance(b, float) and abs(a - b) < 2e-6
        assert len(got) == len(want) and (got == want or all(same(a, b) for x, y in zip(got, want) for a, b in zip(x, y)))

    return check
