"""Every query of the package against its SQL on the small tables."""

import duckdb
import pytest

from prismcube.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()


def values(df):
    cols = sorted(df.columns)
    df = df.astype(object).where(df.notna(), None)
    return sorted((tuple(None if x is None else str(x) if isinstance(x, (str, bool)) else round(float(x), 5) + 0.0 for x in row) for row in df[cols].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    assert len(got.columns) and (len(got) or name == "j7_within_radius")
    if name in ORACLES:
        c = duckdb.connect()
        for t in TABLES:
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        want = c.execute(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert values(got) == values(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_interval_groups_equal_sql(spark):
    import numpy as np
    import pandas as pd

    from prismcube.operators import tables
    from prismcube.queries import J5_SQL

    rng = np.random.default_rng(3)
    first = rng.integers(0, 400, 60)
    last = first + rng.integers(1, 40, 60)
    events = pd.DataFrame({"user_id": np.repeat(np.arange(60), 2), "event_id": np.stack([first, last], 1).ravel()})
    c = duckdb.connect()
    c.register("events", events)
    want = c.execute(J5_SQL).df()
    files = spark.createDataFrame([(str(i), int(a), int(b)) for i, (a, b) in enumerate(zip(first, last, strict=True))], "name string, first long, last long")
    assert values(tables.group_intervals(files).toPandas()) == values(want) and 1 < want.grp.nunique() < len(want) < 60
