"""The operators' queries against their SQL on the small tables."""

import duckdb
import pytest

pytest.importorskip("prismcube.llm")
pytest.importorskip("public_tokenizers")
from prismcube.llm.queries import ORACLES, QUERIES  # noqa: E402

TABLES = "documents embeddings pages benchmark labels conversations".split()


def values(df):
    df = df.astype(object).where(df.notna(), None)
    return sorted((tuple(None if x is None else str(x) if isinstance(x, (str, bool)) else round(float(x), 5) + 0.0 for x in row) for row in df[sorted(df.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = c.execute(ORACLES[name]).df()
    assert len(got) and sorted(got.columns) == sorted(want.columns)
    assert values(got) == values(want)
