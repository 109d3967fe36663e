from collections import Counter

import duckdb
import pytest

from placelink.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert Counter(map(tuple, df.select(columns).collect())) == Counter(want)
