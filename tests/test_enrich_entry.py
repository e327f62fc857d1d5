"""B4 enrichment and the driver contract (entry, queries, oracles)."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from setlist.operators.enrich import enrich
from tests.services import hashed_track_service

SF = "/root/testdata/sf0.001"


def test_enrich_equals_plain_join(spark):
    ids = spark.createDataFrame([(str(i),) for i in range(500)] + [("7",), (None,)], "id string")
    feats = enrich(ids, "id", hashed_track_service, "track", "2024-01-01 00:00:00")
    want = {r["id"] for r in hashed_track_service([str(i) for i in range(500)]) if r}
    got = {r["track_spid"] for r in feats.collect()}
    assert got == want and feats.count() == len(want)          # distinct, empty answers dropped
    assert feats.filter(F.col("track_duration_ms").isNotNull()).count() == 0   # typed null column
    empty = enrich(ids.limit(0), "id", hashed_track_service, "track", "2024-01-01")
    assert empty.count() == 0
    with pytest.raises(ValueError):
        enrich(ids, "id", hashed_track_service, "album", "2024-01-01")


def test_entry_and_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["pid", "rank", "item", "cosine"]
    assert df.count() > 0
    qs, ors = e.queries(), e.oracle_sql()
    assert set(ors) <= set(qs)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_every_query_matches_oracle_small(spark):
    """All registered queries against their DuckDB SQL on the smallest tables."""
    import __spark_entry__ as e
    from scripts.check_oracles import TABLES, _rows
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    bad = []
    for name, sql in e.oracle_sql().items():
        df = e.queries()[name](spark, SF)
        cur = con.execute(sql)
        if _rows(df.columns, df.collect()) != _rows([d[0] for d in cur.description], cur.fetchall()):
            bad.append(name)
    assert bad == []
