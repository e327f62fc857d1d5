"""Calls of bounded size, nothing asked twice, failing calls lose their own ids only."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from setlist._workers import ship_by_value
from setlist.operators.ledger import enrich_with_ledger, ledger_schema, report

ship_by_value(__name__)
RECORD = "id string, size int"


@pytest.fixture()
def schema(spark):
    return spark.createDataFrame([], RECORD).schema


def service(log, fails):
    """Answers from the id; notes every call in ``log``; ``fails(ids)`` breaks it."""
    def fetch(ids):
        with open(os.path.join(log, f"{os.getpid()}-{os.urandom(6).hex()}"), "w") as f:
            f.write("\n".join(ids))
        if fails(ids):
            raise TimeoutError("busy")
        return [None if i.endswith("7") else {"id": i, "size": len(i)} for i in ids]
    return fetch


def calls(log):
    return [open(f).read().split("\n") for f in glob.glob(os.path.join(log, "*"))]


def test_nothing_is_asked_twice(spark, tmp_dir, schema):
    log, path = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "ledger")
    os.makedirs(log)
    ids = spark.range(900).select(F.concat(F.lit("t"), F.col("id") % 600).alias("track")).union(spark.createDataFrame([(None,)], "track string"))
    run = lambda df, fetch, **kw: enrich_with_ledger(df, "track", fetch, schema, path, call_size=10, ids_per_partition=70, wave_ids=200, **kw)
    # The call that holds t5 fails every time, every other one goes well.
    got = run(ids.where("track != 't599'"), service(log, lambda c: "t5" in c), attempts=2)
    done = {r["id"] for r in got.collect()}
    failed = {i for c in calls(log) if "t5" in c for i in c}
    assert max(map(len, calls(log))) <= 10 and "t5" in failed
    assert done == {f"t{i}" for i in range(599) if i % 10 != 7} - failed
    often = [i for c in calls(log) for i in c]
    assert all(often.count(i) == 1 for i in {f"t{i}" for i in range(599)} - failed)
    state = {r["status"]: r["n_ids"] for r in report(spark, path, ledger_schema(ids.schema["track"].dataType, schema)).collect()}
    assert state["failed"] >= 1 and sum(state.values()) == 599
    # The next run asks for what is left and for the new id.
    for f in glob.glob(os.path.join(log, "*")):
        os.remove(f)
    again = run(ids, service(log, lambda c: False))
    left = {i for c in calls(log) for i in c}
    assert {"t599", "t5"} <= left <= failed | {"t599"}
    assert {(r["id"], r["size"]) for r in again.collect()} == {(f"t{i}", len(f"t{i}")) for i in range(600) if i % 10 != 7}
    run(ids, service(log, lambda c: True))
    assert {i for c in calls(log) for i in c} == left  # a settled ledger makes no call


def test_stored_records_come_to_the_call(spark, tmp_dir, schema):
    records = spark.range(300).select(F.col("id").cast("string").alias("id"), F.col("id").cast("int").alias("size"), F.lit("x").alias("extra"))
    ids = spark.range(0, 600, 2).select(F.col("id").cast("string").alias("k"))
    def fetch(call, rows):
        assert len(call) <= 20
        by = dict(zip(rows["id"], rows["size"]))
        return [{"id": i, "size": by[i]} if i in by else None for i in call]
    got = enrich_with_ledger(ids, "k", fetch, schema, tmp_dir + "/l", call_size=20, ids_per_partition=50, records=records, record_key="id")
    assert {(r["id"], r["size"]) for r in got.collect()} == {(str(i), i) for i in range(0, 300, 2)}
    assert enrich_with_ledger(ids.limit(0), "k", fetch, schema, tmp_dir + "/none", records=records, record_key="id").count() == 0
