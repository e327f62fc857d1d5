"""Enrichment that asks for nothing twice.

Ids go out in calls of ``call_size``; what comes back is appended to a ledger,
one row per id: a record (``found``), the news that there is none (``none``),
or the error of its call (``failed``).  Ids that the ledger settles are not
asked again, by this run or a later one.  A failing call fails its own
ids only: the others of its task are kept, and its ids are asked
again, up to ``attempts`` times a run.

Calls are made in waves of ``wave_ids`` ids, each committed before the next
begins, so a lost job loses one wave and a lost executor the open
tasks of one.  There are at most ``MAX_WAVES`` waves a run, so that a wave's own cost
stays small beside its calls: more ids make larger waves.  Ids and stored records are
laid out by wave once, a wave reads its own.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setlist._workers import ship_by_value
from setlist.operators.dedup import dedup_any
from setlist.operators.enrich import IDS_PER_PARTITION
from setlist.session import materialize
from setlist.sources.readers import read_or_empty

ship_by_value(__name__)

#: Ids of one wave: 10,000 tasks of 2,500 ids.
WAVE_IDS = 25_000_000
#: Waves of a run at most.
MAX_WAVES = 64
FOUND, NONE, FAILED = "found", "none", "failed"


def ledger_schema(id_type: T.DataType, record_schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("_id", id_type), T.StructField("_status", T.StringType()),
                         T.StructField("_error", T.StringType()), *record_schema.fields])


def settled(spark: SparkSession, ledger: str, schema: T.StructType) -> DataFrame:
    """Ledger rows of ids that need no call any more: one per id."""
    return dedup_any(read_or_empty(spark, ledger, schema).where(F.col("_status") != FAILED), ["_id"])


def report(spark: SparkSession, ledger: str, schema: T.StructType) -> DataFrame:
    """``(status, n_ids, n_rows)``: ids by how they stand now, ledger rows behind them."""
    rows = read_or_empty(spark, ledger, schema)
    best = rows.groupBy("_id").agg(F.min(F.when(F.col("_status") == FAILED, 1).otherwise(0)).alias("bad"),
                                   F.max(F.when(F.col("_status") != FAILED, F.col("_status"))).alias("s"), F.count(F.lit(1)).alias("c"))
    return (best.groupBy(F.when(F.col("bad") == 1, FAILED).otherwise(F.col("s")).alias("status"))
            .agg(F.count(F.lit(1)).alias("n_ids"), F.sum("c").alias("n_rows")))


def _asked(fetch: Callable, vals: list, rows: pd.DataFrame | None, fields: list[str], call_size: int) -> pd.DataFrame:
    out = {c: [] for c in ["_id", "_status", "_error", *fields]}
    for s in range(0, len(vals), call_size):
        call, error = vals[s:s + call_size], None
        try:
            got = fetch(call) if rows is None else fetch(call, rows)
            got = list(got or [])
            got += [None] * (len(call) - len(got))
        except Exception as e:  # the call's ids are asked again; a broken task would repeat the calls that went well
            got, error = [None] * len(call), f"{type(e).__name__}: {e}"
        for i, record in zip(call, got):
            out["_id"].append(i)
            out["_status"].append(FAILED if error else FOUND if record else NONE)
            out["_error"].append(error)
            for c in fields:
                out[c].append((record or {}).get(c))
    return pd.DataFrame(out, dtype=object)


def enrich_with_ledger(ids: DataFrame, id_col: str, fetch: Callable, record_schema: T.StructType, ledger: str, *,
                       call_size: int = 100, ids_per_partition: int = IDS_PER_PARTITION, wave_ids: int = WAVE_IDS,
                       attempts: int = 3, records: DataFrame | None = None, record_key: str | None = None) -> DataFrame:
    """Records of the distinct non-null ids, from the ledger at ``ledger`` and, for
    ids it does not settle, from ``fetch``.

    ``fetch(ids) -> list[dict | None]``, one answer for each id in order.  With
    ``records``, a stored table with ``record_key``, it is ``fetch(ids, rows)``:
    the rows of its ids, as pandas, are brought to the call.  Ids whose calls
    failed to the end have no record; ``report`` counts them and the next run
    asks them again.  No ids give no records and no ledger."""
    spark, kind = ids.sparkSession, ids.schema[id_col].dataType
    schema = ledger_schema(kind, record_schema)
    asked = materialize(ids.select(F.col(id_col).alias("_id")).where(F.col("_id").isNotNull()).distinct())
    for _ in range(attempts):
        todo = materialize(asked.join(settled(spark, ledger, schema).select("_id"), "_id", "left_anti"))
        n = todo.count()
        if n == 0:
            break
        waves = min(math.ceil(n / wave_ids), MAX_WAVES)
        tasks = math.ceil(n / waves / ids_per_partition)
        slot = F.pmod(F.xxhash64("_id"), F.lit(waves * tasks)).alias("_slot")
        mine, near = todo.select("_id", slot), None
        if records is not None:
            near = records.withColumn("_id", F.col(record_key).cast(kind)).join(todo, "_id", "left_semi").select("*", slot).drop("_id")
        if waves > 1:
            mine, near = _by_wave(mine, waves), None if near is None else _by_wave(near, waves)
        for w in range(waves):  # a wave takes every waves-th slot
            here = [d if d is None or waves == 1 else d.where(F.col("_wave") == w).drop("_wave") for d in (mine, near)]
            _answers(here[0], fetch, schema, call_size, tasks, here[1]).write.mode("append").parquet(ledger)
    found = settled(spark, ledger, schema).where(F.col("_status") == FOUND).join(asked, "_id", "left_semi")
    return found.select(*record_schema.fieldNames())


#: Files that the rows of a wave are spread over.
SPREAD = 8


def _by_wave(rows: DataFrame, waves: int) -> DataFrame:
    wave = F.col("_slot") % waves
    return materialize(rows.withColumn("_wave", wave.cast("int")).repartition(
        "_wave", F.pmod(F.floor(F.col("_slot") / waves), F.lit(SPREAD))), by="_wave")


def _answers(mine: DataFrame, fetch: Callable, schema: T.StructType, call_size: int, tasks: int, near: DataFrame | None) -> DataFrame:
    fields = schema.names[3:]
    if near is None:
        def run(batches):
            for b in batches:
                if len(b):
                    yield _asked(fetch, b["_id"].tolist(), None, fields, call_size)
        return mine.repartition(tasks, "_slot").select("_id").mapInPandas(run, schema)

    def call(ids, rows):
        return _asked(fetch, ids["_id"].tolist(), rows.drop(columns="_near"), fields, call_size)

    return (mine.groupBy("_slot").cogroup(near.withColumnRenamed("_slot", "_near").groupBy("_near"))
            .applyInPandas(call, schema))
