"""Batched enrichment of ids from an external service.

The reference fetches features for ids that have none yet, 100 tracks or 50
artists per call, 2,500 ids per partition.  Here the ids are deduplicated
and hash-partitioned by Spark; ``mapInPandas`` calls the user's ``fetch``
once per chunk inside each task, drops empty answers and returns typed rows.
Pacing, retries and credentials belong to ``fetch``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setlist.functions.flatten import conform, flatten_artist, prefix_columns
from setlist.session import materialize
from setlist.schemas import ARTIST_FEATURES, ARTIST_RECORD, TRACK_FEATURE_RECORD, TRACK_FEATURES

# Ids per external call, by id kind, and ids per partition.
CALL_SIZE = {"track": 100, "artist": 50}
IDS_PER_PARTITION = 2500
# Partitions at most; beyond it a partition holds more calls, not a job more tasks.
MAX_PARTITIONS = 10_000


def _arrow_safe(records: list[dict], schema: T.StructType) -> pd.DataFrame:
    cols = {f.name: [r.get(f.name) for r in records] for f in schema.fields}
    return pd.DataFrame(cols, columns=schema.fieldNames())


def enrich_batches(ids: DataFrame, id_col: str, fetch: Callable[[list], list],
                   record_schema: T.StructType, call_size: int = 100,
                   ids_per_partition: int = IDS_PER_PARTITION) -> DataFrame:
    """Distinct ids → ``ceil(n / ids_per_partition)`` hash partitions →
    ``fetch`` per chunk of ``call_size`` → non-empty records typed by
    ``record_schema``.

    ``fetch(list_of_ids) -> list[dict | None]``; ``None`` answers are
    dropped (P13).  Empty input gives empty output (D21).
    """
    # Written once: sizing the partitions needs the count, and the distinct
    # over the source would otherwise run twice.
    d = materialize(ids.select(F.col(id_col).alias("_id")).filter(F.col("_id").isNotNull()).distinct())
    n = d.count()
    if n == 0:
        return ids.sparkSession.createDataFrame([], record_schema)
    parts = min(max(1, math.ceil(n / ids_per_partition)), MAX_PARTITIONS)
    d = d.repartition(parts, "_id")

    def run(batches):
        for b in batches:
            vals = b["_id"].tolist()
            for s in range(0, len(vals), call_size):
                got = [r for r in (fetch(vals[s:s + call_size]) or []) if r]
                if got:
                    yield _arrow_safe(got, record_schema)

    # Written before it is returned: later actions read the answers and call nothing again.
    return materialize(d.mapInPandas(run, record_schema))


def enrich_from_table(ids: DataFrame, id_col: str, records: DataFrame, key: str,
                      record_schema: T.StructType) -> DataFrame:
    """B2/B4 against a stored record table: distinct ids joined to ``records``
    by ``key``, ids without a record left out (P13), columns conformed to
    ``record_schema`` (missing ones typed nulls)."""
    wanted = ids.select(F.col(id_col).alias(key)).filter(F.col(key).isNotNull()).distinct()
    return conform(records.join(wanted, key, "left_semi"), record_schema, keep_extra=False)


def track_features_frame(records: DataFrame, time_pulled) -> DataFrame:
    """Records of a track fetch → the track feature table: ``id`` → ``spid``,
    prefix ``track_``, stamp ``time_pulled`` (P9; pass the value for
    repeatable runs), conform to the declared schema (P12)."""
    df = prefix_columns(records, "track_", {"id": "spid"})
    df = df.withColumn("time_pulled", F.lit(time_pulled).cast("timestamp"))
    return conform(df, TRACK_FEATURES, keep_extra=False)


def artist_features_frame(records: DataFrame, time_pulled) -> DataFrame:
    """Records of an artist fetch → the artist feature table."""
    df = records.select(*flatten_artist(F.struct(*[F.col(c) for c in records.columns])))
    df = df.withColumn("time_pulled", F.lit(time_pulled).cast("timestamp"))
    return conform(df, ARTIST_FEATURES, keep_extra=False)


def enrich(ids: DataFrame, id_col: str, fetch: Callable[[list], list], id_type: str,
           time_pulled) -> DataFrame:
    """Typed enrichment for ``id_type`` in {track, artist}."""
    if id_type == "track":
        rec = enrich_batches(ids, id_col, fetch, TRACK_FEATURE_RECORD, CALL_SIZE["track"])
        return track_features_frame(rec, time_pulled)
    if id_type == "artist":
        rec = enrich_batches(ids, id_col, fetch, ARTIST_RECORD, CALL_SIZE["artist"])
        return artist_features_frame(rec, time_pulled)
    raise ValueError(f"id_type must be 'track' or 'artist', not {id_type!r}")


from setlist._workers import ship_by_value  # noqa: E402

ship_by_value(__name__)
