"""Job ledger as an append-only event table folded to the latest task state.

Opening a task appends an ``open`` event (only for known source names);
completing appends a ``complete`` event.  State per task id: start = first
open, completion = last complete at or after the start (a completion for an
unknown id changes nothing), progress = COMPLETE once a completion exists.
One aggregation, partial on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IN_PROGRESS = "IN PROGRESS"
COMPLETE = "COMPLETE"
TASK_KIND = "crawler"


def ledger_open(requests: DataFrame, sources: DataFrame, id_col: str = "_id", name_col: str = "name",
                ts_col: str = "ts") -> DataFrame:
    """Open events for requests whose name is a known source (semi-join gate).

    Requests without an ``id_col`` column get a random id; store the events before they are used twice."""
    if id_col not in requests.columns:
        requests = requests.withColumn(id_col, F.expr("uuid()"))
    ok = requests.join(sources.select(F.col("name").alias(name_col)), name_col, "left_semi")
    return ok.select(F.col(id_col).cast("string").alias("_id"), F.lit("open").alias("event"),
                     F.col(ts_col).alias("ts"), F.col(name_col).alias("name"))


def ledger_complete(completions: DataFrame, id_col: str = "_id", ts_col: str = "ts") -> DataFrame:
    return completions.select(F.col(id_col).cast("string").alias("_id"), F.lit("complete").alias("event"),
                              F.col(ts_col).alias("ts"), F.lit(None).cast("string").alias("name"))


def ledger_state(events: DataFrame) -> DataFrame:
    """Fold (_id, event, ts, name) events to one task row per opened id."""
    opened = F.when(F.col("event") == "open", F.col("ts"))
    task = events.groupBy("_id").agg(
        F.min(opened).alias("start_time"), F.min_by("name", opened).alias("name"),
        F.max(F.when(F.col("event") == "complete", F.col("ts"))).alias("_last"))
    done = F.when(F.col("_last") >= F.col("start_time"), F.col("_last"))
    return task.where(F.col("start_time").isNotNull()).select(
        "_id", F.when(done.isNull(), F.lit(IN_PROGRESS)).otherwise(F.lit(COMPLETE)).alias("progress"),
        "start_time", done.alias("completion"), F.lit(TASK_KIND).alias("task"), "name")
