"""Alerts for postings that no earlier batch has seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.functions.messages import alert_payload
from jobstrata.operators.joins import usable
from jobstrata.operators.select import keep_first
from jobstrata.session import adaptive
from jobstrata.sources.idstore import IdStore
from jobstrata.streaming.sinks import batch_key


def alert_rows(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Category as key, alert JSON as value."""
    stamp = F.current_timestamp() if at is None else at
    job = F.struct(*[F.col(c) for c in df.columns])
    return df.select(
        "job_id",
        F.col("category").alias("key"),
        alert_payload(F.col("category"), F.col("title"), F.col("company"), job, stamp).alias("value"),
    )


class AlertSink:
    """``foreachBatch`` handler: alerts per category, ids of what was alerted as history.

    The history is loaded once into buckets. After that a batch reads the buckets of its own ids only.
    """

    def __init__(self, spark: SparkSession, root: str, history: DataFrame, arrival: list[str], compact_every: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.history = history.select("job_id")
        self.arrival = arrival
        self.ids = IdStore(spark, f"{self.root}/ids", compact_every=compact_every)

    def apply(self, df: DataFrame, batch: int) -> None:
        key = batch_key(batch)
        # The ids are written last: with them, the batch is done.
        if self.ids.table.committed(key):
            return
        if not self.ids.table.committed("history"):
            self.ids.add(self.history, "history")
        self.ids.upkeep(batch)
        with adaptive(df.sparkSession):
            first = keep_first(df.filter(usable("job_id")), ["job_id"], self.arrival).persist()
            alerts = alert_rows(self.ids.unseen(first))
            gathered = alerts.hint("rebalance", F.col("key"))
            gathered.write.mode("overwrite").partitionBy("key").json(f"{self.root}/alerts/batch={batch}")
            sent = self.spark.read.schema(alerts.schema).json(f"{self.root}/alerts/batch={batch}")
            self.ids.add(sent, key)
            first.unpersist()
