"""Postings from a message stream: decoded, gated, dealt to categories, each message once however often it is delivered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata import schemas
from jobstrata.functions.dates import AsOf
from jobstrata.sources.idstore import IdStore
from jobstrata.sources.messages import envelope_rows, stream_gate
from jobstrata.sources.snapshots import SnapshotTable
from jobstrata.streaming.dedup import UniqueSink
from jobstrata.streaming.runs import each_batch, run_to_end


class EnvelopeStream:
    """Messages of a topic as a table below a folder, split by category and extraction day.

    A message is known by topic, partition and offset. A replay, as after a lost checkpoint, meets the places that are kept
    and adds nothing; ``repeats`` counts what came again. Messages outside the known categories, without the
    required fields or of another day than ``as_of`` are left out.
    """

    def __init__(self, spark: SparkSession, root: str, as_of: AsOf = None, required: tuple[str, ...] = ("extract_timestamp", "title", "company")):
        self.spark, self.root = spark, root.rstrip("/")
        self.as_of, self.required = as_of, required
        empty = spark.createDataFrame([], schemas.ENVELOPE)
        self.table = SnapshotTable(spark, f"{self.root}/messages", self.rows(empty).schema, ("category", "extract_date"))
        self.repeats = UniqueSink.repeats_table(spark, f"{self.root}/repeats")

    def rows(self, envelopes: DataFrame) -> DataFrame:
        return stream_gate(envelope_rows(envelopes, schemas.MESSAGE), self.as_of, required=self.required)

    def run(self, envelopes: DataFrame, checkpoint: str) -> DataFrame:
        """Take up what the stream holds and return the table."""
        sink = UniqueSink(
            self.table, "messages", ids=IdStore(self.spark, f"{self.root}/ids"), key="message_id", ts="kafka_timestamp", repeats=self.repeats,
            stem=checkpoint.rstrip("/").rpartition("/")[2],
        )
        run_to_end(each_batch(self.rows(envelopes), sink.apply, checkpoint))
        return self.table.read()
