"""Notification feed: what is new, what to send, what was answered.

Tables are folders of Parquet files, appended one cycle at a time:

* ``outbox/cycle=``  messages of a cycle
* ``sent/cycle=``    log of what was notified
* ``mark/cycle=``    how far the feed has come
* ``responses/cycle=``  accepted replies

A cycle writes them in that order and then one name into ``commits/``, which makes all of them count at once. Readers take
committed cycles only, so a cycle that stopped halfway has sent nothing and moved no mark; run again, it overwrites its
folders. Ids of committed cycles are kept in buckets for the anti join, which then reads little of a long sent log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata import schemas, vocab
from jobstrata.functions.dates import AsOf, as_timestamp
from jobstrata.functions.location import city_matches
from jobstrata.functions.messages import notification_text, numbered_text, parse_reply
from jobstrata.operators.joins import attach_lookup, latest_lookup, narrow_history, not_in, usable
from jobstrata.operators.select import keep_first
from jobstrata.sources.idstore import IdStore
from jobstrata.sources.snapshots import Folder

FEED_COLUMNS = [
    "domain", "job_id", "title", "company", "work_modality", "country", "state", "city", "posted_time_ts", "url"
]


def current_mark(state: DataFrame, as_of: AsOf = None, lookback: str = f"{vocab.FEED_LOOKBACK_HOURS} HOURS") -> DataFrame:
    """One row: the last mark, or ``as_of`` less the default look-back when there is none."""
    return state.agg(
        F.coalesce(F.max("last_posted_time_ts"), as_timestamp(as_of) - F.expr(f"INTERVAL {lookback}")).alias("since")
    )


def candidates(gold_all: DataFrame, since: Column, place: Column | None = None, slack: str = "0 HOURS") -> DataFrame:
    """Postings newer than the mark.

    ``slack`` looks further back than the mark, so that a row that arrives late is still
    found; the anti join with what was sent is what keeps notified rows out.
    """
    bound = since - F.expr(f"INTERVAL {slack}")
    newer = F.col("effective_posted_time") > bound
    if {"posted_time_ts", "ingestion_timestamp"} <= set(gold_all.columns):
        # The effective time spelled out over stored columns, a form that reaches the scan.
        posted, ingested = F.col("posted_time_ts"), F.col("ingestion_timestamp")
        newer = (posted > bound) | (posted.isNull() & (ingested > bound))
    rows = gold_all.filter(newer & (city_matches(F.col("city")) if place is None else place))
    return rows.withColumn("posted_time_ts", F.col("effective_posted_time")).select(*FEED_COLUMNS)


def pending(
    gold_all: DataFrame, sent: DataFrame, since: Column, place: Column | None = None, slack: str = "0 HOURS"
) -> DataFrame:
    """Postings newer than the mark that were never notified."""
    rows = candidates(gold_all, since, place, slack)
    return not_in(rows, narrow_history(sent, rows, "job_id"), ["job_id"])


def ordered(feed: DataFrame, n: int | None = None) -> DataFrame:
    out = feed.orderBy(F.asc("posted_time_ts"), F.asc("job_id"))
    return out if n is None else out.limit(n)


def with_message(feed: DataFrame) -> DataFrame:
    c = F.col
    blank = lambda name: F.coalesce(c(name), F.lit(""))
    return feed.withColumn(
        "message",
        notification_text(
            c("job_id"), blank("title"), blank("company"), blank("work_modality"), c("posted_time_ts"), blank("url")
        ),
    )


def numbered_feed(feed: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of the feed with their position and the number of rows in the text.

    The feed is cut to ``n`` rows before it is numbered in one task.
    """
    c = F.col
    blank = lambda name: F.coalesce(c(name), F.lit(""))
    first = ordered(feed, n)
    everything = Window.partitionBy()
    position = F.row_number().over(everything.orderBy(F.asc("posted_time_ts"), F.asc("job_id")))
    text = numbered_text(
        position, F.count("*").over(everything), blank("domain"), blank("title"), blank("company"),
        blank("work_modality"), c("job_id"), blank("url"),
    )
    return first.withColumn("message", text)


def sent_rows(feed: DataFrame, at: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if at is None else at
    return feed.withColumn("notified_ts", stamp).select(
        *[F.col(f.name).cast(f.dataType) for f in schemas.SENT.fields]
    )


def match_replies(
    replies: DataFrame, latest_sent: DataFrame, at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected replies. ``replies`` has ``sender`` and ``message``.

    ``latest_sent`` holds one row per id. A posting that draws a large share of all replies
    is split over tasks by the lookup join.
    """
    parsed = replies.withColumn("_reply", parse_reply(F.col("message"))).filter("_reply.valid").select(
        *replies.columns, F.col("_reply.decision").alias("decision"), F.col("_reply.job_id").alias("job_id")
    )
    stamp = F.current_timestamp() if at is None else at
    accepted = (
        attach_lookup(parsed, latest_sent, ["job_id"], ["title", "company", "work_modality", "url"], "inner")
        .withColumn("decision_ts", stamp)
        .withColumn("responder", F.col("sender"))
        .select(*[F.col(f.name).cast(f.dataType) for f in schemas.RESPONSES.fields])
    )
    return accepted, not_in(parsed, latest_sent, ["job_id"])


class FeedStore:
    """The feed's tables below one folder that all executors can reach."""

    def __init__(self, spark: SparkSession, root: str, compact_every: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.folder = Folder(spark, self.root)
        self.ids = IdStore(spark, f"{self.root}/ids", compact_every=compact_every)

    # Commits: the name of a file says which tables of which cycle count.
    def committed(self, table: str) -> list[int]:
        """Cycles of a table that count."""
        names = [x.split(".") for x in self.folder.names("commits") if not x.startswith(".")]
        return sorted({int(cycle) for cycle, tables, *_ in names if table in tables.split("+")})

    def _commit(self, cycle: int, *tables: str) -> None:
        name = f"commits/{cycle:012d}.{'+'.join(tables)}"
        if not self.folder.exists(name):
            self.folder.write(name, "")

    def _read(self, table: str, schema: T.StructType, cycles: list[int] | None = None) -> DataFrame:
        keyed = T.StructType(schema.fields + [T.StructField("cycle", T.LongType())])
        known = self.committed(table) if cycles is None else cycles
        if not known:
            return self.spark.createDataFrame([], keyed)
        return self.spark.read.schema(keyed).parquet(f"{self.root}/{table}").filter(F.col("cycle").isin(known))

    def _write(self, df: DataFrame, table: str, cycle: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{table}/cycle={cycle}")

    def sent(self) -> DataFrame:
        return self._read("sent", schemas.SENT)

    def log_sent(self, rows: DataFrame, cycle: int) -> None:
        self._write(rows, "sent", cycle)
        self._commit(cycle, "sent")

    def responses(self) -> DataFrame:
        return self._read("responses", schemas.RESPONSES).drop("cycle")

    def outbox(self, cycle: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/outbox/cycle={cycle}")

    def state(self, before: int | None = None) -> DataFrame:
        """The mark written last (or last before a cycle), as a table of at most one row."""
        marks = self._read("mark", schemas.STATE)
        if before is not None:
            marks = marks.filter(F.col("cycle") < before)
        return marks.agg(F.max_by("last_posted_time_ts", "cycle").alias("last_posted_time_ts")).filter(
            "last_posted_time_ts IS NOT NULL"
        )

    def _write_mark(self, mark: DataFrame, cycle: int) -> None:
        self._write(mark.select(F.col("last_posted_time_ts").cast("timestamp")), "mark", cycle)

    def set_mark(self, mark: DataFrame, cycle: int) -> None:
        """Replace the mark: the newest cycle wins, older ones stay as history."""
        self._write_mark(mark, cycle)
        self._commit(cycle, "mark")

    def reset_mark(self, to: AsOf, cycle: int) -> None:
        """Set the mark by hand, backwards too."""
        self.set_mark(self.spark.range(1).select(as_timestamp(to).alias("last_posted_time_ts")), cycle)

    def _settle(self) -> None:
        """Bring the ids up to the committed cycles; a cycle may have stopped right after its commit."""
        for cycle in self.committed("sent"):
            key = f"cycle-{cycle}"
            if not self.ids.table.committed(key):
                self.ids.add(self._read("sent", schemas.SENT, [cycle]), key)
                self.ids.upkeep(cycle)

    def poll(
        self, gold_all: DataFrame, cycle: int, as_of: AsOf = None, place: Column | None = None,
        lookback: str = f"{vocab.FEED_LOOKBACK_HOURS} HOURS", slack: str = "0 HOURS", replies: DataFrame | None = None,
    ) -> DataFrame:
        """Run one cycle and return its outbox; cycles run in rising order.

        The mark is one value, read on the driver so that the time filter is a constant that
        reaches the scan. What an earlier attempt at this cycle left behind does not count, and a cycle that is
        committed is not run again. ``replies`` to what was sent before become part of the cycle.
        """
        if cycle in self.committed("outbox"):
            return self.outbox(cycle)
        self._settle()
        since = F.lit(current_mark(self.state(before=cycle), as_of, lookback).first()["since"])
        # Kept: the candidates are looked up in the ids and joined with them.
        rows = keep_first(candidates(gold_all, since, place, slack), ["job_id"], ["posted_time_ts", "url"]).persist()
        # A posting without an id was never sent before, as far as anyone can tell.
        fresh = self.ids.unseen(rows).unionByName(rows.filter(~F.coalesce(usable("job_id"), F.lit(False))))
        self._write(with_message(fresh), "outbox", cycle)
        rows.unpersist()
        outbox = self.outbox(cycle)
        self._write(sent_rows(outbox), "sent", cycle)
        # A look-back may send old rows only; the mark never moves back by itself.
        sent_now = outbox.select(F.col("posted_time_ts").alias("last_posted_time_ts"))
        newest = sent_now.unionByName(self.state(before=cycle)).agg(F.max("last_posted_time_ts").alias("last_posted_time_ts"))
        self._write_mark(newest.filter("last_posted_time_ts IS NOT NULL"), cycle)
        tables = ["outbox", "sent", "mark"]
        if replies is not None:
            self._write(self._matched(replies)[0], "responses", cycle)
            tables.append("responses")
        self._commit(cycle, *tables)
        self._settle()
        return outbox

    def _matched(self, replies: DataFrame) -> tuple[DataFrame, DataFrame]:
        return match_replies(replies, latest_lookup(self.sent().drop("cycle"), "job_id", "notified_ts", ["url"]))

    def record_replies(self, replies: DataFrame, cycle: int) -> DataFrame:
        """Store the valid replies to notified postings; returns the rejected ones."""
        accepted, rejected = self._matched(replies)
        self._write(accepted, "responses", cycle)
        self._commit(cycle, "responses")
        return rejected
