"""The medallion as chained streams, one table of committed micro-batches per layer."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from jobstrata import schemas, vocab
from jobstrata.functions.dates import AsOf
from jobstrata.operators import quality
from jobstrata.plans import medallion
from jobstrata.sources.files import bronze_lines, bronze_rows
from jobstrata.sources.idstore import IdStore
from jobstrata.sources.snapshots import SnapshotTable
from jobstrata.streaming.dedup import UniqueSink
from jobstrata.streaming.runs import each_batch, run_to_end
from jobstrata.streaming.sinks import RESULTS, LayerSink

# Layers that are split by extraction day on disk.
BY_DAY = ("bronze", "silver_stg", "silver_md")
WARN = {"silver_stg": quality.SILVER_STG_WARN, "silver_md": quality.SILVER_MD_WARN, "gold": quality.GOLD_WARN}


class Domain:
    """The layers of a domain below a folder, brought up to date by ``run``.

    Each layer is a stream with a checkpoint of its own, so a rerun takes up new files only, and a table to which
    every micro-batch is committed once, with few files per day. ``expectations`` holds the passes of
    each rule per layer and batch.
    """

    def __init__(self, spark: SparkSession, target: str, domain: str):
        self.spark, self.domain = spark, domain
        self.base = f"{target.rstrip('/')}/{domain}"
        self.expectations = SnapshotTable(spark, f"{self.base}/_expectations", RESULTS)

    def table(self, layer: str, like: DataFrame | None = None) -> SnapshotTable:
        """A layer's table; only bronze has a schema of its own, the others take that of a frame."""
        schema = schemas.BRONZE_ROW if like is None else like.schema
        return SnapshotTable(self.spark, f"{self.base}/{layer}", schema, ("extract_date",) if layer in BY_DAY else ())

    def run(
        self, source: str, as_of: AsOf = None, unique: bool = False, checks: dict[str, list[quality.Check]] | None = None,
        compact_every: int = 0, max_files: int = vocab.MAX_FILES_PER_TRIGGER,
    ) -> tuple[DataFrame, dict[str, dict[str, int]]]:
        """Gold as a batch frame, and the counts of each layer in this run.

        With ``unique`` the staging layer drops repeats of a posting, however late they come; ``repeats`` counts them.
        ``checks`` per layer stop a micro-batch before anything of it is written. Every ``compact_every``
        batches small files are packed.
        """
        counted: dict[str, dict[str, int]] = {}

        def step(stream: DataFrame, layer: str, table: SnapshotTable, **more) -> DataFrame:
            sink = LayerSink if "ids" not in more else UniqueSink
            handler = sink(
                table, layer, rules=WARN.get(layer), checks=(checks or {}).get(layer), results=self.expectations,
                compact_every=compact_every, **more,
            )
            run_to_end(each_batch(stream, handler.apply, f"{self.base}/_checkpoints/{layer}"))
            counted[layer] = handler.totals
            return table.stream(max_files)

        lines = bronze_lines(self.spark, source, self.domain, stream=True)
        staged = medallion.silver_stg(step(lines, "bronze", self.table("bronze"), prepare=bronze_rows))
        more = {}
        if unique:
            ids = IdStore(self.spark, f"{self.base}/_ids")
            more = {"ids": ids, "key": "job_id", "ts": "extract_ts", "repeats": self.repeats()}
        md = medallion.silver_md(step(staged, "silver_stg", self.table("silver_stg", staged), **more))
        gold = medallion.gold(step(md, "silver_md", self.table("silver_md", md)), as_of)
        table = self.table("gold", gold)
        step(gold, "gold", table)
        return table.read(), counted

    def repeats(self) -> SnapshotTable:
        return UniqueSink.repeats_table(self.spark, f"{self.base}/_repeats")


def run_domain(
    spark: SparkSession, source: str, target: str, domain: str, as_of: AsOf = None, unique: bool = False,
    report: dict[str, dict[str, int]] | None = None, **options,
) -> DataFrame:
    """Bring all layers of a domain up to date and return the gold layer as a batch frame.

    ``report`` receives the rows and the passes of each expectation per layer of this run.
    """
    gold, counted = Domain(spark, target, domain).run(source, as_of, unique, **options)
    if report is not None:
        report.update(counted)
    return gold


def run_all(spark: SparkSession, source: str, target: str, as_of: AsOf = None, **options) -> DataFrame:
    """All domains to gold, then their union.

    The domains share nothing but the session, so their chains run side by side and fill the cluster together.
    """
    with ThreadPoolExecutor(len(vocab.DOMAINS)) as pool:
        runs = {d: pool.submit(run_domain, spark, source, target, d, as_of, **options) for d in vocab.DOMAINS}
        return medallion.gold_all({d: run.result() for d, run in runs.items()})
