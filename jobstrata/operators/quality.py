"""Expectations, profiles, thresholds and audits."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from jobstrata import vocab
from jobstrata.operators.select import per_key
from jobstrata.session import materialize

Rules = dict[str, str]

# Rule texts per layer.
SILVER_STG_WARN: Rules = {
    "job_id_not_null": "job_id IS NOT NULL",
    "title_not_null": "title IS NOT NULL",
    "company_not_null": "company IS NOT NULL",
    "location_not_null": "location IS NOT NULL",
}
SILVER_MD_WARN: Rules = {
    "unique_job_id": "job_id IS NOT NULL",
    "valid_location": "location IS NOT NULL AND length(location) > 2",
}
SILVER_MD_DROP: Rules = {
    "no_empty_fields": "(job_id IS NOT NULL AND job_id != '') AND (title IS NOT NULL AND title != '')"
}
GOLD_WARN: Rules = {
    "has_job_id": "job_id IS NOT NULL",
    "has_ingestion_ts": "ingestion_timestamp IS NOT NULL",
}
GOLD_DROP: Rules = {"unique_job_id_gold": "job_id IS NOT NULL AND job_id != ''"}
JOBS_BRONZE_WARN: Rules = {
    "valid_job_id": "job_id IS NOT NULL AND LENGTH(job_id) > 0",
    "valid_title": "title IS NOT NULL AND LENGTH(title) > 0",
    "valid_company": "company IS NOT NULL",
    "valid_extract_date": "extract_date IS NOT NULL",
}
JOBS_SILVER_WARN: Rules = {
    "valid_title": "title IS NOT NULL",
    "valid_company": "company IS NOT NULL",
    "valid_city": "city IS NOT NULL",
    "valid_country": "country IS NOT NULL",
    "valid_seniority": "seniority_level IN ('Junior', 'Pleno', 'Senior', 'Lead', 'Principal')",
}


def passes(rule: str) -> Column:
    """A rule that evaluates to NULL has failed."""
    return F.coalesce(F.expr(rule), F.lit(False))


def expectation_report(df: DataFrame, rules: Rules) -> DataFrame:
    """Passed and failed rows per rule, counted in one pass over the data."""
    names = list(rules)
    counts = df.agg(
        F.count("*").alias("_total"),
        *[F.count_if(passes(rules[n])).alias(f"_p{i}") for i, n in enumerate(names)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("rule"),
                F.col(f"_p{i}").alias("passed"),
                (F.col("_total") - F.col(f"_p{i}")).alias("failed"),
            )
            for i, n in enumerate(names)
        ]
    )
    return counts.select(F.inline(rows))


def watch(df: DataFrame, rules: Rules, observation: Observation | str) -> DataFrame:
    """The same rows, with passes per rule counted while they flow by.

    Needs no second pass over the data and works on streams, where the counts appear in the
    query's progress under the observation's name. ``total`` counts all rows.
    """
    counts = [F.count_if(passes(rule)).alias(name) for name, rule in rules.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("total"), *counts)


def keep_valid(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that pass every rule.

    A filter drops rows whose rule is NULL anyway, so the rules stay bare and reach the scan.
    """
    return df.filter(reduce(lambda a, b: a & b, [F.expr(r) for r in rules.values()]))


@dataclass(frozen=True)
class Check:
    """A rule with its severity. ``unique`` rules name a column instead of a condition."""

    name: str
    rule: str
    action: str = "WARN"
    unique: bool = False


class ExpectationFailed(Exception):
    """A FAIL check found violating rows."""


def layer_checks(layer: str, as_of: str | None = None) -> list[Check]:
    """Checks per layer; recency is relative to ``as_of``."""
    today = f"DATE'{as_of}'" if as_of else "current_date()"
    # Rules and severities per layer.
    checks = [
        Check("job_id_not_null", "job_id IS NOT NULL", "FAIL"),
        Check("title_not_empty", "title IS NOT NULL AND LENGTH(title) > 0", "FAIL"),
    ]
    if layer == "silver":
        checks += [
            Check("company_not_null", "company IS NOT NULL", "WARN"),
            Check("extract_date_recent", f"extract_date >= {today} - INTERVAL 30 DAYS", "WARN"),
            Check("unique_job_id", "job_id", "FAIL", unique=True),
        ]
    if layer == "gold":
        checks += [
            Check("quality_score_range", "data_quality_score BETWEEN 0 AND 1", "WARN"),
            Check("valid_records_only", "is_valid = true", "FAIL"),
        ]
    return checks


def check_report(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Name, action and number of violating rows per check.

    A uniqueness check counts the rows beyond the first of each value: non-NULL values minus
    distinct values, which needs no group to be gathered anywhere.
    """
    aggs = []
    for i, c in enumerate(checks):
        if c.unique:
            aggs.append((F.count(c.rule) - F.count_distinct(F.col(c.rule))).alias(f"_v{i}"))
        else:
            aggs.append(F.count_if(~passes(c.rule)).alias(f"_v{i}"))
    rows = F.array(
        *[
            F.struct(F.lit(c.name).alias("rule"), F.lit(c.action).alias("action"), F.col(f"_v{i}").alias("violations"))
            for i, c in enumerate(checks)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows))


def enforce(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Raise if a FAIL check is violated, else return ``df`` unchanged.

    This is an action: it reads one row per check.
    """
    broken = [r for r in check_report(df, checks).collect() if r.action == "FAIL" and r.violations > 0]
    if broken:
        raise ExpectationFailed(", ".join(f"{r.rule}: {r.violations} rows" for r in broken))
    return df


def null_profile(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Row count, NULL count and NULL percentage (two digits) of the named columns.

    ``columns`` maps a column to the stem of its output names.
    """
    total = F.count("*")
    nulls = {stem: F.count_if(F.col(c).isNull()) for c, stem in columns.items()}
    return df.agg(
        total.alias("total_records"),
        *[n.alias(f"null_{stem}s") for stem, n in nulls.items()],
        *[F.round(F.try_divide(n * 100.0, total), 2).alias(f"null_{stem}_pct") for stem, n in nulls.items()],
    )


def column_frequencies(df: DataFrame, columns: list[str] | None = None, digest: bool = False) -> DataFrame:
    """How often each value of each column occurs, as ``column, value, n``.

    One scan and one shuffle serve all columns, and counts are combined before the shuffle.
    With ``digest`` values longer than a SHA-256 digest are replaced by theirs, which is
    enough to count them and keeps long texts out of the shuffle.
    """
    columns = columns or df.columns
    digested = [f.name for f in df.schema.fields if digest and f.dataType.typeName() == "string"]

    def value(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.when(F.length(text) > 64, F.sha2(text, 256)).otherwise(text) if c in digested else text

    pairs = F.array(*[F.struct(F.lit(c).alias("column"), value(c).alias("value")) for c in columns])
    return df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count("*").alias("n"))


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL and distinct counts and ratios per column, exact.

    Columns that are at least 90 % NULL report no distinct values.
    """
    stats = (
        column_frequencies(df, columns, digest=True)
        .groupBy("column")
        .agg(
            F.sum("n").alias("total_rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
            F.count("value").alias("_distinct"),
        )
    )
    return _ratios(stats)


def profile_approx(df: DataFrame, columns: list[str] | None = None, rsd: float = 0.05) -> DataFrame:
    """As ``profile`` with estimated distinct counts: one aggregate row, hardly any shuffle."""
    columns = columns or df.columns
    counted = df.agg(
        F.count("*").alias("_total"),
        *[F.count(c).alias(f"_c{i}") for i, c in enumerate(columns)],
        *[F.approx_count_distinct(c, rsd).alias(f"_d{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col("_total").alias("total_rows"),
                (F.col("_total") - F.col(f"_c{i}")).alias("null_count"),
                F.col(f"_d{i}").alias("_distinct"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return _ratios(counted.select(F.inline(rows)))


def _ratios(stats: DataFrame) -> DataFrame:
    ratio = F.coalesce(F.try_divide(F.col("null_count"), F.col("total_rows")), F.lit(0.0))
    looked_at = F.when(ratio < 0.9, F.col("_distinct")).otherwise(F.lit(0))
    return stats.select(
        "column",
        "total_rows",
        "null_count",
        ratio.alias("null_ratio"),
        looked_at.alias("distinct_count"),
        F.coalesce(F.try_divide(looked_at, F.col("total_rows")), F.lit(0.0)).alias("unique_ratio"),
    )


# Longer values are counted by their first characters and a digest.
SHORT = 64


def _parts(c: str) -> tuple[Column, Column]:
    """A value as its start, which orders it, and the digest of a longer one."""
    return F.substring(c, 1, SHORT), F.when(F.length(c) > SHORT, F.sha2(c, 256))


def top_starts(df: DataFrame, columns: list[str], n: int, max_unique_ratio: float) -> DataFrame:
    """The candidates of ``top_values`` as ``column, start, digest, n``: those that may be among the first ``n``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), *[x.alias(k) for x, k in zip(_parts(c), ("start", "digest"))]) for c in columns])
    freq = df.select(F.inline(pairs)).groupBy("column", "start", "digest").agg(F.count("*").alias("n"))
    # One row per profiled column, so this side is bounded by the width of the schema.
    repeated = freq.groupBy("column").agg(
        F.sum("n").alias("_total"), F.count("start").alias("_distinct")
    ).filter(F.col("_distinct") < F.col("_total") * max_unique_ratio)
    # NULL sorts last and is dropped only after ranking: a filter before it would be pushed
    # below the counts, and the two branches could no longer share one shuffle.
    # Values with one start tie here, so all of them are candidates.
    place = F.rank().over(Window.partitionBy("column").orderBy(F.isnull("start"), F.desc("n"), F.asc("start")))
    ranked = freq.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")
    return ranked.join(F.broadcast(repeated.select("column")), "column").filter(F.col("start").isNotNull())


def top_values(
    df: DataFrame, columns: list[str] | None = None, n: int = 10, max_unique_ratio: float = 0.1
) -> DataFrame:
    """Most frequent values of the string columns that repeat enough, as ``column, value, freq``; ties go by value.

    Values are counted by start and digest, so no long text crosses a shuffle. The texts behind the digests that may be
    among the first ``n`` are looked up in a second pass, if there are any.
    """
    strings = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    columns = [c for c in (columns or strings) if c in strings]
    first = materialize(top_starts(df, columns, n, max_unique_ratio), "top_values")
    short = first.filter("digest IS NULL").select("column", F.col("start").alias("value"), "n")
    wanted = first.filter("digest IS NOT NULL")
    found = [r["column"] for r in wanted.select("column").distinct().collect()]
    if found:
        texts = F.array(*[F.struct(F.lit(c).alias("column"), _parts(c)[1].alias("digest"), F.col(c).alias("value")) for c in found])
        meant = df.select(F.inline(texts)).filter("digest IS NOT NULL").join(wanted.select("column", "digest", "n"), ["column", "digest"])
        whole = meant.groupBy("column", "digest").agg(F.min("value").alias("value"), F.min("n").alias("n"))
        short = short.unionByName(whole.select("column", "value", "n"))
    return per_key(short, ["column"], [F.desc("n"), F.asc("value")], n).select("column", "value", F.col("n").alias("freq"))


def duplicate_audit(df: DataFrame, keys: list[str]) -> DataFrame:
    """Occurrences of every key that occurs more than once."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("occurrences"))
        .filter(F.col("occurrences") > 1)
        .withColumn("is_duplicated", F.lit(True))
    )


def layer_ratios(df: DataFrame, key: list[str], required: list[str]) -> DataFrame:
    """Worst NULL ratio, duplicate ratio and completeness of a layer, in one row."""
    total = F.count("*")
    worst = F.greatest(*[F.count_if(F.col(c).isNull()) for c in required]) if len(required) > 1 else F.count_if(
        F.col(required[0]).isNull()
    )
    complete = F.count_if(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required]))
    ids = F.count_distinct(F.struct(*[F.col(k) for k in key]))
    return df.agg(
        total.alias("total"), worst.alias("_nulls"), complete.alias("_complete"), ids.alias("_ids")
    ).select(
        "total",
        F.try_divide("_nulls", "total").alias("null_ratio"),
        F.try_divide(F.col("total") - F.col("_ids"), F.col("total")).alias("duplicate_ratio"),
        F.try_divide("_complete", "total").alias("completeness"),
    )


def threshold_check(ratios: dict[str, DataFrame]) -> DataFrame:
    """One row per threshold of each layer: metric, value, limit and whether it holds.

    ``ratios`` has the ratio row of each layer.
    """
    return reduce(DataFrame.unionByName, [_layer_thresholds(row, layer) for layer, row in ratios.items()])


def _layer_thresholds(ratios: DataFrame, layer: str) -> DataFrame:
    # Which metric a threshold bounds, and from which side.
    sides = {
        "max_null_ratio": ("null_ratio", True),
        "max_duplicate_ratio": ("duplicate_ratio", True),
        "min_completeness": ("completeness", False),
    }
    rows = []
    for name, limit in vocab.LAYER_THRESHOLDS[layer].items():
        metric, upper = sides[name]
        value = F.col(metric)
        rows.append(
            F.struct(
                F.lit(layer).alias("layer"),
                F.lit(metric).alias("metric"),
                value.alias("value"),
                F.lit(limit).alias("threshold"),
                (value <= limit if upper else value >= limit).alias("ok"),
            )
        )
    return ratios.select(F.inline(F.array(*rows)))


def expectation_losses(df: DataFrame) -> DataFrame:
    """Rows that the layer rules would drop, by reason."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("location").isNull()).alias("null_location"),
        F.count_if(F.length("location") <= 2).alias("short_location"),
        F.count_if(F.col("job_id").isNull()).alias("null_job_id"),
    )


def rejection_rate(before: DataFrame, kept: Column, day: Column) -> DataFrame:
    """Share of rows per day that a rule rejects."""
    return (
        before.groupBy(day.alias("event_date"))
        .agg(F.count("*").alias("total"), F.count_if(F.coalesce(kept, F.lit(False))).alias("kept"))
        .withColumn("rejection_rate", (F.col("total") - F.col("kept")) / F.col("total"))
    )
