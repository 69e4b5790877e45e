"""Aggregates for reports, dashboards and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobstrata.functions.dates import AsOf, as_date, not_older
from jobstrata.operators.select import count_top
from jobstrata.operators.sets import union_labelled


def freshness(df: DataFrame, by: str, ingested: str, posted: str, as_of: AsOf = None) -> DataFrame:
    """Volume and age of the data per group, and how many rows have a posting time."""
    return df.groupBy(by).agg(
        F.count("*").alias("total"),
        F.min(ingested).alias("first_ingestion"),
        F.max(ingested).alias("last_ingestion"),
        F.datediff(as_date(as_of), F.to_date(F.max(ingested))).alias("days_since_last"),
        F.count(posted).alias("with_posted_time"),
        (F.count("*") - F.count(posted)).alias("without_posted_time"),
    )


def daily_volume(df: DataFrame, ts: str, as_of: AsOf = None, days: int = 30) -> DataFrame:
    return (
        df.filter(not_older(df, ts, as_of, days))
        .groupBy(F.to_date(ts).alias("day"))
        .agg(F.count("*").alias("n"))
    )


def field_presence(df: DataFrame, field: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("total"),
        F.count(field).alias(f"with_{field}"),
        (F.count("*") - F.count(field)).alias(f"without_{field}"),
    )


def origin_split(df: DataFrame, domestic: Column) -> DataFrame:
    # Labels of the two origins.
    origin = F.when(domestic, "Brasil").otherwise("Internacional")
    return df.groupBy(origin.alias("origin")).agg(F.count("*").alias("n"))


def window_stats(df: DataFrame, ts: str) -> DataFrame:
    """Rows and the span of their times."""
    return df.agg(F.count("*").alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def decisions_per_day(responses: DataFrame) -> DataFrame:
    return responses.groupBy(F.to_date("decision_ts").alias("decision_date"), "decision").agg(
        F.count("*").alias("decisions_count")
    )


def decision_totals(responses: DataFrame) -> DataFrame:
    return responses.groupBy("decision").agg(F.count("*").alias("total"))


def layer_summary(layers: dict[str, DataFrame], key: str, days: dict[str, Column]) -> DataFrame:
    """Last day, rows and distinct ids per layer; ``days`` gives each layer its own day."""
    frames = {
        name: df.agg(
            F.max(days[name]).alias("last_date"),
            F.count("*").alias("total_rows"),
            F.count_distinct(key).alias("unique_ids"),
        )
        for name, df in layers.items()
    }
    return union_labelled(frames, "layer")


def exact_mean(c: Column) -> Column:
    """Mean of money amounts, added up as decimals so the order of rows cannot matter.

    A group whose amounts or sum no decimal can hold gets the mean of doubles instead.
    """
    amount = c.try_cast("decimal(38,10)")
    exact = F.when(F.count(amount) == F.count(c), F.try_sum(amount)).cast("double")
    return F.coalesce(F.try_divide(exact, F.count(c).cast("double")), F.avg(c.cast("double")))


def company_summary(df: DataFrame, company: str, key: str, low: str, high: str) -> DataFrame:
    return df.groupBy(company).agg(
        F.count(key).alias("total_postings"),
        exact_mean(F.col(low)).alias("salary_min_mean"),
        exact_mean(F.col(high)).alias("salary_max_mean"),
    )


def share(df: DataFrame, by: str) -> DataFrame:
    """Rows per value and their percentage of all rows with a value, one digit."""
    counts = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / total, 1))


def chart_top(df: DataFrame, by: str, n: int) -> DataFrame:
    """Most frequent known values of a column."""
    return count_top(df.filter(F.col(by).isNotNull()), [by], n)


def chart_frames(df: DataFrame, columns: dict[str, int], arrays: dict[str, int]) -> DataFrame:
    """Most frequent values of several columns and array columns, as ``frame, label, n``.

    The dictionaries give the number of values to keep. All frames come from one pass: every
    row is unfolded into (frame, label) pairs, which are counted before the shuffle.
    """
    def pair(frame: str, label: Column) -> Column:
        return F.struct(F.lit(frame).alias("frame"), label.alias("label"))

    def unfold(frame: str) -> Column:
        values = F.coalesce(F.col(frame), F.array().cast("array<string>"))
        return F.transform(values, lambda v: pair(frame, v))

    singles = F.array(*[pair(f, F.col(f)) for f in columns])
    unfolded = [unfold(f) for f in arrays]
    counts = (
        df.select(F.inline(F.concat(singles, *unfolded)))
        .filter(F.col("label").isNotNull())
        .groupBy("frame", "label")
        .agg(F.count("*").alias("n"))
    )
    kept = columns | arrays
    window = Window.partitionBy("frame").orderBy(F.desc("n"), F.asc("label"))
    ranked = counts.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= max(kept.values()))
    limit = F.coalesce(*[F.when(F.col("frame") == f, F.lit(k)) for f, k in kept.items()])
    return ranked.filter(F.col("_rank") <= limit).drop("_rank")


def histogram(df: DataFrame, columns: list[str], bins: int = 20) -> DataFrame:
    """Equal-width bins per column, the maximum counted in the last bin.

    Rows need a value in every column. A first pass finds the bounds (one row per charted
    column, so it may be broadcast), a second counts; neither shuffles the values.
    """
    known = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    values = known.select(F.inline(pairs))
    bounds = values.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    slot = F.when(
        F.col("hi") > F.col("lo"), F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))
    ).otherwise(F.lit(0))
    return (
        values.join(F.broadcast(bounds), "column")
        .groupBy("column", (slot + 1).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def summary(df: DataFrame, distinct: list[str], elements: dict[str, str] | None = None) -> DataFrame:
    """Rows and distinct values of columns, and of the elements of at most one array column (``name: column``).

    A row is unfolded into the elements of its array and counted at its first, so one aggregate gives all figures.
    """
    named = elements or {}
    if len(named) > 1:
        raise ValueError("one array column at most")
    total = F.count("*")
    for name, column in named.items():
        df = df.select(*distinct, F.posexplode_outer(column).alias("_at", name))
        total = F.count_if(F.coalesce(F.col("_at") == 0, F.lit(True)))
    return df.agg(total.alias("total"), *[F.count_distinct(c).alias(f"distinct_{c}") for c in [*distinct, *named]])


def extraction_summary(df: DataFrame, by: str) -> DataFrame:
    """Rows per category and in total (flagged ``is_total``), in one pass."""
    return df.rollup(by).agg(
        F.count("*").alias("n"), F.count_distinct(by).alias("categories"), F.grouping(by).cast("int").alias("is_total")
    )


def method_share(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Count and percentage of each method over all rows; no rows give 0 %."""
    total = F.count("*")
    out = [total.alias("total")]
    for name, rule in flags.items():
        hits = F.count_if(rule)
        out.append(hits.alias(f"{name}_count"))
        out.append(F.coalesce(F.try_divide(hits * 100.0, total), F.lit(0.0)).alias(f"{name}_pct"))
    return df.agg(*out)


def ingestion_metrics(df: DataFrame, ingested: Column, extracted: Column) -> DataFrame:
    """Volume and mean latency in seconds per ingestion day."""
    lag = F.unix_timestamp(ingested.cast("timestamp")) - F.unix_timestamp(extracted.cast("timestamp"))
    return df.groupBy(F.to_date(ingested).alias("event_date")).agg(
        F.count("*").alias("volume"), F.avg(lag).alias("mean_latency_s")
    )


def layer_volume(df: DataFrame, ts: str, name: str = "silver_count") -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("event_date")).agg(F.count("*").alias(name))


def trend(df: DataFrame, ts: str, unit: str, by: list[str]) -> DataFrame:
    """Volume per week or month and group, with the change to the period before.

    The previous period is fetched over the aggregated frame, within each group.
    """
    counts = df.groupBy(F.to_date(F.date_trunc(unit, ts)).alias("period"), *by).agg(F.count("*").alias("n"))
    before = F.lag("n").over(Window.partitionBy(*by).orderBy("period"))
    return counts.withColumn("change", F.col("n") - before)


def high_water_mark(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.max(ts).alias("high_water_mark"))


def series(df: DataFrame, day: str, n: int) -> DataFrame:
    """The newest ``n`` days of a daily series."""
    return df.orderBy(F.desc(day)).limit(n)
