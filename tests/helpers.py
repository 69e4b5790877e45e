"""Small helpers shared by the tests."""

from pyspark.sql import functions as F


def values(spark, column_fn, inputs, type_="string"):
    """Results of a one-column rule for each input, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(column_fn(F.col("v"))).collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
