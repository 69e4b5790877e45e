"""Views and tables for SQL users."""

from pyspark.sql import functions as F

from jobstrata import schemas
from jobstrata.plans import views


def test_feed_tables_are_created_once(spark):
    views.ensure_feed_tables(spark, "made_chat")
    views.ensure_feed_tables(spark, "made_chat")
    assert spark.table("made_chat_sent_jobs").columns == schemas.SENT.fieldNames()
    assert spark.table("made_chat_state").schema["last_posted_time_ts"].dataType == schemas.STATE.fields[0].dataType
    for name in ("state", "sent_jobs", "responses"):
        spark.sql(f"DROP TABLE made_chat_{name}")


def test_response_views(spark):
    rows = spark.createDataFrame([("a", "SIM"), ("a", "NAO"), ("b", "SIM")], "job_id string, decision string")
    for name in ("responder", "title", "company", "work_modality", "url"):
        rows = rows.withColumn(name, F.lit("x"))
    views.register_response_views(rows.withColumn("decision_ts", F.lit("2025-10-06 10:00:00").cast("timestamp")))
    totals = {r.decision: r.total for r in spark.sql("SELECT * FROM vw_chat_agent_totals").collect()}
    assert totals == {"SIM": 2, "NAO": 1}
    assert spark.table("vw_chat_agent_responses").columns == schemas.RESPONSES.fieldNames()
    assert spark.table("vw_chat_agent_summary").count() == 2
