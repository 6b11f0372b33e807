"""Completions as a stream: parsed, checked and counted as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import parsing, triage
from ..operators.workspace import ship


def judged_stream(answers: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Judges' answers (id, ts, violated_policy, severity, content) with their destination; an id counts once while it is remembered."""
    ship(answers.sparkSession)
    once = answers.withWatermark("ts", late).dropDuplicatesWithinWatermark(["id"])
    said = once.withColumn("j", parsing.parse_judgment("content", "violated_policy")).select("id", "ts", "violated_policy", "severity", "j.*")
    return triage.routed(triage.audited(said))


def destination_counts(routed: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Destinations by window of event time and policy."""
    return routed.groupBy(F.window("ts", width), "violated_policy").agg(*[F.count_if(F.col("destination") == x).alias(x) for x in ("accepted", "rejected", "review")])


def event_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their sum by window and kind; rows later than the watermark are dropped."""
    seen = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    return seen.select(F.col("window.start").alias("start"), "event_type", "n", "value")
