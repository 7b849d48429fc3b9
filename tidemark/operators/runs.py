"""Runs of capture jobs: what each extracted and stored, and failures that go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Consecutive failures that are reported, and the number that every multiple of is.
REPORTED, EVERY = (1, 20), 180


def audit(rows: DataFrame, run: list[str], reason: str) -> DataFrame:
    """One row for each run: rows extracted, rejected (with a reason) and stored, and how it ended."""
    g = rows.groupBy(*run).agg(F.count("*").alias("extracted"), F.count(reason).alias("rejected"))
    status = F.when(F.col("rejected") == 0, "SUCCESS").when(F.col("rejected") == F.col("extracted"), "FAILED").otherwise("PARTIAL")
    return g.select(*run, "extracted", "rejected", (F.col("extracted") - F.col("rejected")).alias("stored"), status.alias("status"))


def escalations(runs: DataFrame) -> DataFrame:
    """Failed runs at which someone is told: the first of a streak, the 20th, and each 180th."""
    order = Window.partitionBy("scraper").orderBy("started_at", "run_id")
    streak = runs.withColumn("_good", F.count_if(F.col("status") == "SUCCESS").over(order)).where("status = 'FAILED'")
    nth = F.row_number().over(Window.partitionBy("scraper", "_good").orderBy("started_at", "run_id"))
    told = streak.withColumn("failures", nth).where(F.col("failures").isin(*REPORTED) | (F.col("failures") % EVERY == 0))
    return told.select("scraper", "run_id", "started_at", "failures")
