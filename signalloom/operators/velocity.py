"""Weekly signal counts per company.

A table of this module has one row per company and week and keeps about a year, so a
window over one company holds a few dozen rows at most.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import iso_week


def contributions(companies: DataFrame, day: Column, run_id: str) -> DataFrame:
    """What one run adds: role count and keywords per company for the week of ``day``."""
    return (companies.where(F.trim("company") != "")
            .select(F.trim("company").alias("company_name"), iso_week(day).alias("week"),
                    F.lit(run_id).alias("run_id"),
                    F.coalesce("role_count", F.lit(1)).alias("signal_count"),
                    F.col("top_keywords").alias("keyword_set")))


def add_run(log: DataFrame, run: DataFrame, run_id: str) -> DataFrame:
    """Log of contributions with one run added; replaying a run replaces all its rows."""
    return log.where(F.col("run_id") != run_id).unionByName(run)


def weekly(log: DataFrame) -> DataFrame:
    """Counts of all runs added up per company and week; keywords of the last run."""
    return log.groupBy("company_name", "week").agg(
        F.sum("signal_count").alias("signal_count"),
        F.max_by("keyword_set", "run_id").alias("keyword_set"))


def _by_week() -> Window:
    return Window.partitionBy("company_name")


def week_over_week(velocity: DataFrame, min_delta: int = 2) -> DataFrame:
    """Latest week against the latest earlier one, where it grew by ``min_delta``."""
    falling = _by_week().orderBy(F.desc("week"))
    return (velocity.select(
        "company_name", F.col("week").alias("this_week"),
        F.col("signal_count").alias("this_count"),
        F.lead("week").over(falling).alias("prev_week"),
        F.lead("signal_count").over(falling).alias("prev_count"),
        F.row_number().over(falling).alias("_n"))
        .where("_n = 1").drop("_n")
        .withColumn("delta", F.col("this_count") - F.col("prev_count"))
        .where(F.col("delta") >= min_delta)
        .orderBy(F.desc("delta"), "company_name"))


def last_weeks(velocity: DataFrame, n: int = 4) -> DataFrame:
    """The last n recorded weeks of each company."""
    latest = F.row_number().over(_by_week().orderBy(F.desc("week")))
    return velocity.withColumn("_n", latest).where(F.col("_n") <= n).drop("_n")


def accelerating(velocity: DataFrame) -> DataFrame:
    """Per company, whether its latest week beats the one before (1 or 0)."""
    falling = _by_week().orderBy(F.desc("week"))
    grew = F.coalesce(F.col("signal_count") > F.lead("signal_count").over(falling), F.lit(False))
    return (velocity.select("company_name", grew.cast("int").alias("accelerating"),
                            F.row_number().over(falling).alias("_n")).where("_n = 1").drop("_n"))


def week_label(day: date) -> str:
    """The ISO week of a day as the tables name it."""
    year, week, _ = day.isocalendar()
    return f"{year}-{week:02d}"


def first_kept_week(day: date, weeks: int = 52) -> str:
    """The oldest week that is kept on a day; older parts of a log end."""
    return week_label(day - timedelta(weeks=weeks))


def recent_weeks(velocity: DataFrame, today: Column, weeks: int = 52) -> DataFrame:
    """Rows not older than ``weeks`` weeks; week labels sort as text."""
    return velocity.where(F.col("week") >= iso_week(F.date_sub(today, weeks * 7)))
