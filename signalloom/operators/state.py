"""Tables carried from run to run, as snapshots merged in one join or one union each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import HISTORY_COLUMNS, HISTORY_DEFAULTS
from .dedup import last_wins


def name_key(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.lower(F.trim(F.coalesce(col, F.lit(""))))


# --- company history ------------------------------------------------------------------------------

def add_missing(history: DataFrame, defaults: dict = HISTORY_DEFAULTS) -> DataFrame:
    """Add columns an older table lacks, filled with their default.

    Where older and newer parts meet, rows of the older ones have null in such a column and get it too.
    """
    for column, value in defaults.items():
        kind = "long" if isinstance(value, int) else "string"
        filled = F.lit(value).cast(kind)
        if column not in history.columns:
            history = history.withColumn(column, filled)
        elif value is not None:
            history = history.withColumn(column, F.coalesce(column, filled))
    return history


def new_companies(batch: DataFrame, history: DataFrame, batch_name: str = "company",
                  history_name: str = "name") -> DataFrame:
    """Batch rows whose name is not in the history."""
    seen = history.select(name_key(history_name).alias("_key")).distinct()
    keyed = batch.withColumn("_key", name_key(batch_name))
    return keyed.join(seen, "_key", "left_anti").drop("_key")


def seen_companies(batch: DataFrame, history: DataFrame, batch_name: str = "company",
                   history_name: str = "name") -> DataFrame:
    seen = history.select(name_key(history_name).alias("_key")).distinct()
    keyed = batch.withColumn("_key", name_key(batch_name))
    return keyed.join(seen, "_key", "left_semi").drop("_key")


def annotate_new(batch: DataFrame, history: DataFrame, batch_name: str = "company",
                 history_name: str = "name") -> DataFrame:
    """is_new = 1 where the name was not in the history, else 0."""
    seen = history.select(name_key(history_name).alias("_key"),
                          F.lit(True).alias("_seen")).distinct()
    keyed = batch.withColumn("_key", name_key(batch_name))
    return (keyed.join(seen, "_key", "left")
            .withColumn("is_new", F.when(F.col("_seen"), 0).otherwise(1))
            .drop("_key", "_seen"))


# Rollup column -> history column, refreshed on every sighting.
_REFRESHED = {
    "top_keywords": "top_keywords", "role_count": "role_count",
    "sample_title": "sample_title", "sample_url": "sample_url",
    "perk_excerpt": "perk_excerpt", "best_source": "source", "segment": "segment",
    "market": "market", "ezcater_vertical": "ezcater_vertical",
    "zi_industry": "zi_industry", "loc_signal_strength": "loc_signal_strength",
    "expansion_confirmed": "expansion_confirmed", "expansion_possible": "expansion_possible",
    "existing_confirmed": "existing_confirmed", "existing_possible": "existing_possible",
    "location_jd_count": "location_jd_count", "location_detail": "location_detail",
    "known_markets": "known_markets", "office_cities": "office_cities"}
# Kept from the first sighting.
_KEPT = {"company": "name", "inferred_domain": "domain", "location": "location"}


def upsert(history: DataFrame, batch: DataFrame, history_key: Column, batch_key: Column,
           refreshed: dict[str, str], kept: dict[str, str], today: Column,
           best: str | None = None) -> DataFrame:
    """Snapshot after one batch.

    Known rows meet the batch in a left join and new keys are told by the few known ones that the batch
    holds, so a history of any size is not shuffled where Spark can broadcast the batch. New keys start at times_seen 1, is_new 1, notified 0; known keys count up, lose is_new,
    take the refreshed columns and the greater of both ``best`` values. ``new_this_run``
    marks the rows this batch added.
    """
    h = history.select(F.struct("*").alias("h"), history_key.alias("_key"))
    b = batch.select(F.struct("*").alias("b"), batch_key.alias("_key")).where("_key <> ''")
    seen = h.select("_key").join(b.select("_key"), "_key", "left_semi").distinct()
    fresh = b.join(seen, "_key", "left_anti").select(F.lit(None).cast(h.schema["h"].dataType).alias("h"), "_key", "b")
    both = h.join(b, "_key", "left").select("h", "_key", "b").unionByName(fresh)
    in_batch, known = F.col("b").isNotNull(), F.col("h").isNotNull()

    out = {dst: F.when(known, F.col(f"h.{dst}")).otherwise(F.col(f"b.{src}"))
           for src, dst in kept.items()}
    out |= {dst: F.when(in_batch, F.col(f"b.{src}")).otherwise(F.col(f"h.{dst}"))
            for src, dst in refreshed.items()}
    out["first_seen"] = F.when(known, F.col("h.first_seen")).otherwise(today)
    out["last_seen"] = F.when(in_batch, today).otherwise(F.col("h.last_seen"))
    out["times_seen"] = (F.coalesce("h.times_seen", F.lit(0).cast("long"))
                         + F.when(in_batch, 1).otherwise(0))
    out["is_new"] = (F.when(known & in_batch, 0).when(known, F.col("h.is_new"))
                     .otherwise(1).cast("int"))
    out["notified"] = F.coalesce("h.notified", F.lit(0)).cast("int")
    if best:
        out[best] = F.greatest(F.col(f"h.{best}"), F.col(f"b.{best}"))
    return both.select(*[c.alias(n) for n, c in out.items()],
                       F.when(known, 0).otherwise(1).alias("new_this_run"))


def merge_companies(history: DataFrame, batch: DataFrame, today: str, run_id: str | None = None) -> DataFrame:
    """Company history after one run's rollup; with ``run_id`` also which run added a company."""
    columns, kept = [*HISTORY_COLUMNS, "new_this_run"], _KEPT
    if run_id is not None:
        batch, kept = batch.withColumn("_run", F.lit(run_id)), {**_KEPT, "_run": "added_by"}
        columns.append("added_by")
    batch = last_wins(batch.withColumn("_key", name_key("company")), ["_key"],
                      F.struct("gtm_score", "company")).drop("_key")
    merged = upsert(add_missing(history), batch, name_key("name"), name_key("company"),
                    _REFRESHED, kept, F.lit(today), best="gtm_score")
    return merged.select(*columns)


#: Buckets of a table that is merged by key.
BUCKETS = 256


def bucket_of(key: Column, n: int = BUCKETS) -> Column:
    """The part of a table that holds a key: its number and how many there are, so that tables with
    another number of parts are told apart."""
    return F.concat(F.pmod(F.xxhash64(key), F.lit(n)).cast("string"), F.lit(f"-{n}"))


def touched_parts(parts: dict[str, str], keys: DataFrame, key: Column, n: int = BUCKETS) -> dict[str, str]:
    """Those of a table's parts where some of the keys are; all, if the table has other buckets.

    ``n`` bucket names at most reach the driver.
    """
    if any(not p.endswith(f"-{n}") for p in parts):
        return parts
    found = {r["bucket"] for r in keys.select(bucket_of(key, n).alias("bucket")).distinct().collect()}
    return {p: path for p, path in parts.items() if p in found}


def mark_notified(history: DataFrame, names: DataFrame, name: str = "company") -> DataFrame:
    sent = names.select(name_key(name).alias("_key"), F.lit(1).alias("_sent")).distinct()
    return (history.withColumn("_key", name_key("name")).join(sent, "_key", "left")
            .withColumn("notified", F.coalesce("_sent", "notified").cast("int"))
            .drop("_key", "_sent"))


def history_scan(history: DataFrame, *order: Column) -> DataFrame:
    """The whole history with ``company`` beside ``name``, in the caller's order."""
    return (history.withColumn("company", F.col("name"))
            .orderBy(*(order or (F.desc("gtm_score"), F.col("name")))))


def new_unnotified(history: DataFrame) -> DataFrame:
    return (history.where("is_new = 1 and notified = 0")
            .orderBy(F.desc("gtm_score"), "name"))


# --- keyed tables that take the newest row ---------------------------------------------------------

def replace_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key; others stay."""
    return (old.join(new.select(*keys).distinct(), keys, "left_anti")
            .unionByName(new, allowMissingColumns=True))


def merge_locations(old: DataFrame, signals: DataFrame, today: str) -> DataFrame:
    """Location signals keyed by (company_name, market); stale rows are kept."""
    fresh = (signals.where("company_name <> '' and market <> ''")
             .withColumn("last_seen", F.lit(today)))
    return replace_rows(old, fresh, ["company_name", "market"])


def merge_ats_cache(old: DataFrame, resolved: DataFrame, today: str) -> DataFrame:
    fresh = resolved.select("domain", "ats_type", "ats_slug").withColumn(
        "checked_at", F.lit(today))
    return replace_rows(old, fresh, ["domain"])


def confirmed_offices(locations: DataFrame, companies: DataFrame, market: str | None = None,
                      min_strength: str = "confirmed", exact_names: bool = False) -> DataFrame:
    """Location signals of the asked strength with company details, if known."""
    levels = ["confirmed"] if min_strength == "confirmed" else ["confirmed", "possible"]
    wanted = locations.where(F.col("signal_strength").isin(levels))
    if market is not None:
        wanted = wanted.where(F.col("market") == market)
    key = (lambda c: F.col(c)) if exact_names else name_key
    details = companies.select(key("name").alias("_key"), "gtm_score", "segment",
                               "top_keywords", "sample_url")
    return (wanted.withColumn("_key", key("company_name")).join(details, "_key", "left")
            .drop("_key").orderBy(F.desc("jd_count"), F.desc_nulls_last("gtm_score"),
                                  "company_name", "market"))


# --- time to live ------------------------------------------------------------------------------------

def fresh_cache(cache: DataFrame, today: Column, days: int = 90,
                column: str = "checked_at") -> DataFrame:
    """Rows checked within the last ``days`` days."""
    return cache.where(F.col(column).cast("date") >= F.date_sub(today, days))


# --- runs ------------------------------------------------------------------------------------------

def run_row(spark: SparkSession, ran_at: str, raw: int, live: int, new: int) -> DataFrame:
    """One run-log row, to be appended."""
    return spark.createDataFrame(
        [(ran_at, raw, live, new)],
        "ran_at string, raw_count long, live_count long, new_count long")


def run_stats(companies: DataFrame, runs: DataFrame, today: Column, order: str) -> DataFrame:
    """One row: companies, first seen today, runs, date and new count of the last run."""
    totals = companies.agg(F.count("*").alias("total_companies"),
                           F.count_if(F.col("first_seen") == today).alias("new_today"))
    last = F.max_by(F.struct("ran_at", "new_count"), order)
    logged = (runs.agg(F.count("*").alias("total_runs"), last.alias("_last"))
              .select("total_runs", F.col("_last.ran_at").alias("last_run_date"),
                      F.coalesce("_last.new_count", F.lit(0)).alias("last_run_new")))
    # Both sides are one aggregate row.
    return totals.join(logged, how="cross")


def run_metrics(raw: DataFrame, live: DataFrame, new: DataFrame) -> DataFrame:
    """Raw, live, removed and new counts of a run as one row (single-row sides)."""
    sides = [df.agg(F.count("*").alias(n)) for df, n in
             ((raw, "raw_count"), (live, "live_count"), (new, "new_count"))]
    one = sides[0].join(sides[1], how="cross").join(sides[2], how="cross")
    return one.withColumn("removed_count", F.col("raw_count") - F.col("live_count"))
