"""The two runs end to end: all sources, or the boards of a rotating account list.

Every stage boundary is a stored table, so later stages re-read columns instead of
recomputing texts, and a lost executor costs only its own tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .. import schemas as T
from ..functions import scoring as S
from ..lexicon import LOCATION_MARKETS, PERK_LEXICON, PERK_RUBRIC, Lexicon, Rubric
from ..operators import accounts as A, alerts, ats, liveness, rollup as R, state, velocity
from ..sources import boards, feeds, rejects, tables
from ..sources.registry import SOURCES, read_sources, union_all

_LOCATIONS = ("company_name string, market string, jd_count long, max_kw_score long, "
              "signal_strength string, last_seen string")
_LONGS = {"times_seen", "gtm_score", "role_count", "location_jd_count"}
_HISTORY = ", ".join(
    f"{c} {'int' if c in ('is_new', 'notified') else 'long' if c in _LONGS else 'string'}"
    for c in (*T.HISTORY_COLUMNS, "added_by"))


@dataclass
class Run:
    """Settings of one run. ``root`` is the shared folder that holds all tables."""

    spark: SparkSession
    root: str
    today: str
    run_id: str
    accounts: DataFrame
    territories: DataFrame | None = None
    channels: list[str] = field(default_factory=list)
    lexicon: Lexicon = PERK_LEXICON
    rubric: Rubric = PERK_RUBRIC
    markets: tuple = LOCATION_MARKETS
    cache_days: int = 90
    velocity_weeks: int = 52
    board_links: int | None = None
    alert_companies: int = 10

    def __post_init__(self) -> None:
        self.store = tables.Snapshots(self.spark, self.root)
        self.base = self.store.base(self.run_id)
        self.version = self.store.version() + 1

    def _old(self, table: str, schema: str) -> DataFrame:
        return self.store.read(table, self.base, schema)

    def _save(self, table: str, df: DataFrame) -> DataFrame:
        return self.store.write(table, df, self.version, self.run_id)

    def _merge_history(self, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The batch with is_new, and the history after it.

        Only the buckets where the batch has companies are read and written; others are named again.
        """
        parts = self.store.parts("history", self.base)
        touched = state.touched_parts(parts, batch, state.name_key("company"))
        old = self.store.load(touched, _HISTORY)
        added = Observation("new companies")
        companies = self._save("companies", state.annotate_new(batch, old).observe(
            added, F.count_if(F.col("is_new") == 1).alias("new_count")))
        self.new_count = added.get["new_count"]
        merged = state.merge_companies(old, batch, self.today, self.run_id).drop("new_this_run")
        if self.territories is not None:  # new companies are announced below
            merged = state.mark_notified(merged, companies.where("is_new = 1"))
        merged = merged.withColumn("bucket", state.bucket_of(state.name_key("name")))
        history = self.store.replace("history", merged, self.version, self.run_id, "bucket", touched)
        this_run = F.coalesce(F.col("added_by") == self.run_id, F.lit(False)).cast("int")
        return companies, state.add_missing(history).withColumn("new_this_run", this_run).select(
            *T.HISTORY_COLUMNS, "new_this_run")

    def _merge_locations(self, signals: DataFrame) -> DataFrame:
        touched = state.touched_parts(self.store.parts("locations", self.base), signals, F.col("company_name"))
        merged = state.merge_locations(self.store.load(touched, _LOCATIONS), signals, self.today)
        return self.store.replace("locations", merged.withColumn("bucket", state.bucket_of(F.col("company_name"))),
                                  self.version, self.run_id, "bucket", touched)

    def _day(self):
        return F.lit(self.today).cast("date")

    def finish(self, raw: DataFrame, crawl: DataFrame | None = None,
               ats_cache: DataFrame | None = None, rejected=None) -> dict[str, DataFrame]:
        """Verify, roll up, merge state, build alerts, mark their companies, log and commit.

        A repeat of the last committed run starts from the state before it and replaces it.
        ``rejected`` gives the table of unusable payloads once the postings are written.
        """
        counts = Observation("liveness")
        if crawl is not None:
            jobs = self._save("jobs", liveness.verify(raw, crawl, observe=counts))
        else:
            jobs = self._save("jobs", raw.observe(
                counts, F.count("*").alias("raw_count"), F.count("*").alias("live_count")))

        refused = None if rejected is None else self._save("rejects", rejected())
        index = A.open_index(self.accounts, f"{self.root}/account_index")
        rolled, signals = R.rollup_parts(jobs, index, self.rubric, self.markets)
        batch = self._save("batch", rolled)
        companies, history = self._merge_history(batch)
        new = companies.where("is_new = 1")

        signals = self._save("signals", signals)
        locations = self._merge_locations(signals)

        # Each run is a part of the log under its week; parts of weeks that are too old end.
        day = date.fromisoformat(self.today)
        oldest = velocity.first_kept_week(day, self.velocity_weeks)
        log = self.store.add(
            "velocity_log", velocity.contributions(batch, self._day(), self.run_id), self.version, self.run_id,
            f"{velocity.week_label(day)} {self.run_id}",
            keep=lambda part: part.split(" ", 1)[0] >= oldest and part.split(" ", 1)[1] != self.run_id)
        weekly = velocity.weekly(log)

        if ats_cache is not None:
            self._save("ats_cache", ats_cache)
        else:
            self._save("ats_cache", state.fresh_cache(
                self._old("ats_cache", T.ATS_CACHE), self._day(), self.cache_days))

        row = state.run_row(self.spark, self.today, counts.get["raw_count"],
                            counts.get["live_count"], self.new_count)
        runs = self.store.add("runs", row.withColumn("version", F.lit(self.version).cast("long")),
                              self.version, self.run_id, self.run_id)
        stats = state.run_stats(history, runs, F.lit(self.today), "version")

        out = {"jobs": jobs, "companies": companies, "history": history,
               "locations": locations, "velocity": weekly, "runs": runs, "stats": stats}
        if self.territories is not None:
            rows = alerts.alert_rows(new, velocity.accelerating(weekly), self.territories,
                                     self.channels, n=self.alert_companies)
            total = F.lit(stats.first()["total_companies"])
            out["alerts"] = self._save("alerts", alerts.payloads(rows, self.today, total))
        if refused is not None:
            out["rejects"] = refused
        self.store.commit(self.today, self.version, self.run_id)
        return out

    def _rejects(self, inputs: dict, seen: dict, failed: dict) -> DataFrame:
        """Unusable payloads, read again only from inputs whose observation counted some or could not
        count, and failed sources."""
        bad: dict[str, dict[str, DataFrame]] = {}
        for (key, name), observed in seen.items():
            counts = rejects.counts(observed)
            if counts is None or any(counts[r] for r in rejects.REASONS):
                bad.setdefault(key, {})[name] = inputs[key][name]
        labels = {key: source.label for key, source in SOURCES.items()}
        rows = self.spark.createDataFrame(
            [(labels[key], "", "failed", "", error[:1000]) for key, error in failed.items()], rejects.REJECTED)
        return rows.unionByName(rejects.rejected_payloads(bad, labels)) if bad else rows

    def export(self, out: dict[str, DataFrame], folder: str) -> None:
        """The files of a run: posting CSV, company CSV, dashboard records and stats."""
        tables.write_jobs(out["jobs"], f"{folder}/jobs_csv")
        tables.write_companies(R.by_score(out["companies"]), f"{folder}/companies",
                               f"{folder}/companies_csv")
        records = tables.dashboard_records(out["history"], S.confidence, S.icp_tier)
        stats = out["stats"].withColumn("run_date", F.lit(self.today))
        tables.write_dashboard(records, stats, f"{folder}/dashboard")

    def full(self, inputs: dict[str, dict[str, DataFrame]], crawl: DataFrame | None = None,
             selected: list[str] | None = None,
             options: dict[str, dict] | None = None) -> dict[str, DataFrame]:
        """All selected sources.

        Payloads that can't be used are counted as they pass and kept in the table ``rejects``; a source
        whose tables can't be read at all is noted there too, and the others go on.
        """
        seen, failed = {}, {}
        raw = read_sources(inputs, selected, options, self.lexicon, seen, failed)
        return self.finish(raw, crawl, rejected=lambda: self._rejects(inputs, seen, failed))

    def targeted(self, probes: DataFrame, board_pages: DataFrame, posting_pages: DataFrame,
                 search: DataFrame, crawl: DataFrame | None = None,
                 tier2_sample: int | None = None, tier3_sample: int | None = None,
                 include_tier3: bool = True) -> dict[str, DataFrame]:
        """Boards and searches of the account tiers; adds a report of what was found.

        All accounts are worked unless a size makes a tier a sample.

        ``board_pages`` carries ats_type, slug, payload and seq; ``search`` the landed search
        results per account domain.
        """
        cache = self._old("ats_cache", T.ATS_CACHE)
        worked = self.store.write("worked_accounts", ats.resolve(
            A.all_tiers(self.accounts, tier2_sample, tier3_sample, include_tier3,
                        self.run_id), cache, probes, self._day(), self.cache_days),
            self.version, self.run_id)
        kept = ats.supported(worked)
        name = F.coalesce(F.col("name"), F.col("domain_key"))
        on_boards = kept.select("ats_type", F.col("ats_slug").alias("slug"),
                                name.alias("company"))
        pages = board_pages.drop("company").join(on_boards, ["ats_type", "slug"])
        found = boards.targeted_boards(pages, posting_pages, self.today, first=self.board_links,
                                       lexicon=self.lexicon)
        searched = kept.where("ats_type = 'exa'").select(F.col("domain_key").alias("domain"),
                                                         name.alias("company"))
        results = search.drop("company").join(searched, "domain")
        raw = union_all([found, feeds.targeted_search(results, lexicon=self.lexicon)])
        cache = state.merge_ats_cache(
            state.fresh_cache(cache, self._day(), self.cache_days),
            ats.cache_updates(worked), self.today)
        out = self.finish(raw, crawl, cache)
        out["report"] = targeted_report(worked, out["jobs"])
        out["ats_distribution"] = ats.distribution(worked)
        return out


def targeted_report(accounts: DataFrame, jobs: DataFrame, key: str = "domain_key",
                    company: str = "company") -> DataFrame:
    """Accounts checked, companies with a signal, match rate in percent, raw matches."""
    checked = accounts.agg(F.count(key).alias("accounts_checked"))
    found = jobs.agg(F.countDistinct(company).alias("companies_with_signal"),
                     F.count("*").alias("raw_matches"))
    rate = F.when(F.col("accounts_checked") > 0, F.col("companies_with_signal") * 100.0
                  / F.col("accounts_checked")).otherwise(F.lit(0.0))
    # Both sides are one aggregate row.
    return checked.join(found, how="cross").withColumn("match_rate", F.round(rate, 1))
