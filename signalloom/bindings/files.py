"""Queries that write the engine's files and tables and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as T
from ..session import shared_folder
from ..sources import tables
from . import sql as Q, views
from .data import customer_accounts, postings
from .rollup import ROLLUP_SQL, company_rollup
from .runs import _run

_ACCOUNT = ("name", "domain", "vertical", "zi_industry", "city", "state")


def _filled(df, *columns):
    """Blank text reads back as null; here as blank again."""
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def _csv(df, path: str) -> str:
    df.write.csv(path, header=True, quote='"', escape='"')
    return path


def jobs_csv(spark, sf):
    """All postings through the posting CSV."""
    path = f"{shared_folder(spark, 'files')}/jobs"
    tables.write_jobs(postings(spark, sf), path)
    back = tables.read_jobs(spark, path)
    return back.select("keyword_count", *[F.coalesce(c, F.lit("")).alias(c)
                                          for c in T.JOB_COLUMNS if c != "keyword_count"])


def accounts_csv(spark, sf):
    """Both account lists through CSV files with their own headers."""
    folder, paths = shared_folder(spark, "files"), {}
    accounts = customer_accounts(spark, sf)
    for kind in ("managed", "unmanaged"):
        headers = {**{v: k for k, v in T.ACCOUNT_HEADERS.items()}, "domain": T.DOMAIN_HEADERS[kind]}
        rows = accounts.where(F.col("list") == kind)
        paths[kind] = _csv(rows.select(*[F.col(c).alias(h) for c, h in headers.items()]),
                           f"{folder}/{kind}")
    return _filled(tables.read_accounts(spark, paths["managed"], paths["unmanaged"]), "list", *_ACCOUNT)


def territories_csv(spark, sf):
    path = _csv(views._territories(spark, sf), f"{shared_folder(spark, 'files')}/territories")
    return _filled(tables.read_territories(spark, path), *T.TERRITORIES.fieldNames())


def export_csv(spark, sf):
    """The filtered rows through the export CSV."""
    path = f"{shared_folder(spark, 'files')}/export"
    tables.write_export(views.export_rows(spark, sf), path)
    back = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)
    numbers = ("gtm_score", "unique_roles_with_perk")
    return back.select(*[F.col(c).cast("long").alias(c) if c in numbers
                         else F.coalesce(c, F.lit("")).alias(c) for c in T.EXPORT_COLUMNS])


def run_log(spark, sf):
    """The log after two runs over the same postings."""
    root = shared_folder(spark, "runs")
    for day in ("2024-01-29", "2024-02-05"):
        out = _run(spark, sf, root, day, day).finish(postings(spark, sf))
    return out["runs"]


def company_csv(spark, sf):
    """The companies of the rollup through the company table and its CSV."""
    folder = shared_folder(spark, "files")
    tables.write_companies(company_rollup(spark, sf), f"{folder}/companies", f"{folder}/companies_csv")
    back = spark.read.csv(f"{folder}/companies_csv", header=True, quote='"', escape='"', multiLine=True)
    numbers = ("gtm_score", "unique_roles_with_perk", "role_count", "is_new", "location_jd_count")
    return back.select(*[F.col(c).cast("long").alias(c) if c in numbers else F.coalesce(c, F.lit("")).alias(c)
                         for c in T.COMPANY_COLUMNS])


QUERIES = {f.__name__: f for f in (jobs_csv, accounts_csv, company_csv, territories_csv, export_csv, run_log)}

SQL = {
    "jobs_csv": f"""
WITH {Q.POSTINGS} SELECT source, company, title, location, 'On-site' AS remote,
  kws AS food_keywords_matched, n_kw AS keyword_count, excerpt AS perk_excerpt,
  CAST(day AS VARCHAR) AS date_posted, url, domain AS _domain FROM postings""",
    "accounts_csv": f"""
WITH {Q.CUSTOMERS} SELECT list, name, replace(domain, 'www.', 'WWW.') AS domain, vertical,
  zi_industry, city, state FROM accounts""",
    "company_csv": ROLLUP_SQL,
    "territories_csv": f"""
WITH {views._TERRITORY} SELECT market, rep AS rep_name, handle AS slack_handle,
  env AS webhook_env_var FROM t""",
    "export_csv": views.SQL["export_rows"],
    "run_log": f"""
WITH {Q.POSTINGS}, c AS (SELECT count(*) AS n FROM ({ROLLUP_SQL})), p AS (SELECT count(*) AS n FROM postings)
SELECT '2024-01-29' AS ran_at, p.n AS raw_count, p.n AS live_count, c.n AS new_count, 1 AS version FROM c, p
UNION ALL SELECT '2024-02-05', p.n, p.n, 0, 2 FROM c, p""",
}
