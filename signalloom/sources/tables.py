"""Readers and writers of the engine's own files and tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import files, schemas as T
from .base import with_seq

_CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True}


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Posting CSV; blank text reads as null, rows keep their order in ingest_seq."""
    return with_seq(spark.read.schema(T.JOBS_CSV).options(**_CSV).csv(path), "ingest_seq")


def read_accounts(spark: SparkSession, managed: str | None, unmanaged: str | None) -> DataFrame:
    """Both account lists in one table: list, row_no and the account columns."""
    parts = []
    for name, path in (("managed", managed), ("unmanaged", unmanaged)):
        if path is None:
            continue
        raw = with_seq(spark.read.options(**_CSV).csv(path), "_place")
        headers = {**T.ACCOUNT_HEADERS, T.DOMAIN_HEADERS[name]: "domain"}
        columns = [(F.trim(F.col(f"`{h}`")) if h in raw.columns
                    else F.lit(None).cast("string")).alias(c) for h, c in headers.items()]
        rank = F.lit(0 if name == "managed" else 1).alias("list_no")
        parts.append(raw.select(F.lit(name).alias("list"), *columns,
                                F.struct(rank, F.col("_place")).alias("row_no")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_territories(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(T.TERRITORIES).options(**_CSV).csv(path)
    return with_seq(raw, "row_no")


def write_jobs(jobs: DataFrame, path: str) -> None:
    """The 11 posting columns as CSV, replacing the last run's."""
    jobs.select(*T.JOB_COLUMNS).write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"')


def write_companies(companies: DataFrame, path: str, csv_path: str | None = None) -> None:
    """Company table as parquet and, on request, as CSV."""
    companies.write.mode("overwrite").parquet(path)
    if csv_path:
        stored = companies.sparkSession.read.parquet(path)
        stored.write.mode("overwrite").csv(csv_path, header=True, quote='"', escape='"')


def dashboard_records(history: DataFrame, confidence, icp_tier) -> DataFrame:
    """One JSON record per company of the whole history, with derived tiers."""
    full = (history.withColumn("company", F.col("name"))
            .withColumn("confidence", confidence(F.col("gtm_score")))
            .withColumn("icp_tier", icp_tier(F.col("gtm_score"))))
    return full.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_dashboard(records: DataFrame, stats: DataFrame, path: str) -> None:
    """Records and the one-row stats as JSON lines, in two folders."""
    records.write.mode("overwrite").text(f"{path}/companies")
    stats.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
                 ).write.mode("overwrite").text(f"{path}/stats")


def write_export(df: DataFrame, path: str) -> None:
    """Filtered rows as CSV with quoting where a value needs it."""
    df.select(*T.EXPORT_COLUMNS).write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"')


class Snapshots:
    """Versioned tables below a shared folder, made of parts that versions share.

    A run writes the parts that it changes below ``TABLE/version=N/run=ID`` and then commits: one file,
    ``_commits/N.json``, names the paths of all parts of all tables. Parts that the run did not touch are
    named again, not written again; one that is out of date is no longer named. The commit file is
    created only if it is absent, so of two runs that start from one version exactly one wins, at
    whatever moment they commit. A run that dies before its commit leaves the committed version as it was.
    Repeating the last committed run starts from the version before it and replaces what it did.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._staged: dict[tuple[int, str], dict[str, dict[str, str]]] = {}

    # -- commits -------------------------------------------------------------------------------

    def _commit_path(self, version: int) -> str:
        return f"{self.root}/_commits/{version:010d}.json"

    def _commit(self, version: int) -> dict:
        """What version ``version`` holds; version 0 holds nothing."""
        if version == 0:
            return {"runs": [], "tables": {}}
        return json.loads(files.read_text(self.spark, self._commit_path(version)))

    def version(self) -> int:
        """Number of the last committed version (0: none)."""
        found = files.names(self.spark, f"{self.root}/_commits")
        return max([int(n.split(".")[0]) for n in found if n.endswith(".json")], default=0)

    def has(self, run_id: str) -> bool:
        """Whether a run was committed."""
        return any(r == run_id for _, r in self._commit(self.version())["runs"])

    def base(self, run_id: str) -> int:
        """The version a run starts from: the last one that is not its own.

        A run that is repeated right after its commit starts where it started before, so it
        replaces what it did. One that other runs followed can't be repeated.
        """
        runs = self._commit(self.version())["runs"]
        other = max([v for v, r in runs if r != run_id], default=0)
        mine = max([v for v, r in runs if r == run_id], default=0)
        if 0 < mine < other:
            raise ValueError(f"run {run_id!r} was followed by others and can't be repeated")
        return other

    def commit(self, ran_at: str, version: int, run_id: str) -> None:
        """Makes what the run wrote, and all else of its base, the version ``version``."""
        last = self.version()
        if last >= version:
            raise RuntimeError(f"another run has committed version {version}")
        tables = self._commit(self.base(run_id))["tables"] | self._staged.pop((version, run_id), {})
        runs = [*self._commit(last)["runs"], [version, run_id]]
        text = json.dumps({"ran_at": ran_at, "version": version, "run_id": run_id, "runs": runs, "tables": tables})
        if not files.create(self.spark, self._commit_path(version), text):
            raise RuntimeError(f"another run has committed version {version}")

    # -- tables --------------------------------------------------------------------------------

    def _path(self, table: str, version: int, run_id: str) -> str:
        return f"{self.root}/{table}/version={version}/run={quote(run_id, safe='')}"

    def parts(self, table: str, version: int) -> dict[str, str]:
        """Paths of a table's parts at a version, below the root."""
        return self._commit(version)["tables"].get(table, {})

    def load(self, parts: dict[str, str], schema: str | T.T.StructType) -> DataFrame:
        """The rows of some parts; columns that an older part lacks read as null there."""
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{path}" for path in parts.values()])

    def read(self, table: str, version: int, schema: str | T.T.StructType) -> DataFrame:
        """The table at a version; before the first one an empty table of that schema."""
        return self.load(self.parts(table, version), schema)

    def _stage(self, table: str, version: int, run_id: str, parts: dict[str, str]) -> None:
        self._staged.setdefault((version, run_id), {})[table] = parts

    def write(self, table: str, df: DataFrame, version: int, run_id: str) -> DataFrame:
        """Write a table anew, as one part, and read it back."""
        path = self._path(table, version, run_id)
        df.write.mode("overwrite").parquet(path)
        self._stage(table, version, run_id, {"": path[len(self.root) + 1:]})
        return self.spark.read.schema(df.schema).parquet(path)

    def add(self, table: str, df: DataFrame, version: int, run_id: str, part: str,
            keep: Callable[[str], bool] = lambda part: True) -> DataFrame:
        """Write one part beside those of the run's base that ``keep`` keeps; the whole table is returned.

        A part of the same name is replaced. Nothing else is read or written.
        """
        path = self._path(table, version, run_id)
        df.write.mode("overwrite").parquet(path)
        old = self.parts(table, self.base(run_id))
        parts = {p: at for p, at in old.items() if keep(p) and p != part} | {part: path[len(self.root) + 1:]}
        self._stage(table, version, run_id, parts)
        return self.load(parts, df.schema)

    def replace(self, table: str, df: DataFrame, version: int, run_id: str, by: str,
                gone: Iterable[str]) -> DataFrame:
        """Write the values of column ``by`` as a part each; parts of the base named in ``gone`` end.

        The rebalance hint gives each value few files and splits values that are large. Returns the whole table,
        without the column.
        """
        path = self._path(table, version, run_id)
        df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)
        old = self.parts(table, self.base(run_id))
        gone, short = set(gone), path[len(self.root) + 1:]
        written = [n for n in files.names(self.spark, path) if n.startswith(f"{by}=")]
        parts = {p: at for p, at in old.items() if p not in gone}
        parts |= {unquote(n[len(by) + 1:]): f"{short}/{n}" for n in written}
        self._stage(table, version, run_id, parts)
        return self.load(parts, df.drop(by).schema)
