"""Account lists: indexes, classification, tiers, samples and company matching."""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from .. import files
from ..functions.names import name_tokens, normalise_domain, normalise_name
from ..functions.text import any_of
from ..lexicon import CITY_MARKETS, TierRules
from ..session import shared_folder, stored
from .dedup import first_wins, hash_sample
from .markets import office_index

ACCOUNT_FIELDS = ("name", "domain", "zoominfo_id", "vertical", "industry", "zi_industry")
LISTS = ("managed", "unmanaged")


# --- classification ---------------------------------------------------------------------------

def is_suppressed(vertical: Column, industry: Column, name: Column,
                  rules: TierRules = TierRules()) -> Column:
    name = F.lower(F.coalesce(name, F.lit("")))
    return (F.coalesce(F.trim(vertical).isin(*rules.suppress_verticals), F.lit(False))
            | F.coalesce(F.trim(industry).isin(*rules.suppress_industries), F.lit(False))
            | any_of([F.contains(name, F.lit(t)) for t in rules.suppress_tokens]))


def is_icp(vertical: Column, industry: Column, rules: TierRules = TierRules()) -> Column:
    return (F.coalesce(F.trim(vertical).isin(*rules.icp_verticals), F.lit(False))
            | F.coalesce(F.trim(industry).isin(*rules.icp_industries), F.lit(False)))


def with_tier(accounts: DataFrame, rules: TierRules = TierRules()) -> DataFrame:
    """tier: 1 managed, X suppressed, 2 in profile, 3 unclassified."""
    suppressed = is_suppressed(F.col("vertical"), F.col("zi_industry"), F.col("name"), rules)
    icp = is_icp(F.col("vertical"), F.col("zi_industry"), rules)
    return accounts.withColumn(
        "tier", F.when(F.col("list") == "managed", "1").when(suppressed, "X")
        .when(icp, "2").otherwise("3"))


def with_key(accounts: DataFrame) -> DataFrame:
    """Accounts that can be worked: a lower-case domain in ``domain_key``."""
    key = F.lower(F.trim(F.coalesce("domain", F.lit(""))))
    return accounts.withColumn("domain_key", key).where(F.col("domain_key") != "")


def all_tiers(accounts: DataFrame, tier2_sample: int | None = None,
              tier3_sample: int | None = None, include_tier3: bool = True, seed: str = "",
              rules: TierRules = TierRules()) -> DataFrame:
    """Tiers 1 to 3, first account per domain in tier order; a size makes its tier a sample."""
    tiered = with_tier(with_key(accounts), rules)
    parts = [tiered.where("tier = '1'")]
    samples = [("2", tier2_sample)] + ([("3", tier3_sample)] if include_tier3 else [])
    for tier, n in samples:
        part = tiered.where(F.col("tier") == tier)
        parts.append(part if n is None else hash_sample(part, n, "domain_key", seed, "row_no"))
    union = reduce(lambda a, b: a.unionByName(b), parts)
    return first_wins(union, ["domain_key"], F.struct("tier", "row_no"))


def domain_universe(accounts: DataFrame, lists: tuple[str, ...] = LISTS,
                    rules: TierRules = TierRules()) -> DataFrame:
    """Distinct domains of managed and, if listed, in-profile unmanaged accounts."""
    tiered = with_tier(with_key(accounts), rules)
    wanted = {"managed": "1", "unmanaged": "2"}
    return (tiered.where(F.col("tier").isin(*[wanted[x] for x in lists]))
            .select(F.col("domain_key").alias("domain")).distinct())


def unclassified(accounts: DataFrame, rules: TierRules = TierRules()) -> DataFrame:
    """Unmanaged accounts that are neither suppressed nor in profile."""
    return with_tier(with_key(accounts), rules).where("tier = '3'")


def coverage_stats(accounts: DataFrame, per_run: int = 1000,
                   rules: TierRules = TierRules()) -> DataFrame:
    tier = F.col("tier")
    unmanaged = tier != "1"
    return with_tier(with_key(accounts), rules).agg(
        F.count_if(tier == "1").alias("managed"),
        F.count_if(unmanaged).alias("unmanaged_total"),
        F.count_if(tier == "2").alias("unmanaged_icp"),
        F.count_if(tier == "X").alias("unmanaged_suppressed"),
        F.count_if(tier == "3").alias("unmanaged_unclassified"),
        F.round(F.count_if(tier == "2") / F.lit(per_run), 1).alias("weeks_to_full_cycle"))


def account_counts(accounts: DataFrame) -> DataFrame:
    """Distinct normalised domains per list."""
    return (accounts.select("list", normalise_domain(F.col("domain")).alias("nd"))
            .where("nd <> ''").groupBy("list").agg(F.countDistinct("nd").alias("accounts")))


# --- matching indexes ---------------------------------------------------------------------------

def _account() -> Column:
    return F.struct(*ACCOUNT_FIELDS)


def _per_list(agg, order: Column) -> list[Column]:
    """One aggregate per account list; rows of the other list carry a null order."""
    out = []
    for name in LISTS:
        mine = F.col("list") == name
        out.append(agg(F.when(mine, F.col("account")), F.when(mine, order)).alias(name))
    return out


def domain_index(accounts: DataFrame) -> DataFrame:
    """nd -> managed / unmanaged account; the last duplicate of a list wins."""
    keyed = accounts.select(normalise_domain(F.col("domain")).alias("nd"), "list", "row_no",
                            _account().alias("account")).where("nd <> ''")
    return keyed.groupBy("nd").agg(*_per_list(F.max_by, F.col("row_no")))


def name_index(accounts: DataFrame) -> DataFrame:
    """(list, nn) -> account of the last duplicate, with the position of the first."""
    raw = F.trim(F.coalesce("name", F.lit("")))
    keyed = (accounts.where((raw != "") & (F.lower(raw) != "not provided"))
             .select(normalise_name(F.col("name")).alias("nn"), "list", "row_no",
                     _account().alias("account")).where("nn <> ''"))
    return keyed.groupBy("list", "nn").agg(F.max_by("account", "row_no").alias("account"),
                                           F.min("row_no").alias("first_row"))


def _signature(tokens: str) -> Column:
    """64-bit set signature: a subset's bits are part of its superset's bits."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda acc, t: acc.bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("long"),
                        F.pmod(F.xxhash64(t), F.lit(64)).cast("int"))))


def token_postings(names: DataFrame) -> DataFrame:
    """token -> every distinct token set that holds it, from (nn, and first and row of each list).

    Names of equal token sets are one; ``{list}_first`` is where the first of them stands and ``{list}_row``
    its account's row.
    """
    sets = names.withColumn("tokens", name_tokens(F.col("nn")))
    first = [agg for x in LISTS for agg in (
        F.min_by(f"{x}_row", f"{x}_first").alias(f"{x}_row"), F.min(f"{x}_first").alias(f"{x}_first"))]
    sets = sets.groupBy(F.array_join("tokens", " ").alias("akey")).agg(*first)
    sets = sets.withColumn("atokens", F.split("akey", " ")).withColumn("abits", _signature("atokens"))
    return sets.select(F.explode("atokens").alias("token"), "atokens", "abits",
                       *[f"{x}_{c}" for x in LISTS for c in ("first", "row")])


def token_frequency(postings: DataFrame) -> DataFrame:
    return postings.groupBy("token").agg(F.count("*").alias("n"))


def token_rows(queries: DataFrame, frequency: DataFrame, postings: DataFrame) -> DataFrame:
    """nn -> row of the first account of each list whose name holds every token of nn (two at least).

    A query meets only the token sets that share its rarest token; the containment test (a bit test before
    the exact one) is part of the join condition, and the first row is kept by a combining
    aggregate, so pairs are never stored. A token of very many accounts is one that adaptive
    execution splits.
    """
    asked = queries.select("nn").distinct()
    tokens = name_tokens(F.col("nn"))
    # Every token must be known, else no account can hold them all.
    rarest = (asked.select("nn", F.explode(tokens).alias("token")).join(frequency, "token")
              .groupBy("nn").agg(F.count("*").alias("found"), F.min(F.struct("n", "token")).alias("rarest"))
              .withColumn("tokens", tokens)
              .where((F.col("found") == F.size("tokens")) & (F.col("found") >= 2))
              .select("nn", "tokens", _signature("tokens").alias("qbits"), F.col("rarest.token").alias("token")))
    contained = ((F.col("qbits").bitwiseAND(F.col("abits")) == F.col("qbits"))
                 & (F.size(F.array_except("tokens", "atokens")) == 0))
    first = [F.min_by(f"{x}_row", f"{x}_first").alias(x) for x in LISTS]
    return (rarest.alias("q").join(postings.alias("a"), (F.col("q.token") == F.col("a.token")) & contained)
            .groupBy("nn").agg(*first))


def token_matches(queries: DataFrame, names: DataFrame) -> DataFrame:
    """nn -> first account of each list whose name holds every token of nn, from a name index."""
    places = names.groupBy("nn").agg(*[
        F.min(F.when(F.col("list") == x, F.col("first_row"))).alias(f"{x}_{c}")
        for x in LISTS for c in ("first", "row")])
    postings = stored(token_postings(places), "postings")
    hits = token_rows(queries, token_frequency(postings), postings)
    for x in LISTS:
        rows = names.where(F.col("list") == x).select(F.col("first_row").alias(x), F.col("account").alias(f"_{x}"))
        hits = hits.join(rows, x, "left")
    return hits.select("nn", *[F.col(f"_{x}").alias(x) for x in LISTS])


# --- the stored index --------------------------------------------------------------------------------

class AccountIndex(NamedTuple):
    """What matching reads of the account lists, as stored tables.

    rows: row, account. names and domains: key and the row of each list's account that counts. postings and
    frequency: token sets by token. offices: known markets, primary market and cities by domain.
    """

    rows: DataFrame
    names: DataFrame
    domains: DataFrame
    postings: DataFrame
    frequency: DataFrame
    offices: DataFrame


def build_index(accounts: DataFrame, city_rules=None, root: str | None = None) -> AccountIndex:
    """The index of these accounts, written below ``root`` or a shared scratch folder.

    Accounts are normalised once. Of a list's accounts with one name or domain the last counts; a name
    keeps the place of its first.
    """
    spark = accounts.sparkSession
    root = root or shared_folder(spark, "account-index")

    def saved(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    raw = F.trim(F.coalesce("name", F.lit("")))
    given = F.when((raw != "") & (F.lower(raw) != "not provided"), normalise_name(F.col("name")))
    with ThreadPoolExecutor(2) as pool:  # tables that do not wait for each other are written side by side
        offices = pool.submit(saved, office_index(accounts, city_rules).withColumnRenamed("domain", "nd"), "offices")
        rows = saved(accounts.select(
            F.col("row_no").alias("row"), "list", given.alias("nn"), normalise_domain(F.col("domain")).alias("nd"),
            _account().alias("account")), "rows")

        def in_list(x: str) -> Column:
            return F.when(F.col("list") == x, F.col("row"))
        domains = pool.submit(saved, rows.where("nd <> ''").groupBy("nd").agg(
            *[F.max(in_list(x)).alias(x) for x in LISTS]), "domains")
        names = saved(rows.where("nn <> ''").groupBy("nn").agg(
            *[F.max(in_list(x)).alias(f"{x}_row") for x in LISTS],
            *[F.min(in_list(x)).alias(f"{x}_first") for x in LISTS]), "names")
        postings = saved(token_postings(names), "postings")
        frequency = saved(token_frequency(postings), "frequency")
        domains, offices = domains.result(), offices.result()
    return AccountIndex(rows.select("row", "account"),
                        names.select("nn", *[F.col(f"{x}_row").alias(x) for x in LISTS]),
                        domains, postings, frequency, offices)


def open_index(accounts: DataFrame, root: str, city_rules=None) -> AccountIndex:
    """The index below ``root`` of exactly these accounts and rules, built if there is none yet.

    The folder is named by a fingerprint of all rows, so lists that change get a new index and all readers of an
    unchanged list share one. It is built apart and then named by one file, so that of two
    builders at a time one wins and nobody reads half an index.
    """
    spark = accounts.sparkSession
    hashed = accounts.select(F.xxhash64(*accounts.columns).alias("h"))
    n, low, bits = hashed.agg(F.count("*"), F.sum(F.pmod("h", F.lit(1 << 31))), F.bit_xor("h")).first()
    rules = hashlib.md5(repr(CITY_MARKETS if city_rules is None else city_rules).encode()).hexdigest()
    name = f"{n}-{low or 0}-{(bits or 0) % (1 << 64):x}-{rules[:12]}"
    pointer = f"{root}/{name}"
    built = files.read_text(spark, pointer)
    if built is None:
        folder = f"{root}/tables-{uuid.uuid4().hex}"
        index = build_index(accounts, city_rules, folder)
        if files.create(spark, pointer, folder):
            return index
        built = files.read_text(spark, pointer)
    tables = {f: spark.read.parquet(f"{built}/{f}") for f in AccountIndex._fields}
    tables["names"] = tables["names"].select("nn", *[F.col(f"{x}_row").alias(x) for x in LISTS])
    return AccountIndex(**tables | {"rows": tables["rows"].select("row", "account")})


# --- the match waterfall --------------------------------------------------------------------------

def spread_blank(key: Column, *by: str) -> Column:
    """The key, with blanks replaced by values that match nothing and fall on many tasks."""
    spread = F.concat(F.lit("\u0000"), F.xxhash64(*by).cast("string"))
    return F.when(F.coalesce(key, F.lit("")) == "", spread).otherwise(key)


def _index(accounts: DataFrame | AccountIndex) -> AccountIndex:
    return accounts if isinstance(accounts, AccountIndex) else build_index(accounts)


def match_names(companies: DataFrame, accounts: DataFrame | AccountIndex, name: str) -> DataFrame:
    """Adds by_name and by_tokens: struct(managed, unmanaged) of candidate account rows."""
    index = _index(accounts)
    others = [c for c, kind in companies.dtypes if kind in ("string", "bigint", "double")]
    keyed = companies.withColumn("nn", spread_blank(normalise_name(F.col(name)), *others))
    exact = index.names.select("nn", F.struct(*LISTS).alias("by_name"))
    asked = keyed.where(~F.startswith("nn", F.lit("\u0000")))
    tokens = token_rows(asked, index.frequency, index.postings).select("nn", F.struct(*LISTS).alias("by_tokens"))
    return keyed.join(exact, "nn", "left").join(tokens, "nn", "left").drop("nn")


def match_domains(companies: DataFrame, accounts: DataFrame | AccountIndex, domain: str) -> DataFrame:
    """Adds by_domain."""
    index = _index(accounts).domains.select("nd", F.struct(*LISTS).alias("by_domain"))
    others = [c for c, kind in companies.dtypes if kind in ("string", "bigint", "double")]
    keyed = companies.withColumn("nd", spread_blank(normalise_domain(F.col(domain)), *others))
    return keyed.join(index, "nd", "left").drop("nd")


def pick_row(*steps: str) -> Column:
    """struct(segment, row): all steps of the managed list before the unmanaged ones; null if none has a row."""
    ranked = []
    for name in LISTS:
        row = F.coalesce(*[F.col(f"{s}.{name}") for s in steps])
        ranked.append(F.when(row.isNotNull(), F.struct(F.lit(name).alias("segment"), row.alias("row"))))
    return F.coalesce(*ranked)


def with_account(companies: DataFrame, accounts: AccountIndex, pick: Column, out: str = "pick") -> DataFrame:
    """Adds ``out``: struct(segment, account) of a picked row, prospect where there is none."""
    rows = accounts.rows.select(F.col("row").alias("_row"), F.col("account").alias("_account"))
    picked = companies.withColumn("_pick", pick)
    joined = picked.join(rows, F.col("_pick.row") == F.col("_row"), "left")
    segment = F.coalesce("_pick.segment", F.lit("prospect"))
    return joined.withColumn(out, F.struct(segment.alias("segment"), F.col("_account").alias("account"))).drop(
        "_pick", "_row", "_account")


def match_accounts(companies: DataFrame, accounts: DataFrame | AccountIndex, name: str,
                   domain: str) -> DataFrame:
    """Adds segment and account (null for prospects) by domain, name, then tokens.

    Companies are stored first, since two steps read them.
    """
    index = _index(accounts)
    matched = match_domains(match_names(stored(companies, "companies"), index, name), index, domain)
    picked = with_account(matched, index, pick_row("by_domain", "by_name", "by_tokens"), "_picked")
    return (picked.withColumn("segment", F.col("_picked.segment")).withColumn("account", F.col("_picked.account"))
            .drop("_picked", "by_domain", "by_name", "by_tokens"))
