"""Alert rows: companies routed to territories, listed and assembled as message payloads."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import nonblank
from ..lexicon import DEFAULT_CHANNELS, SOURCE_LABELS
from .dedup import last_wins
from .markets import OTHER
from .state import name_key

SEGMENTS = ("managed", "unmanaged", "prospect")

# The texts of a message, by segment. Names in braces are filled in.
MESSAGES = {
    "header": {
        "managed": ":briefcase: {count} Managed Account{s} — {market}",
        "unmanaged": ":dart: {count} Unmanaged Account{s} — {market}",
        "prospect": ":fork_and_knife: {count} New Lunch Perk Prospects"},
    "context": {
        "managed": "{tag}{day}  •  Rep-owned accounts with active food perk hiring activity",
        "unmanaged": "{tag}{day}  •  Unmanaged accounts with active food perk hiring activity",
        "prospect": "{day}  •  {total} total companies in database"},
    "left_out": {
        "managed": "_...and {more} more managed accounts in {market}._",
        "unmanaged": "_...and {more} more unmanaged accounts in {market}._",
        "prospect": "_...and {more} more. Open the dashboard to see all._"},
    "closing": {
        "managed": ":bulb: These rep-owned accounts are actively hiring roles that mention food perks.",
        "unmanaged": ":bulb: These unmanaged accounts are actively hiring roles that mention food perks.",
        "prospect": ":bulb: These companies mention food perks (DoorDash, GrubHub, free lunch, catered "
                    "meals, etc.) in job postings. All listings verified live as of today."},
    "summary": {
        "managed": ":briefcase: {count} managed accounts with food perk signal — {market}",
        "unmanaged": ":dart: {count} unmanaged accounts with food perk signal — {market}",
        "prospect": ":fork_and_knife: {count} new lunch perk prospects found"},
}

# The parts of a company's text.
COMPANY = {
    "managed": ":rotating_light: *MANAGED ACCT*  ",
    "link": "*<{sample_url}|{company}>*  `score: {score}`",
    "market": " :round_pushpin: {market}",
    "vertical": "  `{ezcater_vertical}`",
    "accelerating": "  :fire: *Accelerating*",
    "signal": "\n{source}\n:pushpin: _{roles} role{s} mentioning food perks_ — `{top_keywords}`\n",
    "confirmed": "\n:construction: *Expanding to: {confirmed}* — new office signal from JDs",
    "possible": "\n:construction: Possible expansion: {possible} — watch list",
    "perk": "\n> \"{perk}\"\n",
}


def territories(table: DataFrame) -> DataFrame:
    """One row per market, the last of duplicates (needs ``row_no``)."""
    return last_wins(table, ["market"], "row_no").drop("row_no")


def with_territory(df: DataFrame, table: DataFrame, market: str = "market") -> DataFrame:
    """Adds rep_name, slack_handle and webhook_env_var; unlisted markets take Other's row."""
    fields = [c for c in table.columns if c != "market"]
    named = table.select(F.col("market").alias(market), F.struct(*fields).alias("_t"))
    # The default is a single row.
    other = table.where(F.col("market") == OTHER).agg(
        F.first(F.struct(*fields)).alias("_other"))
    joined = df.join(named, market, "left").join(F.broadcast(other), how="cross")
    picked = joined.withColumn("_t", F.coalesce("_t", "_other"))
    for f in fields:
        picked = picked.withColumn(f, F.coalesce(F.col(f"_t.{f}"), F.lit("")))
    return picked.drop("_t", "_other")


def rep_tag(handle: Column, rep: Column) -> Column:
    """"<@handle> ", else "@rep ", else blank; Unassigned counts as no rep."""
    handle, rep = F.trim(handle), F.trim(rep)
    return (F.when(handle != "", F.concat(F.lit("<@"), handle, F.lit("> ")))
            .when((rep != "") & (F.lower(rep) != "unassigned"),
                  F.concat(F.lit("@"), rep, F.lit(" "))).otherwise(F.lit("")))


def channel(env_var: Column, segment: Column, configured: list[str],
            defaults: dict[str, str] = DEFAULT_CHANNELS) -> Column:
    """Key of the first configured channel: the territory's, the segment's, the global one."""
    def usable(key: Column) -> Column:
        return F.when(key.isin(configured), key)
    options = [F.when(segment != "prospect", usable(env_var))]
    options += [F.when(segment == name, usable(F.lit(key))) for name, key in defaults.items()]
    return F.coalesce(*options, usable(F.lit(defaults["prospect"])))


def source_label(source: Column, labels: dict[str, str] = SOURCE_LABELS) -> Column:
    chain = F.when(F.lit(False), F.lit(""))
    for name, label in labels.items():
        chain = chain.when(source == name, F.lit(label))
    return chain.otherwise(F.concat(F.lit(":white_circle: "), source))


def filled(template: str, values: dict[str, Column]) -> Column:
    """A text with its {names} replaced by columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if i % 2 or p])


def company_text(c) -> Column:
    """Message text of one company. ``c`` gives a column by name."""
    values = {n: c(n) for n in ("sample_url", "company", "market", "ezcater_vertical", "top_keywords")}
    values |= {"score": c("gtm_score").cast("string"), "source": source_label(c("best_source")),
               "roles": c("role_count").cast("string"), "perk": F.substring(c("perk_excerpt"), 1, 140),
               "s": F.when(c("role_count") != 1, "s").otherwise(""),
               "confirmed": c("expansion_confirmed"), "possible": c("expansion_possible")}

    def tag(name: str, condition: Column) -> Column:
        return F.when(condition, filled(COMPANY[name], values)).otherwise(F.lit(""))

    confirmed = c("expansion_confirmed") != ""
    return F.concat(
        tag("managed", c("segment") == "managed"), filled(COMPANY["link"], values),
        tag("market", ~c("market").isin("", OTHER)), tag("vertical", c("ezcater_vertical") != ""),
        tag("accelerating", c("accelerating") == 1), filled(COMPANY["signal"], values),
        tag("confirmed", confirmed), tag("possible", ~confirmed & (c("expansion_possible") != "")),
        tag("perk", values["perk"] != ""))


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int = 10) -> DataFrame:
    """First n rows of each group with ``position``, ``total`` and ``more`` (rows left out).

    The limit on row_number lets Spark drop all but n rows per group before the shuffle;
    totals come from a combining aggregate and not from a window over whole groups.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    totals = df.groupBy(*keys).agg(F.count("*").alias("total"))
    ranked = df.withColumn("position", F.row_number().over(window)).where(F.col("position") <= n)
    return ranked.join(totals, keys).withColumn("more", F.greatest(F.col("total") - n, F.lit(0)))


def alert_rows(new: DataFrame, velocity_flags: DataFrame, table: DataFrame,
               configured: list[str], n: int = 10) -> DataFrame:
    """Companies to announce: the first n of each segment and market.

    Prospects form one group over all markets. Rows without a configured channel are
    dropped, as there is nowhere to send them. ``velocity_flags`` is accelerating().
    """
    flags = velocity_flags.select(name_key("company_name").alias("_key"), "accelerating")
    flags = flags.groupBy("_key").agg(F.max("accelerating").alias("accelerating"))
    market = F.coalesce(nonblank("market"), F.lit(OTHER))
    group = F.when(F.col("segment") == "prospect", F.lit("")).otherwise(market)
    df = new.withColumn("group_market", group)
    top = top_per_group(df, ["segment", "group_market"], [F.desc("gtm_score"), F.col("company")],
                        n)
    top = (top.withColumn("_key", name_key("company")).join(flags, "_key", "left")
           .withColumn("accelerating", F.coalesce("accelerating", F.lit(0))).drop("_key"))
    routed = with_territory(top, table, "group_market")
    key = channel(F.col("webhook_env_var"), F.col("segment"), configured)
    return (routed.withColumn("channel_key", key).where("channel_key is not null")
            .withColumn("rep_tag", rep_tag(F.col("slack_handle"), F.col("rep_name")))
            .withColumn("text", company_text(F.col)))


def _block(kind: str, text: Column | None = None, style: str = "mrkdwn",
           context: Column | None = None) -> Column:
    text_type = "struct<type:string,text:string,emoji:boolean>"
    element_type = "array<struct<type:string,text:string>>"
    body = (F.lit(None).cast(text_type) if text is None else F.struct(
        F.lit(style).alias("type"), text.alias("text"),
        F.when(F.lit(style == "plain_text"), F.lit(True)).alias("emoji")))
    elements = (F.lit(None).cast(element_type) if context is None else F.array(F.struct(
        F.lit("mrkdwn").alias("type"), context.alias("text"))))
    return F.struct(F.lit(kind).alias("type"), body.alias("text"), elements.alias("elements"))


def payloads(rows: DataFrame, day_label: str, companies_total: Column) -> DataFrame:
    """One message per segment and market: channel_key, segment, market, n, payload_json.

    A group holds at most the n rows kept by alert_rows. ``day_label`` is the printed date.
    """
    grouped = rows.groupBy("channel_key", "segment", F.col("group_market").alias("market")).agg(
        F.max("total").alias("n"), F.max("more").alias("more"), F.max("rep_tag").alias("rep_tag"),
        F.array_sort(F.collect_list(F.struct("position", "text"))).alias("items"))
    count, plural = F.col("n").cast("string"), F.when(F.col("n") != 1, "s").otherwise("")
    more, market = F.col("more").cast("string"), F.col("market")

    def by_segment(managed: Column, unmanaged: Column, prospect: Column) -> Column:
        return (F.when(F.col("segment") == "managed", managed)
                .when(F.col("segment") == "unmanaged", unmanaged).otherwise(prospect))

    values = {"count": count, "s": plural, "market": market, "more": more, "day": F.lit(day_label),
              "tag": F.col("rep_tag"), "total": companies_total.cast("string")}
    header, context, left_out, closing, summary = [
        by_segment(*[filled(MESSAGES[part][kind], values) for kind in SEGMENTS])
        for part in ("header", "context", "left_out", "closing", "summary")]

    sections = F.transform("items", lambda i: _block("section", i["text"]))
    overflow = F.when(F.col("more") > 0, F.array(_block("section", left_out))).otherwise(
        F.slice(F.array(_block("divider")), 1, 0))
    blocks = F.concat(
        F.array(_block("header", header, "plain_text"), _block("context", context=context),
                _block("divider")),
        sections, overflow,
        F.array(_block("divider"), _block("context", context=closing)))
    body = F.struct(summary.alias("text"), blocks.alias("blocks"))
    return grouped.select("channel_key", "segment", "market", "n",
                          F.to_json(body).alias("payload_json"))
