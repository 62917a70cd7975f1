"""Payloads that can't be read: told apart, counted and kept, while all others go on.

A payload is parsed once. The parse gives the rows of its source and, beside them, the reason why it
can't be used:

* ``empty``: null or blank;
* ``unparseable``: no JSON, such as a response that was cut;
* ``mistyped``: JSON with a field of another type than its source has; its other fields still count;
* ``missing``: JSON without any of the lists that hold postings, such as an error message.

A list without postings is fine, and so is a page without embedded state, which is read otherwise.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, functions as F

from .. import schemas as T
from ..functions import text as X

REASONS = ("empty", "unparseable", "mistyped", "missing")
_UNREAD = "_unread"
REJECTED = "source string, input string, reason string, payload_hash string, seq string"


class Shape(NamedTuple):
    """What a source expects of the payloads for which the SQL condition ``when`` holds."""

    schema: str
    paths: tuple[str, ...]
    state: bool = False
    when: str | None = None

    def text(self) -> Column:
        return X.page_state(F.col("payload")) if self.state else F.col("payload")

    def read(self) -> Column:
        """The payload as a struct, with the whole text where a part of it does not fit the schema.

        A list at the top becomes the field ``items``: only structs can carry that text.
        """
        text, schema = self.text(), self.schema
        if schema.startswith("array<"):
            text, schema = F.concat(F.lit('{"items":'), text, F.lit("}")), f"items {schema}"
        return F.from_json(text, f"{schema}, {_UNREAD} string", {"columnNameOfCorruptRecord": _UNREAD})

    def reason(self, read: str) -> Column:
        """Why the payload read into the named column can't be used, or null."""
        text = self.text()
        lists = [F.col(f"{read}.{p or 'items'}").isNotNull() for p in self.paths]
        json = F.try_parse_json(text)
        return (F.when(F.col("payload").isNull() | ~F.col("payload").rlike(r"\S"), "empty")
                .when(text.isNull(), F.lit(None))
                .when(F.col(f"{read}.{_UNREAD}").isNotNull() | F.col(read).isNull(),
                      F.when(json.isNull(), "unparseable").otherwise("mistyped"))
                .when(~X.any_of(lists), "missing"))


# What each source expects of its inputs.
SHAPES: dict[str, dict[str, tuple[Shape, ...]]] = {
    "gh": {"landed": (Shape(T.GREENHOUSE, ("jobs",)),)},
    "lv": {"landed": (Shape(T.LEVER, ("",)),)},
    "ab": {"landed": (Shape(T.ASHBY, ("jobs", "jobPostings")),)},
    "bn": {"landed": (Shape(T.SEARCH_PAGE, ("props.pageProps.jobs", "props.pageProps.jobListings"), True),)},
    "wd": {"lists": (Shape(T.WORKDAY_LIST, ("jobPostings",)),),
           "details": (Shape(T.WORKDAY_DETAIL, ("jobPostingInfo",)),)},
    "gd": {"landed": (Shape(T.EMPLOYER_PAGE, ("props.pageProps.jobListings.jobListings",), True),)},
    "ap": {"landed": (Shape(T.LINKEDIN, ("",)),)},
    "wf": {"landed": (Shape(T.WELLFOUND, ("data.talent.jobListings.edges",), when="startswith(trim(payload), '{')"),
                      Shape(T.WELLFOUND_PAGE, ("props.pageProps.jobListings",), True))},
    "ex": {"landed": (Shape(T.EXA, ("results",)),)},
    "fc": {"landed": (Shape(T.FIRECRAWL, ("data",)),)},
    "ts": {"landed": (Shape(T.THEIRSTACK, ("data",)),)},
    "sb": {"landed": (Shape(T.SUMBLE, ("jobs",)),)},
    "da": {"landed": (Shape(T.GREENHOUSE, ("jobs",), when="ats_type = 'greenhouse'"),
                      Shape(T.LEVER, ("",), when="ats_type = 'lever'"),
                      Shape(T.ASHBY, ("jobs", "jobPostings"), when="ats_type = 'ashby'"))},
}


def with_reason(landed: DataFrame, shapes: tuple[Shape, ...]) -> DataFrame:
    """Adds ``_why``, and ``_p`` with the parse where payloads are of one shape, which the source then uses."""
    names = ["_p"] if len(shapes) == 1 else [f"_p{k}" for k in range(len(shapes))]
    def asked(shape: Shape, value: Column) -> Column:
        return value if shape.when is None else F.when(F.expr(shape.when), value)
    read = landed.withColumns({n: asked(s, s.read()) for n, s in zip(names, shapes)})
    why = F.lit(None).cast("string")
    for name, shape in reversed(list(zip(names, shapes))):
        why = shape.reason(name) if shape.when is None else F.when(
            F.expr(shape.when), shape.reason(name)).otherwise(why)
    read = read.withColumn("_why", why)
    return read if len(shapes) == 1 else read.drop(*names)


def watched(landed: DataFrame, shapes: tuple[Shape, ...], seen: Observation) -> DataFrame:
    """``landed`` with its payloads parsed; ``seen`` counts payloads and rejects by reason as they pass."""
    read = with_reason(landed, shapes).observe(
        seen, F.count("*").alias("payloads"), *[F.count_if(F.col("_why") == r).alias(r) for r in REASONS])
    return read.drop("_why")


def counts(seen: Observation) -> dict[str, int] | None:
    """What an observation counted; None where adaptive execution left the counting branch out."""
    try:
        return seen.get
    except Py4JJavaError:
        return None


def rejected(landed: DataFrame, shapes: tuple[Shape, ...], source: str, name: str = "landed") -> DataFrame:
    """One row (source, input, reason, payload_hash, seq) for each payload that can't be used."""
    why = with_reason(landed, shapes).where("_why is not null")
    return why.select(F.lit(source).alias("source"), F.lit(name).alias("input"), F.col("_why").alias("reason"),
                      F.md5(F.coalesce("payload", F.lit(""))).alias("payload_hash"), "seq")


def _each(inputs: dict[str, dict[str, DataFrame]], one) -> DataFrame:
    """The union of ``one(key, input, landed, shapes)`` over all inputs that hold payloads."""
    parts = [one(key, name, inputs[key][name], shapes) for key, own in SHAPES.items() if key in inputs
             for name, shapes in own.items() if name in inputs[key]]
    if not parts:
        raise ValueError("none of the inputs holds payloads")
    return reduce(lambda a, b: a.unionByName(b), parts)


def rejected_payloads(inputs: dict[str, dict[str, DataFrame]], labels: dict[str, str]) -> DataFrame:
    """The rejects of all inputs, with their place as JSON, since inputs may be numbered differently."""
    return _each(inputs, lambda key, name, landed, shapes: rejected(landed, shapes, labels[key], name)
                 .withColumn("seq", F.to_json(F.struct("seq"))))


def reject_report(inputs: dict[str, dict[str, DataFrame]], labels: dict[str, str]) -> DataFrame:
    """(source, input, reason, payloads, first_payload): how many, and the hash of the first in reading order."""
    return _each(inputs, lambda key, name, landed, shapes: rejected(landed, shapes, labels[key], name)
                 .groupBy("source", "input", "reason").agg(
                     F.count("*").alias("payloads"), F.min_by("payload_hash", "seq").alias("first_payload")))
