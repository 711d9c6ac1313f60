"""URL filter by path templates, one tree of path segments per host.

Addresses (host, path) are counted once and walk down the tree together, one segment per
level.  At a node, segments seen fewer than ``LEAST_SEEN`` times are variable and become a
wildcard (``#`` for digits inside them, ``~`` if they have none).  The others are branches;
those whose shares of blocked and allowed addresses do not differ from their siblings'
pooled shares by more than ``Z`` standard errors are merged into ``*``, the rest keep their
name.  The tree is as deep as paths are that many pages share: once no node is left with
``LEAST_SEEN`` pages that go on, no segment can be a branch any more, and all further ones
become wildcards together.

The fixed rules label the addresses they fit.  A template is rejected if
blocked / (blocked + allowed + ``SMOOTHING``) reaches ``REJECT``; without labels it stays.

Every level is aggregated before it is joined, and the joined tables are written first, so
that adaptive execution may broadcast the small ones and split a host, template or address
with a third of all rows.  Only DataFrame functions run here.

Defined results: a NULL URL, or one without ``://``, has an empty host and path and is its
own address; it fits no rule.  Repeated pages get the same verdict, each in its own row.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import ascii_lower, drop, settle

# The rules that come first, and their verdicts.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
LEAST_SEEN = 5
Z = 2.58
SMOOTHING, REJECT = 4.0, 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or NULL."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{rest}"))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def addresses(pages: DataFrame, rules=RULES) -> DataFrame:
    """Distinct (host, path) with number of pages, labelled counts and segments."""
    host, path = host_and_path(F.col("url"))
    counted = pages.select(host.alias("host"), path.alias("path")).groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("pages"))
    verdict = F.lit(None).cast("string")
    for rule, said in rules:
        verdict = F.when(F.col("rule") == rule, F.lit(said)).otherwise(verdict)
    return (
        counted.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
        .withColumn("said", verdict)
        .withColumn("blocked", F.when(F.col("said") == "block", F.col("pages")).otherwise(0))
        .withColumn("allowed", F.when(F.col("said") == "allow", F.col("pages")).otherwise(0))
        .withColumn("segments", F.array_remove(F.split("path", "/"), ""))
        .withColumn("template", F.lit(""))
    )


def _wildcard(segment: Column) -> Column:
    digits = F.regexp_replace(segment, "[0-9]+", "#")
    return F.when(digits == segment, "~").otherwise(digits)


def _differs(part: str) -> Column:
    """Whether a branch's share of ``part`` is too far from that of all branches of its node."""
    seen, seen_all = F.col("pages").cast("double"), F.col("all_pages").cast("double")
    pooled = (F.col(f"all_{part}") + F.lit(1.0)) / (seen_all + 2.0)
    gap = F.col(part) / seen - F.col(f"all_{part}") / seen_all
    return gap * gap > Z * Z * pooled * (1.0 - pooled) / seen


def descend(state: DataFrame, level: int, least_seen: int = LEAST_SEEN) -> DataFrame | None:
    """``state`` with one more segment in every template that goes on at ``level``.

    None if no node has ``least_seen`` pages that go on.
    """
    going = state.withColumn("segment", F.get("segments", F.lit(level)))
    children = settle(going.where(F.col("segment").isNotNull()).groupBy("host", "template", "segment").agg(
        *[F.sum(c).alias(c) for c in ("pages", "blocked", "allowed")]), f"url-children-{level}")
    if children.groupBy("host", "template").agg(F.sum("pages").alias("n")).where(F.col("n") >= least_seen).isEmpty():
        drop(children)
        return None
    branches = children.where(F.col("pages") >= least_seen)
    nodes = settle(branches.groupBy("host", "template").agg(
        *[F.sum(c).alias(f"all_{c}") for c in ("pages", "blocked", "allowed")]), f"url-nodes-{level}")
    named = branches.join(nodes, ["host", "template"]).withColumn(
        "name", F.when(_differs("blocked") | _differs("allowed"), F.col("segment")).otherwise("*"))
    rare = children.where(F.col("pages") < least_seen).withColumn("name", _wildcard(F.col("segment")))
    names = settle(named.select("host", "template", "segment", "name").unionByName(
        rare.select("host", "template", "segment", "name")), f"url-names-{level}")
    return settle(
        going.join(names, ["host", "template", "segment"], "left").withColumn(
            "template", F.when(F.col("name").isNull(), F.col("template"))
            .otherwise(F.concat("template", F.lit("/"), "name"))).drop("segment", "name"), f"url-level-{level}")


def templates(pages: DataFrame, rules=RULES, least_seen: int = LEAST_SEEN) -> tuple[DataFrame, DataFrame]:
    """(addresses with their templates, templates with counts, purity and ``rejected``)."""
    state = settle(addresses(pages, rules), "url-addresses")
    level = 0
    while (deeper := descend(state, level, least_seen)) is not None:
        drop(state)  # written anew, one segment further
        state, level = deeper, level + 1
    rare = F.slice("segments", F.lit(level + 1), F.greatest(F.size("segments") - level, F.lit(0)))
    rest = F.array_join(F.transform(rare, lambda s: F.concat(F.lit("/"), _wildcard(s))), "")
    state = settle(state.withColumn("template", F.concat("template", rest)), "url-paths")
    known = state.groupBy("host", "template").agg(
        *[F.sum(c).alias(c) for c in ("pages", "blocked", "allowed")])
    purity = F.col("blocked") / (F.col("blocked") + F.col("allowed") + F.lit(SMOOTHING))
    known = known.withColumn("purity", purity).withColumn("rejected", F.col("purity") >= REJECT)
    return state, settle(known, "url-templates")


def judge(pages: DataFrame, rules=RULES, least_seen: int = LEAST_SEEN) -> DataFrame:
    """(page_id, host, path, rule, verdict, template) for every page."""
    state, known = templates(pages, rules, least_seen)
    judged = state.join(known.select("host", "template", "rejected"), ["host", "template"]).select(
        "host", "path", "rule", "template",
        F.coalesce("said", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"))
    judged = settle(judged, "url-verdicts")
    host, path = host_and_path(F.col("url"))
    return (
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .join(judged, ["host", "path"])
        .select("page_id", "host", "path", "rule", "verdict", "template")
    )
