"""How five filters act in each of their 120 orders, from one table of counts.

A document fails a set of filters, its mask.  In an order of the filters it is removed at the
first one it fails.  Orders are numbered lexicographically (the Lehmer code in factorial
digits), so all orders with a given beginning of i filters are one interval of (5 - i)! ranks.
What a mask does at step i depends on those i filters only: it is one and the same over an
interval.  So each mask adds its counts at the beginning of an interval and takes them off at
its end; a running sum over the 120 ranks then has the totals of every order.

Documents are read once and reduced to counts by part and mask, 32 rows a part; the
difference arrays have 120 ranks and 5 steps whatever the number of documents.  Equal texts
are found by a digest of 256 bits and pre-aggregated before every shuffle, so a large group
of copies is a few rows for each task.

Defined results: a NULL text is empty and equal to other empty ones; a NULL or empty ``lang``
is the part ``""``.  Rows with the smallest id of their text are no copies, however often that
row is repeated, and neither are rows without an id, to which no text is a copy.  A document
counts as good (toxic) if any row of its labels says so.  Texts of any length are taken whole.
Columns beyond ``doc_id``, ``text`` and ``lang`` are not read.  An empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import WORD

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
STEPS = len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]  # in lexicographic order: the index is the rank

# Fixed values of the filters.
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # percent of the words
MOST_CAPITALS = 3  # percent of the code points
SIGNS = r"[#$%&*|]"


def own_mask(text: Column) -> Column:
    """Bits of the filters that a text fails by itself: A to D."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words).cast("long")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    failed = [
        n < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)).cast("long") < LEAST_DISTINCT * n,
        100 * capitals > MOST_CAPITALS * F.length(text).cast("long"),
        text.rlike(SIGNS),
    ]
    return sum((F.when(f, F.lit(1 << k)).otherwise(0) for k, f in enumerate(failed)), F.lit(0))


def labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, part, text digest, mask A to D, good, toxic) of every document."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.sha2(text, 256).alias("digest"), own_mask(text).alias("mask"))
    flags = [(F.col(source) == 1).alias(name) for source, name in (("quality", "good"), ("toxic", "toxic"))]
    known = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").select("doc_id", *flags)
    known = known.groupBy("doc_id").agg(*[F.coalesce(F.bool_or(k), F.lit(False)).alias(k) for k in ("good", "toxic")])
    return rows.join(known, "doc_id", "left").withColumns({
        k: F.coalesce(k, F.lit(False)).cast("long") for k in ("good", "toxic")})


def mask_counts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, documents, good, toxic): documents by all filters that they fail."""
    alike = ["digest", "part", "mask", "good", "toxic"]
    repeats = labelled(documents, labels).groupBy(*alike, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least")
    nameless = F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless")
    groups = repeats.groupBy(*alike).agg(F.sum("n").alias("n"), least, nameless)
    # A text has at most four rows for each part here, whatever the number of its copies.
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    original = F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(0) + F.col("nameless")
    split = groups.select(*alike, "n", original.alias("original")).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("mask"), F.col("original").alias("n")),
            F.struct(F.col("mask").bitwiseOR(F.lit(COPY)).alias("mask"), (F.col("n") - F.col("original")).alias("n")))).alias("m"))
    return split.where("m.n > 0").groupBy("part", "m.mask").agg(
        F.sum("m.n").alias("documents"), F.sum(F.col("m.n") * F.col("good")).alias("good"),
        F.sum(F.col("m.n") * F.col("toxic")).alias("toxic"))


def interval(beginning: str) -> tuple[int, int]:
    """First rank of the orders that begin so, and the rank after the last one."""
    rest, first = FILTERS, 0
    for k, letter in enumerate(beginning):
        first += rest.index(letter) * factorial(STEPS - 1 - k)
        rest = rest.replace(letter, "")
    return first, first + factorial(len(rest))


def differences() -> list[tuple[int, int, int, int, int, int, int]]:
    """(mask, step, rank, here, removed, redundant, only): what a document of a mask changes.

    ``here`` begins at rank 0 of each step; the other three go up at the beginning of an
    interval of orders and down at its end.  All ranks are listed, zeros too.
    """
    out = []
    beginnings = [p for size in range(1, STEPS + 1) for p in permutations(FILTERS, size)]
    for mask in range(1 << STEPS):
        fails = {f for k, f in enumerate(FILTERS) if mask >> k & 1}
        change = {(step, rank): [int(rank == 0), 0, 0, 0]
                  for step in range(1, STEPS + 1) for rank in range(len(ORDERS) + 1)}
        for beginning in beginnings:
            *before, last = beginning
            if last not in fails:
                continue
            first, end = interval("".join(beginning))
            gone = not fails.isdisjoint(before)
            for rank, sign in ((first, 1), (end, -1)):
                at = change[len(beginning), rank]
                at[2 if gone else 1] += sign
                at[3] += sign * (len(fails) == 1)
        out += [(mask, step, rank, *values) for (step, rank), values in change.items() if rank < len(ORDERS)]
    return out


def difference_table(spark: SparkSession) -> DataFrame:
    """``differences`` as a table of 32 masks, 5 steps and 120 ranks, the same for any data."""
    return spark.createDataFrame(
        differences(), "mask int, step int, rank int, here int, removed int, redundant int, only int")


def audit(counts: DataFrame) -> DataFrame:
    """One row for each part, order and step, from counts by mask.

    See ``mask_counts``; the counts are long, and ``shapley`` is the sum of what the row's
    filter removes over all orders.
    """
    n = F.col("documents")
    added = counts.join(F.broadcast(difference_table(counts.sparkSession)), "mask").groupBy("part", "step", "rank").agg(
        *[F.sum(n * F.col(k)).alias(k) for k in ("here", "removed", "redundant", "only")],
        *[F.sum(F.col(k) * F.col("removed")).alias(f"{k}_lost") for k in ("good", "toxic")])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    measures = ("here", "removed", "redundant", "only", "good_lost", "toxic_lost")
    totals = added.select("part", "step", "rank", *[F.sum(k).over(along).alias(k) for k in measures])
    order = F.array(*[F.lit(o) for o in ORDERS])[F.col("rank")]
    named = totals.select("*", order.alias("filter_order")).withColumn("filter", F.expr("substring(filter_order, step, 1)"))
    steps = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return named.select(
        "part", "filter_order", "step", (F.col("here") - F.sum("removed").over(steps)).alias("kept"), "removed",
        "redundant", F.col("only").alias("unique_fails"), "good_lost", "toxic_lost",
        F.sum("removed").over(Window.partitionBy("part", "filter")).alias("shapley"))
