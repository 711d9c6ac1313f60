"""Mixing sources to target weights by a time-varying curriculum.

Sources in code-point order (NULL last) weigh 5, 2, 1 and so on.  Together they are owed
``share`` of all words; none gets more than ``most`` times its own, and what it cannot
take is shared again by weight.  Each source also has a schedule: its weight over training
time as a broken line.  The integral of the schedule is the source's cumulative demand;
documents, in a fixed random order within their source, meet that demand word by word, so
inverting it gives each one its training position between 0 and 1.  A second pass over a
source starts where the first ended.  ``sequence`` is the mix itself: a row for each take,
range-sorted by position and numbered.

Cumulative words come from sums per (source, cell of the random order) and a ranking
inside a cell, so a source with a third of all rows is spread like any other.

Defined results: a NULL text has no words; sources of size 0 have target 0; the NULL source
is a source.  Rows equal in id, source and size are interchangeable and handled as one item
with a number of copies.  The last take of a source is cut where its target ends, so the
words taken differ from the target by less than one.  Texts of any length are counted whole.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import WORD, quoted, settle

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
#: (time, weight) knots by place in the cycle of weights: early, even and late sources.
SCHEDULES = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)),
             ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))
#: Hexadecimal digits of the random order that make a cell: 4096 cells for each source.
CELL_DIGITS = 3


def numbered(df: DataFrame, into: str, *order: Column) -> DataFrame:
    """Rows with their place in ``order`` from 0; only one count per partition reaches the driver."""
    mark = "__mark"
    sorted_ = settle(df.orderBy(*order).withColumn(mark, F.monotonically_increasing_id()), "sorted")
    part = F.shiftright(mark, 33)
    counts = sorted_.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).collect()
    before, firsts = 0, []
    for r in sorted(counts):
        firsts.append((r["part"], before))
        before += r["rows"]
    firsts = df.sparkSession.createDataFrame(firsts, "__part long, __first long")
    return (
        sorted_.withColumn("__part", part).join(F.broadcast(firsts), "__part")
        .withColumn(into, F.col("__first") + F.col(mark).bitwiseAND(F.lit((1 << 33) - 1)))
        .drop(mark, "__part", "__first")
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """``sources`` (source, source_size) with weight class, weight and target.

    Each round adds two sums over the sources; capped sources stay capped, so it ends.
    """
    ranked = numbered(sources, "kind", F.asc_nulls_last("source")).withColumn(
        "kind", (F.col("kind") % len(weights)).cast("int"))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("kind") + 1).cast("double")
    ranked = settle(ranked.withColumn("weight", weight), "sources")
    owed = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        full = (F.col("source_size") * most < F.col("weight") * level) if capped >= 0 else F.lit(False)
        seen = ranked.agg(
            F.coalesce(F.sum(F.when(full, F.col("source_size") * most)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum(full.cast("int")), F.lit(0))).first()
        if seen[2] == capped or not seen[1]:
            break
        level, capped = (owed - float(seen[0])) / seen[1], seen[2]
    target = F.least(F.col("source_size").cast("double") * most, F.col("weight") * level)
    return ranked.withColumn("target", target)


def _integral(knots) -> list[tuple[float, float, float, float, float]]:
    """Segments (time, weight, slope, demand before, demand after)."""
    done, out = 0.0, []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        area = (w0 + w1) * (t1 - t0) / 2
        out.append((t0, w0, (w1 - w0) / (t1 - t0), done, done + area))
        done += area
    return out


def position(demand: Column, kind: Column, schedules=SCHEDULES) -> Column:
    """Training time at which a source of that kind has met this share of its demand."""
    found = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        segments = _integral(knots)
        area = demand * segments[-1][4]
        inverse = F.lit(float(knots[-1][0]))
        for t0, w0, slope, before, after in reversed(segments):
            more = F.greatest(area - before, F.lit(0.0))
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * more, F.lit(0.0)))
            at = t0 + F.when(more > 0, 2 * more / (w0 + root)).otherwise(0.0)
            inverse = F.when(area < after, at).otherwise(inverse)
        found = F.when(kind == k, inverse).otherwise(found)
    return found


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plan(sized: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, schedules=SCHEDULES) -> DataFrame:
    """Items of (doc_id, source, size) with ``copies`` and where they lie in their source.

    ``start`` is the number of words of the source before the item's first copy.
    """
    items = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
    lot = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                            F.col("size").cast("string")).cast("binary"))
    items = settle(items.withColumn("lot", lot), "mix-items").withColumn(
        "cell", F.substring("lot", 1, CELL_DIGITS))
    held = F.col("size") * F.col("copies")
    cells = items.groupBy("source", "cell").agg(F.sum(held).alias("words"))
    sources = targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")),
                      weights, share, most)
    cells = cells.withColumn("before", F.sum("words").over(
        Window.partitionBy("source").orderBy("cell")) - F.col("words"))
    cells = cells.alias("c").join(sources.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select(
        F.col("c.source").alias("of"), F.col("c.cell").alias("lots"), "before", "source_size", "kind", "target")
    earlier = (
        Window.partitionBy("source", "cell").orderBy("lot", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        items.withColumn("inside", F.coalesce(F.sum(held).over(earlier), F.lit(0)))
        .join(cells, F.col("source").eqNullSafe(F.col("of")) & (F.col("cell") == F.col("lots")))
        .select("doc_id", "source", "size", "copies", (F.col("before") + F.col("inside")).alias("start"),
                "source_size", "kind", "target")
    )


def takes(start: Column, schedules=SCHEDULES, most: int = MOST) -> Column:
    """Takes of a document that begins at word ``start`` of its source: pass, words, position."""
    goal = F.round("target").cast("long")
    found = []
    for again in range(most):
        begin = start + F.col("source_size") * again
        taken = F.greatest(F.lit(0), F.least(F.col("size"), goal - begin))
        found.append(F.struct(
            F.lit(again).alias("pass"), taken.cast("long").alias("words"),
            position((begin + taken / 2) / F.greatest(goal, F.lit(1)), F.col("kind"), schedules).alias("position")))
    return F.filter(F.array(*found), lambda t: t["words"] > 0)


def mix(documents: DataFrame) -> DataFrame:
    """One row per document: its source's size and target, and its takes."""
    sized = documents.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    copy = F.explode(F.expr("sequence(0L, copies - 1)"))
    return (
        plan(sized).select("*", copy.alias("copy"))
        .select("doc_id", "source", "size", "copy", "source_size", "target",
                takes(F.col("start") + F.col("copy") * F.col("size")).alias("takes"))
    )


def sequence(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix`` as they are trained on: one for each take, at its ``place`` from 0.

    They are range-sorted by training position; takes at one position, as two sources may have,
    lie in the order of ids.  Documents without a take come last, with a NULL take.
    """
    taken = mixed.select(*[c for c in mixed.columns if c != "takes"], F.explode_outer("takes").alias("take"))
    return numbered(taken, "place", F.asc_nulls_last("take.position"), F.asc_nulls_last("doc_id"),
                    F.asc_nulls_last("source"), F.asc("size"), F.asc("copy"), F.asc("take.pass"))


def gathered(ordered: DataFrame) -> DataFrame:
    """One row per document from ``sequence``, its takes in the order of their places."""
    document = ("doc_id", "source", "size", "copy", "source_size", "target")
    placed = F.sort_array(F.collect_list(F.when(F.col("take").isNotNull(), F.struct("place", "take"))))
    return ordered.groupBy(*document).agg(placed.alias("placed")).select(  # ``MOST`` takes at most
        *document, F.transform("placed", lambda p: p["take"]).alias("takes"))


def training_rows(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` as the mix takes them, range-sorted by training position.

    A document is never cut here: a take counts if it has at least half of the words.
    Rows equal in id, source and size get their copies' takes in any order; only such rows
    are ranked, split by the part of the input that they were read from.
    """
    columns = documents.columns
    own = {c: f"__{c}" for c in ("doc_id", "source", "size", "copies", "start", "source_size", "kind", "target")}
    carried = [f"__col{k}" for k in range(len(columns))]
    rows = settle(  # the caller's columns take names of ours, so that no name can clash
        documents.select(
            "doc_id", "source", word_count(F.col("text")).alias("__words"),
            F.shiftright(F.monotonically_increasing_id(), 33).alias("__part"),
            *[F.col(quoted(c)).alias(n) for c, n in zip(columns, carried, strict=True)]), "mix-rows")
    sized = rows.select("doc_id", "source", F.col("__words").alias("size"))
    items = settle(plan(sized), "mix-plan")
    items = items.select(*[F.col(c).alias(n) for c, n in own.items()])
    joined = rows.join(items, rows["doc_id"].eqNullSafe(items["__doc_id"])
                       & rows["source"].eqNullSafe(items["__source"])
                       & (rows["__words"] == items["__size"]))
    key = ["__doc_id", "__source", "__size"]
    repeated = joined.where(F.col("__copies") > 1)
    before = (
        repeated.groupBy(*key, "__part").agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__before", F.sum("__n").over(Window.partitionBy(*key).orderBy("__part")) - F.col("__n"))
        .select(*[F.col(c).alias(f"{c}_") for c in (*key, "__part")], "__before")
    )
    same = F.lit(True)
    for c in (*key, "__part"):
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    rank = F.row_number().over(Window.partitionBy(*key, "__part").orderBy(F.lit(1))) - 1
    repeated = repeated.withColumn("__rank", rank).join(before, same).withColumn(
        "__copy", (F.col("__before") + F.col("__rank")).cast("long"))
    single = joined.where(F.col("__copies") == 1).withColumn("__copy", F.lit(0).cast("long"))
    kept = [*carried, *own.values(), "__copy"]
    whole = single.select(kept).unionByName(repeated.select(kept))
    whole = whole.select(*carried, *[F.col(n).alias(c) for c, n in own.items()], F.col("__copy").alias("copy"))
    one = F.filter(takes(F.col("start") + F.col("copy") * F.col("size")),
                   lambda t: t["words"] * 2 >= F.col("size"))
    return (
        whole.select(*[f"__col{k}" for k in range(len(columns))], F.explode(one).alias("take"))
        .orderBy(F.col("take")["position"])
        .select(*[F.col(f"__col{k}").alias(c) for k, c in enumerate(columns)])
    )


def digest(mixed: DataFrame) -> DataFrame:
    """One row per document; ``positions`` has the training position of each take, in millionths."""
    words = F.aggregate("takes", F.lit(0).cast("long"), lambda a, t: a + t["words"])
    at = F.transform("takes", lambda t: F.floor(t["position"] * 1_000_000).cast("string"))
    return mixed.select("doc_id", "size", "source_size", "target", words.alias("taken"),
                        F.array_join(at, ",").alias("positions"))
