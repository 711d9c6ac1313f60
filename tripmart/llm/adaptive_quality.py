"""Quality rules whose thresholds come from mergeable quantile sketches.

Each text gives a few whole-number measures (``MEASURES``).  A sketch is a histogram with
decimal buckets: values below 1000 are kept exactly, larger ones to three digits.  Sketches
merge by adding counts, so one aggregation over (language, source, measure, bucket) serves
every level: language and source, language, everything.  A group with fewer than
``least_rows`` documents borrows the thresholds of the next level.

A measure is out of bounds if it lies more than its ``reach`` of interquartile ranges beyond
the quartiles of its group; a range below the measure's ``least`` counts as that.  Measures
that are 0 in most texts (symbols, repeated lines) have no range, so ``least`` decides for
them; for capitals and word lengths the sketches do.  The thresholds, a few numbers per
language and source, are joined to the documents' measures.

Only DataFrame functions run here; equality of 5-word windows is that of 64-bit hashes.

Defined results: a NULL text has no words and fails the base rule, as does an empty one.
NULL languages or sources form groups of their own.  Texts of any length are measured whole.  Repeated rows are judged alike, each
by itself.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import WORD, quoted, settle

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20
LEAST_ROWS = 100
#: Measure, interquartile ranges that it may lie away, smallest range that counts, and whether
#: low values are out too.
MEASURES = (
    ("symbols", 3, 100, False),  # symbols per 1000 words
    ("loud", 24, 25, False),  # capitals and exclamation marks per 1000 words
    ("dup_lines", 3, 134, False),  # repeated lines per 1000 lines
    ("word_length", 12, 100, True),  # characters per 1000 words
)


def _repeat_words(hashed: DataFrame) -> DataFrame:
    """Adds ``__repeated``: the words covered by windows that occur twice or more.

    Windows are sorted with their places; a place is repeated if a neighbour is equal.
    Sorted again, each place covers the words up to the next one, five at most.  Each list
    is a column of its own, because a lambda would compute it anew for every element.
    """
    some = F.size(F.array_distinct("__windows")) < F.size("__windows")
    placed = F.sort_array(F.transform("__windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    hashed = hashed.withColumn("__placed", F.when(some, placed))
    hashed = hashed.withColumn("__sorted", F.transform("__placed", lambda x: x["w"]))

    def repeated(x: Column, k: Column) -> Column:
        before = F.coalesce(F.get("__sorted", k - 1) == x["w"], F.lit(False))
        return before | F.coalesce(F.get("__sorted", k + 1) == x["w"], F.lit(False))

    places = F.sort_array(F.transform(F.filter("__placed", repeated), lambda x: x["i"]))
    hashed = hashed.withColumn("__places", places)
    covered = F.transform("__places", lambda p, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get("__places", k + 1) - p, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return hashed.withColumn("__repeated", F.coalesce(total, F.lit(0)))


def features(documents: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` and the counts of each text."""
    taken = documents.select(*keep, F.coalesce("text", F.lit("")).alias("__text"))
    split = taken.withColumn("__words", F.array_remove(F.split("__text", SPACE), ""))
    hashed = split.withColumn("__hash", F.transform("__words", lambda w: F.xxhash64(w)))
    count = F.size("__hash")
    at = [lambda i, k=k: F.get("__hash", i + k) for k in range(WINDOW)]
    windows = F.when(count >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.greatest(count - WINDOW, F.lit(0))),
        lambda i: F.xxhash64(*[get(i) for get in at]))).otherwise(F.array().cast("array<long>"))
    lines = F.filter(F.split("__text", "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))
    rows = hashed.withColumn("__windows", windows).withColumn("__lines", lines)
    rows = _repeat_words(rows)
    return rows.select(
        *[F.col(c) for c in taken.columns if c != "__text"],
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.col("__repeated").cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.length("__text") - F.length(F.regexp_replace("__text", "[A-Z!]", ""))).cast("long").alias("n_loud"),
    )


def _measures() -> Column:
    """Map-like array of (measure, value); a text without words has none."""
    per = lambda count, of: F.expr(f"{count} * 1000 div greatest({of}, 1)")
    values = {"symbols": per("n_symbols", "n_words"), "loud": per("n_loud", "n_words"),
              "dup_lines": per("n_dup_lines", "n_lines"), "word_length": per("word_chars", "n_words")}
    pairs = F.array(*[F.struct(F.lit(name).alias("measure"), values[name].alias("value"))
                      for name, *_ in MEASURES])
    return F.when(F.col("n_words") > 0, pairs).otherwise(F.slice(pairs, 1, 0))


def bucket(value: Column) -> Column:
    """``value`` to three decimal digits."""
    unit = F.expr("cast(rpad('1', greatest(length(cast(value as string)) - 2, 1), '0') as bigint)")
    return F.floor(value / unit).cast("long") * unit


def sketch(counted: DataFrame) -> DataFrame:
    """Counts per (lang, source, measure, bucket)."""
    pairs = counted.select("lang", "source", F.explode(_measures()).alias("pair"))
    return (
        pairs.select("lang", "source", "pair.measure", "pair.value")
        .groupBy("lang", "source", "measure", bucket(F.col("value")).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def thresholds(sketches: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """(lang, source, measure, low, high) for every language and source of the sketches."""
    reach, least, both = F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("boolean")
    for name, far, floor, two in MEASURES:
        reach = F.when(F.col("measure") == name, F.lit(far)).otherwise(reach)
        least = F.when(F.col("measure") == name, F.lit(floor)).otherwise(least)
        both = F.when(F.col("measure") == name, F.lit(two)).otherwise(both)

    def bounds(level: int) -> DataFrame:
        group = [["lang", "source"], ["lang"], []][level]
        merged = sketches.groupBy(*group, "measure", "bucket").agg(F.sum("rows").alias("rows"))
        every = Window.partitionBy(*group, "measure")
        upto = every.orderBy("bucket")  # buckets are few: three digits for each power of ten
        ranked = merged.withColumn("upto", F.sum("rows").over(upto)).withColumn("all", F.sum("rows").over(every))
        low = F.min(F.when(F.col("upto") * 4 >= F.col("all"), F.col("bucket")))
        high = F.min(F.when(F.col("upto") * 4 >= F.col("all") * 3, F.col("bucket")))
        found = ranked.groupBy(*group, "measure").agg(
            low.alias("q1"), high.alias("q3"), F.max("all").alias("all"))
        width = reach * F.greatest(F.col("q3") - F.col("q1"), least)
        return found.select(
            *[F.col(g).alias(f"{g}{level}") for g in group], F.col("measure").alias(f"measure{level}"),
            F.when(both, F.col("q1") - width).alias(f"low{level}"),
            (F.col("q3") + width).alias(f"high{level}"), F.col("all").alias(f"all{level}"))

    fine, mid, top = bounds(0), bounds(1), bounds(2)
    joined = fine.join(mid, F.col("lang0").eqNullSafe(F.col("lang1")) & (F.col("measure0") == F.col("measure1")))
    joined = joined.join(top, F.col("measure0") == F.col("measure2"))

    def pick(what: str) -> Column:
        return (F.when(F.col("all0") >= least_rows, F.col(f"{what}0"))
                .when(F.col("all1") >= least_rows, F.col(f"{what}1")).otherwise(F.col(f"{what}2")))

    return joined.select(F.col("lang0").alias("lang"), F.col("source0").alias("source"),
                         F.col("measure0").alias("measure"), pick("low").alias("low"), pick("high").alias("high"))


def judge(documents: DataFrame, keep: list[Column], least_rows: int = LEAST_ROWS) -> DataFrame:
    """``keep``, the counts, ``base_failed`` and ``kept`` for every row of ``documents``."""
    named = [F.col("lang").alias("__lang"), F.col("source").alias("__source")]
    counted = settle(features(documents, [*keep, *named]), "quality")
    plain = counted.select(
        F.col("__lang").alias("lang"), F.col("__source").alias("source"), "n_words", "word_chars", "n_symbols",
        "n_dup_lines", "n_repeat_words", "n_lines", "n_loud")
    limits = thresholds(sketch(plain), least_rows)
    wide = limits.groupBy("lang", "source").agg(
        F.collect_list(F.struct("measure", "low", "high")).alias("__limits"))  # one entry per measure
    wide = wide.select(F.col("lang").alias("__of_lang"), F.col("source").alias("__of_source"), "__limits")
    joined = counted.join(wide, F.col("__lang").eqNullSafe(F.col("__of_lang"))
                          & F.col("__source").eqNullSafe(F.col("__of_source")), "left")
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    outside = F.exists(_measures(), lambda m: F.exists("__limits", lambda x: (
        x["measure"] == m["measure"]) & ((m["value"] > x["high"]) | F.coalesce(m["value"] < x["low"], F.lit(False)))))
    return joined.withColumn("base_failed", base).withColumn(
        "kept", ~base & ~F.coalesce(outside, F.lit(False))).drop(
        "__lang", "__source", "__of_lang", "__of_source", "__limits", "n_lines", "n_loud")


def keep_good(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are kept, all columns as they were, whatever their names."""
    columns = documents.columns
    judged = judge(documents, [F.col(quoted(c)).alias(f"__col{k}") for k, c in enumerate(columns)])
    return judged.where("kept").select(*[F.col(f"__col{k}").alias(c) for k, c in enumerate(columns)])
