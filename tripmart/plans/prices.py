"""Price per km by pickup zone and year: sample, histogram, quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.contracts import (
    MAX_PRICE_PER_KM,
    MIN_ZONE_TRIPS,
    QUANTILE_ROW_BOUND,
    SAMPLE_FRACTION,
    SAMPLE_SEED,
    SAMPLE_YEARS,
    ZONE_ROW_BOUND,
)
from tripmart.functions import valid_price
from tripmart.operators.joins import broadcast_within, join_null_safe
from tripmart.operators.sampling import keyed_sample, keyed_sample_by, random_sample_by_year

#: Parts of a bin that are ranked apart.
RANK_SPLIT = 1024
ROW_KEY = ("source_file", "source_row")
PRICE_GROUP = ("pickup_zone_id", "year")
#: Size of a quantile sketch, and the rank error that is stated for it.
SKETCH_K = 1024
SKETCH_RANK_ERROR = 0.01


def priced_trips(
    trips: DataFrame, ceiling: float = MAX_PRICE_PER_KM, keep: Sequence[str] = ()
) -> DataFrame:
    """Zone, year and price of trips with a usable price and a known pickup zone."""
    usable = valid_price(F.col("price_per_km"), ceiling) & F.col("pickup_zone_id").isNotNull()
    return trips.filter(usable).select("pickup_zone_id", "year", "price_per_km", *keep)


def zone_volumes(priced: DataFrame) -> DataFrame:
    return priced.groupBy("pickup_zone_id").agg(F.count("*").alias("nb_courses"))


def eligible_zones(priced: DataFrame, minimum: int = MIN_ZONE_TRIPS) -> DataFrame:
    """Zones with at least ``minimum`` usable trips over all years."""
    return zone_volumes(priced).filter(F.col("nb_courses") >= minimum)


def in_eligible_zones(
    rows: DataFrame, zones: DataFrame, at_most: int | None = None, row_bound: int = ZONE_ROW_BOUND
) -> DataFrame:
    """Rows whose pickup zone is among ``zones``.

    ``at_most`` is the number of zones there are, if known: the eligible ones, which
    come out of all trips, need not be counted then.  Without it adaptive execution
    decides on its own.
    """
    keys = broadcast_within(zones.select("pickup_zone_id"), None if at_most is None else row_bound, at_most)
    return rows.join(keys, "pickup_zone_id", "left_semi")


def price_sample(
    trips: DataFrame,
    ceiling: float = MAX_PRICE_PER_KM,
    minimum: int = MIN_ZONE_TRIPS,
    fraction: float = SAMPLE_FRACTION,
    years: Sequence[int] | None = SAMPLE_YEARS,
    seed: int = SAMPLE_SEED,
    row_key: Sequence[str] = ROW_KEY,
) -> DataFrame:
    """Sampled (zone, year, price) rows of eligible zones.

    Rows are kept by the hash of their own key, at the same rate in every (zone,
    year).  The choice depends on nothing else, so it may come before the join:
    only the sampled rows are then joined, and repartitioning, retries or a second
    evaluation give the same rows.
    """
    priced = priced_trips(trips, ceiling, keep=row_key)
    if years is None:
        chosen = keyed_sample(priced, row_key, fraction, seed)
    else:
        chosen = keyed_sample_by(priced, "year", {y: fraction for y in years}, row_key, seed)
    eligible = eligible_zones(priced, minimum)
    return in_eligible_zones(chosen, eligible).select(
        "pickup_zone_id", "year", "price_per_km"
    )


def price_sample_random(
    trips: DataFrame,
    ceiling: float = MAX_PRICE_PER_KM,
    minimum: int = MIN_ZONE_TRIPS,
    fraction: float = SAMPLE_FRACTION,
    years: Sequence[int] | None = SAMPLE_YEARS,
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """The same report with Spark's own per-year sampling (not repeatable)."""
    priced = priced_trips(trips, ceiling)
    kept = in_eligible_zones(priced, eligible_zones(priced, minimum))
    return random_sample_by_year(kept, fraction, years, seed)


def price_histogram(prices: DataFrame, width: float) -> DataFrame:
    """Trips per (zone, year, price bin); bin k covers [k*width, (k+1)*width)."""
    return prices.groupBy(
        "pickup_zone_id",
        "year",
        F.floor(F.col("price_per_km") / F.lit(width)).alias("bin"),
    ).agg(F.count("*").alias("nb_courses"))


def price_sketches(
    prices: DataFrame, keys: Sequence[str] = PRICE_GROUP, k: int = SKETCH_K
) -> DataFrame:
    """A mergeable quantile sketch of the prices of each group, and how many there are.

    A sketch has a bounded size whatever the group's, and map tasks make their own, so no
    group meets anywhere.  Kept by month, they are merged for any span without a trip read.
    """
    return prices.groupBy(*keys).agg(
        F.kll_sketch_agg_double(F.col("price_per_km").cast("double"), F.lit(k)).alias("sketch"),
        F.count("price_per_km").alias("nb_courses"),
    )


def sketch_quantiles(
    sketches: DataFrame,
    quantiles: Sequence[float],
    keys: Sequence[str] = PRICE_GROUP,
    k: int = SKETCH_K,
) -> DataFrame:
    """Quantiles of all sketches of a group: (keys, quantile, price, nb_courses).

    The price is one that occurs, and the share of prices up to it differs from the quantile
    by ``SKETCH_RANK_ERROR`` at most, but for one case in many thousands (twice the sketch's
    own error at 99 %).  ``price_quantiles`` has the exact ones.
    """
    merged = sketches.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.sum("nb_courses").alias("nb_courses")
    )
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    return merged.filter("nb_courses > 0").select(
        *keys, "nb_courses",
        F.inline(F.arrays_zip(
            asked.alias("quantile"), F.kll_sketch_get_quantile_double("sketch", asked).alias("price")
        )),
    )


def price_quantiles(
    prices: DataFrame,
    histogram: DataFrame,
    quantiles: Sequence[float],
    width: float,
    groups: int | None = None,
    row_bound: int = QUANTILE_ROW_BOUND,
    split: int = RANK_SPLIT,
) -> DataFrame:
    """Exact interpolated quantiles per (zone, year), without gathering any group.

    ``histogram`` is ``price_histogram(prices, width)``, best read from its stored
    table.  It tells which bin holds each wanted rank; only prices in those bins are
    counted.  They are ranked in ``split`` parts of a bin, each after the sum of the
    parts before it, so neither a group's bulk nor a full bin meets in one task.
    ``groups`` bounds the number of (zone, year) pairs, if the caller knows a bound;
    nothing is counted for it.
    """
    group = ["pickup_zone_id", "year"]
    targets = _rank_bins(histogram, group, quantiles)
    # Two ranks per quantile and group at most.
    ranks = None if groups is None else 2 * len(quantiles) * groups
    needed = broadcast_within(
        targets.select(*group, "bin").distinct(), None if ranks is None else row_bound, ranks
    )
    binned = prices.select(
        *group,
        "price_per_km",
        F.floor(F.col("price_per_km") / F.lit(width)).alias("bin"),
        F.floor(F.col("price_per_km") / F.lit(width / split)).alias("part_of_bin"),
    )
    counted = (
        join_null_safe(binned, needed, [*group, "bin"], "left_semi")
        .groupBy(*group, "bin", "part_of_bin", "price_per_km")
        .agg(F.count("*").alias("k"))
    )
    parts = counted.groupBy(*group, "bin", "part_of_bin").agg(F.sum("k").alias("k"))
    lower = Window.partitionBy(*group, "bin").orderBy("part_of_bin")
    parts = parts.select(
        *group, "bin", "part_of_bin", (F.sum("k").over(lower) - F.col("k")).alias("below")
    )
    upto = (
        Window.partitionBy(*group, "bin", "part_of_bin").orderBy("price_per_km")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = join_null_safe(
        counted.withColumn("inside", F.sum("k").over(upto)), parts, [*group, "bin", "part_of_bin"]
    ).withColumn("through", F.col("below") + F.col("inside"))
    # Ranks inside a bin, from 0, that each distinct price stands for.
    first, last = F.col("through") - F.col("k"), F.col("through") - 1
    hits = join_null_safe(ranked, targets, [*group, "bin"])

    def at(rank: str) -> Column:
        inside = (F.col(rank) - F.col("before")).between(first, last)
        return F.max(F.when(inside, F.col("price_per_km")))

    return (
        hits.groupBy(*group, "quantile")
        .agg(at("low").alias("lower"), at("high").alias("upper"), F.max("part").alias("part"))
        .select(
            *group,
            "quantile",
            (F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("part")).alias("price"),
        )
    )


def _rank_bins(
    histogram: DataFrame, group: Sequence[str], quantiles: Sequence[float]
) -> DataFrame:
    """Bins that hold the two ranks around each quantile: one or two per quantile.

    Ranks count from 0; position q*(n-1) lies between ``low`` and ``high``, ``part``
    of the way.  ``before`` is the number of prices in lower bins.
    """
    upto = Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = histogram.select(
        *group,
        "bin",
        (F.sum("nb_courses").over(upto) - F.col("nb_courses")).alias("before"),
        F.sum("nb_courses").over(upto).alias("upto"),
        F.sum("nb_courses").over(Window.partitionBy(*group)).alias("n"),
    )

    def position(q: Column) -> Column:
        return q * (F.col("n") - 1)

    def held(q: Column) -> Column:
        return (F.ceil(position(q)) >= F.col("before")) & (F.floor(position(q)) < F.col("upto"))

    # Most bins hold no wanted rank: they go before quantiles become rows.
    asked = F.filter(F.array(*[F.lit(float(q)) for q in quantiles]), held)
    at = position(F.col("quantile"))
    return bins.select(*group, "bin", "before", "n", F.explode(asked).alias("quantile")).select(
        *group,
        "bin",
        "quantile",
        "before",
        F.floor(at).alias("low"),
        F.ceil(at).alias("high"),
        (at - F.floor(at)).alias("part"),
    )
