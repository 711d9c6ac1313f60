"""Row samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.contracts import SAMPLE_FRACTION, SAMPLE_SEED, SAMPLE_YEARS
from tripmart.functions import in_hash_fraction


def keyed_sample(
    df: DataFrame,
    keys: Sequence[str],
    fraction: float = SAMPLE_FRACTION,
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """Rows whose key hash falls within ``fraction``; a plain filter, no shuffle."""
    return df.filter(in_hash_fraction([F.col(k) for k in keys], fraction, seed))


def keyed_sample_by(
    df: DataFrame,
    stratum: str,
    fractions: Mapping[int, float],
    keys: Sequence[str],
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """Keyed sample with one fraction per stratum; other strata, and NULL, give none."""
    hashed = [F.col(k) for k in keys]
    by_rate: dict[float, list[int]] = {}
    for value, rate in fractions.items():
        by_rate.setdefault(rate, []).append(value)
    keep = F.lit(False)
    for rate, values in by_rate.items():
        keep = keep | (F.col(stratum).isin(values) & in_hash_fraction(hashed, rate, seed))
    return df.filter(keep)


def random_sample_by_year(
    df: DataFrame,
    fraction: float = SAMPLE_FRACTION,
    years: Sequence[int] | None = SAMPLE_YEARS,
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """Spark's own stratified sample.  Its rows depend on how ``df`` is partitioned.

    Without ``years`` every row has the same chance, whatever its year.
    """
    if years is None:
        return df.sample(fraction=fraction, seed=seed)
    return df.sampleBy("year", {year: fraction for year in years}, seed)


def within_binomial_bounds(
    population: DataFrame,
    sample: DataFrame,
    stratum: str,
    fractions: Mapping[int, float],
    deviations: float = 5.0,
) -> DataFrame:
    """(stratum, rows, within_bounds): whether each stratum's sample has a likely size.

    Of n rows taken with chance p, n*p come on average, with a deviation of
    sqrt(n*p*(1-p)); a sample within ``deviations`` of these (and one row) is in bounds.
    A stratum without a fraction must give no rows.
    """
    rate = F.lit(0.0)
    for value, fraction in fractions.items():
        rate = F.when(F.col(stratum) == value, F.lit(float(fraction))).otherwise(rate)
    both = population.select(stratum, F.lit(0).alias("__taken")).unionAll(
        sample.select(stratum, F.lit(1).alias("__taken"))
    )
    counted = both.groupBy(stratum).agg(
        F.count_if(F.col("__taken") == 0).alias("rows"), F.sum("__taken").alias("__taken")
    )
    width = deviations * F.sqrt(F.col("rows") * rate * (1 - rate)) + 1
    likely = F.when(rate == 0, F.col("__taken") == 0).otherwise(
        F.abs(F.col("__taken") - F.col("rows") * rate) <= width
    )
    return counted.select(stratum, "rows", likely.alias("within_bounds"))
