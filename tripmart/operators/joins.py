"""Broadcasting behind a size check, and joins on keys that may be NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_within(
    df: DataFrame, row_bound: int | None, at_most: int | None = None, recount: bool = False
) -> DataFrame:
    """Hint ``df`` for broadcasting if it has at most ``row_bound`` rows.

    ``at_most`` is a number of rows that ``df`` cannot exceed, if the caller knows
    one, such as ``stored_rows`` of the table it is made from; otherwise ``df`` is counted,
    which prunes to its grouping columns.  With ``recount`` it is counted as well if ``at_most``
    is beyond the bound: a grouping may leave few of the stored rows, and one count of
    the lookup costs less than a shuffle of all rows that are joined with it.

    Beyond the bound, or with ``None``, the join shuffles, and adaptive execution
    splits hot keys of its left side.  It does so only if both sides are shuffled for
    the join itself; an aggregate already grouped by the join keys would be joined as
    it lies, hence the rebalance.
    """
    if row_bound is not None:
        if at_most is None or (recount and at_most > row_bound):
            at_most = df.count()
        if at_most <= row_bound:
            return F.broadcast(df)
    return df.hint("rebalance")


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which NULL keys match each other, as they do in a grouping."""
    named = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    )
    return left.join(named, same, how).drop(*[f"__{k}" for k in keys])
