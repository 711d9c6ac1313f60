"""Row selection by key hash: the same rows at any parallelism and after retries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 8
_BUCKETS = 16**_DIGITS


def in_hash_fraction(keys: list[Column], fraction: float, seed: int) -> Column:
    """True for about ``fraction`` of the distinct key values.

    The first eight hex digits of md5("seed|key|key...") are compared as text with
    the fraction's own eight digits, so no number parsing happens per row.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction must be within [0, 1]: {fraction}")
    cut = int(fraction * _BUCKETS)
    if cut == _BUCKETS:
        return F.lit(True)
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.substring(F.md5(text), 1, _DIGITS) < F.lit(f"{cut:0{_DIGITS}x}")
