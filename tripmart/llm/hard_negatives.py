"""Hard negatives by a secondary-sort shuffle.

Scores of (anchor, row) pairs travel under packed keys (anchor, descending score, positives
first, id).  ``repartitionAndSortWithinPartitions`` deals them out by anchor and sorts them on
the way; a task then reads a sorted stream.  A positive opens a window that reaches down to
``REACH`` percent of its score; a different-label row goes to every window that is open and
not yet full.  The stream keeps the open windows of one anchor, never its rows.

Anchors meet all rows in cells: a block of some ``BLOCK_ANCHORS`` anchors and a slice of some
``SLICE_ROWS`` rows, scored as products of two matrices.  A cell sends on only what can still
matter: the first ``POSITIVES`` of each anchor, and then, the positives being known, the first
``NEGATIVES`` of each of their windows.  Everything else is behind those already in its cell, so
the result is that of sending all pairs, while the shuffle has some 30 rows for each anchor
and slice.  No group grows with a label or with a vector that many rows share.

Defined results: rows with a NULL id, label or vector, or with a NULL or non-finite component
take no part.  Rows with one id are one row, the first by label and components.  A shorter
vector ends in zeros; an empty one scores 0 with every row.  Scores are exact; those beyond
64 bits are held at their ends.  Ties go to the smaller id.  A positive with a negative score has no
negatives, as its window is empty.  Columns beyond the three named ones are not read.  An empty table
gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import drop, settle

# Fixed values of the contract.
SCALE = 256
POSITIVES = NEGATIVES = 5
REACH = 80  # percent of the positive's score

BLOCK_ANCHORS = 8192
SLICE_ROWS = 4096
#: Anchors of a block that are scored at once.
AT_ONCE = 64
LEAST, MOST = -(1 << 63), (1 << 63) - 1

PAIRS = "anchor_id long, score long, vec_id long, positive boolean"
RESULT = T.StructType([
    T.StructField("anchor_id", T.LongType()), T.StructField("positive_id", T.LongType()),
    T.StructField("rank", T.IntegerType()), T.StructField("negative_id", T.LongType()),
    T.StructField("positive_score", T.LongType()), T.StructField("negative_score", T.LongType())])


def vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vector of whole numbers) of the rows that take part."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.col("label").cast("long")
    known = embeddings.where(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & ~odd)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    changed = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return known.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(changed.alias("label"), whole.alias("vector")).alias("r")).groupBy(
        "vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.label", "r.vector")


@dataclass
class Rows:
    """Rows of a cell as arrays."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def of(table: pa.Table, width: int) -> Rows:
        ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
        lists = table.column("vector").combine_chunks()
        lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
        lengths = np.diff(lists.offsets.to_numpy())
        matrix = np.zeros((len(ids), width), dtype=np.int64)
        matrix[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
        return Rows(ids, labels, matrix)


def width_of(*tables: pa.Table) -> int:
    return max((pc.max(pc.list_value_length(t.column("vector"))).as_py() or 0) for t in tables)


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of all anchors with all rows.

    Doubles hold them exactly as long as no sum can pass 2^53; beyond that Python's own
    integers are used, held at the ends of 64 bits.
    """
    largest = [max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0)))) for m in (anchors, rows)]
    if largest[0] * largest[1] * max(1, rows.shape[1]) < 1 << 53:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    exact = anchors.astype(object) @ rows.astype(object).T
    return np.clip(exact, LEAST, MOST).astype(np.int64) if exact.size else np.zeros(exact.shape, np.int64)


def first(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` by descending score and ascending id, in order."""
    at = np.arange(len(scores))
    if len(scores) > most:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
    return at[np.lexsort((ids[at], ~scores[at]))][:most]  # ~s is -s - 1, which cannot overflow


def floor_of(score: int) -> int:
    """The least score in the window of a positive."""
    return -(-REACH * score // 100)


def best_positives(anchors: Rows, rows: Rows) -> Iterator[tuple[int, int, int, bool]]:
    """The first positives of each anchor among the rows of a slice."""
    for k in range(0, len(anchors.ids), AT_ONCE):
        scores = products(anchors.vectors[k:k + AT_ONCE], rows.vectors)
        for line, anchor, label in zip(scores, anchors.ids[k:], anchors.labels[k:]):
            like = np.flatnonzero((rows.labels == label) & (rows.ids != anchor))
            for at in like[first(line[like], rows.ids[like], POSITIVES)]:
                yield int(anchor), int(line[at]), int(rows.ids[at]), True


def best_negatives(anchors: Rows, windows: list[list[int]], rows: Rows) -> Iterator[tuple[int, int, int, bool]]:
    """The first negatives of each window among the rows of a slice; ``windows`` are positives' scores."""
    for k in range(0, len(anchors.ids), AT_ONCE):
        scores = products(anchors.vectors[k:k + AT_ONCE], rows.vectors)
        for line, anchor, label, tops in zip(scores, anchors.ids[k:], anchors.labels[k:], windows[k:]):
            tops = [s for s in tops if s >= 0]
            if not tops:
                continue
            inside = np.flatnonzero((rows.labels != label) & (line <= max(tops)) & (line >= floor_of(min(tops))))
            found: set[int] = set()
            for top in set(tops):
                own = inside[(line[inside] <= top) & (line[inside] >= floor_of(top))]
                found.update(own[first(line[own], rows.ids[own], NEGATIVES)].tolist())
            for at in found:
                yield int(anchor), int(line[at]), int(rows.ids[at]), False


def in_cells(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, score) -> DataFrame:
    """``score`` of every cell: a block of anchors and a slice of rows, both of bounded size."""
    blocks, parts = max(1, -(-n_anchors // BLOCK_ANCHORS)), max(1, -(-n_rows // SLICE_ROWS))
    part_of = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.select("*", part_of(1, blocks).alias("block"), every(parts).alias("part"))
    right = rows.toDF(*rows.columns).select("*", part_of(2, parts).alias("part"), every(blocks).alias("block"))

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        found = list(score(a, b)) if a.num_rows and b.num_rows else []
        columns = list(zip(*found, strict=True)) or [[], [], [], []]
        kinds = {"anchor_id": pa.int64(), "score": pa.int64(), "vec_id": pa.int64(), "positive": pa.bool_()}
        return pa.table({n: pa.array(c, k) for (n, k), c in zip(kinds.items(), columns, strict=True)})

    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(cell, PAIRS)


def score_positives(a: pa.Table, b: pa.Table) -> Iterator[tuple[int, int, int, bool]]:
    width = width_of(a, b)
    return best_positives(Rows.of(a, width), Rows.of(b, width))


def score_negatives(a: pa.Table, b: pa.Table) -> Iterator[tuple[int, int, int, bool]]:
    width = width_of(a, b)
    return best_negatives(Rows.of(a, width), a.column("tops").to_pylist(), Rows.of(b, width))


def pack(anchor: int, score: int, positive: bool, row: int) -> bytes:
    """A key whose byte order is (anchor, descending score, positives first, id)."""
    return struct.pack(">QQBQ", anchor - LEAST, MOST - score, not positive, row - LEAST)


def deal(key: bytes) -> int:
    """The same number for all keys of an anchor, well spread."""
    return zlib.crc32(key[:8])


def unpack(key: bytes) -> tuple[int, int, bool, int]:
    anchor, score, negative, row = struct.unpack(">QQBQ", key)
    return anchor + LEAST, MOST - score, not negative, row + LEAST


def mined(keys: Iterator[tuple[bytes, None]]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Negatives of every window, from packed keys in order."""
    now, open_windows = None, []  # (positive, its score, negatives so far)
    for key, _ in keys:
        anchor, score, positive, row = unpack(key)
        if anchor != now:
            now, open_windows = anchor, []
        if positive:
            open_windows.append([row, score, 0])
            continue
        open_windows = [w for w in open_windows if w[2] < NEGATIVES and floor_of(w[1]) <= score]
        for window in open_windows:
            window[2] += 1
            yield anchor, window[0], window[2], row, window[1], score


def mine(embeddings: DataFrame, every: int = 100) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``every``.

    The result is written to the shared folder, and the tables on the way are deleted.
    """
    spark = embeddings.sparkSession
    rows = settle(vectors(embeddings), "negative-vectors")
    anchors = rows.where(F.col("vec_id") % every == 0)
    n_rows, n_anchors = rows.count(), anchors.count()
    near = in_cells(anchors, rows, n_anchors, n_rows, score_positives)
    first_of = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("place", F.row_number().over(first_of)).where(F.col("place") <= POSITIVES)
    top = settle(near.drop("place"), "negative-positives")
    tops = top.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list("score").alias("tops"))  # ``POSITIVES`` at most
    far = in_cells(anchors.join(tops, "vec_id"), rows, n_anchors, n_rows, score_negatives)
    pairs = far.unionByName(top).rdd.map(lambda r: (pack(r[0], r[1], r[3], r[2]), None))
    dealt = pairs.repartitionAndSortWithinPartitions(int(spark.conf.get("spark.sql.shuffle.partitions")), deal)
    result = settle(spark.createDataFrame(dealt.mapPartitions(mined), RESULT), "negatives")
    drop(rows, top)
    return result
