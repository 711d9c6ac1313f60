"""Quality by compression: which of two dictionaries packs a text better.

Two zstandard dictionaries are built, one from good and one from poor labelled text.  A text
is cut into pieces of ``PIECE`` bytes, each packed on its own with either dictionary, so that
what counts is the dictionary and not how often the text repeats itself.  The difference of
the two packed sizes, per byte of text, is large for text like the good one.  A logistic
curve on it, fitted to labelled texts that neither dictionary has seen, gives the score.

The fit uses at most ``SAMPLE_DOCUMENTS`` labelled documents, chosen by a hash of the id, and
of these at most ``SAMPLE_PIECES`` pieces of either kind, as many of the one as of the other;
every document is scored whole, a slice of the batch at a time.

Defined results: NULL and empty texts have no bytes and get the score of no difference; a text
of a few bytes lies close to it.  A text beyond the slice size makes a slice of its own.
Documents labelled twice with different labels do not train, nor do NULL ids, and equal texts
train once, with the lower of their labels.  Without training labels of both kinds the score
is the share of good labels, or 0.  Repeated rows score alike.  All columns of the caller are
kept, whatever their names; the result's column comes last.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import drop, settle, slices

PIECE = 1024
SAMPLE_DOCUMENTS = 20_000
SAMPLE_PIECES = 8_000
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Bytes added to a text's size, so that a difference in a few bytes says little.
SLACK_BYTES = 20
THRESHOLD = 0.7
SLICE_BYTES = 4 << 20

RESULT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("good_bytes", T.LongType()),
                       T.StructField("poor_bytes", T.LongType())])


@dataclass
class Model:
    good: bytes = b""  # dictionaries; empty if the labels are all of one kind
    poor: bytes = b""
    slope: float = 0.0  # of the logistic curve
    offset: float = -20.0


def pieces(text: str | None) -> list[bytes]:
    data = (text or "").encode()
    return [data[k:k + PIECE] for k in range(0, len(data), PIECE)]


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """Packs with the dictionary; headers are left out, as they say nothing of the text."""
    known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_AUTO)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False, write_checksum=False)


class Scales:
    """Packed sizes of texts under both dictionaries of a model."""

    def __init__(self, model: Model):
        self.both = [compressor(d) for d in (model.good, model.poor)] if model.good else []

    def weigh(self, text: str | None) -> tuple[int, int]:
        cut = pieces(text)
        if not self.both:
            return 0, 0
        return tuple(sum(len(c.compress(p)) for p in cut) for c in self.both)


def difference(text: str | None, good_bytes: int, poor_bytes: int) -> float:
    """Bytes that the good dictionary saves against the poor one, per byte of text."""
    return (poor_bytes - good_bytes) / (len((text or "").encode()) + SLACK_BYTES)


def probability(model: Model, x: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, model.offset + model.slope * x))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:].ljust(8, b" ")


def curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the logistic curve of y on x, by damped Newton steps.

    A light penalty on the slope, in units of the spread of x, keeps it finite where x tells
    the two kinds apart completely.
    """
    middle, spread = x.mean(), x.std() or 1.0
    design = np.stack([(x - middle) / spread, np.ones(len(x))])
    weights, penalty = np.zeros(2), np.array([1e-2, 1e-6])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(weights @ design, -30, 30)))
        slopes = design @ (y - p) - penalty * weights
        bend = (design * np.maximum(p * (1 - p), 1e-9)) @ design.T + np.diag(penalty)
        step = np.clip(np.linalg.solve(bend, slopes), -1, 1)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    slope = weights[0] / spread
    return float(slope), float(weights[1] - slope * middle)


def hash_sample(rows: DataFrame, lot: Column, n: int, most: int) -> DataFrame:
    """The ``most`` of ``n`` rows with the least hash, or a few less.

    All that lie far above are left out first, so that no task sends on more than its share.
    """
    share = min(1.0, 1.2 * most / max(1, n))
    near = rows.where(F.pmod(lot, F.lit(1 << 31)) < int(share * (1 << 31)) + 1)
    return near.orderBy(F.pmod(lot, F.lit(1 << 31)), *rows.columns).limit(most)


def training_texts(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """(text, quality, fits) of at most ``sample`` labelled documents that are not held out.

    Two thirds of the texts, by their hash, build the dictionaries (``fits``); the others
    are for the curve.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
    known = known.where(F.col("quality") == F.col("most")).select("doc_id", "quality")
    known = hash_sample(known, F.xxhash64("doc_id"), known.count(), sample)
    texts = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # ``sample`` rows at most
    return texts.groupBy("text").agg(F.min("quality").alias("quality")).where("text <> ''").select(
        "text", "quality", (F.pmod(F.xxhash64("text"), F.lit(3)) != 0).alias("fits"))


def sample_pieces(texts: DataFrame, quality: int, most: int) -> list[bytes]:
    """At most ``most`` pieces of texts of one kind, by a hash of the piece."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"piece": pa.array(pieces(text), pa.binary())})

    own = texts.where(F.col("quality") == quality).select("text")
    n = own.agg(F.sum(F.ceil(F.octet_length("text") / PIECE))).first()[0] or 0
    chosen = hash_sample(own.mapInArrow(cut, "piece binary"), F.xxhash64("piece"), n, most)
    return [bytes(r[0]) for r in chosen.collect()]  # ``most`` pieces of ``PIECE`` bytes


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Model:
    """A model from labelled documents that are not held out."""
    texts = settle(training_texts(documents, labels, sample), "quality-train")
    counts = {(r["quality"], r["fits"]): r["count"] for r in texts.groupBy("quality", "fits").count().collect()}
    of = lambda quality: sum(n for (q, _), n in counts.items() if q == quality)
    model = Model()
    if not of(0) or not of(1):
        share = min(max(of(1) / max(1, of(0) + of(1)), 1e-9), 1 - 1e-9)
        model = Model(offset=math.log(share / (1 - share)))
    else:
        # A kind that one part lacks makes all texts serve for both.
        apart = len(counts) == 4
        fitting = texts.where("fits") if apart else texts
        good, poor = (sample_pieces(fitting, q, SAMPLE_PIECES) for q in (1, 0))
        as_many = min(len(good), len(poor))
        model.good, model.poor = dictionary(good[:as_many]), dictionary(poor[:as_many])
        rest = weighed(texts.where("NOT fits") if apart else texts, model, "weighed")
        seen = rest.select("quality", "weighed.x").collect()  # at most ``sample`` rows of two numbers
        model.slope, model.offset = curve(np.array([r["x"] for r in seen]), np.array([float(r["quality"]) for r in seen]))
    drop(texts)
    return model


def weighed(documents: DataFrame, model: Model, into: str) -> DataFrame:
    """``documents`` with (score, good_bytes, poor_bytes, x) of their texts as last column."""
    names, at = documents.columns, documents.columns.index("text")
    plain = documents.toDF(*[f"c{k}" for k in range(len(names))])
    kind = T.StructType([*RESULT.fields, T.StructField("x", T.DoubleType())])
    sent = documents.sparkSession.sparkContext.broadcast(vars(model))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**sent.value)
        scales = Scales(model)
        for batch in batches:
            for run in slices(batch, at, SLICE_BYTES):
                found = []
                for text in run.column(at).to_pylist():
                    good, poor = scales.weigh(text)
                    x = difference(text, good, poor)
                    found.append({"score": probability(model, x), "good_bytes": good, "poor_bytes": poor, "x": x})
                last = pa.array(found, pa.struct([("score", pa.float64()), ("good_bytes", pa.int64()),
                                                  ("poor_bytes", pa.int64()), ("x", pa.float64())]))
                yield pa.RecordBatch.from_arrays([*run.columns, last], names=[*run.schema.names, "found"])

    return plain.mapInArrow(scan, T.StructType([*plain.schema.fields, T.StructField("found", kind)])).toDF(*names, into)


def score(documents: DataFrame, model: Model, into: str = "quality_score") -> DataFrame:
    """``documents`` with (score, good_bytes, poor_bytes, x) in the last column, ``into``."""
    return weighed(documents, model, into)


def digest(scored: DataFrame, into: str = "quality_score") -> DataFrame:
    result = F.col(into)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), result["score"].alias("score"),
        (result["score"] >= THRESHOLD).cast("int").alias("predicted"),
        result["good_bytes"].alias("good_bytes"), result["poor_bytes"].alias("poor_bytes"))
