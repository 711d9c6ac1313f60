"""Toxicity by maximum-scoring segments of token log-odds.

Tokens are weighed by their log-odds between toxic and clean training documents, with a
Dirichlet prior whose pseudo-counts follow the tokens' overall shares; only tokens whose
log-odds stand ``LEAST_Z`` deviations from 0 keep a weight.  A token that training saw in
fewer than ``LEAST_DOCUMENTS`` documents takes the weight of its longest weighted beginning
(``PREFIXES`` letters).  Every other token costs ``DRIFT``, so a random text drifts down.  One pass over a text finds all maximal scoring
segments (the all-segments form of the maximum-sum scan, linear in the number of weighted
tokens).  A segment's score S in a text of n tokens is calibrated by the extreme-value law
of such maxima, E = K n exp(-lambda S): lambda solves the score equation of the clean
training tokens, K comes from their best segments.  A document's evidence is the sum of
log(1/E) over its significant segments; a logistic curve on it, fitted to the training
labels, gives the score.

The fit uses at most ``SAMPLE_DOCUMENTS`` labelled documents, chosen by a hash of the id;
every document is scored whole.  That sample also bounds the number of weights.

Defined results: NULL and empty texts have no tokens and get the score of no evidence.
Documents labelled twice with different labels do not train;
equal texts train once.  Without training labels of
both kinds the score is the share of toxic labels, or 0.  Repeated rows score alike.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import settle, slices

TOKEN = re.compile(r"[^\W\d_]+")
SAMPLE_DOCUMENTS = 20_000
#: Pseudo-counts, as a share of how often a token occurs in either kind of document.
PRIOR = 0.1
LEAST_Z = 3.5
LEAST_DOCUMENTS = 5
PREFIXES = (8, 7, 6, 5, 4)
DRIFT = 0.05
SIGNIFICANT = 0.05
THRESHOLD = 0.7
SLICE_BYTES = 4 << 20
#: Looked-up tokens that a task remembers.
REMEMBERED = 500_000

SEGMENTS = T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("score", T.DoubleType()), T.StructField("e_value", T.DoubleType())]))


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)  # 0 for known tokens without weight
    rate: float = 1.0  # lambda of the extreme-value law
    size: float = 1.0  # its K
    slope: float = 0.0  # of the logistic curve
    offset: float = -20.0


def prefixes(token: str) -> list[str]:
    """Beginnings of the token, longest first; ``*`` sets them apart from whole tokens."""
    return [f"{token[:k]}*" for k in PREFIXES if len(token) > k]


class Weights(dict):
    """Token to weight, looked up in a model once per token."""

    def __init__(self, known: dict[str, float]):
        super().__init__()
        self.known = known

    def __missing__(self, token: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        weight = next((self.known[t] for t in (token, *prefixes(token)) if t in self.known), 0.0)
        self[token] = weight
        return weight


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def maximal_segments(hits: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score).

    ``hits`` are the weighted tokens in order; between them each token costs ``DRIFT``.
    Candidates are kept with the running totals at both ends.  A new one is joined to the
    nearest earlier candidate that starts lower, if that one also ends lower.
    """
    total, last = 0.0, -1
    found: list[list] = []  # first, last, total before, total after
    for place, weight in hits:
        total -= DRIFT * (place - last - 1)
        before = total
        total += weight
        last = place
        if weight <= 0:
            continue
        new = [place, place, before, total]
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= new[2]:
                k -= 1
            if k < 0 or found[k][3] >= new[3]:
                found.append(new)
                break
            new = [found[k][0], new[1], found[k][2], new[3]]
            del found[k:]
    return [(a, b, after - before) for a, b, before, after in found]


def segments(text: str | None, model: Model, weights: Weights) -> tuple[int, list[tuple[int, int, float, float]]]:
    """Number of tokens, and significant segments (first, end, score, E)."""
    words = tokens(text)
    hits = [(k, w) for k, w in enumerate(map(weights.__getitem__, words)) if w]
    found = []
    for a, b, score in maximal_segments(hits):
        e_value = model.size * max(len(words), 1) * math.exp(-min(model.rate * score, 700.0))
        if e_value <= SIGNIFICANT:
            found.append((a, b + 1, score, e_value))
    return len(words), found


def evidence(e_values: list[float]) -> float:
    """Sum of log10(1/E), in equal steps beyond 1: one strong passage counts, more add less."""
    return math.log1p(sum(-math.log10(max(e, 1e-300)) for e in e_values))


def probability(model: Model, x: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, model.offset + model.slope * x))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_texts(documents: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled documents that are not held out."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    known = known.where(F.col("toxic") == F.col("most")).select("doc_id", "toxic")
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # ``sample`` rows at most
    return settle(texts.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxic-train")


def token_weights(texts: DataFrame) -> dict[str, float]:
    """Log-odds of the tokens that tell toxic from clean documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(tokens(text))
                for word in words.union(*map(prefixes, words)):
                    counts.setdefault(word, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_pydict({
                "token": pa.array(list(counts), pa.string()),
                "clean": pa.array([c[0] for c in counts.values()], pa.int64()),
                "toxic": pa.array([c[1] for c in counts.values()], pa.int64())})

    counted = settle(
        texts.select("text", "toxic").mapInArrow(count, "token string, clean long, toxic long")
        .groupBy("token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxic-tokens")
    sums = counted.agg(F.sum("clean"), F.sum("toxic")).first()
    n_clean, n_toxic = float(sums[0] or 0), float(sums[1] or 0)
    if not n_clean or not n_toxic:
        return {}
    prior = PRIOR * (F.col("clean") + F.col("toxic"))
    pseudo = PRIOR * (n_clean + n_toxic)
    odds = lambda seen, n: F.log((seen + prior) / (n + pseudo - seen - prior))
    log_odds = odds(F.col("toxic"), n_toxic) - odds(F.col("clean"), n_clean)
    spread = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    weighed = (
        counted.where(F.col("toxic") + F.col("clean") >= LEAST_DOCUMENTS)
        .select("token", log_odds.alias("weight"), (log_odds / spread).alias("z"))
    )
    weighed = settle(weighed, "toxic-weights")
    strong = weighed.where(F.abs("z") >= LEAST_Z)
    weights = {r["token"]: r["weight"] for r in strong.collect()}
    # Known tokens without weight of their own must not take that of their beginning.
    begin = [F.concat(F.substring("token", 1, k), F.lit("*")) for k in PREFIXES]
    starts = strong.where(F.endswith("token", F.lit("*"))).select(F.col("token").alias("start"))
    neutral = (
        weighed.where((F.abs("z") < LEAST_Z) & ~F.endswith("token", F.lit("*")))
        .select("token", F.explode(F.array(*begin)).alias("start")).join(starts, "start", "left_semi")
        .select("token").distinct()
    )
    return weights | {r["token"]: 0.0 for r in neutral.collect()}


def _rate(scores: np.ndarray) -> float:
    """The positive root of mean(exp(rate * score)) = 1."""
    if not len(scores) or scores.max() <= 0 or scores.mean() >= 0:
        return 1.0
    low, high = 1e-6, 50.0 / scores.max()
    for _ in range(200):
        middle = (low + high) / 2
        if np.exp(middle * scores).mean() > 1:
            high = middle
        else:
            low = middle
    return (low + high) / 2


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) by bounded Newton steps with a light penalty on the slope."""
    slope, offset = 0.0, math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(offset + slope * x, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        grad = np.array([((y - p) * x).sum() - 0.1 * slope, (y - p).sum()])
        hess = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(hess, grad), -0.5, 0.5)
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(offset)


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Model:
    """A model from labelled documents that are not held out."""
    texts = training_texts(documents, labels, sample)
    share = texts.agg(F.avg("toxic")).first()[0]
    model = Model(token_weights(texts))
    if not share or share == 1 or not model.weights:
        share = min(max(share or 0.0, 1e-9), 1 - 1e-9)
        return Model(offset=math.log(share / (1 - share)))
    sent = documents.sparkSession.sparkContext.broadcast(model.weights)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, weights = Model(size=0.0), Weights(sent.value)  # every segment is significant
        for batch in batches:
            rows = {"toxic": batch.column(1), "n": [], "hits": [], "scores": []}
            for text in batch.column(0).to_pylist():
                n, found = segments(text, plain, weights)
                rows["n"].append(n)
                rows["hits"].append([w for w in map(weights.__getitem__, tokens(text)) if w])
                rows["scores"].append([s for _, _, s, _ in found])
            yield pa.RecordBatch.from_arrays(
                [rows["toxic"], pa.array(rows["n"], pa.int64()), pa.array(rows["hits"], pa.list_(pa.float64())),
                 pa.array(rows["scores"], pa.list_(pa.float64()))], names=list(rows))

    seen = settle(texts.select("text", "toxic").mapInArrow(
        best, "toxic int, n long, hits array<double>, scores array<double>"), "toxic-fit")
    clean = seen.where("toxic = 0")
    weighted = [(r[0], r[1]) for r in clean.select(F.explode("hits").alias("w")).groupBy("w").count().collect()]
    n = clean.agg(F.sum("n")).first()[0] or 0
    values = np.array([w for w, _ in weighted] + [-DRIFT])
    counts = np.array([c for _, c in weighted] + [max(0, n - sum(c for _, c in weighted))], dtype=float)
    model.rate = _rate(np.repeat(values, np.maximum(1, (counts * 1e5 / max(1.0, counts.sum()))).astype(int)))
    # K from the mean of exp(rate * best score) / n over clean texts, heavy tail cut by the log.
    tail = clean.where("n > 0").select(F.log("n").alias("n"), F.coalesce(F.array_max("scores"), F.lit(0.0)).alias("s"))
    gap = tail.agg(F.avg(F.col("s") * model.rate - F.col("n"))).first()[0] or 0.0
    model.size = math.exp(min(20.0, gap))
    rows = seen.select("toxic", "n", "scores").collect()  # at most ``sample`` rows
    x, y = [], []
    for r in rows:
        e = [model.size * max(r["n"], 1) * math.exp(-min(model.rate * s, 700.0)) for s in r["scores"]]
        x.append(evidence([v for v in e if v <= SIGNIFICANT]))
        y.append(r["toxic"])
    model.slope, model.offset = _logistic(np.array(x), np.array(y, dtype=float))
    return model


def find_segments(documents: DataFrame, model: Model, into: str = "toxic") -> DataFrame:
    """``documents`` with their significant segments (in tokens) and score in ``into``."""
    sent = documents.sparkSession.sparkContext.broadcast(vars(model))
    kind = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("segments", SEGMENTS)])
    df = documents.withColumn(into, F.lit(None).cast(kind))
    at, out = df.columns.index("text"), df.columns.index(into)
    arrow = pa.struct([("score", pa.float64()), ("segments", pa.list_(pa.struct([
        ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())])))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**sent.value)
        weights = Weights(model.weights)
        for batch in batches:
            for run in slices(batch, at, SLICE_BYTES):
                rows = []
                for text in run.column(at).to_pylist():
                    _, found = segments(text, model, weights)
                    rows.append({"score": probability(model, evidence([e for *_, e in found])), "segments": [
                        {"start": a, "end": b, "score": s, "e_value": e} for a, b, s, e in found]})
                arrays = [run.column(k) if k != out else pa.array(rows, type=arrow) for k in range(run.num_columns)]
                yield pa.RecordBatch.from_arrays(arrays, names=run.schema.names)

    return df.mapInArrow(scan, df.schema)


def digest(found: DataFrame) -> DataFrame:
    score = F.col("toxic")["score"]
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
                        (score >= THRESHOLD).cast("int").alias("predicted"),
                        F.size(F.col("toxic")["segments"]).cast("long").alias("n_segments"))
