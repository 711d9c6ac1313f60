"""Personal data: fixed patterns, and a semi-Markov conditional random field beside them.

The patterns give the base spans.  Where digits, ``@`` or a spelled-out ``[at]`` remain
outside them, the text around is cut into tokens, and every run of up to ``MAX_TOKENS``
tokens that could be an entity is a candidate segment for each kind.  A candidate's score
is a sum of weights of features of the whole span (digits, check sum, groups, separators,
what stands beside it).  Dynamic programming over the tokens chooses boundaries and kinds
together; a segment stays if it beats the reading without it by ``MARGIN``.

The weights are fitted by likelihood (forward-backward over segments) on at most
``SAMPLE_REGIONS`` passages with base spans.  They are found in all documents and taken in
the order of a hash, kinds by turns, so that rare ones are not missed.  Each passage also serves in rewritten forms whose
right answer is known: signs spelled out, prefixes left out or put before, digits falsified.
Documents without base spans give a model that adds nothing.

Defined results: a NULL text is empty and has no spans.  Offsets count code points, ends
are exclusive.  Repeated rows are searched alike; other columns pass through.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import slices

# The kinds in their order and the base patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (13, 19), (9, 15)

#: A bracketed sign with its blanks is one token.
TOKEN = re.compile(r"\s?[\[(]\s?(?:at|dot|AT|DOT)\s?[\])]\s?|[A-Za-z]+|[0-9]+|\s+|[^A-Za-z0-9\s]")
TRIGGER = re.compile(r"[0-9]+|@|[\[(]\s?(?:at|dot|AT|DOT)\s?[\])]")
AT = re.compile(r"@|\s?[\[(]\s?(?:at|AT)\s?[\])]\s?")
DOT = re.compile(r"\s?[\[(]\s?(?:dot|DOT)\s?[\])]\s?")
DIGITS = re.compile(r"[0-9]+")
MAX_TOKENS, MAX_CHARS = 28, 96
AROUND = 48
MARGIN = 2.0
SAMPLE_REGIONS = 400
EPOCHS, RATE, PENALTY = 30, 0.5, 0.02
SLICE_BYTES = 4 << 20

Span = tuple[str, int, int]
SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        value = int(c) * (1 + k % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """From each ``@`` back over its local part: long runs without ``@`` cost nothing."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            found.append(("email", start, domain.end()))
            done = domain.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))
    return found


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by kind as listed, then start."""
    found = emails(text) if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = m[0].replace(" ", "").replace("-", "")
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                found.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if PHONE_DIGITS[0] <= sum(map(str.isdecimal, m[0])) <= PHONE_DIGITS[1]:
            found.append(("phone", m.start(), m.end()))
    return found


def kinds_of(span: str, digits: str) -> list[str]:
    """Kinds that a segment could be at all; the weights decide the rest."""
    found = []
    if AT.search(span) and span[0].isalnum() and span[-1].isalnum():
        found.append("email")
    groups = DIGITS.findall(span)
    letters = any(map(str.isalpha, span))
    if not letters and len(groups) == 4 and len(digits) <= 14 and span[-1].isdigit() and span[0].isdigit():
        found.append("ip")
    if not letters and 12 <= len(digits) <= 20 and span[0].isdigit() and span[-1].isdigit():
        found.append("card")
    if not letters and 7 <= len(digits) <= 16 and span[-1].isdigit():
        found.append("phone")
    return found


def span_features(kind: str, span: str, digits: str, left: str, right: str) -> list[str]:
    """Names of the features of a whole segment."""
    groups = DIGITS.findall(span)
    between = "".join(sorted(set(re.sub(r"[A-Za-z0-9]", "", span))))
    found = [f"{kind}:bias", f"{kind}:digits={len(digits)}", f"{kind}:between={between[:6]}",
             f"{kind}:left={'w' if left.isalnum() else left if left in '+.@-(' else '_'}",
             f"{kind}:right={'w' if right.isalnum() else right if right in '@-)' else '_'}",
             f"{kind}:groups={'-'.join(str(min(len(g), 7)) for g in groups[:6])}" if kind != "email" else "email"]
    if kind == "card":
        found.append(f"card:luhn={luhn(digits)}")
    elif kind == "ip":
        found.append(f"ip:quad={all(int(g) <= 255 and len(g) <= 3 for g in groups)}")
    elif kind == "phone":
        found.append(f"phone:open={span[0] if not span[0].isdigit() else '0'}")
    else:
        parts = AT.split(span)
        domain = DOT.sub(".", parts[-1])
        found += [f"email:ats={len(parts) - 1}", f"email:domain={bool(DOMAIN.fullmatch(domain))}",
                  f"email:name={bool(parts[0]) and all(c in LOCAL for c in parts[0])}",
                  f"email:sign={'@' in span}"]
    return found


@dataclass
class Region:
    """A passage in tokens with its candidate segments (from, to, kind, features)."""

    text: str
    edges: list[int]
    segments: list[tuple[int, int, str, list[str]]] = field(default_factory=list)


def covered(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Beginnings and ends of what the spans cover, in order and apart."""
    begins: list[int] = []
    ends: list[int] = []
    for begin, end in sorted(spans):
        if ends and begin < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            begins.append(begin)
            ends.append(end)
    return begins, ends


def touches(cover: tuple[list[int], list[int]], begin: int, end: int) -> bool:
    """Whether [begin, end) and the cover have a character in common."""
    begins, ends = cover
    k = bisect_right(ends, begin)
    return k < len(ends) and begins[k] < end


def region(text: str, taken: list[tuple[int, int]]) -> Region:
    """Tokens of ``text`` and the candidates that overlap nothing in ``taken``."""
    edges = [0, *(m.end() for m in TOKEN.finditer(text))]
    found = Region(text, edges)
    cover = covered(taken)
    closed = [touches(cover, a, b) for a, b in zip(edges, edges[1:], strict=False)]
    for i in range(len(edges) - 1):
        first = text[edges[i]]
        if closed[i] or not (first.isalnum() or first in "+("):
            continue
        for j in range(i + 1, min(i + MAX_TOKENS, len(edges) - 1) + 1):
            if closed[j - 1] or edges[j] - edges[i] > MAX_CHARS:
                break
            last = text[edges[j] - 1]
            if not last.isalnum():
                continue
            span = text[edges[i]: edges[j]]
            digits = "".join(DIGITS.findall(span))
            if not digits and not AT.search(span):
                continue
            left = text[edges[i] - 1] if edges[i] else " "
            right = text[edges[j]] if edges[j] < len(text) else " "
            for kind in kinds_of(span, digits):
                found.segments.append((i, j, kind, span_features(kind, span, digits, left, right)))
    return found


def best_segments(found: Region, weights: dict[str, float]) -> list[tuple[int, int, str]]:
    """Segments (from, to, kind) of the best reading; outside tokens score 0."""
    by_end: dict[int, list] = {}
    for i, j, kind, names in found.segments:
        score = sum(weights.get(n, 0.0) for n in names) - MARGIN
        if score > 0:
            by_end.setdefault(j, []).append((i, kind, score))
    n = len(found.edges)
    best, back = [0.0] * n, [None] * n
    for j in range(1, n):
        best[j] = best[j - 1]
        for i, kind, score in by_end.get(j, ()):
            if best[i] + score > best[j]:
                best[j], back[j] = best[i] + score, (i, kind)
    chosen, j = [], n - 1
    while j > 0:
        if back[j]:
            chosen.append((back[j][0], j, back[j][1]))
            j = back[j][0]
        else:
            j -= 1
    return chosen[::-1]


def _log_sum(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def fit(examples: list[tuple[Region, set[tuple[int, int, str]]]]) -> dict[str, float]:
    """Weights that maximise the penalised likelihood of the right segmentations."""
    weights: dict[str, float] = {}
    square: dict[str, float] = {}
    for _ in range(EPOCHS if examples else 0):
        slope: dict[str, float] = {}
        for found, right in examples:
            scored = [(i, j, sum(weights.get(n, 0.0) for n in names), names, (i, j, kind) in right)
                      for i, j, kind, names in found.segments]
            n = len(found.edges)
            forward, backward = [0.0] * n, [0.0] * n
            ends: dict[int, list] = {}
            starts: dict[int, list] = {}
            for s in scored:
                ends.setdefault(s[1], []).append(s)
                starts.setdefault(s[0], []).append(s)
            for j in range(1, n):
                forward[j] = forward[j - 1]
                for i, _, score, _, _ in ends.get(j, ()):
                    forward[j] = _log_sum(forward[j], forward[i] + score)
            for i in range(n - 2, -1, -1):
                backward[i] = backward[i + 1]
                for _, j, score, _, _ in starts.get(i, ()):
                    backward[i] = _log_sum(backward[i], backward[j] + score)
            for i, j, score, names, gold in scored:
                chance = math.exp(min(0.0, forward[i] + score + backward[j] - forward[-1]))
                if gold or chance > 1e-6:
                    for name in names:
                        slope[name] = slope.get(name, 0.0) + gold - chance
        for name, value in slope.items():
            value -= PENALTY * weights.get(name, 0.0)
            square[name] = square.get(name, 1e-8) + value * value
            weights[name] = weights.get(name, 0.0) + RATE * value / math.sqrt(square[name])
    return weights


def rewritten(text: str, spans: list[Span]) -> Iterator[tuple[str, list[Span]]]:
    """The passage as it is and in forms that the patterns miss or must not take."""
    yield text, spans
    for turn in range(3):
        out, kept, at = [], [], 0
        length = 0

        def put(piece: str) -> None:
            nonlocal length
            out.append(piece)
            length += len(piece)

        for kind, start, end in sorted(spans, key=lambda s: s[1]):
            if start < at:
                continue
            put(text[at:start])
            span, real = text[start:end], True
            if kind == "email":
                name, _, domain = span.partition("@")
                sign = (" [at] ", " (at) ", "@")[turn]
                span = name + sign + domain.replace(".", (" [dot] ", " (dot) ", " [dot] ")[turn])
            elif kind == "ip" and turn:
                parts = span.split(".")
                span = "[.]".join(parts) if turn == 1 else ".".join([*parts[:3], str(300 + int(parts[3]))])
                real = turn == 1
            elif kind == "card":
                if turn == 2:
                    span, real = span[:-1] + str((int(span[-1]) + 3) % 10), False
                else:
                    put(("7 ", "21-")[turn])
            elif kind == "phone":
                head, _, tail = span.partition(" ")
                if turn == 0 and tail:
                    span = tail
                elif turn == 1:
                    span = "00" + span[1:]
                else:
                    span, real = "+" + "".join(DIGITS.findall(span))[:5], False
            if real:
                kept.append((kind, length, length + len(span)))
            put(span)
            at = end
        put(text[at:])
        yield "".join(out), kept


def examples_of(passages: list[str]) -> list[tuple[Region, set[tuple[int, int, str]]]]:
    found = []
    for text in passages:
        for form, spans in rewritten(text, base_spans(text)):
            cut = region(form, [])
            at = {edge: k for k, edge in enumerate(cut.edges)}
            right = {(at.get(s), at.get(e), kind) for kind, s, e in spans}
            if right <= {(i, j, kind) for i, j, kind, _ in cut.segments}:
                found.append((cut, right))
    return found


def passages(text: str | None, only_base: bool) -> Iterator[tuple[int, str]]:
    """(offset, passage) around triggers, apart by ``AROUND`` characters and more."""
    if not text:
        return
    marks = [(s, e) for _, s, e in base_spans(text)] if only_base else [m.span() for m in TRIGGER.finditer(text)]
    begin = end = None
    for s, e in sorted(marks):
        if end is not None and s - end > AROUND:
            yield _padded(text, begin, end)
            begin = None
        begin, end = s if begin is None else begin, e if begin is None else max(end, e)
    if begin is not None:
        yield _padded(text, begin, end)


def _padded(text: str, begin: int, end: int) -> tuple[int, str]:
    """The passage with words to its left and right; no word is cut unless it is very long."""
    start, stop = max(0, begin - AROUND), min(len(text), end + AROUND)
    while 0 < start < begin and text[start - 1].isalnum() and text[start].isalnum():
        start += 1
    while end < stop < len(text) and text[stop - 1].isalnum() and text[stop].isalnum():
        stop -= 1
    return start, text[start:stop]


def pieces(passage: str, most: int = 4 * MAX_CHARS) -> Iterator[str]:
    """The passage, or a long one in pieces that begin and end between its spans.

    A span of more than ``most`` characters has no piece, as it is no candidate either.
    """
    if len(passage) <= most:
        yield passage
        return
    begins, ends = covered([(s, e) for _, s, e in base_spans(passage)])
    k = 0
    while k < len(begins):
        left = max(begins[k] - AROUND, ends[k - 1] if k else 0)
        j = k
        while j + 1 < len(begins) and ends[j + 1] - left <= most - AROUND:
            j += 1
        right = min(ends[j] + AROUND, begins[j + 1] if j + 1 < len(begins) else len(passage))
        if right - left <= most:
            yield passage[left:right]
        k = j + 1


def _lot(passage: str) -> int:
    return int.from_bytes(hashlib.blake2b(passage.encode(), digest_size=8).digest(), "big", signed=True)


def train(documents: DataFrame, sample_regions: int = SAMPLE_REGIONS) -> dict[str, float]:
    """Weights from a sample of the passages with base spans of all ``documents``.

    Kinds take turns, each in the order of a hash, so that a rare one has its share.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[str, dict[str, int]] = {kind: {} for kind in KINDS}  # no task sends more than the sample of a kind

        def prune(most: int) -> None:
            for kind, lots in first.items():
                if len(lots) > most:
                    first[kind] = dict(sorted(lots.items(), key=lambda x: (x[1], x[0]))[:sample_regions])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, whole in passages(text, only_base=True):
                    for passage in pieces(whole):
                        for kind in {s[0] for s in base_spans(passage)}:
                            first[kind][passage] = _lot(passage)
                    prune(4 * sample_regions)
        prune(sample_regions)
        rows = [(kind, lot, passage) for kind, lots in first.items() for passage, lot in lots.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string()))],
            names=["kind", "lot", "passage"])

    found = documents.select("text").mapInArrow(cut, "kind string, lot long, passage string").distinct()
    turn = F.row_number().over(Window.partitionBy("kind").orderBy("lot", "passage"))  # few of each task
    found = found.withColumn("turn", turn).where(F.col("turn") <= sample_regions).groupBy("passage").agg(F.min("turn").alias("turn"), F.min("lot").alias("lot"))
    rows = found.orderBy("turn", "lot", "passage").limit(sample_regions).collect()
    return fit(examples_of([r["passage"] for r in rows]))


def added_spans(text: str, base: list[Span], weights: dict[str, float]) -> list[Span]:
    """Spans that the model finds outside the base spans."""
    cover = begins, ends = covered([(s, e) for _, s, e in base])
    found = []
    for offset, passage in passages(text, only_base=False):
        if all(touches(cover, offset + m.start(), offset + m.end()) for m in TRIGGER.finditer(passage)):
            continue
        k = bisect_right(ends, offset)
        stop = bisect_left(begins, offset + len(passage))
        own = [(s - offset, e - offset) for s, e in zip(begins[k:stop], ends[k:stop], strict=True)]
        cut = region(passage, own)
        for i, j, kind in best_segments(cut, weights):
            found.append((kind, offset + cut.edges[i], offset + cut.edges[j]))
    return found


def find_spans(documents: DataFrame, weights: dict[str, float], into: str = "spans") -> DataFrame:
    """``documents`` with all spans in ``into``, by kind as listed, then start."""
    sent = documents.sparkSession.sparkContext.broadcast(weights)  # a few hundred features
    df = documents.withColumn(into, F.lit(None).cast(SPANS))
    at, out = df.columns.index("text"), df.columns.index(into)
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("base", pa.bool_())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for run in slices(batch, at, SLICE_BYTES):
                rows = []
                for text in run.column(at).to_pylist():
                    base = base_spans(text) if text else []
                    both = [(s, True) for s in base]
                    both += [(s, False) for s in added_spans(text, base, model)] if text and model else []
                    both.sort(key=lambda x: (KINDS.index(x[0][0]), x[0][1], x[0][2]))
                    rows.append([{"kind": k, "start": s, "end": e, "base": b} for (k, s, e), b in both])
                arrays = [run.column(k) if k != out else pa.array(rows, type=arrow) for k in range(run.num_columns)]
                yield pa.RecordBatch.from_arrays(arrays, names=run.schema.names)

    return df.mapInArrow(search, df.schema)


def digest(found: DataFrame) -> DataFrame:
    """One row per document: base spans by kind, their hash, and all spans as text."""
    written = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["base"])
    of = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(of) - F.size(F.array_remove(of, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts,
        F.sha2(F.array_join(F.transform(base, written), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", written), ",").alias("spans"))
