"""Benchmark decontamination with suffix arrays over the training documents.

Every run of documents that a task reads (some ``shard_bytes`` of text) gets a suffix
array over its words.  All suffixes of all test items are looked up in it by binary
search, one word deeper at a time, so that the longest verbatim match of each suffix and
all its places come out of the same search.  Documents never move: the test items, which
are the stated query set, travel to them in blocks of bounded size.

Words that no test item has can end a match but never be part of one.  They share the
number 0, and no suffix that begins with one is kept.

Defined results: a NULL or empty text has no words and is clean; an item without words
matches nothing; an item of fewer words than the window is one window; items with equal
ids count once; an item with a NULL id can hit words but is neither counted nor listed.
Repeated documents are judged row by row, and all other columns pass through unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import slices

# What a word is, after A-Z became a-z.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 64 << 20

MATCHES = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest", T.StructType([
        T.StructField("words", T.LongType()), T.StructField("start", T.LongType()),
        T.StructField("item", T.StringType()), T.StructField("item_start", T.LongType())])),
])


def words(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode().lower()) if text else []


@dataclass
class Suffixes:
    """All suffixes of a block of test items: numbered words and where each one starts."""

    vocabulary: dict[bytes, int]
    numbers: np.ndarray  # the items' words, one item after another
    start: np.ndarray  # of each suffix in ``numbers``
    length: np.ndarray  # words up to the end of its item
    window: np.ndarray  # words of the window that starts there, 0 if none does
    item: np.ndarray  # index into ``items``
    offset: np.ndarray  # of the suffix in its item
    items: list[str | None]

    @classmethod
    def of(cls, rows: list[tuple[object, str | None]], window: int) -> Suffixes:
        vocabulary: dict[bytes, int] = {}
        numbers, items, sizes = [], [], []
        for item, text in rows:
            found = words(text)
            if found:
                numbers += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in found]
                items.append(None if item is None else str(item))
                sizes.append(len(found))
        size = np.array(sizes, dtype=np.int64)
        item = np.repeat(np.arange(len(sizes)), size)
        start = np.arange(len(numbers), dtype=np.int64)
        offset = start - np.repeat(np.cumsum(size) - size, size)
        length = size[item] - offset
        least = np.minimum(window, size[item])
        return cls(vocabulary, np.array(numbers, dtype=np.int64), start, length,
                   np.where(length >= least, least, 0), item, offset, items)


def suffix_array(numbers: np.ndarray, depth: int) -> np.ndarray:
    """Places of the non-zero words, sorted by the next ``depth`` words from each.

    As many words as fit are packed into one 64-bit key.  After the first sort only ties
    are sorted on, by the words behind.  ``numbers`` must end in ``depth`` zeros or more.
    """
    places = np.flatnonzero(numbers)
    bits = max(1, int(numbers.max(initial=0)).bit_length())
    packed = max(1, min(depth, 62 // bits))
    key = np.zeros(len(numbers), dtype=np.int64)
    for k in range(packed):
        key[: len(key) - k] = (key[: len(key) - k] << bits) | numbers[k:]
        key[len(key) - k:] <<= bits
    order = places[np.argsort(key[places], kind="stable")]
    tied, group = np.arange(len(order)), key[order]
    done = packed
    while done < depth and len(tied):
        same = group[1:] == group[:-1]
        keep = np.append(same, False) | np.append(False, same)
        tied, group = tied[keep], group[keep]
        if not len(tied):
            break
        group = np.cumsum(np.append(True, group[1:] != group[:-1]))
        behind = key[np.minimum(order[tied] + done, len(key) - 1)]
        inner = np.lexsort((behind, group))
        order[tied] = order[tied][inner]
        behind = behind[inner]
        changed = (group[1:] != group[:-1]) | (behind[1:] != behind[:-1])
        group = np.cumsum(np.append(True, changed))
        done += packed
    return order


def _bound(numbers: np.ndarray, order: np.ndarray, depth: int, low: np.ndarray, high: np.ndarray,
           wanted: np.ndarray, after: bool):
    """First place in [low, high) of ``order`` whose word ``depth`` further is >= (or >) ``wanted``.

    Only the words that a search meets are looked at; a range that is closed costs nothing more.
    """
    low, high = low.copy(), high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        value = numbers[np.minimum(order[middle] + depth, len(numbers) - 1)]
        right = (value <= wanted[open_]) if after else (value < wanted[open_])
        low[open_[right]] = middle[right] + 1
        high[open_[~right]] = middle[~right]
        open_ = open_[low[open_] < high[open_]]
    return low


def search(numbers: np.ndarray, order: np.ndarray, test: Suffixes):
    """For each test suffix: its longest match, where in ``order`` that is, and its window.

    Returns (length, low, high, window_low, window_high).
    """
    n = len(test.start)
    length = np.zeros(n, dtype=np.int64)
    low, high = np.zeros(n, dtype=np.int64), np.full(n, len(order), dtype=np.int64)
    window_low, window_high = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    active = np.arange(n)
    depth = 0
    while len(active):
        wanted = test.numbers[test.start[active] + depth]
        new_low = _bound(numbers, order, depth, low[active], high[active], wanted, after=False)
        new_high = _bound(numbers, order, depth, new_low, high[active], wanted, after=True)
        found = new_low < new_high
        active = active[found]
        low[active], high[active] = new_low[found], new_high[found]
        depth += 1
        length[active] = depth
        closed = active[test.window[active] == depth]
        window_low[closed], window_high[closed] = low[closed], high[closed]
        active = active[test.length[active] > depth]
    return length, low, high, window_low, window_high


def match(texts: list[str | None], test: Suffixes) -> tuple[np.ndarray, list, list, list]:
    """Per text: number of words, merged hit ranges, items, longest match."""
    get = test.vocabulary.get
    sizes = np.zeros(len(texts), dtype=np.int64)
    depth = int(test.length.max(initial=1))
    numbers: list[int] = []
    starts = np.zeros(len(texts), dtype=np.int64)
    for k, text in enumerate(texts):
        found = words(text)
        starts[k], sizes[k] = len(numbers), len(found)
        numbers.extend([get(w, 0) for w in found])
        numbers.append(0)
    number = np.zeros(len(numbers) + depth + 1, dtype=np.int64)
    number[: len(numbers)] = numbers
    order = suffix_array(number, depth)
    hits: list = [[] for _ in texts]
    items: list = [[] for _ in texts]
    longest: list = [None] * len(texts)
    if not len(order) or not len(test.start):
        return sizes, hits, items, longest
    length, low, high, window_low, window_high = search(number, order, test)

    # Items share windows: each distinct one is looked up and marked once, for all its items.
    inside = np.flatnonzero(window_low < window_high)
    ranges = np.stack([window_low[inside], window_high[inside], test.window[inside]])
    distinct, of = np.unique(ranges, axis=1, return_inverse=True)
    by_window = np.split(test.item[inside][np.argsort(of, kind="stable")], np.cumsum(np.bincount(of))[:-1])
    edge = np.zeros(len(number) + 1, dtype=np.int64)
    named: list[set[str]] = [set() for _ in texts]
    for (begin, end, width), owners in zip(distinct.T.tolist(), by_window, strict=False):
        place = order[begin:end]  # of one window in all texts: no place comes twice
        edge[place] += 1
        edge[place + width] -= 1
        names = {test.items[k] for k in np.unique(owners).tolist()} - {None}
        for k in np.unique(np.searchsorted(starts, place, side="right") - 1).tolist():
            named[k] |= names
    items = [sorted(n) for n in named]
    hit = np.cumsum(edge)[:-1] > 0
    change = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    for begin, end in zip(change[::2].tolist(), change[1::2].tolist(), strict=True):
        k = int(np.searchsorted(starts, begin, side="right")) - 1
        hits[k].append({"start": begin - int(starts[k]), "end": end - int(starts[k])})

    # The longest match at each place: longer ones are laid over shorter ones, and of equal
    # ones the first test suffix stays.
    least = np.where(test.window > 0, test.window, np.iinfo(np.int64).max)
    full = np.flatnonzero(length >= least)
    full = full[np.lexsort((-test.start[full], length[full]))]
    _, last = np.unique(np.stack([low[full], high[full]])[:, ::-1], axis=1, return_index=True)
    full = full[np.sort(len(full) - 1 - last)]
    best_at = np.full(len(order), -1, dtype=np.int64)
    for k in full.tolist():
        best_at[low[k]:high[k]] = k
    covered = np.flatnonzero(best_at >= 0)
    suffix, place = best_at[covered], order[covered]
    document = np.searchsorted(starts, place, side="right") - 1
    best = np.lexsort((place, -length[suffix], document))
    first = best[np.append(True, np.diff(document[best]) > 0)] if len(best) else best
    for k in first.tolist():
        s, d = int(suffix[k]), int(document[k])
        longest[d] = {"words": int(length[s]), "start": int(place[k] - starts[d]),
                      "item": test.items[int(test.item[s])], "item_start": int(test.offset[s])}
    return sizes, hits, items, longest


def _merged(old: dict | None, hits: list, items: list, longest: dict | None, n: int) -> dict:
    if old:
        ranges = sorted((r["start"], r["end"]) for r in [*old["hits"], *hits])
        hits = []
        for begin, end in ranges:
            if hits and begin <= hits[-1]["end"]:
                hits[-1]["end"] = max(end, hits[-1]["end"])
            else:
                hits.append({"start": begin, "end": end})
        items = [*old["items"], *items]
        if old["longest"] and (not longest or old["longest"]["words"] >= longest["words"]):
            longest = old["longest"]
    return {"n_words": n, "hits": hits, "items": sorted(set(items)), "longest": longest}


def blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Suffixes]:
    """The test items as suffix tables of some ``block_bytes`` of text each.

    An item is never cut, so a block holds that much or its largest item.
    """
    plain = benchmark.select(F.col("item_id").alias("item"), F.col("text").alias("words"))
    total = plain.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = plain if n == 1 else plain.where(F.pmod(F.xxhash64("item", "words"), F.lit(n)) == k)
        yield Suffixes.of([tuple(r) for r in part.distinct().collect()], window)


def find_matches(documents: DataFrame, benchmark: DataFrame, into: str = "matches",
                 window: int = WINDOW, shard_bytes: int = SHARD_BYTES,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``documents`` with a column ``into`` of type ``MATCHES``, added or replaced.

    One pass over the documents for each block of test items; no shuffle.
    """
    spark = documents.sparkSession
    df = documents.withColumn(into, F.lit(None).cast(MATCHES))
    at, out = df.columns.index("text"), df.columns.index(into)
    arrow = pa.struct([
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.string())),
        ("longest", pa.struct([("words", pa.int64()), ("start", pa.int64()),
                               ("item", pa.string()), ("item_start", pa.int64())]))])
    for block in blocks(benchmark, window, block_bytes):
        sent = spark.sparkContext.broadcast(vars(block))

        def probe(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            test = Suffixes(**sent.value)
            for batch in batches:
                for run in slices(batch, at, shard_bytes):
                    sizes, hits, items, longest = match(run.column(at).to_pylist(), test)
                    old = run.column(out).to_pylist()
                    rows = [_merged(*x) for x in zip(old, hits, items, longest, sizes.tolist(), strict=True)]
                    arrays = [run.column(k) if k != out else pa.array(rows, type=arrow)
                              for k in range(run.num_columns)]
                    yield pa.RecordBatch.from_arrays(arrays, names=run.schema.names)

        df = df.mapInArrow(probe, df.schema)
    return df


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``documents`` in which no window of a test item occurs, all columns kept."""
    names = documents.columns
    plain = documents.toDF(*[c if c == "text" else f"__col{k}" for k, c in enumerate(names)])
    found = find_matches(plain, benchmark, "matches", **options)
    return found.where(F.size(F.col("matches")["hits"]) == 0).drop("matches").toDF(*names)


def digest(matches: DataFrame) -> DataFrame:
    """One row per document from ``find_matches``: what was hit, by how many items."""
    found = F.col("matches")
    n_hit = F.aggregate(found["hits"], F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return matches.select(
        "doc_id", found["n_words"].alias("n_words"), n_hit.alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(found["items"], ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(found["hits"]) > 0).alias("contaminated"),
    )
