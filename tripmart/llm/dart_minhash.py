"""Near-duplicate classes by DartMinHash signatures, banding, and exact verification.

A document is a weighted set of shingles of five words: a shingle weighs as often as it
occurs.  Every element owns a strip of the plane, as wide as its weight; hashed darts fall into the cells of the plane (one per unit
of area on average, the same ones for every document that has the element).  The darts in
a document's region below a height that leaves some k ln k + 2k of them are thrown at k
coordinates, and each coordinate keeps its earliest dart.  Two documents agree in a
coordinate with the probability of their weighted Jaccard similarity.  Coordinates are
joined in bands; documents that share a band are candidates.

Equal texts are one item.  Within a band's bucket candidates are compared with one chosen
item (in later rounds the one with most links so far), not with each other; what is in one
class already needs no comparison.  After ``ROUNDS`` rounds whatever one bucket still holds
in different classes is compared, so no link inside a bucket is lost: in a bucket of up to
``SMALL`` items as pairs, in a larger one block against block, where a task multiplies the
shingle tables of two blocks of bounded size and returns the links only.  Every link is
verified on whole texts: weighted Jaccard similarity (the lesser counts of all shingles
against the greater ones), ``SIMILAR`` or more.
Classes are the connected components.

Defined results: fewer than five words are one shingle; texts without words (NULL too) have
none and are similar only to texts equal to them, NULL counting as empty.  A class is named
by its least id, ``NULL`` if it has none.  Repeated rows share their class.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import quoted, settle, slices
from tripmart.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 28, 5  # a pair at 0.8 shares no band once in 70,000 times
ROUNDS = 2
#: Buckets that are compared in pairs; beyond, items and shingles of a block.
SMALL = 16
BLOCK_ITEMS, BLOCK_SHINGLES = 1024, 200_000
TABLE_COLUMNS = 2048
#: What a Python worker works on at once: bytes of text, and shingles of the texts compared before.
SLICE_BYTES = 256 << 10
KNOWN_SHINGLES = 50_000
#: Distribution function of a Poisson variable of mean 1.
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                         0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def shingle_sets(texts: list[str | None]):
    """(document, element, weight) of all texts' distinct shingles; a weight counts occurrences."""
    found = [WORD.findall(t) if t else [] for t in texts]
    sizes = np.array([len(w) for w in found], dtype=np.int64)
    flat = np.array([w for ws in found for w in ws], dtype=object)
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = mix(pd.util.hash_array(flat, categorize=True))
    starts = np.cumsum(sizes) - sizes
    n = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    document = np.repeat(np.arange(len(texts)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + starts[document]
    element = np.zeros(len(place), dtype=np.uint64)
    for k in range(SHINGLE):
        inside = k < sizes[document]
        word = words[np.minimum(place + k, len(words) - 1)]
        element += np.where(inside, word * _MULTIPLIERS[k], np.uint64(k + 1))
    element = mix(element)
    order = np.lexsort((element, document))
    document, element = document[order], element[order]
    first = np.append(True, (document[1:] != document[:-1]) | (element[1:] != element[:-1]))
    begin = np.flatnonzero(first)
    return document[begin], element[begin], np.diff(np.append(begin, len(element)))


def occurrences(document, element, weight):
    """(document, element) with an element of its own for each occurrence of a shingle.

    The Jaccard similarity of these sets is the weighted one of the shingles.
    """
    at = np.repeat(np.arange(len(element)), weight)
    number = np.arange(len(at)) - np.repeat(np.cumsum(weight) - weight, weight)
    own = mix(element[at] + number.astype(np.uint64) * _MULTIPLIERS[0])
    return document[at], np.where(number > 0, own, element[at])


def throw(document, element, weight, height: np.ndarray):
    """Darts (document, rank, identity) in the regions of the elements below ``height``."""
    levels = np.floor(np.log2(weight.astype(np.float64))).astype(np.int64) + 1
    at = np.repeat(np.arange(len(element)), levels)
    level = np.arange(len(at)) - np.repeat(np.cumsum(levels) - levels, levels)
    width = np.exp2(level)  # the strip [2^level - 1, 2^(level + 1) - 1), in cells of area 1
    rows = np.ceil(height[document[at]] * width).astype(np.int64)
    pick = np.repeat(np.arange(len(at)), rows)
    row = np.arange(len(pick)) - np.repeat(np.cumsum(rows) - rows, rows)
    at, level, width = at[pick], level[pick], width[pick]
    place = mix(level.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + row.astype(np.uint64) + np.uint64(1))
    cell = mix(element[at] ^ place)
    darts = np.searchsorted(POISSON, _unit(cell), side="right")
    pick = np.repeat(np.arange(len(at)), darts)
    number = np.arange(len(pick)) - np.repeat(np.cumsum(darts) - darts, darts)
    at, row, width = at[pick], row[pick], width[pick]
    dart = mix(cell[pick] + (number.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    across = width - 1 + width * _unit(dart)
    dart = mix(dart ^ np.uint64(0xA0761D6478BD642F))
    rank = (row + _unit(dart)) / width
    keep = (across < weight[at]) & (rank <= height[document[at]])
    return document[at][keep], rank[keep], mix(dart[keep] ^ np.uint64(0xE7037ED1A0B428DB))


def signatures(document, element, weight, n: int, k: int) -> np.ndarray:
    """(n, k) earliest darts; rows of documents without elements are 0."""
    out = np.zeros((n, k), dtype=np.uint64)
    total = np.bincount(document, weights=weight, minlength=n)
    darts = math.ceil(k * math.log(k) + 2 * k)
    open_ = total > 0
    boost = 1.0
    while open_.any():
        mine = open_[document]
        height = np.where(total > 0, boost * darts / np.maximum(total, 1), 0.0)
        where, rank, identity = throw(document[mine], element[mine], weight[mine], height)
        slot = where * k + (identity % np.uint64(k)).astype(np.int64)
        order = np.lexsort((rank, slot))
        slot, identity = slot[order], identity[order]
        first = np.append(True, slot[1:] != slot[:-1])[: len(slot)]
        filled = np.zeros(n * k, dtype=bool)
        filled[slot[first]] = True
        out.reshape(-1)[slot[first]] = identity[first]
        open_ = open_ & ~filled.reshape(n, k).all(axis=1)
        boost *= 2
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signature), bands), dtype=np.uint64)
    for r in range(rows):
        keys = mix(keys + signature[:, r * bands:(r + 1) * bands])
    return mix(keys ^ mix(np.arange(1, bands + 1, dtype=np.uint64))).view(np.int64)


def item_of(text: Column) -> Column:
    """Equal texts have equal items: 128 bits."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def sketch(documents: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, item, n, keys): number of shingles and the band keys of every row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in slices(batch, 2, SLICE_BYTES):
                texts = run.column(2).to_pylist()
                sets = shingle_sets(texts)
                keys = band_keys(signatures(*sets, len(texts), bands * rows), bands, rows)
                n = np.bincount(sets[0], weights=sets[2], minlength=len(texts)).astype(np.int64)
                some = n > 0
                flat = pa.array(keys[some].reshape(-1), pa.int64())
                offsets = pa.array(np.append(0, np.cumsum(some * bands)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [run.column(0), run.column(1), pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
                    names=["doc_id", "item", "n", "keys"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", item_of(F.col("text")).alias("item"), "text").mapInArrow(
        work, f"doc_id {kind}, item binary, n long, keys array<long>")


def shingles(text: str) -> frozenset:
    """The shingles of a text; the second and later ones of a kind are numbered."""
    words = WORD.findall(text)
    if len(words) < SHINGLE:
        return frozenset([tuple(words)]) if words else frozenset()
    found = Counter(zip(*(words[k:] for k in range(SHINGLE)), strict=False))
    once = frozenset(found)
    if len(once) == len(words) - SHINGLE + 1:
        return once
    return once | {(s, k) for s, n in found.items() for k in range(1, n)}


def jaccard(x: frozenset, y: frozenset) -> float:
    both = len(x & y)
    return both / (len(x) + len(y) - both) if x or y else 0.0


def similar_pairs(batches: Iterator[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    """(a, b) of the rows (a, b, text_a, text_b) whose texts are similar.

    Texts leave a batch in slices, and the shingles that are remembered are bounded by their
    number, so memory does not grow with the lengths of the texts.
    """
    known: dict[str, frozenset] = {}  # hubs come again and again
    held = 0

    def of(text: str) -> frozenset:
        nonlocal held
        if text in known:
            return known[text]
        found = shingles(text)
        if held + len(found) > KNOWN_SHINGLES:
            known.clear()
            held = 0
        known[text] = found
        held += len(found)
        return found

    for batch in batches:
        for run in slices(batch, 2, SLICE_BYTES):
            left, right = run.column(2).to_pylist(), run.column(3).to_pylist()
            keep = [jaccard(of(x), of(y)) >= similar for x, y in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [run.column(k).filter(pa.array(keep, pa.bool_())) for k in (0, 1)], names=["a", "b"])


def _verify(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) of items whose texts are similar."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return similar_pairs(batches, similar)

    one = texts.select(F.col("item").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("item").alias("b"), F.col("text").alias("text_b"))
    # Merge joins at every size: what moves stays in proportion to the input.
    return pairs.select("a", "b").join(one.hint("merge"), "a").join(two.hint("merge"), "b").select(
        "a", "b", "text_a", "text_b").mapInArrow(work, "a binary, b binary")


def links_between(texts: list[str], first: np.ndarray, second: np.ndarray, similar: float) -> np.ndarray:
    """Index pairs (one ``first``, one ``second``) of similar texts, each pair once.

    The table of texts and shingles has a column only for those of two texts or more;
    it is multiplied with itself a few columns at a time.
    """
    document, element = occurrences(*shingle_sets(texts))
    n = np.bincount(document, minlength=len(texts)).astype(np.float32)
    _, column, seen = np.unique(element, return_inverse=True, return_counts=True)
    keep = seen[column] > 1
    document, column = document[keep], np.unique(column[keep], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    document, column = document[order], column[order]
    both = np.zeros((len(texts), len(texts)), dtype=np.float32)
    for begin in range(0, int(column.max(initial=-1)) + 1, TABLE_COLUMNS):
        lo, hi = np.searchsorted(column, [begin, begin + TABLE_COLUMNS])
        table = np.zeros((len(texts), TABLE_COLUMNS), dtype=np.float32)
        table[document[lo:hi], column[lo:hi] - begin] = 1
        both += table @ table.T
    near = both >= similar * (n[:, None] + n[None, :] - both) - 1e-4
    near &= (both > 0) & ((first[:, None] & second[None, :]) | (second[:, None] & first[None, :]))
    return np.argwhere(np.triu(near, 1))


def _block_links(members: DataFrame, buckets: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """Links (a, b) inside large buckets, between items that have different roots."""
    wide = F.greatest(F.ceil(F.col("members") / BLOCK_ITEMS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    rows = members.join(buckets.select("key", wide.alias("blocks")), "key").withColumn(
        "block", F.pmod(F.xxhash64("item", "key"), "blocks").cast("int"))
    rows = rows.select("key", "item", "root", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("key", "item", "root", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def work(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        block = table["block"].to_numpy()
        items, roots = table["item"].to_pylist(), table["root"].to_pylist()
        found = links_between(table["text"].to_pylist(), block == i, block == j, similar)
        pairs = [sorted((items[x], items[y])) for x, y in found.tolist() if roots[x] != roots[y]]
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.binary()), "b": pa.array([p[1] for p in pairs], pa.binary())})

    return rows.join(texts.hint("merge"), "item").groupBy("key", "i", "j").applyInArrow(
        work, "a binary, b binary").distinct()


def _sized(similar: float) -> Column:
    """What the sizes of two sets must fulfil to be similar at all."""
    return F.least("n", "n_b") >= similar * F.greatest("n", "n_b") - 1e-9


def near_links(rows: DataFrame, documents: DataFrame, similar: float = SIMILAR, rounds: int = ROUNDS) -> DataFrame:
    """(node, root) of the items that are similar to another one; ``rows`` come from ``sketch``."""
    # Short names of the items are enough to see which keys are shared.
    short = rows.select(F.xxhash64("item").alias("short"), F.explode("keys").alias("key"))
    shared = short.groupBy("key").agg(F.min("short").alias("lo"), F.max("short").alias("hi")).where("lo <> hi")
    shared = settle(shared.select("key"), "near-keys")
    entries = short.join(shared.hint("merge"), "key").distinct()
    named = rows.groupBy("item").agg(F.min("n").alias("n")).withColumn("short", F.xxhash64("item"))
    entries = settle(entries.join(named.hint("merge"), "short").select("item", "n", "key"), "near-entries")
    shared = entries.select("item").distinct().hint("merge")
    chosen = rows.select("item", "doc_id").join(shared, "item", "left_semi").groupBy("item").agg(
        F.min("doc_id").alias("doc_id"))  # one row of each text; ids are NULL only if all are
    chosen = settle(chosen.select(F.col("item").alias("wanted"), F.col("doc_id").alias("wanted_id")), "near-items")
    texts = documents.select("doc_id", item_of(F.col("text")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    # Texts of candidates only; a merge join at every size, as one side has no bound.
    texts = settle(texts.join(chosen.hint("merge"), (F.col("item") == F.col("wanted")) & F.col("doc_id").eqNullSafe(
        F.col("wanted_id")), "left_semi").groupBy("item").agg(F.min("text").alias("text")), "near-texts")

    tested = links = roots = None
    for turn in range(rounds + 1):
        known = entries
        if roots is not None:
            ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
            degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
            state = settle(roots.join(degree, "node", "left").withColumnRenamed("node", "item"), "near-state")
            known = entries.join(state, "item", "left")
        else:
            known = known.withColumn("root", F.lit(None).cast("binary")).withColumn("degree", F.lit(0))
        known = settle(known.withColumn("root", F.coalesce("root", "item")).withColumn(
            "degree", F.coalesce("degree", F.lit(0)).cast("long")), "near-known")
        mixed = known.groupBy("key").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi"),
            F.max(F.struct("degree", F.xxhash64("item", F.lit(turn)).alias("lot"), "item", "root", "n")).alias("hub"),
            F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
        mixed = settle(mixed.where("lo <> hi").select(
            "key", "members", "shingles", F.col("hub.item").alias("b"), F.col("hub.root").alias("root_b"), F.col("hub.n").alias("n_b")), "near-hubs")
        if turn < rounds:
            pairs = known.withColumnRenamed("item", "a").join(mixed, "key")
            pairs = pairs.where((F.col("root") != F.col("root_b")) & _sized(similar))
        else:
            left = known.join(mixed.where(F.col("members") <= SMALL).select("key"), "key").withColumnRenamed("item", "a")
            right = left.select("key", F.col("a").alias("b"), F.col("root").alias("root_b"), F.col("n").alias("n_b"))
            pairs = settle(left, "near-left").join(settle(right, "near-right"), "key").where(
                (F.col("a") < F.col("b")) & (F.col("root") != F.col("root_b")) & _sized(similar))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = settle(pairs, "near-pairs")
        found = _verify(pairs, texts, similar)
        if turn == rounds:
            found = found.unionByName(_block_links(known, mixed.where(F.col("members") > SMALL), texts, similar))
        found = settle(found, "near-links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        if turn == 0 or found.limit(1).count():
            roots = components(links)
    return roots


def classes(documents: DataFrame, bands: int = BANDS, rows: int = ROWS, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, item, root, class_id, class_rows) for every row of ``documents``; ``root`` is never NULL."""
    drawn = settle(sketch(documents, bands, rows), "near-rows")
    roots = near_links(drawn, documents, similar)
    named = drawn.select("doc_id", "item").join(
        roots.withColumnRenamed("node", "item"), "item", "left").withColumn("root", F.coalesce("root", "item"))
    named = settle(named, "near-named")
    least = settle(named.groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_rows")), "near-classes")
    return named.join(least, "root").select("doc_id", "item", "root", "class_id", "class_rows")


def deduplicate(documents: DataFrame, **options) -> DataFrame:
    """One row of every class: that of the least id (NULL last) and, among those, of the least item.

    All columns pass through.  Rows go straight through unless their id and text repeat; of
    such repeated rows one stays.
    """
    found = classes(documents.select("doc_id", "text"), **options)
    keyed = found.groupBy("root", "doc_id", "item").agg(F.count(F.lit(1)).alias("copies"))
    best = keyed.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "item", "copies")).alias("best"))
    named = settle(best.select(F.col("best.doc_id").alias("__id"), F.col("best.item").alias("__item"),
                               F.col("best.copies").alias("__copies")), "near-kept")
    columns = documents.columns
    rows = documents.select(*[F.col(quoted(c)).alias(f"__col{k}") for k, c in enumerate(columns)],
                            F.col("doc_id").alias("__own"), item_of(F.col("text")).alias("__of"))
    kept = rows.join(named, F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__item")))
    back = [F.col(f"__col{k}").alias(c) for k, c in enumerate(columns)]
    again = kept.where("__copies > 1").dropDuplicates(["__id", "__item"])
    return kept.where("__copies = 1").select(back).unionByName(again.select(back))
