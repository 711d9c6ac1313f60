"""Language-model scores by prediction by partial matching, over the bytes of a text.

The trie of byte contexts up to ``ORDER`` bytes lives in tables, one per depth, counted
from all training documents.  A symbol's probability is that of the longest context seen
in training; a context that never saw the symbol gives an escape (method D: each distinct
symbol lends half a count to it) and hands over to the context one byte shorter, in which
the symbols of the longer one are excluded.  Below the empty context all symbols that
training lacks are equally likely.  A text ends with an end symbol, which also stands
before its first byte.  A-Z count as a-z.

Texts are worked on in blocks of some ``BLOCK_BYTES``.  A block sends out its distinct
grams and words only, packed into one row for each part of the code space; the totals and
probabilities come back to it part by part, so what moves grows with the corpus and no task
holds more than a block's share of the model.  There are twice as many parts as blocks, and
codes are spread over them by their bits, so no part is much larger than the others.

Words travel as 64-bit hashes.  Tables are deleted once what is made of them is written.
Beside the model stands a unigram score over words with one pseudo-count for each known word and
one for the unknown.

Defined results: a NULL text is empty, a text of only an end.  Documents without an id
train.  Repeated rows count and are scored each for itself.  An empty table gives no rows;
without training documents every symbol costs the same.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import drop, settle, slices

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ORDER = 5
#: Symbols are bytes and the end, 9 bits each.
END, BITS, SYMBOLS = 256, 9, 257
BLOCK_BYTES = 24 << 20
SLICE_BYTES = 4 << 20
#: Words are negative numbers, grams are not; this one is the end.
END_WORD = -1


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def raw(text: str | None) -> bytes:
    return text.encode().lower() if text else b""


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Every symbol with the ``order`` symbols before it as one number; where texts begin."""
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    line = np.full(int(sizes.sum()) + order * len(texts), END, dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    for k, text in enumerate(texts):
        at = starts[k] + order * (k + 1)
        line[at: at + len(text)] = np.frombuffer(text, dtype=np.uint8)
    code = np.zeros(len(line), dtype=np.int64)
    for back in range(order, -1, -1):
        code[order:] = (code[order:] << BITS) | line[order - back: len(line) - back]
    symbol = np.ones(len(line), dtype=bool)
    for k in range(order):
        symbol[starts + order * np.arange(len(texts)) + k] = False
    return code[symbol], starts


def word_codes(words: list[bytes]) -> np.ndarray:
    """Negative 64-bit hashes of words."""
    hashed = pd.util.hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, np.uint64)
    return np.minimum((hashed | np.uint64(1 << 63)).view(np.int64), END_WORD - 1)


def pack(numbers: np.ndarray) -> bytes:
    """Eight-byte numbers, compressed with like bytes together."""
    return zlib.compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack(packed: bytes, kind: type) -> np.ndarray:
    columns = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(columns.T).reshape(-1).view(kind)


def pack_codes(codes: np.ndarray) -> bytes:
    """Codes in ascending order."""
    return pack(np.diff(codes, prepend=np.int64(0)))


def unpack_codes(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, np.int64))


#: Shifts that spread the bits of a code over its part.
SPREAD = (17, 31)


def part_of(code: Column, parts: int) -> Column:
    mixed = code
    for by in SPREAD:
        mixed = mixed.bitwiseXOR(F.shiftrightunsigned(code, by))
    return F.pmod(mixed, F.lit(parts).cast("long"))


def parts_of(codes: np.ndarray, parts: int) -> np.ndarray:
    """The same for an array."""
    bits = codes.view(np.uint64)
    mixed = bits.copy()
    for by in SPREAD:
        mixed ^= bits >> np.uint64(by)
    return mixed.view(np.int64) % parts


def in_blocks(documents: DataFrame, block_bytes: int) -> DataFrame:
    """(block, doc_id, train, text): consecutive rows of a task in blocks of bounded size."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_pylist()
            blocks = []
            for size in sizes:
                if held and held + size > block_bytes:
                    block, held = block + 1, 0
                blocks.append(block)
                held += size + 16
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), *batch.columns], names=["block", "doc_id", "train", "text"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    chosen = documents.select("doc_id", (~held_out(F.col("doc_id"))).alias("train"), "text")
    return settle(chosen.mapInArrow(assign, f"block long, doc_id {kind}, train boolean, text string"), "lm-texts", "zstd")


def counts(texts: DataFrame, order: int, parts: int) -> DataFrame:
    """(block, part, codes, n): distinct grams and words of each block, n times in training."""
    def emit(block: int, found: list, words: dict[bytes, int], ends: int) -> Iterator[pa.RecordBatch]:
        codes, n = _merged(found)
        codes = np.concatenate([codes, word_codes(list(words)), [END_WORD]])
        n = np.concatenate([n, np.fromiter(words.values(), np.int64, len(words)), [ends]])
        part = parts_of(codes, parts)
        placed = np.lexsort((codes, part))
        codes, n, part = codes[placed], n[placed], part[placed]
        begins = np.flatnonzero(np.diff(part, prepend=-1))
        ends_at = [*begins[1:], len(part)]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(begins), block)), pa.array(part[begins]),
            pa.array([pack_codes(codes[a:b]) for a, b in zip(begins, ends_at, strict=True)], pa.binary()),
            pa.array([pack(n[a:b]) for a, b in zip(begins, ends_at, strict=True)], pa.binary()),
        ], names=["block", "part", "codes", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, found, words, ends = None, [], {}, 0
        for batch in batches:
            for run in slices(batch, 3, SLICE_BYTES):
                rows = zip(*(run.column(k).to_pylist() for k in (0, 2, 3)), strict=True)
                parts: dict[tuple[int, bool], list[bytes]] = {}
                for at, train, text in rows:
                    parts.setdefault((at, train), []).append(raw(text))
                for (at, train), chosen in sorted(parts.items()):
                    if at != block:
                        if block is not None:
                            yield from emit(block, found, words, ends)
                        block, found, words, ends = at, [], {}, 0
                    codes, n = np.unique(grams(chosen, order)[0], return_counts=True)
                    found.append((codes, n if train else np.zeros_like(n)))
                    if len(found) > 8:
                        found = [_merged(found)]
                    get = words.get
                    for text in chosen:
                        for word in WORD.findall(text):
                            words[word] = get(word, 0) + train
                    ends += train * len(chosen)
        if block is not None:
            yield from emit(block, found, words, ends)

    return settle(texts.mapInArrow(count, "block long, part long, codes binary, n binary"), "lm-counts")


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.concatenate([c for c, _ in found])
    n = np.concatenate([x for _, x in found])
    distinct, at = np.unique(codes, return_inverse=True)
    return distinct, np.bincount(at, weights=n, minlength=len(distinct)).astype(np.int64)


def totals(counted: DataFrame) -> DataFrame:
    """(code, n): every distinct gram and word, n times in training."""
    def add(rows: pa.Table) -> pa.Table:
        found = []
        for codes, n in zip(rows["codes"].to_pylist(), rows["n"].to_pylist(), strict=True):
            found.append((unpack_codes(codes), unpack(n, np.int64)))
        codes, n = _merged(found)
        return pa.table({"code": codes, "n": n})

    return settle(counted.groupBy("part").applyInArrow(add, "code long, n long"), "lm-totals")


def blocks_model(counted: DataFrame, values: DataFrame, parts: int) -> DataFrame:
    """(block, codes, values): what each block needs of ``values`` (code, value)."""
    def fill(key: tuple, rows: pa.Table, known: pa.Table) -> pa.Table:
        codes, value = known["code"].to_numpy(), known["value"].to_numpy()
        placed = np.argsort(codes)
        codes, value = codes[placed], value[placed]
        own = [pack(value[np.searchsorted(codes, unpack_codes(c))]) for c in rows["codes"].to_pylist()]
        return pa.table({"block": rows["block"], "codes": rows["codes"], "values": pa.array(own, pa.binary())})

    placed = values.withColumn("part", part_of(F.col("code"), parts))
    return counted.select("block", "part", "codes").groupBy("part").cogroup(placed.groupBy("part")).applyInArrow(
        fill, "block long, codes binary, values binary")


def levels(known: DataFrame, order: int) -> list[DataFrame]:
    """For each depth (gram, n, total, kinds, lent) of ``known`` (gram, n): a node of the trie and its context.

    ``total`` and ``kinds`` count the symbols seen in the gram's context, ``lent`` how
    often those symbols were seen in the context one byte shorter.
    """
    nodes = [None] * (order + 1)
    nodes[order] = known
    for depth in range(order - 1, -1, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << BITS * (depth + 1)) - 1))
        nodes[depth] = settle(nodes[depth + 1].groupBy(shorter.alias("gram")).agg(F.sum("n").alias("n")), f"lm-grams-{depth}")
    found = []
    for depth, grams_ in enumerate(nodes):
        seen = grams_.where("n > 0")
        if depth:
            shorter = F.col("gram").bitwiseAND(F.lit((1 << BITS * depth) - 1))
            below = nodes[depth - 1].select(F.col("gram").alias("shorter"), F.col("n").alias("n_below"))
            seen = seen.withColumn("shorter", shorter).join(below, "shorter")
        else:
            seen = seen.withColumn("n_below", F.lit(0))
        context = F.shiftright("gram", BITS)
        contexts = seen.groupBy(context.alias("context")).agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.sum("n_below").alias("lent"))
        contexts = settle(contexts, f"lm-contexts-{depth}")
        joined = grams_.withColumn("context", context).join(contexts, "context", "left")
        found.append(settle(joined.select("gram", "n", "total", "kinds", "lent"), f"lm-level-{depth}"))
        drop(contexts)
        if depth:
            drop(nodes[depth - 1])
    return found


def code_lengths(known: DataFrame, order: int) -> DataFrame:
    """(gram, log10p) for ``known`` (gram, n): probability of every gram's last symbol after the others."""
    tables = levels(known, order)
    done, left_over = [], []
    for depth in range(order, -1, -1):
        table = tables[depth].select(
            F.col("gram").alias("node"), "n", "total", F.col("kinds").alias("own"), F.col("lent").alias("own_lent"))
        mask = F.lit((1 << BITS * (depth + 1)) - 1)
        if depth == order:  # the nodes are the grams themselves
            at = table.select(F.col("node").alias("gram"), *[c for c in table.columns if c != "node"],
                              *[F.lit(0).cast(kind).alias(c) for c, kind in (
                                  ("log10p", "double"), ("lent", "long"), ("kinds", "long"))])
        else:
            at = pending.withColumn("node", F.col("gram").bitwiseAND(mask)).join(table, "node").drop("node")
        left = (F.col("total") - F.col("lent")).cast("double")  # counts of symbols not excluded
        new = F.col("own") - F.col("kinds")
        at = at.withColumn("left", left).withColumn("new", new)
        if depth < order:
            at = settle(at, f"lm-at-{depth}")
            drop(tables[depth])
        left_over.append(at)
        done.append(at.where("n > 0").select("gram", (F.col("log10p") + F.log10(
            (2 * F.col("n") - 1) / (2 * F.col("left")))).alias("log10p")))
        escape = F.when(F.col("new") > 0, F.log10(F.col("new") / (2 * F.col("left")))).otherwise(0.0)
        pending = at.where("n = 0").select(
            "gram", (F.col("log10p") + escape).alias("log10p"),
            F.coalesce("own_lent", "lent").alias("lent"), F.coalesce("own", "kinds").alias("kinds"))
    rest = F.log10(F.greatest(F.lit(SYMBOLS) - F.col("kinds"), F.lit(1)))
    done.append(pending.select("gram", (F.col("log10p") - rest).alias("log10p")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    out = settle(out, "lm-lengths")
    drop(tables[order], *left_over[1:])
    return out


def score(documents: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document with its unigram and its model score."""
    texts = in_blocks(documents, block_bytes)
    parts = 2 * texts.agg(F.count_distinct("block")).first()[0] + 1
    counted = counts(texts, order, parts)
    total = totals(counted)
    words = total.where("code < 0")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    n_train, distinct = sums
    lengths = code_lengths(total.where("code >= 0").select(F.col("code").alias("gram"), "n"), order)
    values = words.select("code", F.col("n").cast("double").alias("value")).unionByName(
        lengths.select(F.col("gram").alias("code"), F.col("log10p").alias("value")))
    model = blocks_model(counted, values, parts)

    def work(key: tuple, docs: pa.Table, known: pa.Table) -> pa.Table:
        codes = np.concatenate([unpack_codes(c) for c in known["codes"].to_pylist()])
        values = np.concatenate([unpack(v, np.float64) for v in known["values"].to_pylist()])
        _, once = np.unique(codes, return_index=True)  # two tasks may have counted a block
        codes, values = codes[once], values[once]
        index, lengths = pd.Index(codes[codes >= 0]), values[codes >= 0]
        counted_words, c = pd.Index(codes[codes < 0]), values[codes < 0]
        c_end = c[counted_words.get_indexer([END_WORD])[0]]
        end_log, end_known = float(np.log10(c_end + 1)), bool(c_end > 0)
        log: dict[bytes, float] = {}
        unknown: set[bytes] = set()

        def look_up(words: list[bytes]) -> None:
            own = c[counted_words.get_indexer(word_codes(words))]
            log.update(zip(words, np.log10(own + 1).tolist(), strict=True))
            unknown.update(words[k] for k in np.flatnonzero(own == 0))

        columns: dict[str, list] = {"n_tokens": [], "n_known": [], "log_counts": [], "score": [], "n_bytes": []}
        for batch in docs.select(["text"]).to_batches():
            for run in slices(batch, 0, SLICE_BYTES):
                chosen = [raw(t) for t in run.column(0).to_pylist()]
                codes, starts = grams(chosen, order)
                each = lengths[index.get_indexer(codes)]
                columns["score"].extend(np.add.reduceat(each, starts).tolist())
                split = [WORD.findall(text) for text in chosen]
                look_up(list({w for found in split for w in found if w not in log}))
                for text, found in zip(chosen, split, strict=True):
                    columns["n_tokens"].append(len(found) + 1)
                    columns["n_known"].append(len(found) + end_known - (sum(w in unknown for w in found) if unknown else 0))
                    columns["log_counts"].append(float(sum(map(log.__getitem__, found)) + end_log))
                    columns["n_bytes"].append(len(text))
        return pa.table({"doc_id": docs["doc_id"], "train": docs["train"], **columns})

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = texts.groupBy("block").cogroup(model.groupBy("block")).applyInArrow(
        work, f"doc_id {kind}, train boolean, n_tokens long, n_known long, log_counts double, score double, n_bytes long")
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.log10(F.lit(float(n_train + distinct + 1)))).alias("base_score"),
        "score", "n_bytes")
