import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tripmart.llm import dart_minhash as D
from tripmart.llm.components import components

SCHEMA = "doc_id long, text string, source string"


def counted(text):
    """How often every shingle of a text occurs."""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    return Counter(" ".join(found[k:k + 5]) for k in range(max(1, len(found) - 4))) if found else Counter()


def weighted(x, y):
    return (x & y).total() / max((x | y).total(), 1)


def brute_classes(rows):
    """Least id of every row's class, by comparing all pairs that share a shingle."""
    texts = sorted({t or "" for _, t in rows})
    sets = [counted(t) for t in texts]
    where = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            where[x].append(k)
    parent = list(range(len(texts)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j > k}:
            if weighted(s, sets[j]) >= 0.8:
                parent[root(j)] = root(k)
    at = {t: root(k) for k, t in enumerate(texts)}
    least = {}
    for i, t in rows:
        if i is not None:
            least[at[t or ""]] = min(i, least.get(at[t or ""], i))
    return sorted(((i, least.get(at[t or ""])) for i, t in rows), key=repr)


def found(df):
    return sorted(((r["doc_id"], r["class_id"]) for r in D.classes(df).collect()), key=repr)


def test_classes_equal_brute_force(spark, tables):
    rows = [(d["doc_id"], d["text"], d["source"]) for d in tables("documents")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute_classes([r[:2] for r in rows])


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def family(rng, center, n, edits):
    out = []
    for _ in range(n):
        copy = list(center)
        for _ in range(edits):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(5)
    center = words(rng, 300)
    texts = [" ".join(center), *family(rng, center, 12, 4), *family(rng, words(rng, 200), 6, 1)]
    texts += [None, "", "   ", "", "one", "one", "a b c d", "a b c d", "a b c d e"]
    texts += [" ".join(words(rng, 20000)), "same same " * 3000, "same same " * 2000]
    rows = [(k, t, "s") for k, t in enumerate(texts)]
    return rows + [rows[0], rows[0], (None, texts[0], None), (None, "alone without id", "t"), (None, "alone without id", "t")]


def test_hub_families_odd_texts_nulls_and_repeated_rows(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, SCHEMA)
    assert found(df) == brute_classes([r[:2] for r in odd_rows])


def test_deduplicate_keeps_one_row_of_each_class_and_all_columns(spark, odd_rows):
    extra = "doc_id long, text string, item string, root long, copies int"
    rows = [(i, t, s, 7, None) for i, t, s in odd_rows]
    kept = [tuple(r) for r in D.deduplicate(spark.createDataFrame(rows, extra)).collect()]
    classes = brute_classes([r[:2] for r in odd_rows])
    assert sorted(r[0] for r in kept if r[0] is not None) == sorted({c for _, c in classes if c is not None})
    assert [r for r in kept if r[0] is None] == [(None, "alone without id", "t", 7, None)]
    assert all(r in rows for r in kept)


def test_large_buckets_of_loose_copies_equal_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    center = words(rng, 150)
    texts = [t for edits in (1, 2, 3, 4, 5) for t in family(rng, center, 12, edits)]
    rows = [(k, t, "s") for k, t in enumerate(texts)]
    monkeypatch.setattr(D, "SMALL", 3)
    monkeypatch.setattr(D, "BLOCK_ITEMS", 8)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute_classes([r[:2] for r in rows])


def test_block_links_equal_pairs():
    rng = random.Random(2)
    texts = family(rng, words(rng, 120), 40, 2) + ["", "one", "one two", " ".join(words(rng, 50)), *(" ".join(["a b c"] * n) for n in (40, 44, 45, 60, 70))]
    first = np.arange(len(texts)) % 2 == 0
    sets = [counted(t) for t in texts]
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts))
            if first[i] != first[j] and weighted(sets[i], sets[j]) >= 0.8}
    assert {tuple(p) for p in D.links_between(texts, first, ~first, 0.8).tolist()} == want and want


def test_repeats_weigh_in_signatures_and_in_comparisons(spark):
    passage = " ".join(f"p{k}" for k in range(30))
    texts = [" ".join([passage] * n) for n in (1, 2, 3, 10, 11, 12, 40)]
    rows = [(k, t, "s") for k, t in enumerate(texts)]
    assert brute_classes([r[:2] for r in rows]) == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 3), (5, 3), (6, 6)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute_classes([r[:2] for r in rows])


def test_numbered_shingles_have_the_weighted_similarity():
    rng = random.Random(8)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(40))) for _ in range(60)]
    document, element = D.occurrences(*D.shingle_sets(texts))
    sets = [set(element[document == k].tolist()) for k in range(len(texts))]
    for k, x in enumerate(texts):
        for j, y in enumerate(texts[:k]):
            want = weighted(counted(x), counted(y))
            assert D.jaccard(D.shingles(x), D.shingles(y)) == pytest.approx(want)
            assert D.jaccard(frozenset(sets[k]), frozenset(sets[j])) == pytest.approx(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert D.classes(df).count() == 0 and D.deduplicate(df).columns == df.columns


def test_agreement_estimates_weighted_similarity():
    rng = np.random.default_rng(3)
    elements = rng.integers(0, 2**63, 400).astype(np.uint64)
    weights = rng.integers(1, 40, (2, 400))
    weights[1, :200] = weights[0, :200]
    doc = np.repeat([0, 1], 400)
    k = 2048
    sig = D.signatures(doc, np.tile(elements, 2), weights.reshape(-1), 2, k)
    true = np.minimum(*weights).sum() / np.maximum(*weights).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 4 * (true * (1 - true) / k) ** 0.5


def test_components_of_paths_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)} | {200: 200, 201: 200, 202: 200}


def test_comparisons_hold_little_memory(monkeypatch):
    """Long texts are taken from a batch a few at a time, and few of their shingles are kept."""
    import tracemalloc

    rng = random.Random(3)
    texts = [" ".join(words(rng, 5000)) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([b"a%d" % k for k in range(60)]), pa.array([b"b%d" % k for k in range(60)]), pa.array(texts),
         pa.array([t + " end" if k % 2 else "other" for k, t in enumerate(texts)])], names=["a", "b", "text_a", "text_b"])
    tracemalloc.start()
    kept = [x.as_py() for out in D.similar_pairs(iter([batch]), 0.8) for x in out.column(0)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert kept == [b"a%d" % k for k in range(1, 60, 2)]
    assert peak < 20e6  # all 90 texts' shingles take over 30 MB
