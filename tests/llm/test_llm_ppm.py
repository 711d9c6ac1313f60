import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tripmart.llm import ppm_score as S

SCHEMA = "doc_id long, text string, score string, block int"


def brute(rows, order):
    """Scores by a dictionary of contexts, symbol by symbol."""
    trains = [i is None or zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    lines = [[*((t or "").encode().lower()), S.END] for _, t in rows]
    tree = defaultdict(Counter)
    words = Counter()
    tokens = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [None] for _, t in rows]
    for train, line, found in zip(trains, lines, tokens):
        if train:
            words.update(found)
            past = [S.END] * order + line
            for k in range(order, len(past)):
                for depth in range(order + 1):
                    tree[tuple(past[k - depth:k])][past[k]] += 1
    n, v = sum(words.values()), len(words)
    out = []
    for (i, _), train, line, found in zip(rows, trains, lines, tokens):
        score, past = 0.0, [S.END] * order + line
        for k in range(order, len(past)):
            excluded = set()
            for depth in range(order, -1, -1):
                seen = {s: c for s, c in tree.get(tuple(past[k - depth:k]), {}).items() if s not in excluded}
                if past[k] in seen:
                    score += math.log10((2 * seen[past[k]] - 1) / (2 * sum(seen.values())))
                    break
                if seen:
                    score += math.log10(len(seen) / (2 * sum(seen.values())))
                excluded |= seen.keys()
            else:
                score -= math.log10(max(1, S.SYMBOLS - len(excluded)))
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in found)
        out.append((i, not train, len(found), sum(words[w] > 0 for w in found), n, round(base, 6), round(score, 6)))
    return sorted(out, key=repr)


def found(df, **options):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6),
                    round(r["score"], 6)) for r in S.score(df, **options).collect()), key=repr)


@pytest.mark.parametrize("order, block", [(2, 1 << 20), (5, 3000)])
def test_scores_equal_brute_force(spark, tables, order, block):
    rows = [(d["doc_id"], d["text"][:400]) for d in tables("documents")[:40]]
    rows += [(900, None), (901, ""), (902, "É\x00\x0b x"), (None, "no id"), (None, "no id"), (1, rows[1][1]), (903, "ab " * 4000)]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], SCHEMA)
    assert found(df, order=order, block_bytes=block) == brute(rows, order)


def test_empty_table_and_no_training_rows(spark):
    assert S.score(spark.createDataFrame([], SCHEMA)).count() == 0
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    (row,) = S.score(spark.createDataFrame([(held, "abc", "s", 1)], SCHEMA)).collect()
    assert row["score"] == pytest.approx(-4 * math.log10(S.SYMBOLS)) and row["n_known"] == 0


def test_probabilities_of_a_context_sum_to_one_at_most(spark):
    rows = [(10, "abracadabra"), (11, "abrac"), (13, "bra")]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], SCHEMA)
    held = [k for k in range(10_000) if zlib.crc32(str(k).encode()) % 7 == 2][:128]
    probe = df.unionByName(spark.createDataFrame([(i, "abra" + chr(32 + k % 94), "s", 1) for k, i in enumerate(held[:94])], SCHEMA))
    scores = {r["doc_id"]: r["score"] for r in S.score(probe, order=3).collect()}
    assert sum(10 ** scores[i] for i in held[:94] if i not in (10, 11, 13)) <= 1.0


def test_contexts_have_five_bytes(spark, tables):
    rows = [(d["doc_id"], d["text"][:300]) for d in tables("documents")[:20]]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], SCHEMA)
    assert found(df) == brute(rows, 5)


def test_packed_numbers_come_back():
    codes = np.unique(np.array([-(1 << 63), -5, -1, 0, 7, 1 << 53, (1 << 54) - 1]))
    assert S.unpack_codes(S.pack_codes(codes)).tolist() == codes.tolist()
    values = np.array([-0.1, float("-inf"), 3.0])
    assert S.unpack(S.pack(values), np.float64).tolist() == values.tolist()
