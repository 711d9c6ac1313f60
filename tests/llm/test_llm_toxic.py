import random

import pytest

from tripmart.llm import toxic_segments as X


def brute_segments(hits, drift):
    """Ruzzo and Tompa by definition: best segment first, then left and right of it."""
    if not hits:
        return []
    line = [-drift] * (hits[-1][0] + 1)
    for k, w in hits:
        line[k] = w
    def split(lo, hi):
        best = max(((sum(line[a:b]), -a, -(b)) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0))
        if best[0] <= 1e-12:
            return []
        a, b = -best[1], -best[2]
        return split(lo, a) + [(a, b - 1, best[0])] + split(b, hi)
    return split(0, len(line))


def test_segments_equal_the_definition():
    rng = random.Random(4)
    for _ in range(60):
        places = sorted(rng.sample(range(22), rng.randrange(1, 9)))
        hits = [(k, rng.choice([1.37, 2.11, 0.53, -1.19, -0.31])) for k in places]
        got = [(a, b, round(s, 6)) for a, b, s in X.maximal_segments(hits)]
        want = [(a, b, round(s, 6)) for a, b, s in brute_segments(hits, X.DRIFT)]
        assert got == want, hits


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = X.digest(X.find_segments(documents, X.train(documents, labels))).join(labels, "doc_id").where("held_out").collect()
    wrong = sum(r["predicted"] != r["toxic"] for r in scored)
    found = sum(r["predicted"] for r in scored if r["toxic"])
    assert wrong <= 0.08 * len(scored) and found >= 0.6 * sum(r["toxic"] for r in scored)


@pytest.fixture
def small(spark):
    rng = random.Random(9)
    word = lambda: f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}"
    rows, labels = [], []
    for k in range(300):
        text = [word() for _ in range(60)]
        if k % 4 == 0:
            text[10:10] = ["badword", "evilword"]
        rows.append((k, " ".join(text), "x", 0.5))
        labels.append((k, 1, int(k % 4 == 0)))
    return rows, labels


SCHEMA, LABELS = "doc_id long, text string, source string, score double", "doc_id long, quality int, toxic int"


def test_odd_rows_and_labels(spark, small):
    rows, labels = small
    rows = rows + [(900, None, "x", 0.1), (901, "", "x", 0.1), (None, "badword evilword", "x", 0.1), rows[0],
                   (902, "badword " * 50000, "x", 0.1)]
    labels = labels + [(None, 1, 1), (5, 1, 1), (7, None, None), labels[0]]
    documents, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    got = X.digest(X.find_segments(documents, X.train(documents, known))).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[902]["predicted"] == by_id[4]["predicted"] == 1 and by_id[None]["held_out"] is False
    assert by_id[900]["predicted"] == by_id[901]["predicted"] == by_id[1]["predicted"] == 0
    assert X.find_segments(documents, X.Model()).columns == ["doc_id", "text", "source", "score", "toxic"]


def test_no_labels_and_no_documents(spark, small):
    documents = spark.createDataFrame(small[0][:3], SCHEMA)
    none = spark.createDataFrame([], LABELS)
    assert X.digest(X.find_segments(documents, X.train(documents, none))).where("predicted = 0").count() == 3
    empty = spark.createDataFrame([], SCHEMA)
    assert X.find_segments(empty, X.train(empty, none)).count() == 0


def test_no_neutral_token_takes_the_weight_of_its_beginning(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    neutral = [f"zoxi{a}{b}{c}{d}" for a in letters for b in letters for c in letters for d in "abcd"][:20_500]
    rows = [(" ".join(neutral) + f" {end}", toxic) for toxic in (0, 1) for end in "xyz"]
    rows += [(f"zoxi{letters[k % 26]}{letters[k // 26]} rare", 1) for k in range(400)]
    rows += [(f"plain {letters[k % 26]}{letters[k // 26]}", 0) for k in range(400)]
    weights = X.token_weights(spark.createDataFrame(rows, "text string, toxic int"))
    assert weights["zoxi*"] > 0 and all(weights.get(t) == 0.0 for t in neutral)
