import random

import numpy as np
import pytest

from tripmart.llm import compression_quality as X

SCHEMA, LABELS = "doc_id long, text string, `a.b` string, quality string", "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = X.digest(X.score(documents, X.train(documents, labels)))
    assert scored.count() == documents.count()
    seen = scored.join(labels, "doc_id").where("held_out").collect()
    poor = [r for r in seen if not r["quality"]]
    assert sum(r["predicted"] != r["quality"] for r in seen) <= 0.025 * len(seen)
    assert sum(r["predicted"] for r in poor) <= 0.1 * len(poor)
    # Calibrated: the mean score is near the share of good documents.
    assert abs(np.mean([r["score"] for r in seen]) - np.mean([r["quality"] for r in seen])) < 0.03


@pytest.fixture
def small():
    rng = random.Random(2)
    documents, labels = [], []
    for k in range(400):
        good = k % 4 != 0
        words = [f"{rng.choice('abcdef')}{rng.choice('ghij')}{rng.choice('klmn')}{'' if good else '%%#'}" for _ in range(120)]
        documents.append((k, " ".join(words), f"x{k}", "caller"))
        labels.append((k, int(good), None))
    return documents, labels


def score(spark, documents, labels):
    df = spark.createDataFrame(documents, SCHEMA)
    return X.score(df, X.train(df, spark.createDataFrame(labels, LABELS)))


def test_tells_kinds_apart_and_keeps_columns(spark, small):
    documents, labels = small
    documents = documents + [(900, None, None, None), (901, "", "", ""), (902, documents[1][1] * 20_000, "long", "q"),
                             (None, documents[0][1], "n", "n"), documents[1], documents[1]]
    labels = labels + [(1, 1, 1), (2, 0, 0), (900, 0, 0), (None, 1, 1), (5, None, 1), (6, 7, 1)]  # 2 is labelled both ways
    scored = score(spark, documents, labels)
    assert scored.columns == ["doc_id", "text", "a.b", "quality", "quality_score"]
    rows = scored.collect()
    assert sorted(tuple(r)[:4] for r in rows if r[0]) == sorted(d for d in documents if d[0])
    assert all((r["quality_score"]["score"] >= 0.7) == (r[0] % 4 != 0) for r in rows if r[0] is not None and r[0] < 400)
    by_id = {r[0]: r["quality_score"]["score"] for r in rows}
    assert by_id[900] == by_id[901] and by_id[902] > 0.7 and by_id[None] < 0.7
    assert all(0 <= s <= 1 for s in by_id.values())


def test_sizes_are_those_of_the_pieces(spark, small):
    documents, labels = small
    df = spark.createDataFrame(documents[:40] + [(500, "é日" * 3000, None, None)], SCHEMA)
    model = X.train(spark.createDataFrame(documents, SCHEMA), spark.createDataFrame(labels, LABELS))
    good, poor = X.compressor(model.good), X.compressor(model.poor)
    for r in X.score(df, model).collect():
        data = r["text"].encode()
        cut = [data[k:k + 1024] for k in range(0, len(data), 1024)]
        sizes = [sum(len(c.compress(p)) for p in cut) for c in (good, poor)]
        x = (sizes[1] - sizes[0]) / (len(data) + 20)
        assert r["quality_score"][1:] == (*sizes, x)
        assert abs(r["quality_score"]["score"] - 1 / (1 + np.exp(-(model.offset + model.slope * x)))) < 1e-9


def test_curve_is_the_best_one():
    rng = np.random.default_rng(1)
    x = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2.0 * x - 0.5)))).astype(float)
    slope, offset = X.curve(x, y)
    loss = lambda a, b: np.sum(np.log1p(np.exp(a * x + b)) - y * (a * x + b))
    assert all(loss(slope, offset) <= loss(slope + d, offset + e) + 1e-3 for d in (-.05, 0, .05) for e in (-.05, 0, .05))
    assert abs(slope - 2) < 0.2 and abs(offset + 0.5) < 0.2


def test_labels_of_one_kind_and_none(spark, small):
    documents, labels = small
    every = lambda labels: {r["quality_score"]["score"] for r in score(spark, documents[:20], labels).collect()}
    assert max(every([(k, 0, 0) for k in range(20)])) < 1e-6 and min(every([(k, 1, 0) for k in range(20)])) > 0.999
    assert max(every([])) < 1e-6
    assert len(score(spark, documents[:6], [(0, 0, 0), (1, 1, 0), (3, 1, 0)]).collect()) == 6
    assert score(spark, [], labels).collect() == []
