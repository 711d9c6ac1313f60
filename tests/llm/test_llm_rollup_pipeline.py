import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tripmart.llm import adaptive_quality, curriculum, dart_minhash, suffix_decontam
from tripmart.llm import token_rollup as T

CHANGES = "op string, doc_id long, source string, lang string, tokenizer string, tokens long, documents string"
DATA = "/root/testdata/sf0.001"


def totals(spark, store):
    return sorted((tuple(r) for r in T.totals(spark, store).collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    T.open_store(spark, str(tmp_path / "s"), buckets=16)
    return str(tmp_path / "s")


def put(spark, store, batch, rows):
    return T.commit(spark, store, batch, spark.createDataFrame([(*r, "own") for r in rows], CHANGES))


def test_signed_batches_equal_a_recount(spark, store):
    assert totals(spark, store) == []
    assert put(spark, store, "1", [("insert", 1, "a", "en", "v1", 10), ("insert", 2, "a", "en", "v1", 5), ("insert", 2, "a", "en", "v1", 5),
                                   ("insert", None, None, None, "v1", None), ("insert", 3, "b", "de", "v1", 7)])
    assert totals(spark, store) == sorted([("a", "en", "v1", 3, 20), ("b", "de", "v1", 1, 7), (None, None, "v1", 1, 0)], key=repr)
    second = [("revise", 1, "a", "en", "v2", 12), ("delete", 2, None, None, None, None), ("delete", 99, None, None, None, None),
              ("delete", None, None, None, None, None)]
    assert put(spark, store, "2", second)
    want = sorted([("a", "en", "v2", 1, 12), ("b", "de", "v1", 1, 7)], key=repr)
    assert totals(spark, store) == want
    assert not put(spark, store, "2", second) and not put(spark, store, "1", [("insert", 5, "c", "en", "v1", 1)])
    assert totals(spark, store) == want
    assert put(spark, store, "3", [])
    assert totals(spark, store) == want


def test_attempts_that_died_are_not_seen(spark, store):
    put(spark, store, "1", [("insert", 1, "a", "en", "v1", 10)])
    lost = spark.createDataFrame([("a", "en", "v1", 4, 400)], T.DELTA)
    lost.write.parquet(f"{store}/deltas/2-dead")  # written, never named in the commits
    assert totals(spark, store) == [("a", "en", "v1", 1, 10)]
    assert put(spark, store, "2", [("revise", 1, "a", "en", "v1", 11)])
    assert totals(spark, store) == [("a", "en", "v1", 1, 11)]


def test_two_batches_from_one_base_do_not_both_count(spark, store):
    put(spark, store, "1", [("insert", 1, "a", "en", "v1", 10)])
    def rows(n):
        return spark.createDataFrame([("revise", 1, "a", "en", "v1", n, "own")], CHANGES)
    one, two = (T.prepare(spark, store, b, rows(n)) for b, n in (("2", 20), ("3", 30)))
    assert T.publish(spark, store, one) and not T.publish(spark, store, two)
    assert totals(spark, store) == [("a", "en", "v1", 1, 20)]
    # Also when both were named before either saw the other: the chain has room for one.
    late = T.prepare(spark, store, "4", rows(40))
    assert T.publish(spark, store, T.prepare(spark, store, "5", rows(50)))
    T._append(spark, store, "batch", late.version, late.base, late.batch, late.attempt)
    assert totals(spark, store) == [("a", "en", "v1", 1, 50)]
    assert T.commit(spark, store, "3", rows(30)) and T.commit(spark, store, "4", rows(41))
    assert totals(spark, store) == [("a", "en", "v1", 1, 41)]
    assert not any(T.commit(spark, store, b, rows(9)) for b in ("1", "2", "3", "4", "5"))


def test_compaction_changes_nothing_and_remembers_batches(spark, store):
    T.compact(spark, store)
    put(spark, store, "1", [("insert", k, "a", "en", "v1", k) for k in range(50)] + [("insert", None, None, None, None, 3)])
    put(spark, store, "2", [("delete", k, None, None, None, None) for k in range(0, 50, 2)])
    before = totals(spark, store)
    T.compact(spark, store)
    at = T.chain(spark, store)
    assert at.batches == {} and len(at.folders) == 1 and totals(spark, store) == before == sorted(
        [("a", "en", "v1", 25, 625), (None, None, None, 1, 3)], key=repr)
    assert not put(spark, store, "2", [("delete", 1, None, None, None, None)])
    assert put(spark, store, "3", [("delete", 1, None, None, None, None), ("delete", None, None, None, None, None)])
    T.compact(spark, store)
    assert not put(spark, store, "1", []) and not put(spark, store, "3", [])
    assert totals(spark, store) == [("a", "en", "v1", 24, 624)]
    assert sorted(r["doc_id"] for r in T.state(spark, store).collect()) == list(range(3, 50, 2))


def test_a_small_batch_reads_a_small_share_of_the_ledger(spark, store):
    put(spark, store, "1", [("insert", k, "a", "en", "v1", 1) for k in range(2000)])
    at = T.chain(spark, store)
    small = T.checked(spark.createDataFrame([("revise", 7, "a", "en", "v1", 2, ""), ("insert", 5000, "a", "en", "v1", 2, "")], CHANGES))
    bucket = spark.range(7, 8).select(T.bucket_of(F.col("id"), at.buckets)).first()[0]
    plan = T.touched(spark, store, small, at)._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[isnotnull\(bucket#\d+\), \(bucket#\d+ = {bucket}\)\]", plan), plan
    assert len([f for f in os.listdir(f"{store}/ledger/{at.folders[0]}") if f.startswith("bucket=")]) == 16
    assert T.touched(spark, store, small.where("op = 'insert'"), at).inputFiles() == []


def test_unknown_changes_are_an_error(spark, store):
    with pytest.raises(Exception, match="unknown change"):
        put(spark, store, "1", [("drop", 1, "a", "en", "v1", 1)])
    assert totals(spark, store) == []


def test_pipeline_equals_its_stages_by_brute_force(spark, tables):
    """Each stage on the rows that the one before kept, and the shards hold exactly the mix."""
    from test_llm_dart_minhash import brute_classes

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    by_id = {d["doc_id"]: d for d in tables("documents")}
    kept = {r["doc_id"] for r in adaptive_quality.judge(docs, [docs["doc_id"]]).where("kept").collect()}
    good = docs.where(docs["doc_id"].isin(*kept))
    classes = brute_classes([(i, by_id[i]["text"]) for i in kept])
    assert {r["doc_id"] for r in dart_minhash.deduplicate(good).collect()} == {c for _, c in classes}
    single = good.where(docs["doc_id"].isin(*{c for _, c in classes}))
    items = [(b["item_id"], set(zip(*(suffix_decontam.words(b["text"])[k:] for k in range(10))))) for b in tables("benchmark")]
    def windows(t):
        w = suffix_decontam.words(t)
        return set(zip(*(w[k:] for k in range(10))))
    clean = {c for _, c in classes if not any(windows(by_id[c]["text"]) & spans for _, spans in items)}
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    assert {r["doc_id"] for r in suffix_decontam.decontaminate(single, bench).collect()} == clean
    mixed = curriculum.training_rows(single.where(docs["doc_id"].isin(*clean)))
    want = sorted((r["doc_id"], len(r["text"].encode()) + 8) for r in mixed.collect())
    assert sorted((r["doc_id"], r["size"]) for r in P.run(spark, DATA).collect()) == want


def test_stages_pass_on_the_columns_of_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, item binary, kept int, root string"
    rows = [(k, f"word{k} " + " ".join(f"x{k}y{j}" for j in range(30)), "en", "s", 1, None, 2, "r") for k in range(12)]
    rows += [(None, None, None, None, None, None, None, None), rows[0], (99, "", "en", "s", 0, None, 1, "r")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in P.STAGES:
            out = stage(spark, docs, DATA)
            assert out.columns == docs.columns or name == "sharding"
            docs = spark.createDataFrame(out.collect(), out.schema)
        assert bool(docs.count()) == bool(data)


def test_stages_may_be_chained_before_anything_is_written(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in P.STAGES[:3]:
        docs = stage(spark, docs, DATA)
    assert docs.count() > 0
