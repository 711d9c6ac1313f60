import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm import curriculum as C
from tripmart.llm import ring_sharding as R

SCHEMA = "doc_id long, text string, source string, size string, shard string, copies long"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, "word " * (k % 40), f"s{k % 5}") for k in range(400)]
    rows += [(1000, "same", "s1")] * 700  # one row repeated: a third of all
    rows += [(None, None, None), (None, "", None), (1001, None, "s2"), (1002, "long " * 30000, "s3"), (1, "other text", "s1")]
    return spark.createDataFrame([(*r, "mine", "own", 9) for r in rows], SCHEMA)


def test_shards_are_balanced_gapless_and_repeatable(odd):
    got = [tuple(r) for r in R.shard(odd, shards=6).collect()]
    assert len(got) == odd.count() and sorted(got, key=repr) == sorted((tuple(r) for r in R.shard(odd.repartition(5), shards=6).collect()), key=repr)
    slots, loads = defaultdict(list), Counter()
    for _, size, _, law, shard, slot, grown in got:
        slots[shard].append(slot)
        loads[shard] += size
        assert law == "bytes" and grown is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    whole = sorted(loads.values())[:-1]  # one text alone outweighs a shard
    assert max(whole) <= 1.1 * min(whole)
    assert sorted(Counter(r[:3] for r in got).items(), key=repr) == sorted(
        ((tuple(r)[:3], r["copies"]) for r in R.keys(odd).collect()), key=repr)


def by_hand(rows, shards):
    """(doc_id, size, crc, shard, slot) by walking the ring node by node; rows differ in id."""
    cells = shards * R.CELLS_PER_SHARD
    owner = sorted((int.from_bytes(hashlib.blake2b(b"%d/%d" % (s, k), digest_size=8).digest(), "big") * cells // 2**64, s)
                   for s in range(shards) for k in range(R.NODES_PER_SHARD))
    members = defaultdict(list)
    for doc_id, text in rows:
        raw = (text or "").encode()
        key = (doc_id, len(raw) + 8, zlib.crc32(raw), 0, 0)
        point = 42
        for value in key:
            if value is not None:
                point = xxhash.xxh64_intdigest(struct.pack("<q", value), seed=point)
        members[point % cells if point < 2**63 else (point - 2**64) % cells].append((point - 2**64 * (point >= 2**63), *key[:3]))
    loads = {cell: sum(m[2] for m in inside) for cell, inside in members.items()}
    order = sorted(loads, key=lambda cell: (-loads[cell], cell))
    rest, left = sum(loads.values()), shards
    for cell in order:
        if left > 1 and loads[cell] * left > rest:
            rest, left = rest - loads[cell], left - 1
        else:
            break
    held, shard_of = [0] * shards, {}
    for cell in order:
        clockwise = [s for at, s in owner if at >= cell] + [s for at, s in owner if at < cell]
        free = [s for s in clockwise if held[s] + loads[cell] <= (1 + R.SLACK) * rest / left]
        shard_of[cell] = free[0] if free else min(clockwise, key=held.__getitem__)
        held[shard_of[cell]] += loads[cell]
    filled, out = [0] * shards, []
    for cell in sorted(members):
        for _, doc_id, size, crc in sorted(members[cell]):
            out.append((doc_id, size, crc, shard_of[cell], filled[shard_of[cell]]))
            filled[shard_of[cell]] += 1
    return out


def test_shards_equal_a_walk_by_hand(spark, tables):
    rows = [(d["doc_id"], d["text"]) for d in tables("documents")]
    rows += [(-1, None), (None, "without id"), (-2, "long " * 40000), (-3, "é\U0001F600")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for shards in (5, 24):
        got = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in R.shard(df, shards=shards).collect()]
        assert sorted(got, key=repr) == sorted(by_hand(rows, shards), key=repr)


def test_walk_bounds_loads_and_moves_little():
    loads = {k: 100 + k * 7919 % 60 for k in range(12_000)}
    one, two = (R.walk(loads, n, 64, 12_000, R.SLACK) for n in (24, 25))
    held = Counter()
    for cell, shard in one.items():
        held[shard] += loads[cell]
    mean = sum(loads.values()) / 24
    assert set(one) == set(loads) and max(held.values()) <= mean * (1 + R.SLACK) + max(loads.values()) and min(held.values()) >= 0.98 * mean
    moved = sum(loads[c] for c in loads if one[c] != two[c]) / sum(loads.values())
    assert 1 / 25 <= moved < 0.2


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert R.shard(empty).count() == C.mix(empty).count() == C.training_rows(empty).count() == 0
    zero = spark.createDataFrame([(1, None, "a", "", "", 1), (2, "", None, "", "", 1)], SCHEMA)
    assert [(r["size"], r["target"], r["taken"]) for r in C.digest(C.mix(zero)).collect()] == [(0, 0.0, 0)] * 2


def test_mix_meets_targets_without_exceeding(odd):
    rows = C.digest(C.mix(odd)).collect()
    assert len(rows) == odd.count()
    taken, sizes, target = Counter(), {}, {}
    documents = odd.select(C.word_count(F.col("text")).alias("n"), "source").collect()
    own = Counter()
    for r in documents:
        own[r["source"]] += r["n"]
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        target[r["source_size"]] = r["target"]
        sizes[r["source_size"]] = taken[r["source_size"]] = taken[r["source_size"]] + r["taken"]
    for size in target:
        assert abs(taken[size] - target[size]) <= 1 and target[size] <= 2 * size
    assert set(target) == set(own.values())
    assert sum(target.values()) == pytest.approx(1.5 * sum(own.values()))


def test_positions_follow_the_schedules(spark):
    df = spark.createDataFrame([(k, "w " * 10, s, "", "", 1) for s in "abc" for k in range(ord(s) * 1000, ord(s) * 1000 + 300)], SCHEMA)
    takes = C.mix(df).select("source", F.explode("takes").alias("t")).select("source", "t.position", "t.words").collect()
    assert all(0 <= t["position"] <= 1 for t in takes)
    early = {s: sum(t["words"] for t in takes if t["source"] == s and t["position"] < 0.5) /
             sum(t["words"] for t in takes if t["source"] == s) for s in "abc"}
    # Areas of the three schedules below one half: 0.625, 0.5, 0.375.
    assert early["a"] == pytest.approx(0.625, abs=0.02) and early["b"] == pytest.approx(0.5, abs=0.02)
    assert early["c"] == pytest.approx(0.375, abs=0.02)


def test_training_rows_take_whole_rows_in_order(odd):
    got = C.training_rows(odd)
    assert got.columns == odd.columns
    plan = Counter()
    for r in C.mix(odd).collect():
        for t in r["takes"]:
            plan[r["doc_id"], r["size"]] += t["words"] * 2 >= r["size"]
    rows = got.withColumn("n", C.word_count(F.col("text"))).collect()
    assert Counter((r["doc_id"], r["n"]) for r in rows) == +plan


def test_shards_equal_a_walk_by_hand(spark):
    """Sizes, CRC-32, the clockwise walk and the slots, each by plain Python."""
    rows = [(k, "é" * (k % 90) + str(k), "s", "", "", 1) for k in range(500)] + [(9000, None, "s", "", "", 1)]
    shards, nodes, cells = 5, 7, 40
    got = R.shard(spark.createDataFrame(rows, SCHEMA), shards, nodes, cells, 0.05).collect()
    plain = {k: ((t or "").encode(), len((t or "").encode()) + 8) for k, t, *_ in rows}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == {
        (k, size, zlib.crc32(data)) for k, (data, size) in plain.items()}
    points = {r["doc_id"]: r["cell"] for r in R._runs(R.keys(spark.createDataFrame(rows, SCHEMA)), shards * cells).collect()}
    load = Counter()
    for k, cell in points.items():
        load[cell] += plain[k][1]
    ring = sorted((int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big") * shards * cells >> 64, s)
                  for s in range(shards) for v in range(nodes))
    room, held, where = 1.05 * sum(load.values()) / shards, Counter(), {}
    assert max(load.values()) * shards < sum(load.values())
    for cell in sorted(load, key=lambda c: (-load[c], c)):
        clockwise = [s for at, s in ring if at >= cell] + [s for at, s in ring if at < cell]
        fits = [s for s in clockwise if held[s] + load[cell] <= room]
        where[cell] = fits[0] if fits else min(dict.fromkeys(clockwise), key=lambda s: held[s])
        held[where[cell]] += load[cell]
    assert {r["doc_id"]: r["shard"] for r in got} == {k: where[c] for k, c in points.items()}
    for shard in range(shards):
        own = [r["slot"] for r in got if r["shard"] == shard]
        assert sorted(own) == list(range(len(own)))


def test_names_of_the_caller_never_clash(spark):
    from tripmart.llm import adaptive_quality, dart_minhash, suffix_decontam

    odd = ["a.b", "`q`", "__words", "__part", "__copy", "copies", "words", "matches", "__size"]
    schema = T.StructType([T.StructField(n, T.StringType() if n != "doc_id" else T.LongType())
                           for n in ("doc_id", "text", "lang", "source", *odd)])
    rows = [(k, " ".join(f"x{k}y{j}" for j in range(40)), "en", "s", *[f"{n}{k}" for n in odd]) for k in range(9)]
    df = spark.createDataFrame(rows, schema)
    items = spark.createDataFrame([(1, "nothing of that")], "item_id long, text string")
    for run in (adaptive_quality.keep_good, dart_minhash.deduplicate, lambda d: suffix_decontam.decontaminate(d, items),
                C.training_rows):
        out = run(df)
        assert out.columns == df.columns and {tuple(r) for r in out.collect()} <= set(rows) and out.count() >= 9


def test_sequence_is_the_mix_in_training_order(odd):
    mixed = C.mix(odd)
    ordered = C.sequence(mixed)
    got = sorted(ordered.collect(), key=lambda r: r["place"])
    taken = [r for r in got if r["take"]]
    assert [r["place"] for r in got] == list(range(len(got))) and not any(r["take"] for r in got[len(taken):])
    at = [r["take"]["position"] for r in taken]
    assert at == sorted(at) and len(at) == sum(len(r["takes"]) for r in mixed.collect())
    rows = lambda df: sorted(map(tuple, C.digest(df).collect()), key=repr)
    assert rows(C.gathered(ordered)) == rows(mixed)


def test_query_goes_through_the_training_order(spark, tmp_path, monkeypatch):
    from tripmart.llm import queries as Q

    df = spark.createDataFrame([(k, "w " * (k % 7), f"s{k % 3}") for k in range(60)], "doc_id long, text string, source string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    seen, real = [], C.sequence
    monkeypatch.setattr(C, "sequence", lambda mixed: seen.append(real(mixed)) or seen[-1])
    out = Q.op9_curriculum(spark, str(tmp_path))
    assert out.count() == 60 and len(seen) == 1
    words = seen[0].agg(F.sum("take.words")).first()[0]
    assert words == out.agg(F.sum("taken")).first()[0] > 0
