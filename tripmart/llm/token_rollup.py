"""Token counts kept by deltas: totals by source, language and tokenizer version.

A store is a folder.  A batch of changes becomes signed rows (+ for what is added, - for
what is taken away), which are written twice: by document (the ledger, from which later
batches learn what they replace) and summed by source, language and tokenizer (the delta).
Both go to a folder of their own attempt; a last small append to ``commits`` names it and
the commit that it was computed from, its base.  Commits form a chain: of several with one
base only the first counts, so two batches that saw the same state never both count; the
other one is computed again from the new state.  A batch that dies halfway leaves nothing
visible, and one committed again changes nothing.

The ledger lies in buckets of the document id.  A batch reads the buckets of the ids that it
takes away and no others; one that only inserts reads none.  ``compact`` sums the chain up
to now, so that readers open one folder and the later ones.  The driver sees numbers of
buckets and a short row for each batch since the last compaction.

Changes have an ``op``: ``insert`` adds a row; ``delete`` takes away all rows of the id;
``revise`` takes them away and adds the new row.  A batch's own rows do not see each other:
deletes and revisions refer to what earlier batches left.  An id deleted and revised in one
batch is revised.

Defined results: NULL ids, sources, languages and versions are keys like any other; a NULL
count adds a document without tokens; an unknown ``op`` is an error; taking away an unknown
id does nothing.  Repeated inserts add up.  Groups whose documents and tokens are both 0
do not show.  Totals of an empty store are empty.  NULL, empty and very long texts have the
tokens that the tokenizer finds in the whole text.  Extra columns of changes are not read.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
LEDGER = "doc_id long, source string, lang string, tokenizer string, documents long, tokens long"
DELTA = "source string, lang string, tokenizer string, documents long, tokens long"
COMMITS = "kind string, version long, base string, batch string, attempt string, buckets int, at timestamp"
#: Buckets of a new store's ledger (up to 32 folders are listed without a job); more, where batches are small beside it.
BUCKETS = 32

# Two versions of a tokenizer; the second one parts ASCII punctuation off.
TOKENIZERS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "words-2": r"[^\x20\x09-\x0D!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]",
}


def token_count(text: Column, tokenizer: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKENIZERS[tokenizer])), F.lit(0)).cast("long")


class Chain(NamedTuple):
    """What counts: folders to read, their batches since ``snapshot``, and where the next one goes."""

    snapshot: str | None
    batches: dict[str, str]
    tip: str
    version: int
    buckets: int

    @property
    def folders(self) -> list[str]:
        return [self.snapshot] * (self.snapshot is not None) + list(self.batches.values())


class Prepared(NamedTuple):
    """An attempt that is written but does not count yet."""

    batch: str
    attempt: str
    base: str
    version: int


def _append(spark: SparkSession, store: str, kind: str, version: int, base: str, batch: str | None,
            attempt: str, buckets: int | None = None) -> None:
    row = spark.createDataFrame([(kind, version, base, batch, attempt, buckets)], COMMITS.rsplit(",", 1)[0])
    row.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{store}/commits")


def open_store(spark: SparkSession, store: str, buckets: int = BUCKETS) -> None:
    """Begin a store; one that was begun before stays as it is."""
    _append(spark, store, "open", 0, "", None, "open", buckets)


def chain(spark: SparkSession, store: str) -> Chain:
    """The commits that count, from the last compaction on."""
    rows = spark.read.schema(COMMITS).parquet(f"{store}/commits")
    ends = rows.agg(
        F.min(F.when(F.col("kind") == "open", F.struct("at", "buckets"))).alias("first"),
        F.max(F.when(F.col("kind") == "snapshot", F.struct("version", "at", "attempt", "base"))).alias("last")).first()
    buckets, found = ends["first"]["buckets"], ends["last"]
    snapshot, version, tip = (found["attempt"], found["version"], found["base"]) if found else (None, 0, "open")
    recent = rows.where((F.col("kind") == "batch") & (F.col("version") > version)).groupBy("base").agg(
        F.min(F.struct("at", "attempt", "batch")).alias("first"))
    after = {r["base"]: r["first"] for r in recent.collect()}  # one short row for each batch
    batches: dict[str, str] = {}
    while tip in after:
        batches[after[tip]["batch"]] = tip = after[tip]["attempt"]
        version += 1
    return Chain(snapshot, batches, tip, version, buckets)


def _read(spark: SparkSession, store: str, what: str, schema: str, folders: list[str]) -> DataFrame:
    found = None
    for folder in folders:
        rows = spark.read.schema(schema).parquet(f"{store}/{what}/{folder}")
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], schema) if found is None else found


def bucket_of(doc_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(buckets)).cast("int")


def _summed(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum("documents").cast("long").alias("documents"),
                                 F.sum("tokens").cast("long").alias("tokens"))


def _write(spark: SparkSession, store: str, attempt: str, rows: DataFrame, buckets: int) -> None:
    """The ledger's rows in buckets, large ones over many tasks, and their delta."""
    placed = rows.withColumn("bucket", bucket_of(F.col("doc_id"), buckets)).hint("rebalance", "bucket")
    placed.write.partitionBy("bucket").parquet(f"{store}/ledger/{attempt}")
    written = spark.read.schema(LEDGER).parquet(f"{store}/ledger/{attempt}")
    _summed(written, *KEYS).write.parquet(f"{store}/deltas/{attempt}")


def state(spark: SparkSession, store: str) -> DataFrame:
    """What the committed batches left of every document."""
    ledger = _read(spark, store, "ledger", LEDGER, chain(spark, store).folders)
    return _summed(ledger, "doc_id", *KEYS).where("documents <> 0 OR tokens <> 0")


def checked(changes: DataFrame) -> DataFrame:
    """``changes`` (op, doc_id, source, lang, tokenizer, tokens) with known kinds of change only."""
    known = F.col("op").isin("insert", "delete", "revise")
    op = F.when(known, F.col("op")).otherwise(
        F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("NULL")))).cast("string"))
    return changes.select(op.alias("op"), F.col("doc_id").cast("long").alias("doc_id"), *KEYS,
                          F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))


def touched(spark: SparkSession, store: str, changes: DataFrame, at: Chain) -> DataFrame:
    """Ledger rows of the documents that ``changes`` take away, from their buckets alone."""
    gone = changes.where("op <> 'insert'").select(F.col("doc_id").alias("gone")).distinct()
    buckets = [r[0] for r in gone.select(bucket_of(F.col("gone"), at.buckets)).distinct().collect()]  # ``at.buckets`` at most
    if not buckets:
        return spark.createDataFrame([], LEDGER)
    ledger = _read(spark, store, "ledger", LEDGER + ", bucket int", at.folders)
    return ledger.where(F.col("bucket").isin(buckets)).drop("bucket").join(
        gone, F.col("doc_id").eqNullSafe(F.col("gone")), "left_semi")


def signed(changes: DataFrame, before: DataFrame) -> DataFrame:
    """Signed ledger rows of ``changes``, where ``before`` has the rows of what they take away."""
    added = changes.where("op <> 'delete'").select("doc_id", *KEYS, F.lit(1).cast("long").alias("documents"), "tokens")
    taken = before.select("doc_id", *KEYS, (-F.col("documents")).alias("documents"), (-F.col("tokens")).alias("tokens"))
    return _summed(added.unionByName(taken), "doc_id", *KEYS).where("documents <> 0 OR tokens <> 0")


def is_committed(spark: SparkSession, store: str, batch: str, at: Chain) -> bool:
    if batch in at.batches:
        return True
    if at.snapshot is None:
        return False
    names = spark.read.schema("batch string").parquet(f"{store}/batches/{at.snapshot}")
    return bool(names.where(F.col("batch") == batch).limit(1).count())


def prepare(spark: SparkSession, store: str, batch: str, changes: DataFrame) -> Prepared | None:
    """Write the attempt of a batch against what counts now; None if the batch counts already."""
    at = chain(spark, store)
    if is_committed(spark, store, batch, at):
        return None
    attempt = f"{batch}-{uuid.uuid4().hex}"
    known = checked(changes)
    _write(spark, store, attempt, signed(known, touched(spark, store, known, at)), at.buckets)
    return Prepared(batch, attempt, at.tip, at.version + 1)


def publish(spark: SparkSession, store: str, prepared: Prepared) -> bool:
    """Make an attempt count; False, and nothing changes, if another commit took its place."""
    if chain(spark, store).tip != prepared.base:
        return False
    _append(spark, store, "batch", prepared.version, prepared.base, prepared.batch, prepared.attempt)
    return prepared.attempt in chain(spark, store).batches.values()


def commit(spark: SparkSession, store: str, batch: str, changes: DataFrame) -> bool:
    """Apply a batch once, again and again until no other commit comes between; False if it counts already."""
    while (prepared := prepare(spark, store, batch, changes)) is not None:
        if publish(spark, store, prepared):
            return True
    return False


def compact(spark: SparkSession, store: str) -> None:
    """Sum what counts now into one folder; to be called while no commit is under way.

    Earlier folders stay until someone deletes them, since readers may still be at them.
    """
    at = chain(spark, store)
    if not at.batches:
        return
    attempt = f"snapshot-{uuid.uuid4().hex}"
    _write(spark, store, attempt, state(spark, store), at.buckets)
    names = spark.createDataFrame([(b,) for b in at.batches], "batch string")
    if at.snapshot is not None:
        names = names.unionByName(spark.read.schema("batch string").parquet(f"{store}/batches/{at.snapshot}"))
    names.write.parquet(f"{store}/batches/{attempt}")
    _append(spark, store, "snapshot", at.version, at.tip, None, attempt)


def totals(spark: SparkSession, store: str) -> DataFrame:
    """Documents and tokens by source, language and tokenizer, from the deltas alone."""
    deltas = _read(spark, store, "deltas", DELTA, chain(spark, store).folders)
    return _summed(deltas, *KEYS).where("documents <> 0 OR tokens <> 0")
