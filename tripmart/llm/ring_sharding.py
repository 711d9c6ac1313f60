"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every document is a key on a ring of ``cells_per_shard * shards`` cells.  Each shard owns
many virtual nodes on the ring; a cell goes to the first one clockwise whose shard still
has room, so a full shard's overflow continues clockwise.  Room is the mean load plus
``slack``, which holds for every shard as long as no cell outweighs the slack.

The load of a cell is a sum, aggregated on Spark.  The ring itself (one number per cell,
a bound that does not grow with the corpus) is walked on the driver and joined back.
Slots need no global sort: cells are laid out one after another within their shard, and
documents are ranked within their cell only.

The law kept is ``bytes``.  A small ``slack`` keeps shards nearly equal but moves more
keys when a shard is added; see ``movement`` in the tests.

Defined results: a NULL text counts as empty (size 8, CRC 0); a NULL id is a key like any
other.  Rows equal in id, size and CRC are interchangeable: they are counted, cut into
runs of at most ``RUN`` copies, and each run is a key of its own, so that a row repeated
without end still spreads over all shards.  An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from hashlib import blake2b

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import settle

SHARDS = 24
NODES_PER_SHARD = 64
CELLS_PER_SHARD = 2048
SLACK = 0.0005
#: Copies of one row that stay together, and runs made at once from one row.
RUN, RUNS_AT_ONCE = 16, 4096


def virtual_nodes(shards: int, nodes: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise."""
    def at(shard: int, node: int) -> int:
        mark = blake2b(f"{shard}/{node}".encode(), digest_size=8).digest()
        return int.from_bytes(mark, "big") * cells >> 64

    return sorted((at(s, n), s) for s in range(shards) for n in range(nodes))


def walk(loads: dict[int, int], shards: int, nodes: int, cells: int, slack: float) -> dict[int, int]:
    """The shard of every cell in ``loads``.

    Heavy cells choose first, so that light ones fill what is left.  A cell that no shard
    has room for goes to the lightest one; one that outweighs the mean is left out of it.
    """
    ring = virtual_nodes(shards, nodes, cells)
    places = [p for p, _ in ring]
    after: dict[int, list[int]] = {}
    held = [0] * shards
    heavy_first = sorted(loads.items(), key=lambda x: (-x[1], x[0]))
    rest, left = sum(loads.values()), shards
    for _, load in heavy_first:  # a cell above the mean has a shard of its own
        if left == 1 or load * left <= rest:
            break
        rest, left = rest - load, left - 1
    room = (1 + slack) * rest / left
    placed = {}
    for cell, load in heavy_first:
        first = bisect_left(places, cell) % len(ring)
        if first not in after:
            after[first] = list(dict.fromkeys(s for _, s in ring[first:] + ring[:first]))
        shard = next((s for s in after[first] if held[s] + load <= room), None)
        if shard is None:
            shard = min(after[first], key=lambda s: held[s])
        placed[cell] = shard
        held[shard] += load
    return placed


def keys(documents: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32) of every document with its number of copies."""
    text = F.coalesce("text", F.lit(""))
    return (
        documents.select("doc_id", (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
                         F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
        .groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    )


def _runs(items: DataFrame, cells: int) -> DataFrame:
    """Copies cut into runs, each with its cell."""
    batch = RUN * RUNS_AT_ONCE
    return (
        items.withColumn("batch", F.explode(F.expr(f"sequence(0L, (copies - 1) div {batch})")))
        .withColumn("copies", F.least(F.lit(batch), F.col("copies") - F.col("batch") * batch))
        .withColumn("run", F.explode(F.expr(f"sequence(0L, (copies - 1) div {RUN})")))
        .withColumn("copies", F.least(F.lit(RUN), F.col("copies") - F.col("run") * RUN))
        .withColumn("point", F.xxhash64("doc_id", "size", "text_crc32", "batch", "run"))
        .withColumn("cell", F.pmod("point", F.lit(cells)).cast("int"))
    )


def shard(documents: DataFrame, shards: int = SHARDS, nodes: int = NODES_PER_SHARD,
          cells_per_shard: int = CELLS_PER_SHARD, slack: float = SLACK) -> DataFrame:
    """Every document's shard and its gapless slot there."""
    spark = documents.sparkSession
    cells = shards * cells_per_shard
    runs = _runs(settle(keys(documents), "ring-keys"), cells)
    loads = runs.groupBy("cell").agg(
        F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows"))
    found = {r["cell"]: (r["bytes"], r["rows"]) for r in loads.collect()}  # one row per cell
    placed = walk({c: b for c, (b, _) in found.items()}, shards, nodes, cells, slack)
    filled = [0] * shards
    plan = []
    for cell, where in sorted(placed.items()):
        plan.append((cell, where, filled[where]))
        filled[where] += found[cell][1]
    ring = spark.createDataFrame(plan, "cell int, shard int, first long")
    earlier = (
        Window.partitionBy("cell").orderBy("point", "doc_id", "size", "text_crc32", "batch", "run")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        runs.join(F.broadcast(ring), "cell")  # at most ``cells`` rows
        .withColumn("first", F.col("first") + F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
        .withColumn("slot", F.explode(F.expr("sequence(first, first + copies - 1)")))
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                F.lit(None).cast("int").alias("grown_shard"))
    )
