"""Sharding through a fixed number of virtual slots.

A record's key hashes to one of thousands of slots, for good. A small map says
which shard holds each slot; only that map changes when shards are added or
loads drift. Maps carry a version, and every edit makes a new one.

The map is laid out by the bytes in each slot, so the law that holds is
``bytes``: shards are near equal in size. Null key columns hash like any other
value, a null text has no bytes, a very long one is one record of its size,
equal rows share a slot and rows that tie in a slot are equal, an empty table
gives a map of empty slots, and other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiframe.llm.common import cut

#: Slots; the map and the loads have so many rows whatever the table's size.
SLOTS = 4096
#: Equal rows dealt out by one task at once.
BLOCK = 10_000


@dataclass(frozen=True)
class SlotMap:
    """``shard_of[slot]`` for every slot."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, self.shards, slot, shard) for slot, shard in enumerate(self.shard_of)]
        return spark.createDataFrame(rows, "version int, shards int, v_slot int, shard int")


def lay_out(loads: Sequence[int], shards: int) -> SlotMap:
    """The first map: slots by falling load, each to the shard with the least so far."""
    heap, shard_of = [(0, s) for s in range(shards)], [0] * len(loads)
    for slot in sorted(range(len(loads)), key=lambda k: (-loads[k], k)):
        total, shard = heapq.heappop(heap)
        shard_of[slot] = shard
        heapq.heappush(heap, (total + loads[slot], shard))
    return SlotMap(1, shards, tuple(shard_of))


def rebalance(old: SlotMap, loads: Sequence[int], shards: int | None = None, tolerance: float = 0.001) -> SlotMap:
    """An edited map for new loads or more shards, which moves only what it must.

    While some shard is over the mean by more than ``tolerance``, its largest
    slot that fits goes to the lightest shard. With one more shard and even
    loads, slots move only into the new shard.
    """
    shards = shards or old.shards
    if shards < old.shards:
        raise ValueError("shards can be added but not taken away")
    shard_of, totals, members = list(old.shard_of), [0] * shards, [[] for _ in range(shards)]
    for slot, shard in enumerate(shard_of):
        totals[shard] += loads[slot]
        members[shard].append((loads[slot], slot))
    for slots in members:
        slots.sort()
    mean = sum(totals) / shards
    for _ in range(len(shard_of)):
        heavy, light = max(range(shards), key=totals.__getitem__), min(range(shards), key=totals.__getitem__)
        if totals[heavy] <= mean * (1 + tolerance):
            break
        room = totals[heavy] - totals[light]
        fits = [m for m in members[heavy] if 0 < m[0] < room and m[0] <= max(totals[heavy] - mean, mean - totals[light])]
        if not fits:
            break
        load, slot = fits[-1]
        members[heavy].remove((load, slot))
        members[light].append((load, slot))
        members[light].sort()
        totals[heavy] -= load
        totals[light] += load
        shard_of[slot] = light
    return replace(old, version=old.version + 1, shards=shards, shard_of=tuple(shard_of))


def write_map(spark: SparkSession, slot_map: SlotMap, path: str) -> None:
    """Store a map beside its earlier versions; a version is never overwritten."""
    slot_map.frame(spark).coalesce(1).write.mode("error").parquet(f"{path}/map_version={slot_map.version}")


def newest_map(spark: SparkSession, path: str) -> SlotMap | None:
    """The newest map at ``path``, None if there is none."""
    try:
        return read_map(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """The given version, by default the newest."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.where(F.col("version") == version).select("v_slot", "shard", "shards").orderBy("v_slot").collect()
    shard_of = tuple(row.shard for row in rows)
    return SlotMap(version, rows[0].shards, shard_of)


def with_slots(rows: DataFrame, keys: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``rows`` with ``v_slot``, which the key columns alone decide."""
    return rows.withColumn("v_slot", F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int"))


def slot_loads(slotted: DataFrame, size_col: str, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of every slot; the result has as many rows as there are slots, no more."""
    sizes, counts = [0] * slots, [0] * slots
    for row in slotted.groupBy("v_slot").agg(F.sum(size_col).alias("size"), F.count("*").alias("n")).collect():
        sizes[row.v_slot], counts[row.v_slot] = row["size"], row.n
    return sizes, counts


def place(slotted: DataFrame, slot_map: SlotMap, counts: Sequence[int], order: Sequence[str]) -> DataFrame:
    """The columns ``order`` and ``v_slot`` of ``slotted`` with ``shard`` and ``slot``, a number in the shard that is gapless from 0.

    Rows equal in ``order`` are counted before they are shuffled and dealt out
    again in blocks, so a row that makes up much of the table burdens no task.
    Different rows are numbered inside their virtual slot, and each slot starts
    where its shard's earlier slots end. The map has one row for each virtual
    slot, so it can be broadcast at any size of the table.
    """
    starts, ends = [], [0] * slot_map.shards
    for v_slot, shard in enumerate(slot_map.shard_of):
        starts.append((v_slot, shard, ends[shard]))
        ends[shard] += counts[v_slot]
    offsets = slotted.sparkSession.createDataFrame(starts, "v_slot int, shard int, start long")
    earlier = Window.partitionBy("v_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = slotted.groupBy("v_slot", *order).agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / BLOCK))))
    dealt = blocks.repartition("v_slot", *order, "_block").withColumn("_first", F.col("_block") * BLOCK)
    rows = dealt.withColumn("_at", F.explode(F.sequence("_first", F.least(F.col("_first") + BLOCK, F.col("_n")) - 1)))
    placed = rows.join(F.broadcast(offsets), "v_slot").withColumn("slot", F.col("start") + F.col("_before") + F.col("_at"))
    return placed.select("v_slot", *order, "shard", "slot")


def shard_documents(docs: DataFrame, shards: int | Sequence[int], id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """One row for each document: id, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``v_slot``, ``shard``, ``slot``.

    With ``map_path``, the newest map stored there is rebalanced to the present
    loads, or a first one laid out; the new version is stored there, and rows are
    placed by what is read back. Several numbers of ``shards`` are versions that
    follow one another, the last of which places the rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    slotted = cut(with_slots(rows, (id_col, "text_crc32"), slots))
    sizes, counts = slot_loads(slotted, "size", slots)
    spark = docs.sparkSession
    slot_map = newest_map(spark, map_path) if map_path is not None else None
    for number in [shards] if isinstance(shards, int) else shards:
        slot_map = rebalance(slot_map, sizes, number) if slot_map else lay_out(sizes, number)
        if map_path is not None:
            write_map(spark, slot_map, map_path)
            slot_map = read_map(spark, map_path, slot_map.version)
    return place(slotted, slot_map, counts, (id_col, "text_crc32", "size")).withColumn("map_version", F.lit(slot_map.version))
