"""Sharding by fixed virtual slots: records hash to slots, a stored map sends slots to shards.

Only DataFrame operations.  The number of slots never changes, so a new number of shards edits
the map and moves whole slots; no record is hashed anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Slots in every map.  A map is one row per slot, so its size is fixed whatever the data.
SLOTS = 4096
MOST_SLOTS = 1 << 16


def record_size(text: Column | str) -> Column:
    """UTF-8 bytes of a text plus 1; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def slot_of(keys: list[str], slots: int = SLOTS) -> Column:
    """The virtual slot of a record; nulls take part in the hash."""
    if not 0 < slots <= MOST_SLOTS:
        raise ValueError(f"slots must be 1 to {MOST_SLOTS}")
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def slot_loads(slotted: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(slot, rows, bytes) of every slot, from ``slotted(slot, size)``; empty slots have zeros."""
    sums = slotted.groupBy("slot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
    every = slotted.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"))
    filled = every.join(sums, "slot", "left")
    return filled.select("slot", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("bytes", F.lit(0)).alias("bytes"))


def _deal(gathered: DataFrame) -> DataFrame:
    """(slot, shard): each of ``items`` to the shard of the fewest bytes so far, the heaviest first.

    ``gathered`` is one row: ``load``, the bytes each shard has already, and ``items``, a struct of
    ``minus`` (bytes below zero) and ``slot`` for each slot to deal, of which ``MOST_SLOTS`` bounds the number.
    """
    begin = F.struct("load", F.array().cast("array<int>").alias("picks"))

    def step(state, item):
        pick = F.array_position(state["load"], F.array_min(state["load"])) - 1
        grown = F.transform(state["load"], lambda x, i: F.when(i == pick, x - item["minus"]).otherwise(x))
        return F.struct(grown.alias("load"), F.array_append(state["picks"], pick.cast("int")).alias("picks"))

    dealt = gathered.withColumn("items", F.array_sort("items"))
    dealt = dealt.withColumn("picks", F.aggregate("items", begin, step)["picks"])
    pairs = dealt.select(F.explode(F.arrays_zip("items", "picks")).alias("p"))
    return pairs.select(F.col("p.items.slot").alias("slot"), F.col("p.picks").alias("shard"))


def first_map(loads: DataFrame, shards: int) -> DataFrame:
    """(version, slot, shard): version 1, shards of near equal bytes.

    No two shards differ by more bytes than the heaviest slot has.
    """
    items = F.collect_list(F.struct((-F.col("bytes")).alias("minus"), "slot"))
    nothing = F.array_repeat(F.lit(0).cast("long"), shards)
    gathered = loads.agg(items.alias("items")).withColumn("load", nothing)
    return _deal(gathered).select(F.lit(1).alias("version"), "slot", "shard")


def edited_map(old: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The next version of ``old`` for the loads and the number of shards of today.

    A shard keeps its slots, in a fixed mixed order, as long as they fit an equal share of all
    bytes (one slot over at most); only the others, and slots of shards that are no more, move.
    """
    share = loads.agg((F.sum("bytes") / shards).alias("share"))
    order = Window.partitionBy("shard").orderBy(F.xxhash64("slot"), "slot")
    now = old.join(loads, "slot").withColumn("before", F.sum("bytes").over(order) - F.col("bytes"))
    now = now.join(F.broadcast(share)).withColumn("stays", (F.col("shard") < shards) & (F.col("before") < F.col("share")))
    kept = now.where("stays")
    start = F.array(*[F.coalesce(F.sum(F.when((F.col("shard") == k) & F.col("stays"), F.col("bytes"))), F.lit(0)).cast("long")
                      for k in range(shards)])
    items = F.collect_list(F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("minus"), "slot")))
    moved = _deal(now.agg(start.alias("load"), items.alias("items")))
    version = old.agg((F.max("version") + 1).alias("version"))
    both = kept.select("slot", "shard").union(moved)
    return both.join(F.broadcast(version)).select("version", "slot", "shard")


def save_map(slot_map: DataFrame, path: str) -> int:
    """Store a map under its version in ``path``; storing the same version again replaces it.  Runs at once."""
    version = slot_map.agg(F.max("version")).first()[0]
    slot_map.drop("version").coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")
    return version


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored map, the newest if no version is named."""
    stored = spark.read.parquet(path).select(F.col("version").cast("int").alias("version"), "slot", "shard")
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version)


def place(slotted: DataFrame, slot_map: DataFrame, loads: DataFrame, order: list[str]) -> DataFrame:
    """``slotted`` with ``shard`` and ``position``, a number without gaps from 0 in each shard.

    Positions follow the slots; a slot's first position is a running sum over the map.  Rows meet
    only those of their own slot, in the order of ``order``.
    """
    running = Window.partitionBy("shard").orderBy("slot")
    begin = slot_map.join(loads, "slot").withColumn("begin", F.sum("rows").over(running) - F.col("rows"))
    begin = begin.select(F.col("slot").alias("_slot"), "shard", "begin")
    inside = Window.partitionBy("slot").orderBy(*order)
    numbered = slotted.withColumn("_n", F.row_number().over(inside))
    # at most MOST_SLOTS rows
    placed = numbered.join(F.broadcast(begin), F.col("slot") == F.col("_slot"))
    return placed.withColumn("position", F.col("begin") + F.col("_n") - 1).drop("_slot", "_n", "begin")
