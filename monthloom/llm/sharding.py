"""Shards from fixed virtual slots and a versioned map from slot to shard.

A record is hashed into one of ``SLOTS`` virtual slots and never leaves it. What moves is the slot:
the map says which shard holds it, and every change of the map is a new version, so that a reader who
knows a version finds all records of it.

1. One pass over the texts leaves a narrow row a record: size, checksum, slot. Counted rows of that
   table give records and bytes per slot, and each record its place within the slot.
2. Version 0 deals the slots out in turn. ``rebalanced`` edits it: a shard keeps its largest slots as
   long as they fit the mean of all shards, and the others go, largest first, each to the shard that is
   the emptiest then. Sizes differ by less than the slot that was placed last.
3. ``grown`` edits the map for one more shard: each old shard gives its smallest slots beyond the new
   mean to the new one, and no slot moves between old shards.

Everything here is DataFrame functions. A map has ``SLOTS`` rows whatever the input, and only the map is ever
brought into one task.

Cases: a null text has no bytes and the checksum of an empty one; null ids are hashed like any other value;
rows alike in id and text share a slot and are placed one after the other; further columns are not looked
at; an empty table gives no rows and a map of empty slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthloom.sources.scratch import materialise

SHARDS, SLOTS = 24, 8192
OVERHEAD = 8

MAP = "version int, slot int, shard int"


def virtual_slot(*record: Column, slots: int = SLOTS) -> Column:
    """The slot of a record: a hash of the columns that identify it."""
    return F.pmod(F.xxhash64(*record), F.lit(slots)).cast("int")


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, virtual_slot, n, place)``, written out; ``n`` rows alike are one.

    ``place`` counts the rows of the slot before this one. Rows alike are combined before they shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    cells = docs.select(
        F.col("doc_id"),
        (F.octet_length(text).cast("bigint") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        virtual_slot(F.col("doc_id"), text, slots=slots).alias("virtual_slot"),
    )
    alike = cells.groupBy("virtual_slot", "doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    return materialise(alike.withColumn("place", F.coalesce(F.sum("n").over(earlier), F.lit(0))))


def slot_totals(rows: DataFrame) -> DataFrame:
    """``(slot, n, bytes)`` of the slots that hold records."""
    return rows.groupBy(F.col("virtual_slot").alias("slot")).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("bytes"))


def first_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Version 0: the slots dealt out in turn."""
    return spark.range(slots).select(F.lit(0).alias("version"), F.col("id").cast("int").alias("slot"), (F.col("id") % shards).cast("int").alias("shard"))


def latest(maps: DataFrame) -> DataFrame:
    """The newest version in a table of maps."""
    newest = maps.select("*", F.max("version").over(Window.partitionBy()).alias("newest"))
    return newest.filter(F.col("version") == F.col("newest")).drop("newest")


def _held(slot_map: DataFrame, totals: DataFrame, shards: int) -> DataFrame:
    """The map with each slot's bytes, whether its shard keeps it within the mean of ``shards``, and that mean."""
    sized = slot_map.join(totals.select("slot", "bytes"), "slot", "left").na.fill(0, ["bytes"])
    largest_first = Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot")
    mean = F.sum("bytes").over(Window.partitionBy()) / F.lit(shards)
    return sized.select("*", F.sum("bytes").over(largest_first).alias("upto"), mean.alias("mean")).select(
        "version", "slot", "shard", "bytes", (F.col("upto") <= F.col("mean")).alias("stays")
    )


def rebalanced(slot_map: DataFrame, totals: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version: slots beyond the mean of their shard go to the emptiest shards."""
    held = materialise(_held(slot_map, totals, shards))
    moving = F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("order"), "slot", "bytes"))
    one = held.agg(
        F.sort_array(F.collect_list(moving)).alias("moving"),
        *[F.coalesce(F.sum(F.when(F.col("stays") & (F.col("shard") == s), F.col("bytes"))), F.lit(0)).alias(f"load{s}") for s in range(shards)],
    ).select("moving", F.array(*[f"load{s}" for s in range(shards)]).alias("loads"))

    def put(so_far: Column, slot: Column) -> Column:
        emptiest = F.array_position(so_far["loads"], F.array_min(so_far["loads"])) - 1
        filled = F.transform(so_far["loads"], lambda load, s: load + F.when(s == emptiest, slot["bytes"]).otherwise(0))
        return F.struct(filled.alias("loads"), F.concat(so_far["shards"], F.array(emptiest.cast("int"))).alias("shards"))

    start = F.struct("loads", F.array().cast("array<int>").alias("shards"))
    placed = one.select("moving", F.aggregate("moving", start, put, lambda end: end["shards"]).alias("to"))
    moves = placed.select(F.inline(F.arrays_zip(F.transform("moving", lambda m: m["slot"]).alias("slot"), F.col("to"))))
    return held.join(moves, "slot", "left").select((F.col("version") + 1).alias("version"), "slot", F.coalesce("to", "shard").alias("shard"))


def grown(slot_map: DataFrame, totals: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version for one shard more than ``shards``, which alone takes slots."""
    held = _held(slot_map, totals, shards + 1)
    return held.select((F.col("version") + 1).alias("version"), "slot", F.when(F.col("stays"), F.col("shard")).otherwise(F.lit(shards)).alias("shard"))


def write_map(version: DataFrame, path: str) -> None:
    """Adds a version to the stored maps; earlier ones stay readable."""
    version.coalesce(1).write.partitionBy("version").mode("append").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version, or the newest."""
    maps = spark.read.schema(MAP).parquet(path)
    return latest(maps) if version is None else maps.filter(F.col("version") == version)


def place(rows: DataFrame, slot_map: DataFrame, totals: DataFrame) -> DataFrame:
    """The records with their ``shard`` and their ``slot`` in it, counted from 0 without gaps."""
    filled = slot_map.join(totals.select("slot", "n"), "slot", "left").na.fill(0, ["n"])
    before = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = filled.select(F.col("slot").alias("virtual_slot"), "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    first = F.col("start") + F.col("place")
    return rows.join(starts, "virtual_slot").select(
        "doc_id", "size", "text_crc32", "shard", F.explode(F.sequence(first, first + F.col("n") - 1)).alias("slot"), "virtual_slot"
    )


def write_shards(docs: DataFrame, slot_map: DataFrame, path: str, slots: int = SLOTS) -> str:
    """The documents as files, a folder per shard, written by many tasks; returns the name of the column in the folders.

    That name is ``shard``, or that with underscores where the documents have such a column.
    """
    name, key = "shard", "slot_of_row"
    while name in docs.columns:
        name += "_"
    while key in docs.columns:
        key += "_"
    held = slot_map.select(F.col("slot").alias(key), F.col("shard").alias(name))
    own = virtual_slot(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")), slots=slots)
    placed = docs.withColumn(key, own).join(F.broadcast(held), key)  # a row per slot
    placed.drop(key).write.partitionBy(name).parquet(path)
    return name


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot, virtual_slot)`` under the first rebalanced map."""
    rows = records(docs, slots)
    totals = materialise(slot_totals(rows))
    return place(rows, materialise(rebalanced(first_map(docs.sparkSession, shards, slots), totals, shards)), totals)
