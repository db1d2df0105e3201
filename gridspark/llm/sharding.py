"""Sharding by fixed virtual slots, with DataFrame functions only.

A record's text hashes to one of a fixed number of slots, so equal texts share a slot. Bytes and rows are added up per
slot, and a slot-to-shard map places the slots, heaviest first, on the lightest shard. A slot that holds too many bytes or
rows is cut into parts by a second hash of the text, which still keeps equal texts together. Only a text whose copies are
more than half a shard is dealt to several shards, by a hash of the record id; one with many short copies stays in one
shard and is cut into the same pieces, so that no task has to number them all. The map is a small table of
(version, bucket, part, piece, unit, shard, bytes, n) rows, stored as Parquet; rows of one unit move together. Rebalancing
edits the newest version and stores the next, and units that need not move stay.

Defined cases: a null text has 0 bytes and CRC 0, its size is 1; repeated rows are records of their own, placed after each
other; an empty table has an empty map; columns other than the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Virtual slots, parts of a slot and pieces of a part that are cut.
SLOTS, PARTS, PIECES = 4096, 64, 512
#: A slot or part is cut from this share of a shard's bytes or of all rows, a text is dealt out from this share of a shard.
CUT_BYTES, CUT_ROWS, DEAL_BYTES = 0.05, 0.002, 0.5
_MAP = "bucket int, part int, piece int, unit string, shard int, bytes long, n long, version int"


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS, parts: int = PARTS, pieces: int = PIECES) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(slots)).cast("int").alias("bucket"),
        F.pmod(F.xxhash64(F.lit("part"), text), F.lit(parts)).cast("int").alias("part"),
        F.pmod(F.xxhash64(F.lit("piece"), F.col(id_col)), F.lit(pieces)).cast("int").alias("piece"),
    )


def _is_hot(total: DataFrame, shards: int) -> Column:
    return (F.col("bytes") > F.lit(total["bytes"] or 0) * CUT_BYTES / shards) | (F.col("n") > F.lit(total["n"]) * CUT_ROWS)


def slot_bytes(rows: DataFrame, shards: int) -> DataFrame:
    """(bucket, part, piece, unit, bytes, n): a row for each slot, or for its parts, or for their pieces; -1 for what is whole.

    What is cut holds a fixed share of all bytes or rows, so the number of slots, parts and pieces bounds the table.
    """
    sums = [F.sum("size").alias("bytes"), F.count("*").alias("n")]
    total = rows.agg(*sums).first()
    hot = _is_hot(total, shards)
    whole = F.lit(-1)
    slots = rows.groupBy("bucket").agg(*sums)
    parts = rows.join(F.broadcast(slots.filter(hot).select("bucket")), "bucket").groupBy("bucket", "part").agg(*sums)
    pieces = rows.join(F.broadcast(parts.filter(hot).select("bucket", "part", F.col("bytes").alias("part_bytes"))), ["bucket", "part"])
    pieces = pieces.groupBy("bucket", "part", "piece", "part_bytes").agg(*sums)
    own = lambda *keys: F.concat_ws(":", *keys)
    dealt = F.col("part_bytes") > F.lit(total["bytes"] or 0) * DEAL_BYTES / shards
    return (
        slots.filter(~hot).select("bucket", whole.alias("part"), whole.alias("piece"), own("bucket").alias("unit"), "bytes", "n")
        .unionByName(parts.filter(~hot).select("bucket", "part", whole.alias("piece"), own("bucket", "part").alias("unit"), "bytes", "n"))
        .unionByName(pieces.select("bucket", "part", "piece", F.when(dealt, own("bucket", "part", "piece")).otherwise(own("bucket", "part")).alias("unit"), "bytes", "n"))
    )


def _dealt(units: DataFrame, loads: DataFrame) -> DataFrame:
    """(unit, shard): units, heaviest first, each to the shard that is lightest when it comes; ``loads``: one row, what the shards hold."""
    ordered = units.agg(F.sort_array(F.collect_list(F.struct("bytes", "unit")), asc=False).alias("units"))  # bounded by the map
    start = F.struct("loads", F.array().cast("array<int>").alias("shards"))

    def step(state: Column, unit: Column) -> Column:
        at = (F.array_position(state["loads"], F.array_min(state["loads"])) - 1).cast("int")
        more = F.transform(state["loads"], lambda v, i: F.when(i == at, v + unit["bytes"]).otherwise(v))
        return F.struct(more.alias("loads"), F.concat(state["shards"], F.array(at)).alias("shards"))

    placed = ordered.join(F.broadcast(loads), F.lit(True)).withColumn("shards", F.aggregate("units", start, step, lambda s: s["shards"]))
    return placed.select(F.explode(F.arrays_zip("units", "shards")).alias("u")).select("u.units.unit", F.col("u.shards").alias("shard"))


def _by_unit(cells: DataFrame, *more: str) -> DataFrame:
    return cells.groupBy("unit", *more).agg(F.sum("bytes").alias("bytes"))


def place(cells: DataFrame, shards: int, version: int = 0) -> DataFrame:
    """The first map."""
    nothing = cells.sparkSession.range(1).select(F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"))
    return cells.join(F.broadcast(_dealt(_by_unit(cells), nothing)), "unit").withColumn("version", F.lit(version))


def rebalance(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version for ``shards`` shards: units beyond a shard's fair share, lightest first, go to the lightest shards.

    Units of shards that are gone move too; every other unit stays where it is.
    """
    units = _by_unit(slot_map, "shard")
    fair = units.agg((F.sum("bytes") / shards).alias("fair"))
    running = F.sum("bytes").over(Window.partitionBy("shard").orderBy(F.desc("bytes"), "unit"))
    marked = units.withColumn("running", running).join(F.broadcast(fair), F.lit(True)).withColumn("moves", (F.col("shard") >= shards) | (F.col("running") > F.col("fair")))
    stay = marked.filter("not moves").select("unit", "shard", "bytes")
    entries = F.map_from_entries(F.collect_list(F.struct("shard", "load")))
    loads = stay.groupBy("shard").agg(F.sum("bytes").alias("load")).agg(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.coalesce(F.element_at(entries, i), F.lit(0).cast("long"))).alias("loads"))
    now = stay.select("unit", "shard").unionByName(_dealt(marked.filter("moves"), loads))
    return slot_map.drop("shard").join(F.broadcast(now), "unit").withColumn("version", F.col("version") + 1)


def store_map(slot_map: DataFrame, folder: str) -> DataFrame:
    """Write a map's version beside the others and read it back."""
    slot_map.coalesce(1).write.partitionBy("version").mode("append").parquet(folder)
    return load_map(slot_map.sparkSession, folder)


def load_map(spark, folder: str, version: int | None = None) -> DataFrame:
    """A version of the stored map, the newest by default."""
    stored = spark.read.schema(_MAP).parquet(folder)
    newest = stored.agg(F.max("version").alias("newest"))
    return stored.filter(F.col("version") == version) if version is not None else stored.join(F.broadcast(newest), F.col("version") == F.col("newest")).drop("newest")


def assign(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add ``shard`` and the record's gapless place in it: what the map has before it in the shard, then its place in its slot or piece."""
    before = Window.partitionBy("shard").orderBy("bucket", "part", "piece")  # over the map, which the number of slots bounds
    at = ["bucket", "part", "piece"]
    offsets = slot_map.withColumn("first", F.sum("n").over(before) - F.col("n")).select(*at, "shard", "first")
    cut = slot_map.filter("part >= 0").select("bucket").distinct().withColumn("is_cut", F.lit(True))
    fine = slot_map.filter("piece >= 0").select("bucket", "part").distinct().withColumn("is_fine", F.lit(True))
    keyed = rows.join(F.broadcast(cut), "bucket", "left").withColumn("part", F.when(F.col("is_cut"), F.col("part")).otherwise(-1))
    keyed = keyed.join(F.broadcast(fine), ["bucket", "part"], "left").withColumn("piece", F.when(F.col("is_fine"), F.col("piece")).otherwise(-1))
    placed = keyed.join(F.broadcast(offsets), at)
    inside = Window.partitionBy(*at).orderBy("doc_id", "text_crc32", "size")
    return placed.withColumn("slot", (F.col("first") + F.row_number().over(inside) - 1).cast("long"))
