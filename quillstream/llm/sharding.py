"""Sharding by fixed virtual slots.

Every row hashes by its id and text into one of `slots` virtual slots. A row without an id, and one of an id and text that
repeat, hashes by its place in the table as well where together
they have more than a slot's share of the bytes: neither a common id nor a repeated row fills a slot by itself. Bytes and rows are summed per slot (a map-side
combined aggregate of at most `slots` times PARTS groups), and a slot-to-shard map is planned from those sums: largest slot
first, always to the lightest shard. Rows never move by themselves: rebalancing edits the map.
`grow` makes the next version, in which slots move into the added shard only, `move` one with given slots moved.
Versions are stored as a table each (`save_map`), listed (`versions`) and read again (`load_map`).

All of it is DataFrame expressions; the map has `slots` rows at most, whatever the input's size, so it is broadcast, as
are the places where each slot's PARTS begin.

Null ids have places of their own, null texts have no bytes, texts of any length count whole, repeated rows are spread
over slots and get places of their own, slots of equal size are placed by their number, empty tables give empty maps and
results, and columns besides the id and the text are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstream.llm.common import materialise, work_path

SLOTS = 8192
#: Parts that a slot's rows are numbered in.
PARTS = 8
ROW_OVERHEAD = 16
MAP_SCHEMA = "version int, vslot bigint, shard int, bytes bigint, n_rows bigint, start bigint"


def virtual_slot(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots))


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """One narrow row for each input row: id, size, crc32 of the text's bytes, virtual slot, part, the hash of id and text, and a number by its place. To be stored: a row's place is in the last three."""
    body = F.coalesce(F.col(text), F.lit(""))
    place = F.monotonically_increasing_id()
    row_key = F.xxhash64(F.struct(F.col(key), F.xxhash64(text, F.col(text).isNull()), F.when(F.col(key).isNull(), place)))
    return docs.select(
        F.col(key),
        (F.octet_length(body).cast("long") + ROW_OVERHEAD).alias("size"),
        F.crc32(F.encode(body, "utf-8")).alias("text_crc32"),
        F.pmod(row_key, F.lit(slots)).alias("vslot"),
        F.pmod(place, F.lit(PARTS)).cast("int").alias("part"),
        row_key.alias("row_key"),
        F.pmod(place, F.lit(slots)).cast("int").alias("spot"),
    )


def spread(digests: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The digests with equal rows that exceed a slot's share dealt over all slots by their place.

    Each of these takes more than one of `slots` shares, so there are fewer of them than slots: they are broadcast.
    """
    total = digests.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    each = digests.groupBy("row_key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    heavy = materialise(each.where((F.col("n") > 1) & (F.col("bytes") * slots > total)).select("row_key", F.lit(True).alias("heavy")), "heavy-rows")
    slot = F.when(F.col("heavy"), virtual_slot(F.struct("row_key", "spot"), slots)).otherwise(F.col("vslot"))
    return digests.join(F.broadcast(heavy), "row_key", "left").withColumn("vslot", slot).drop("heavy", "row_key", "spot")


def part_sizes(digests: DataFrame) -> DataFrame:
    return digests.groupBy("vslot", "part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))


def slot_sizes(parts: DataFrame) -> DataFrame:
    return parts.groupBy("vslot").agg(F.sum("bytes").alias("bytes"), F.sum("n_rows").alias("n_rows"))


def plan_map(sizes: DataFrame, shards: int, version: int = 1) -> DataFrame:
    """The slot-to-shard map of the first version: slots by bytes, largest first, each to the lightest shard.

    `start` is the number of rows that slots placed earlier on the same shard hold, so that places within a shard
    are gapless. The fold runs over one array of at most `slots` entries.
    """
    lightest = "array_position(acc.loads, array_min(acc.loads)) - 1"
    fold = f"""
        aggregate(
          slots,
          named_struct('loads', array_repeat(0L, {shards}), 'counts', array_repeat(0L, {shards}),
                       'placed', cast(array() as array<struct<vslot:bigint,shard:bigint,bytes:bigint,n_rows:bigint,start:bigint>>)),
          (acc, x) -> named_struct(
            'loads', transform(acc.loads, (v, i) -> if(i = {lightest}, v - x.minus_bytes, v)),
            'counts', transform(acc.counts, (v, i) -> if(i = {lightest}, v + x.n_rows, v)),
            'placed', concat(acc.placed, array(named_struct(
                'vslot', x.vslot, 'shard', cast({lightest} as bigint), 'bytes', -x.minus_bytes, 'n_rows', x.n_rows,
                'start', acc.counts[cast({lightest} as int)])))),
          acc -> acc.placed)"""
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("minus_bytes"), F.col("vslot"), F.col("n_rows"))))
    return (
        sizes.agg(ordered.alias("slots"))
        .select(F.explode(F.expr(fold)).alias("p"))
        .select(F.lit(version).alias("version"), "p.vslot", F.col("p.shard").cast("int").alias("shard"), "p.bytes", "p.n_rows", "p.start")
    )


def starts() -> Column:
    """Rows of the slots before a slot in its shard."""
    return F.coalesce(F.sum("n_rows").over(Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def grow(slot_map: DataFrame, shards: int) -> DataFrame:
    """The map's next version with shard number `shards` added: every old shard keeps slots up to the new mean and gives the rest."""
    everything = Window.partitionBy()
    in_shard = Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot")
    held = F.sum("bytes").over(in_shard)
    mean = F.sum("bytes").over(everything) / F.lit(shards + 1)
    moved = slot_map.withColumn("shard", F.when(held > mean, F.lit(shards)).otherwise(F.col("shard")).cast("int"))
    return moved.withColumn("version", F.col("version") + 1).withColumn("start", starts())


def move(slot_map: DataFrame, to: dict[int, int]) -> DataFrame:
    """The map's next version with some slots moved: slot -> shard."""
    shard = F.col("shard")
    for vslot, target in to.items():
        shard = F.when(F.col("vslot") == vslot, F.lit(target)).otherwise(shard)
    return slot_map.withColumn("shard", shard.cast("int")).withColumn("version", F.col("version") + 1).withColumn("start", starts())


def save_map(slot_map: DataFrame, folder: str) -> int:
    """Stores a version beside those before it; a version that is there already is an error. Its number (0: an empty map)."""
    version = slot_map.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
    slot_map.drop("version").coalesce(1).write.mode("errorifexists").parquet(f"{folder}/version={version}")
    return version


def versions(spark: SparkSession, folder: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    listed = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)
    return sorted(int(x.getPath().getName().removeprefix("version=")) for x in listed if x.getPath().getName().startswith("version="))


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A stored version of the map, the latest by default."""
    wanted = max(versions(spark, folder)) if version is None else version
    return spark.read.parquet(f"{folder}/version={wanted}").select(F.lit(wanted).alias("version"), "vslot", "shard", "bytes", "n_rows", "start")


def place(digests: DataFrame, slot_map: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each row's shard by the map, and its place in the shard: `slot`, gapless from 0.

    Places are counted within a part of a virtual slot, and added to what the parts and slots before it hold: neither a
    shard nor a slot is sorted whole.
    """
    before = F.coalesce(F.sum("n_rows").over(Window.partitionBy("vslot").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = part_sizes(digests).withColumn("before", before).select("vslot", "part", "before")
    small = parts.join(F.broadcast(slot_map.select("vslot", "shard", "start", "version")), "vslot")
    ranked = digests.withColumn("at", F.row_number().over(Window.partitionBy("vslot", "part").orderBy(key, "text_crc32", "size")) - 1)
    return ranked.join(F.broadcast(small), ["vslot", "part"]).withColumn("slot", F.col("start") + F.col("before") + F.col("at")).drop("start", "before", "at", "part", "row_key", "spot")


def shard(docs: DataFrame, shards: int = 40, slots: int = SLOTS, key: str = "doc_id", text: str = "text", folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(placed rows, slot map of version 1). The texts are read once; the map is stored in `folder`, where its next versions belong."""
    spark = docs.sparkSession
    folder = folder or work_path(spark, "slot-maps")
    digests = spread(materialise(digest(docs, key, text, slots), "shard-digests"), slots)
    version = save_map(materialise(plan_map(slot_sizes(part_sizes(digests)), shards), "slot-map"), folder)  # planned once
    slot_map = load_map(spark, folder, version)
    return place(digests, slot_map, key), slot_map
