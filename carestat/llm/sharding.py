"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass one scatters the records uniformly into buckets of about BUCKET_BYTES by a
seeded hash of the record; a bucket is one shuffle partition. Pass two gathers
each bucket in its task, shuffles it by Fisher-Yates (the array function
``shuffle``, whose generator is seeded with SEED plus the partition's number,
here the bucket's) and writes it. Buckets one after another are then a uniform
random order of all records; shard s of S holds places s n / S to (s + 1) n / S,
so counts differ by one at most (law ``rows``). Nothing here runs Python on the
executors.

Buckets are put in hash order before they are shuffled, so the result depends on
the records, the seed and the bucket count alone: reruns, retried tasks and
other splits of the input agree. Records are scattered one by one; records of
equal text are not kept together, so a group of copies of any size is spread
over all buckets. Equal rows are numbered first (those of one row are counted,
then dealt out again in lots of LOT), so that they scatter like others.

A bucket's place in the whole comes from the buckets' counts, added up in two
levels: within groups of buckets, then over the groups.

Defined cases: null text has size 16 and checksum 0; null ids and equal rows are
records like any other; a text longer than a bucket is in a bucket above the
size; an empty table has no rows; with fewer records than shards some shards
are empty; other columns are carried along by ``shuffled`` and ``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from carestat.llm.common import BROADCAST_IDS, Scratch

SEED = 20_240_311
BUCKET_BYTES = 64 << 20
ROW_BYTES = 16  # counted for a record besides its text
LOT = 4_096  # copies of one row dealt out by one task at a time
GROUP = 1_024  # buckets whose counts are added up together
SHARDS = 40


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text.cast("string")), F.lit(0)) + ROW_BYTES).cast("long")


def _digests(docs: DataFrame) -> list[Column]:
    cols = [F.to_json(F.struct(F.col(f"`{c}`"))) if _has_map(f.dataType) else F.col(f"`{c}`") for c, f in zip(docs.columns, docs.schema)]
    return [F.xxhash64(F.lit(salt), *cols) for salt in (1, 2)]


def _has_map(t: T.DataType) -> bool:
    return "map<" in t.simpleString() or "variant" in t.simpleString()


def numbered_copies(docs: DataFrame) -> DataFrame:
    """(record struct, a, b, copy): the rows, with copies of one row numbered from 0."""
    a, b = _digests(docs)
    once = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), a.alias("a"), b.alias("b"))
    once = once.groupBy("a", "b").agg(F.first("record").alias("record"), F.count("*").alias("n"))
    single = once.where("n = 1").select("record", "a", "b", F.lit(0).cast("long").alias("copy"))
    lots = once.where("n > 1").withColumn("lot", F.explode(F.expr(f"sequence(0L, n - 1, {LOT}L)"))).repartition("a", "b", "lot")
    many = lots.select("record", "a", "b", F.explode(F.expr(f"sequence(lot, least(n, lot + {LOT}) - 1)")).alias("copy"))
    return single.unionByName(many)


def bucket_count(docs: DataFrame, size: Column, bucket_bytes: int = BUCKET_BYTES) -> tuple[int, int]:
    """(rows, buckets) for the table."""
    n, total = docs.agg(F.count("*"), F.sum(size)).first()
    return n, max(1, -(-int(total or 0) // bucket_bytes))


def shuffled(docs: DataFrame, scratch: Scratch, buckets: int, seed: int = SEED) -> DataFrame:
    """(bucket, at, record): pass one and two, written; ``at`` counts a bucket's records from 0."""
    hashed = numbered_copies(docs).withColumn("h", F.xxhash64(F.lit(seed), "a", "b", "copy"))
    dealt = (hashed.select(F.pmod(F.col("h"), F.lit(buckets)).cast("int").alias("bucket"), F.struct("h", "a", "b", "copy", "record").alias("r"))
             .repartitionById(buckets, F.col("bucket")))
    held = F.collect_list("r")
    if any(_has_map(f.dataType) for f in docs.schema):  # such records have no order of their own
        held = F.array_sort(held, lambda x, y: F.when(x["h"] < y["h"], -1).when(x["h"] > y["h"], 1).otherwise(0))
    else:
        held = F.sort_array(held)
    mixed = dealt.groupBy("bucket").agg(held.alias("rs")).select("bucket", F.shuffle("rs", seed).alias("rs"))
    return scratch.put(mixed.select("bucket", F.posexplode("rs").alias("at", "r")).select("bucket", "at", "r.record"), "buckets")


def bucket_starts(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(bucket, start): records in the buckets before, added up within groups, then over groups."""
    counts = scratch.put(rows.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("g", F.floor(F.col("bucket") / GROUP).cast("int")), "counts")
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = counts.groupBy("g").agg(F.sum("n").alias("n")).withColumn("_one", F.lit(0))
    groups = groups.select("g", before(Window.partitionBy("_one").orderBy("g")).alias("_base"))
    inner = counts.withColumn("_in", before(Window.partitionBy("g").orderBy("bucket")))
    return scratch.put(inner.join(groups, "g").select("bucket", (F.col("_base") + F.col("_in")).alias("start")), "starts")


def sharded(spark: SparkSession, docs: DataFrame, size: Column, scratch: Scratch, shards: int = SHARDS,
            bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """(shard, slot, bucket, at, record) of every row of docs, ``size`` its bytes."""
    n, buckets = bucket_count(docs, size, bucket_bytes)
    rows = shuffled(docs, scratch, buckets, seed)
    starts = bucket_starts(rows, scratch)
    place = rows.join(F.broadcast(starts) if buckets <= BROADCAST_IDS else starts, "bucket").withColumn("_p", F.col("start") + F.col("at"))
    shard = F.expr(f"cast(cast(_p as decimal(38,0)) * {shards} div {max(n, 1)} as int)")
    first = F.expr(f"cast((cast(shard as decimal(38,0)) * {n} + {shards - 1}) div {shards} as bigint)")
    return place.withColumn("shard", shard).withColumn("slot", F.col("_p") - first).select("shard", "slot", "bucket", "at", "record")


def write_shards(spark: SparkSession, docs: DataFrame, path: str, text_col: str = "text", shards: int = SHARDS,
                 bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> None:
    """All columns of docs and their slot as Parquet, a folder ``_shard=s`` per shard; a bucket is written by one
    task, so a shard's files are its buckets' shuffled pieces, each in slot order."""
    with Scratch(spark, "shards") as scratch:
        size = record_size(F.col(f"`{text_col}`"))
        buckets = bucket_count(docs, size, bucket_bytes)[1]
        out = sharded(spark, docs, size, scratch, shards, bucket_bytes, seed)
        (out.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("shard", "slot")
         .select(F.col("shard").alias("_shard"), F.col("slot").alias("_slot"), "record.*").write.mode("overwrite").partitionBy("_shard").parquet(path))


def shards_of(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is rows), bucket. Records are dealt without
    their texts; buckets are as many as the texts need."""
    text = F.col(text_col).cast("string")
    thin = docs.select(F.col(id_col).cast("long").alias("id"), record_size(text).alias("size"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"), F.md5(text.cast("binary")).alias("digest"))
    with Scratch(spark, "sharding") as scratch:
        out = sharded(spark, thin, F.col("size"), scratch, shards).select(
            F.col("record.id").alias(id_col), "record.size", F.col("record.crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard"), "bucket")
        return scratch.put(out, "out", keep=True)
