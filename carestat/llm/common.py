"""Tables, scratch storage and row numbering shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from carestat.session import scratch_path

# A side is broadcast only after it was counted and holds at most this many ids.
BROADCAST_IDS = 500_000
# Spark removes a query's shuffle files at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


class Scratch:
    """Intermediate tables in the shared checkpoint folder.

    ``put`` writes a table and reads it back, which cuts the lineage: a lost
    executor costs the running stage only. The shuffle files of the write go
    with its end, not when the driver next collects its garbage. Leaving the
    ``with`` block deletes the tables that were not put with ``keep=True``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.drop = spark, scratch_path(spark, f"{name}-{uuid.uuid4().hex}"), []

    def put(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        path, conf = f"{self.base}/{name}", self.spark.conf
        before = conf.get(SHUFFLE_CLEANUP, None)
        conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            if before is None:
                conf.unset(SHUFFLE_CLEANUP)
            else:
                conf.set(SHUFFLE_CLEANUP, before)
        if not keep:
            self.drop.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.drop:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
        self.drop = []


def keep_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in the distinct ``ids``; the ids are
    broadcast when their count is within BROADCAST_IDS, else both sides shuffle."""
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, key, "left_semi")


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of edges (a long, b long) as (node, comp), comp
    the smallest node reachable; nodes without an edge are not listed.

    Alternates star contractions until nothing changes: every node's larger
    neighbours are tied to its smallest neighbour, then its smaller ones.
    Minima are combined map-side, so a hub of any size is no hot task.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, step, before = scratch.put(links, "cc-0"), 0, None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        step += 1
        large = scratch.put(large.where("u <> v"), f"cc-{step}")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                               F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        step += 1
        links = scratch.put(small, f"cc-{step}")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    pairs = links.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return pairs.unionByName(pairs.select(F.col("comp").alias("node"), "comp").distinct())


def numbered(df: DataFrame, order: list, scratch: Scratch, name: str) -> DataFrame:
    """``df`` with column ``row_no``, 0.. in the given order: a range-partitioned
    sort, then the partitions' counts (as many as there are partitions) added up."""
    low = F.monotonically_increasing_id()
    part = scratch.put(df.orderBy(*order).withColumn("_part", F.shiftright(low, 33))
                       .withColumn("_at", low.bitwiseAND((1 << 33) - 1)), name)
    counts = sorted((r["_part"], r["n"]) for r in part.groupBy("_part").agg(F.count("*").alias("n")).collect())
    offsets, seen = [], 0
    for p, n in counts:
        offsets.append((p, seen))
        seen += n
    base = df.sparkSession.createDataFrame(offsets or [(0, 0)], "_part long, _base long")
    return (part.join(F.broadcast(base), "_part")
            .withColumn("row_no", F.col("_base") + F.col("_at")).drop("_part", "_at", "_base"))
