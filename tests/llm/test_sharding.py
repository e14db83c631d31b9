import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from carestat.llm import sharding as sh
from carestat.llm.common import Scratch

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, shard int, record map<string,int>, a int"


class Twister:
    """The 32-bit Mersenne twister, drawing ints below a bound as the JVM's generator does."""

    def __init__(self, seed: int):
        self.rng = np.random.RandomState(np.array([seed >> 32, seed & 0xFFFFFFFF], np.uint32))

    def below(self, n: int) -> int:
        while True:
            bits = int(self.rng.randint(0, 1 << 32, dtype=np.uint64)) >> 1
            if n & (n - 1) == 0:
                return n * bits >> 31
            if bits - bits % n + n - 1 < 1 << 31:
                return bits % n


def _fisher_yates(n: int, seed: int) -> list[int]:
    rng, out = Twister(seed), [0] * n
    for i in range(n):
        j = rng.below(i + 1)
        if j != i:
            out[i] = out[j]
        out[j] = i
    return out


def _rows():
    texts = ["", None, "x" * 100_000, "é\U0001f600", "same text", "same text"]
    rows = [(i, texts[i % 6], i, {"k": i}, 0) for i in range(60)] + [(None, "no id", 0, None, None)] * 2
    return rows + [(7, "copy", 1, None, 0)] * 10_000


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(5)


def test_contract(spark, edge):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for table in (docs, edge):
        want = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in table.collect())
        out = sh.shards_of(spark, table)
        got = out.collect()
        assert [(c, t) for c, t in out.dtypes if c != "bucket"] == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"),
                                                                 ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
        assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == want
        slots = {s: sorted(r.slot for r in got if r.shard == s) for s in range(40)}
        counts = [len(v) for v in slots.values()]
        assert max(counts) - min(counts) <= 1 and sum(counts) == len(want)
        assert all(v == list(range(len(v))) for v in slots.values())


def test_buckets_are_fisher_yates_shuffled(spark, edge):
    """Every bucket is the plain inside-out shuffle of its records in hash order."""
    thin = edge.select("doc_id", F.length("text").alias("n"))
    with Scratch(spark, "t") as scratch:
        got = sh.shuffled(thin, scratch, 7, seed=11).collect()
        order = (sh.numbered_copies(thin).withColumn("h", F.xxhash64(F.lit(11), "a", "b", "copy"))
                 .withColumn("bucket", F.expr("cast(pmod(h, 7) as int)")).collect())
    assert len(got) == len(order) == edge.count()
    for b in range(7):
        rows = [r.record for r in sorted((r for r in order if r.bucket == b), key=lambda r: r.h)]
        mine = [r.record for r in sorted((r for r in got if r.bucket == b), key=lambda r: r["at"])]
        assert mine == [rows[i] for i in _fisher_yates(len(rows), 11 + b)]
    sizes = [sum(r.bucket == b for r in got) for b in range(7)]
    assert max(sizes) < 1.2 * min(sizes)  # a hot row's copies are spread as well


def test_layout_and_reruns_agree(spark, edge):
    one = {tuple(r) for r in sh.shards_of(spark, edge).drop("bucket").collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert {tuple(r) for r in sh.shards_of(spark, edge.repartition(2)).drop("bucket").collect()} == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_order_is_uniform(spark):
    """Tenths of the ids against tenths of the places."""
    table, hits = spark.range(5000).toDF("doc_id"), np.zeros((10, 10))
    with Scratch(spark, "u") as scratch:
        for r in sh.sharded(spark, table, F.lit(16), scratch, shards=1, bucket_bytes=16_000).collect():
            hits[r.record.doc_id // 500, r.slot // 500] += 1
    assert (hits.sum(axis=0) == 500).all() and ((hits - 50) ** 2 / 50).sum() < 140  # 81 degrees of freedom


def test_written_shards(spark, edge, tmp_path):
    sh.write_shards(spark, edge, str(tmp_path / "out"), shards=3, bucket_bytes=20_000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == ["_slot", "doc_id", "text", "shard", "record", "a", "_shard"]
    key = lambda r: repr(tuple(r[c] for c in edge.columns))
    assert sorted(key(r) for r in back.collect()) == sorted(key(r) for r in edge.collect())
    counts = [r["count"] for r in back.groupBy("_shard").count().collect()]
    assert len(counts) == 3 and max(counts) - min(counts) <= 1


def test_few_and_no_rows(spark, edge):
    assert sh.shards_of(spark, edge.limit(0)).count() == 0
    few = sh.shards_of(spark, edge.limit(3)).collect()
    assert len(few) == 3 and len({r.shard for r in few}) == 3 and {r.slot for r in few} == {0}


def test_no_python_in_the_plan(spark, edge):
    with Scratch(spark, "p") as scratch:
        plan = sh.sharded(spark, edge.select("doc_id"), F.lit(16), scratch)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
