"""Approximate nearest neighbours by cross-polytope hashing.

Vectors are hashed by direction, in ranges of norms: within a range the longest
is at most RANGE times the shortest, so the largest inner products are near the
nearest directions, and every range has tables of its own, all of which a query
probes. A query that meets fewer than k candidates is compared with every
vector, in the same blocks as a hot bucket. A pseudo-rotation (three rounds of random signs and a fast Hadamard
transform) sends a vector to a random position; its hash is the signed axis
nearest to it, one of twice as many as there are dimensions. TABLES rotations
give as many tables. A query probes the nearest axes of each table, so
a candidate is met if any table has it in a probed bucket. When buckets would
hold more than TARGET rows on average, a second polytope over fewer
dimensions is added to the hash, and the probes are the best pairs of axes.

How many buckets a query probes is fitted: SAMPLE queries (first by a hash) are
compared with every row, and the least count is taken by which RECALL of their
true nearest is met, at most MOST probes (times the buckets a second polytope adds).
As nearest vectors come nearer when a table grows, the count, and so the share of
rows that is scored, falls with its size.

Every row is indexed; there is no cap on a bucket. A bucket's rows
and the queries that probe it are cut into parts of about CHUNK, so that no
task holds a hot bucket, and each pair of parts is one matrix product. Equal vectors
are one row of the index with its k + 1 smallest ids, which are all that can
be among a query's k nearest. Scores are computed again from the original
vectors in double precision, row by row, so equal vectors tie exactly.

Defined cases: vectors that are null, empty, zero, of another length than most,
or hold null or non-finite components take no part, nor do rows with a null
id; of repeated ids the first by vector counts; ties go to the smaller id;
with fewer than k candidates all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from carestat.llm.common import Scratch

TABLES = 14
SAMPLE = 200  # queries that the number of probes is fitted on
RECALL = 0.96  # of their true nearest
MOST = 64  # probes of a table
TARGET = 1_024
CHUNK = 2_048
BLOCK_ROWS = 16_384  # index rows scored in one call, about
SEED = 97
RANGE = 1.25  # of norms


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the orthonormal Hadamard matrix; the width is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        pair = x.reshape(len(x), -1, 2, h)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, table: int, part: int) -> np.ndarray:
    rng = np.random.default_rng([SEED, table, part])
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], x.shape[1]))
    return x


def axes(x: np.ndarray, table: int, second: int) -> list[np.ndarray]:
    """Closeness of each row to each signed axis, for each polytope of a table."""
    out = []
    for part, width in enumerate([x.shape[1]] + [second] * (second > 0)):
        r = rotated(x, table, part)[:, :width]
        out.append(np.concatenate([r, -r], 1))
    return out


def buckets(x: np.ndarray, table: int, second: int) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    for near in axes(x, table, second):
        out = out * near.shape[1] + near.argmax(1)
    return out


def probes(x: np.ndarray, table: int, second: int, count: int) -> np.ndarray:
    """The ``count`` nearest buckets of each row, by the squared gaps to the nearest axes."""
    cost = code = None
    for near in axes(x, table, second):
        top = np.argsort(-near, 1, kind="stable")[:, :count]
        value = np.take_along_axis(near, top, 1)
        gap = (value[:, :1] - value) ** 2
        if cost is None:
            cost, code = gap, top.astype(np.int64)
        else:
            cost = (cost[:, :, None] + gap[:, None]).reshape(len(x), -1)
            code = (code[:, :, None] * near.shape[1] + top[:, None]).reshape(len(x), -1)
    best = np.argsort(cost, 1, kind="stable")[:, :count]
    return np.take_along_axis(code, best, 1)


def probes_needed(x: np.ndarray, found: np.ndarray, at: np.ndarray, tables: int, second: int, recall: float, most: int = MOST) -> int:
    """The least number of probes a table by which ``recall`` of the rows ``found`` are met by the queries ``x[at]``."""
    need = np.full(len(found), 1 << 30)
    count = most * max(1, 2 * second)
    for t in range(tables):
        own, near = buckets(found, t, second), probes(x, t, second, count)
        met = near[at] == own[:, None]
        need = np.where(met.any(1), np.minimum(need, met.argmax(1)), need)
    rank = np.sort(need)[max(0, int(np.ceil(recall * len(need))) - 1)] if len(need) else 0
    return int(min(rank + 1, count))


def _unit(raw: list[bytes]) -> np.ndarray:
    v = np.stack([np.frombuffer(b, "<f8") for b in raw])
    out = np.zeros((len(v), 1 << int(v.shape[1]).bit_length()))  # a power of two above the length
    out[:, :v.shape[1]] = v / np.sqrt((v * v).sum(1))[:, None]
    return out


def usable(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec array<double>, norm) of the rows that take part."""
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where("id is not null and size(vec) > 0")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    rows = rows.where(~bad).withColumn("norm", norm).where("norm > 0 and norm < double('infinity')")
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vec") == (size[0]["n"] if size else 0)).groupBy("id").agg(F.min(F.struct("vec", "norm")).alias("v")).select("id", "v.vec", "v.norm")


def _with_bytes(classes: DataFrame) -> DataFrame:
    """The rows with their vector's bytes as ``raw``."""
    at, names = classes.columns.index("vec"), [*classes.columns, "raw"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = b.column(at).flatten().to_numpy(zero_copy_only=False).astype("<f8").tobytes()
            step = len(data) // max(1, b.num_rows)
            raw = pa.array([data[i:i + step] for i in range(0, len(data), step)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, raw], names=names)
    return classes.mapInArrow(run, T.StructType([*classes.schema.fields, T.StructField("raw", T.BinaryType())]))


def nearest(spark: SparkSession, table: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding",
            k: int = 20, tables: int = TABLES, recall: float = RECALL, target: int = TARGET) -> DataFrame:
    """query_id, rank, id_col, score: the k nearest found of each query row, itself left out."""
    with Scratch(spark, "cross-polytope") as scratch:
        rows = scratch.put(usable(table, id_col, vec_col).withColumn("h", F.xxhash64("vec")), "rows")
        first = Window.partitionBy("h", "vec").orderBy("id")
        classes = (rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
                   .groupBy("h", "vec").agg(F.min("id").alias("cid"), F.sort_array(F.collect_list("id")).alias("ids"), F.max("norm").alias("norm")))
        classes = scratch.put(_with_bytes(classes), "classes")
        n, largest = classes.agg(F.count("*"), F.max("norm")).first()
        if n:
            # a hair above the largest norm: equal norms up to rounding are one range
            band = F.floor((F.log(F.lit(largest)) - F.log("norm") + 1e-6) / float(np.log(RANGE))).cast("int")
            classes = scratch.put(classes.withColumn("band", band), "ranges")
            bands = [r["band"] for r in classes.select("band").distinct().orderBy("band").collect()]
        else:
            return spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score double")
        width = 1 << len(classes.select("vec").first()[0]).bit_length()
        second = 0
        while n / target > 2 * width * max(1, 2 * second) and second < width:
            second = max(1, 2 * second)
        queries = scratch.put(rows.where(is_query(F.col("id"))).join(classes.select("h", "vec", "cid"), ["h", "vec"]).select("id", "cid"), "queries")

        best = Window.partitionBy("q").orderBy(F.desc("score"), "cid")
        spread = max(8, -(-n * tables // BLOCK_ROWS))
        block = F.pmod(F.xxhash64("band", "tab", "bucket", "chunk", "ask"), F.lit(spread)).cast("int").alias("block")

        def part(own: str, count: str):
            return F.pmod(F.xxhash64(own), F.col(count)).cast("int")

        def every(count: str):
            return F.explode(F.sequence(F.lit(0), F.col(count) - 1))
        def score(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            out = [pd.DataFrame({"q": np.zeros(0, np.int64), "cid": np.zeros(0, np.int64), "score": np.zeros(0)})]
            key = ["band", "tab", "bucket", "chunk", "ask"]
            by = rows.groupby(key, sort=False).indices
            for name, at in asked.groupby(key, sort=False).indices.items():
                if name not in by:
                    continue
                own = rows.iloc[by[name]]
                x, ids = np.stack([np.frombuffer(b, "<f8") for b in own["raw"]]), own["cid"].to_numpy()
                ask = asked.iloc[at]
                q = np.stack([np.frombuffer(b, "<f8") for b in ask["raw"]])
                m = min(k + 1, len(x))
                slack = 1e-9 * float(np.sqrt((x * x).sum(1).max() * (q * q).sum(1).max()))
                for lo in range(0, len(q), 256):
                    part_q = q[lo:lo + 256]
                    near = part_q @ x.T
                    # every row that ties with the m-th, to rounding
                    row, col = np.nonzero(near >= -np.partition(-near, m - 1, 1)[:, m - 1:m] - slack)
                    exact = (part_q[row] * x[col]).sum(1)
                    out.append(pd.DataFrame({"q": ask["cid"].to_numpy()[lo:lo + 256][row], "cid": ids[col], "score": exact}))
            return pd.concat(out)

        def scored(indexed: DataFrame, asked: DataFrame) -> DataFrame:
            """(q, cid, score): the best of every bucket for each query that probes it."""
            at = ["band", "tab", "bucket"]
            sizes = (indexed.groupBy(*at).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
                     .join(asked.groupBy(*at).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("asks")), at))
            cols = [*at, "chunk", "ask", "cid", "raw"]
            indexed = indexed.join(sizes, at).withColumn("chunk", part("cid", "chunks")).withColumn("ask", every("asks")).select(block, *cols)
            asked = asked.join(sizes, at).withColumn("ask", part("cid", "asks")).withColumn("chunk", every("chunks")).select(block, *cols)
            met = asked.groupBy("block").cogroup(indexed.groupBy("block")).applyInPandas(score, "q long, cid long, score double")
            top = met.groupBy("q", "cid").agg(F.max("score").alias("score"))
            return top.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).select("q", "cid", "score")

        one = [F.lit(0).alias("band"), F.lit(-1).alias("tab"), F.lit(0).cast("long").alias("bucket"), "cid", "raw"]
        # the probes that a sample of the queries needs
        tried = queries.select("cid").distinct().orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).join(classes.select("cid", "raw"), "cid")
        tried = scratch.put(tried, "sample")
        true = scored(classes.select(*one), tried.select(*one)).where("q <> cid").join(classes.select("cid", "raw"), "cid").select("q", "raw").collect()
        asked_raw = {r["cid"]: r["raw"] for r in tried.collect()}  # SAMPLE vectors, and k + 1 found for each
        order = {q: i for i, q in enumerate(asked_raw)}
        probe = probes_needed(_unit(list(asked_raw.values())), _unit([r["raw"] for r in true]), np.array([order[r["q"]] for r in true]), tables, second, recall) if true else 1

        def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    x = _unit(list(pdf["raw"]))
                    for t in range(tables):
                        yield pd.DataFrame({"band": pdf["band"], "tab": t, "bucket": buckets(x, t, second), "cid": pdf["cid"], "raw": pdf["raw"]})

        def probing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    x = _unit(list(pdf["raw"]))
                    for t in range(tables):
                        p = np.concatenate([probes(x[lo:lo + 256], t, second, probe) for lo in range(0, len(x), 256)])
                        at = np.repeat(np.arange(len(pdf)), p.shape[1])
                        for r in bands:
                            yield pd.DataFrame({"band": r, "tab": t, "bucket": p.ravel(), "cid": pdf["cid"].to_numpy()[at], "raw": pdf["raw"].to_numpy()[at]})

        hashed = "band int, tab int, bucket long, cid long, raw binary"
        indexed = scratch.put(classes.select("cid", "raw", "band").mapInPandas(index, hashed), "index")
        asked = queries.select("cid").distinct().join(classes.select("cid", "raw"), "cid").mapInPandas(probing, hashed)
        # a bucket's rows and the queries that probe it are both cut into blocks
        asked = scratch.put(asked, "probes")
        top = scratch.put(scored(indexed, asked), "top")
        # queries that met too few are compared with all
        few = min(k + 1, n)
        enough = top.groupBy("q").count().where(F.col("count") >= few).select(F.col("q").alias("cid"))
        short = scratch.put(queries.select("cid").distinct().join(enough, "cid", "left_anti").join(classes.select("cid", "raw"), "cid"), "short")
        if short.limit(1).count():
            whole = scored(classes.select(*one), short.select(*one))
            top = scratch.put(top.join(short.select(F.col("cid").alias("q")), "q", "left_anti").unionByName(whole), "top-all")
        # the ids behind the nearest vectors; one more than asked for, as a query meets itself
        ids = (top.join(classes.select("cid", "ids"), "cid").select("q", "score", F.explode("ids").alias("id"))
               .withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).where(F.col("r") <= k + 1))
        found = scratch.put(ids.groupBy("q").agg(F.collect_list(F.struct("r", "id", "score")).alias("l")), "found", keep=True)
        queries = scratch.put(queries, "asked", keep=True)
    own = queries.select(F.col("id").alias("query_id"), F.col("cid").alias("q")).join(found, "q")
    own = own.select("query_id", F.slice(F.filter(F.array_sort("l"), lambda e: e["id"] != F.col("query_id")), 1, k).alias("l"))
    return own.select("query_id", F.posexplode("l").alias("p", "e")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("e.id").alias(id_col), F.col("e.score").alias("score"))
