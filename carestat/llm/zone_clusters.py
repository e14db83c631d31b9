"""Centroid clustering over space-filling-curve zone maps.

Vectors become integers, floor(SCALE x). They are sorted by their place on a
Hilbert curve (through the CURVE_DIMS components of largest variance, BITS bits
each, from mean - 2 to mean + 2 standard deviations) and packed into blocks of
BLOCK neighbours with their componentwise least and largest values. In a round a
block's box gives every centroid a least and a largest possible distance; only
centroids whose least is within the smallest largest, and that no other beats at every corner of the box, are
compared with the block's vectors, in one matrix product. A block with one candidate is taken as a
whole. The bounds and the distances are exact integers, so the blocks' order and
size change the speed only, never a result.

A round is one pass over the written blocks: every task gives its sums by
centroid and component, which are added up before they reach the driver (k times
the components, whatever the table's size), and the next centroids are their
exact floors. Rounds stop early once the centroids stay as they are, since then
all later ones are the same.

Sorting is by (place, row number of the task that read it), so vectors of one
place, or copies of one vector, are split over tasks like any others.

Defined cases: vectors that are null, of another length, or hold null or
non-finite components take no part; components beyond 2^62 after scaling are
held at it and distances at 2^63 - 1; equal vectors and repeated ids are rows of
their own; a null id hashes as the empty text and is given back as null; fewer
rows than centroids give as many centroids as rows, equal hashes ordered by
vector; extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from carestat.llm.common import Scratch

DIMS = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
BLOCK = 256
CURVE_DIMS = 16
BITS = 4
LIMIT = 1 << 62
LONG = (1 << 63) - 1


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells (n, d) of 0..2^bits - 1, as big-endian bytes (n, ceil(d bits / 8))."""
    x = cells.T.astype(np.uint32)
    q = np.uint32(1 << bits - 1)
    while q > 1:  # undo the rotations of the finer levels
        low = q - np.uint32(1)
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, np.uint32(0)) ^ swap
            x[i] ^= swap
        q >>= np.uint32(1)
    for i in range(1, len(x)):  # Gray code
        x[i] ^= x[i - 1]
    flip, q = np.zeros_like(x[0]), np.uint32(1 << bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - np.uint32(1), np.uint32(0))
        q >>= np.uint32(1)
    x ^= flip
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def quantised(values: pa.Array, dims: int, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Rows that hold a full finite vector, and their integers (m, dims) as int64."""
    values = values.cast(pa.large_list(pa.float64()))
    flat = values.flatten() if len(values) else pa.array([], pa.float64())
    length = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(values), -1))
    ends = np.cumsum(np.maximum(length, 0))
    parts = np.nan_to_num(flat.to_numpy(zero_copy_only=False), nan=np.nan, posinf=np.nan, neginf=np.nan)  # null: nan
    rows = np.flatnonzero(length == dims)
    if not len(rows):
        return rows, np.zeros((0, dims), np.int64)
    x = parts[(ends[rows] - dims)[:, None] + np.arange(dims)]
    whole = np.isfinite(x).all(axis=1)
    with np.errstate(over="ignore"):
        q = np.floor(x[whole] * float(scale))
    return rows[whole], np.clip(q, -float(LIMIT), float(LIMIT)).astype(np.int64)


def _packed(q: np.ndarray) -> tuple[bytes, int]:
    """A block's integers in the narrowest of 2, 4 and 8 bytes."""
    width = 2 if (np.abs(q) < 1 << 15).all() else 4 if (np.abs(q) < 1 << 31).all() else 8
    return q.astype(f"<i{width}").tobytes(), width


def box_bounds(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact least and largest squared distance of each centroid to any vector of a box (Python ints where they may not fit)."""
    kind = _kind(max(_largest(low), _largest(high), _largest(centroids)), low.shape[-1])
    lo, hi, c = low.astype(kind), high.astype(kind), centroids.astype(kind)
    near = np.maximum(np.maximum(lo - c, c - hi), kind(0) if kind is not object else 0)
    far = np.maximum(np.abs(c - lo), np.abs(hi - c))
    return (near * near).sum(axis=1), (far * far).sum(axis=1)


def _beaten(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Centroids that the one nearest the box's middle beats at every point of the box. The difference of two
    squared distances is linear in the point, so its least value is at a corner."""
    kind = _kind(max(_largest(low), _largest(high), _largest(centroids)), low.shape[-1])
    lo, hi, c = low.astype(kind), high.astype(kind), centroids.astype(kind)
    best = int(np.square((c - lo).astype(float) + (c - hi).astype(float)).sum(axis=1).argmin())
    apart = c - c[best]
    least = (c * c).sum(axis=1) - (c[best] * c[best]).sum() - 2 * np.where(apart > 0, apart * hi, apart * lo).sum(axis=1)
    out = (least > 0) | ((least == 0) & (np.arange(len(c)) > best))
    out[best] = False
    return out


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0


def _kind(largest: int, dims: int) -> type:
    """A number type in which squared distances, and the terms they are made of, are exact."""
    most = 4 * largest * largest * max(dims, 1)
    return np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object


def distances(q: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (m, c)."""
    kind = _kind(max(_largest(q), _largest(centroids)), q.shape[1])
    v, c = q.astype(kind), centroids.astype(kind)
    if kind is object:
        return np.array([[sum(int(a) ** 2 for a in row - one) for one in c] for row in v], object).reshape(len(v), len(c))
    return (v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)


def assigned(q: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of the block, and each vector's nearest centroid (ties: the smaller number)."""
    near, far = box_bounds(low, high, centroids)
    able = np.flatnonzero(near <= far.min())
    able = able[~_beaten(low, high, centroids[able])]
    if len(able) == 1:
        return able, np.full(len(q), able[0])
    return able, able[np.argmin(distances(q, centroids[able]), axis=1)]


# ---- zone maps

def _spread(embeddings: DataFrame, dims: int, scale: int) -> np.ndarray:
    """Mean and deviation by component, (2, dims): only the curve uses them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, one, two = 0, np.zeros(dims), np.zeros(dims)
        for b in batches:
            q = quantised(b.column(0), dims, scale)[1].astype(float)
            n, one, two = n + len(q), one + q.sum(axis=0), two + (q * q).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([list(one)]), pa.array([list(two)])], names=["n", "one", "two"])
    sums = embeddings.mapInArrow(run, "n long, one array<double>, two array<double>")
    total = sums.select("n", F.posexplode(F.arrays_zip("one", "two")).alias("i", "s")).groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("s.one").alias("one"), F.sum("s.two").alias("two")).orderBy("i").collect()
    if not total:
        return np.zeros((2, dims))
    n, one, two = (np.array([r[c] for r in total], float) for c in ("n", "one", "two"))
    return np.stack([one / n, np.sqrt(np.maximum(two / n - (one / n) ** 2, 0))])


_ROWS = "id long, key binary, vec binary, width int"
_BLOCKS = "ids array<long>, vec binary, width int, low array<long>, high array<long>"


def zone_map(vectors: DataFrame, scratch: Scratch, dims: int, scale: int, block: int = BLOCK) -> DataFrame:
    """Blocks (ids, vec, width, low, high) of (id, vec) rows, neighbours on the curve together."""
    mean, dev = _spread(vectors.select("vec"), dims, scale)
    curve = np.argsort(-dev, kind="stable")[:CURVE_DIMS]
    start, cell = mean[curve] - 2 * dev[curve], np.maximum(4 * dev[curve] / (1 << BITS), 1e-9)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, q = quantised(b.column(1), dims, scale)
            if len(rows):
                cells = np.clip((q[:, curve] - start) / cell, 0, (1 << BITS) - 1)
                keys = hilbert_keys(cells, BITS)
                raw, width = _packed(q)
                step = width * dims
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows)), pa.array([k.tobytes() for k in keys], pa.binary()),
                     pa.array([raw[i:i + step] for i in range(0, len(raw), step)], pa.binary()), pa.array(np.full(len(rows), width, np.int32))],
                    names=["id", "key", "vec", "width"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, vecs, widths = b.column(0), b.column(2).to_pylist(), b.column(3).to_numpy()
            out = []
            for lo in range(0, len(vecs), block):
                q = np.stack([np.frombuffer(v, f"<i{w}").astype(np.int64) for v, w in zip(vecs[lo:lo + block], widths[lo:lo + block])])
                raw, width = _packed(q)
                out.append((ids.slice(lo, block).to_pylist(), raw, width, q.min(axis=0).tolist(), q.max(axis=0).tolist()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.list_(pa.int64()), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())))], names=["ids", "vec", "width", "low", "high"])

    rows = vectors.mapInArrow(keyed, _ROWS).withColumn("_row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("key", "_row").sortWithinPartitions("key", "_row").select("id", "key", "vec", "width")
    return scratch.put(rows.mapInArrow(packed, _BLOCKS), "blocks")


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple]:
    """(ids, vectors, low, high) of each block."""
    for b in batches:
        for i in range(b.num_rows):
            width = b.column(2)[i].as_py()
            q = np.frombuffer(b.column(1)[i].as_buffer(), f"<i{width}").astype(np.int64).reshape(-1, dims)
            yield b.column(0)[i].values, q, b.column(3)[i].values.to_numpy(), b.column(4)[i].values.to_numpy()


def _sums(blocks: DataFrame, centroids: np.ndarray, dims: int) -> tuple[dict[int, tuple[int, list[int]]], int, int]:
    """Count and exact component sums by centroid; vectors and the candidates compared with them."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, exact, part, room, work = [0] * k, np.zeros((k, dims), object), np.zeros((k, dims), np.int64), LONG, 0
        for _, q, low, high in _blocks(batches, dims):
            able, at = assigned(q, low, high, centroids)
            work += len(q) * len(able)
            need = _largest(q) * len(q)
            if need > room:
                exact, part, room = exact + part.astype(object), np.zeros((k, dims), np.int64), LONG
            for c in able:
                mine = at == c
                count[c] += int(mine.sum())
                if need > LONG:
                    exact[c] += q[mine].astype(object).sum(axis=0) if mine.any() else 0
                else:
                    part[c] += q[mine].sum(axis=0)
            room -= min(need, room)
        exact = exact + part.astype(object)
        rows = [(c, d, str(exact[c][d]), count[c], work if c == d == 0 else 0) for c in range(k) for d in range(dims) if count[c] or c == d == 0]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                                         names=["c", "d", "total", "n", "work"])
    parts = blocks.mapInArrow(run, "c int, d int, total string, n long, work long")
    got = parts.groupBy("c", "d").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"), F.sum("work").alias("work")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in got:
        if r["n"]:
            out.setdefault(r["c"], (r["n"], [0] * dims))[1][r["d"]] = int(r["total"])
    return out, sum(n for n, _ in out.values()), sum(r["work"] for r in got)


def first_centroids(vectors: DataFrame, k: int, dims: int, scale: int) -> np.ndarray:
    """The vectors of the k smallest sha256 of "3:<id>", in hash order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, q = quantised(b.column(1), dims, scale)
            if len(rows):
                hashes = [hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest() for i in b.column(0).take(pa.array(rows)).to_pylist()]
                order = sorted(range(len(rows)), key=lambda j: (hashes[j], tuple(q[j])))[:k]
                yield pa.RecordBatch.from_arrays([pa.array([hashes[j] for j in order]), pa.array([q[j].tolist() for j in order], pa.list_(pa.int64()))], names=["h", "q"])
    low = vectors.mapInArrow(run, "h string, q array<long>").orderBy("h", "q").limit(k).collect()
    return np.array([r["q"] for r in low], np.int64).reshape(len(low), dims)


def clusters(spark: SparkSession, embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = CENTROIDS,
             rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, block: int = BLOCK) -> tuple[DataFrame, np.ndarray, list[float]]:
    """(id, cluster, distance) of every vector that takes part, the last centroids, and each round's candidates per vector."""
    vectors = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    with Scratch(spark, "clusters") as scratch:
        centroids = first_centroids(vectors, k, dims, scale)
        blocks, compared = zone_map(vectors, scratch, dims, scale, block), []
        for _ in range(rounds if len(centroids) else 0):
            sums, n, work = _sums(blocks, centroids, dims)
            compared.append(work / max(n, 1))
            moved = centroids.copy()
            for c, (count, total) in sums.items():
                moved[c] = [t // count for t in total]
            if (moved == centroids).all():
                break
            centroids = moved

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, q, low, high in _blocks(batches, dims):
                at = assigned(q, low, high, centroids)[1]
                d = np.zeros(len(q), np.int64)
                for c in np.unique(at):
                    mine = np.flatnonzero(at == c)
                    d[mine] = [min(int(v), LONG) for v in distances(q[mine], centroids[c:c + 1])[:, 0]]
                yield pa.RecordBatch.from_arrays([ids, pa.array(at.astype(np.int32)), pa.array(d)], names=["id", "cluster", "distance"])
        out = scratch.put(blocks.mapInArrow(run, "id long, cluster int, distance long"), "assigned", keep=True)
    return out, centroids, compared


def clustered(spark: SparkSession, embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    rows, centroids, _ = clusters(spark, embeddings, id_col, vec_col)
    shas = [(c, hashlib.sha256(",".join(str(int(v)) for v in row).encode()).hexdigest()) for c, row in enumerate(centroids)]
    total = lambda c: F.least(F.sum(F.col(c).cast("decimal(38,0)")), F.lit(LONG)).cast("long")
    own = rows.groupBy("cluster").agg(total("distance").alias("cluster_inertia"))
    every = int(own.agg(total("cluster_inertia").alias("inertia")).first()[0] or 0)
    names = spark.createDataFrame(shas, "cluster int, centroid_sha256 string")  # a row a centroid, as are the sums
    return (rows.join(F.broadcast(own), "cluster").join(F.broadcast(names), "cluster").withColumn("inertia", F.lit(every).cast("long"))
            .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
