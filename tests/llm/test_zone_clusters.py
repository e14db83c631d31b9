import hashlib

import numpy as np
import pytest

from carestat.llm import zone_clusters as zc

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, id long, vec string, cluster int, key string"


def _plain(rows, k=8, rounds=10, dims=64):
    """Lloyd's rounds in Python ints."""
    kept = [(i, [int(np.floor(np.float64(x) * 1024)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    centroids = [q for _, q in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    far = lambda q, c: sum((a - b) ** 2 for a, b in zip(q, c))
    nearest = lambda: [min((far(q, c), j) for j, c in enumerate(centroids)) for _, q in kept]
    for _ in range(rounds):
        at = [j for _, j in nearest()]
        for j in range(len(centroids)):
            mine = [q for (_, q), a in zip(kept, at) if a == j]
            if mine:
                centroids[j] = [sum(col) // len(mine) for col in zip(*mine)]
    last = nearest()
    inertia = [sum(d for d, a in last if a == j) for j in range(len(centroids))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, j, d, inertia[j], sum(inertia), shas[j]) for (i, _), (d, j) in zip(kept, last)]


def _key(row):
    return tuple((v is not None, v or 0) if not isinstance(v, str) else v for v in row)


def _check(spark, table):
    want = _plain([(r.vec_id, r.embedding) for r in table.collect()])
    got = [tuple(r) for r in zc.clustered(spark, table).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()]
    assert sorted(got, key=_key) == sorted(want, key=_key)


def _edge_rows():
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 64).tolist()) for i in range(50)]
    rows += [(i, [float(i % 3)] * 64) for i in range(100, 700)]  # large groups of one vector
    rows += [(700, None), (701, []), (702, [1.0] * 63), (703, [1.0] * 65), (704, [None] + [1.0] * 63), (705, [float("nan")] * 64),
             (706, [float("inf")] + [0.0] * 63), (707, [0.0] * 64), (708, [-0.0] * 64), (None, [0.5] * 64), (None, [0.5] * 64), (5, [9.0] * 64),
             (709, [5000.25] * 64), (710, [-1e6] * 64)]
    return rows


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, v, 1, "clash", 2, "k") for i, v in _edge_rows()], SCHEMA).repartition(3)


def test_clusters_match_plain_rounds(spark, edge):
    _check(spark, edge)
    _check(spark, spark.read.parquet(f"{SMALL}/embeddings.parquet"))


def test_few_and_no_vectors(spark, edge):
    _check(spark, edge.where("vec_id in (0, 1, 700, 707)"))
    assert zc.clustered(spark, edge.where("vec_id = 700")).count() == 0
    assert zc.clustered(spark, edge.limit(0)).count() == 0


def test_numbers_beyond_machine_words(spark):
    rows = [(i, [s * 1e300] + [0.0] * 63, 0, "", 0, "") for i, s in enumerate((1, -1, 1, -1, 0, 0, 1, 0, -1, 1, 1))]
    got = zc.clustered(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 11 and max(r.inertia for r in got) <= zc.LONG


def test_box_bounds_hold_every_distance():
    rng = np.random.default_rng(1)
    for scale in (10, 10**5, 10**9, 1 << 61):
        q, c = (rng.integers(-scale, scale, (n, 5)) for n in (40, 6))
        near, far = zc.box_bounds(q.min(axis=0), q.max(axis=0), c)
        d = zc.distances(q, c)
        assert [[int(v) for v in row] for row in d] == [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w)) for w in c] for v in q]
        assert (d >= near).all() and (d <= far).all()
        for q in (q, q[:1], q[:2], np.vstack([c[:1], c[:1]])):
            d = zc.distances(q, c)
            able, at = zc.assigned(q, q.min(axis=0), q.max(axis=0), c)
            assert (at == d.argmin(axis=1)).all() and set(at) <= set(able)


def test_hilbert_neighbours_touch():
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = [k.tobytes() for k in zc.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(keys)
        walk = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_boxes_rule_centroids_out(spark):
    """Plane points: hardly any block needs all centroids. (On evenly spread 64-component vectors all are needed.)"""
    rng = np.random.default_rng(2)
    rows = [(i, rng.uniform(0, 9, 2).tolist(), 0, "", 0, "") for i in range(6000)]
    table = spark.createDataFrame(rows, SCHEMA)
    got, centroids, compared = zc.clusters(spark, table, dims=2, block=32)
    assert compared[-1] < 3  # of 8
    want = _plain([(r[0], r[1]) for r in rows], dims=2)
    assert {(r.id, r.cluster, r.distance) for r in got.collect()} == {w[:3] for w in want}
