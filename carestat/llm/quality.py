"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades 0 < 1 < ... < G - 1 share one weight vector over hashed text features:
P(grade > j) = sigmoid(w . x - threshold_j) with increasing thresholds. Scores
are the expected grade and the tail probability P(grade >= keep_from); a
document is kept when the tail probability reaches KEEP.

Features are presence of a text's words (lower case, without surrounding
signs), its word shapes (letters a/A, digits 0, runs shortened) and the share
of each shape, so a text of any length is read whole and a word counts once.

Bounds: up to LABELLED labelled documents, first by a hash of their id, are
read to fit (their features, not their texts, reach the driver).

Defined cases: null text is empty; a text without words scores by thresholds
alone; without any labelled row every document has tail probability 1 and is
kept; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from carestat.llm.common import keep_ids

BITS = 18
LABELLED = 8_000
KEEP = 0.5
SHAPE = 16.0  # value of a shape that all words have; a word present has 1
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_RULES = ((re.compile(r"[^\W\d_]+"), lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "a"), (re.compile(r"\d+"), "0"), (re.compile(r"(.)\1+"), r"\1"))
_cache: dict[str, tuple[int, int]] = {}


def _slots(word: str) -> tuple[int, int]:
    """Hashed slots of a word and of its shape."""
    found = _cache.get(word)
    if found is None:
        if len(_cache) > 400_000:
            _cache.clear()
        bare, shape = _EDGE.sub("", word).lower(), word
        for rule, by in _RULES:
            shape = rule.sub(by, shape)
        found = (crc32(b"w" + bare.encode()) >> (32 - BITS), crc32(b"s" + shape[:12].encode()) >> (32 - BITS))
        if len(word) <= 40:
            _cache[word] = found
    return found


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values): 1 for each word present, share of words for each shape."""
    words = Counter((text or "").split())
    total = sum(words.values())
    out: dict[int, float] = {}
    for word, n in words.items():
        a, b = _slots(word)
        out[a] = max(out.get(a, 0.0), 1.0)
        out[b] = out.get(b, 0.0) + SHAPE * n / total
    return np.fromiter(out, np.int64, len(out)), np.fromiter(out.values(), float, len(out))


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(slots: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray, levels: int, prior: float = 1.0,
        steps: int = 250, least_docs: int = 5):
    """(weights, thresholds) of the most likely cumulative-link model under a normal
    prior of precision ``prior`` on each weight, by Adam."""
    n = len(grades)
    w = np.zeros(1 << BITS)
    if not n:
        return w, np.full(levels - 1, -50.0)
    row, col, val = np.repeat(np.arange(n, dtype=np.int32), [len(s) for s in slots]), np.concatenate(slots), np.concatenate(values)
    used, col, seen = np.unique(col, return_inverse=True, return_counts=True)
    known = seen >= least_docs  # rarer features only tell single documents apart
    keep, renumber = known[col], np.cumsum(known) - 1
    row, col, val, used = row[keep], renumber[col[keep]], val[keep], used[known]
    # features are scaled by how much their frequency differs below and above a threshold,
    # so that the many that tell nothing get little weight
    scale = np.zeros(len(used))
    for j in range(levels - 1):
        rate = [(np.bincount(col[high[row]], minlength=len(used)) + 0.5) / (high.sum() + 1) for high in (grades <= j, grades > j)]
        scale = np.maximum(scale, np.abs(np.log(rate[0] / rate[1])))
    val = val * scale[col]
    tail = np.clip([(grades > j).mean() for j in range(levels - 1)], 1e-3, 1 - 1e-3)
    start = -np.log(tail / (1 - tail))
    gaps = np.r_[start[0], np.log(np.maximum(1e-2, np.diff(start)))]
    p = np.r_[np.zeros(len(used)), gaps]
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        weights, g = p[:len(used)], p[len(used):]
        cuts = np.cumsum(np.r_[g[0], np.exp(g[1:])])
        z = np.bincount(row, weights[col] * val, n)
        edge = np.concatenate([[-np.inf], cuts, [np.inf]])
        hi, lo = _sigmoid(edge[grades + 1] - z), _sigmoid(edge[grades] - z)
        prob = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / prob, lo * (1 - lo) / prob
        dz = (d_hi - d_lo) / n
        d_cut = np.zeros(levels + 1)
        np.add.at(d_cut, grades + 1, -d_hi / n)
        np.add.at(d_cut, grades, d_lo / n)
        d_cut = d_cut[1:-1]
        d_gap = np.cumsum(d_cut[::-1])[::-1] * np.r_[1.0, np.exp(g[1:])]
        grad = np.r_[np.bincount(col, dz[row] * val, len(used)) + prior / n * weights, d_gap]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        p -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    w[used] = p[:len(used)] * scale
    return w, np.cumsum(np.r_[p[len(used)], np.exp(p[len(used) + 1:])])


def train(docs: DataFrame, ratings: DataFrame, levels: int, id_col: str = "doc_id", text_col: str = "text", bound: int = LABELLED):
    """Fit on documents rated in ``ratings`` (id_col, grade)."""
    rated = ratings.where(f"`{id_col}` is not null and grade is not null").groupBy(id_col).agg(F.min("grade").alias("grade"))
    rated = rated.orderBy(F.xxhash64(id_col), id_col).limit(bound)
    texts = keep_ids(docs.select(id_col, F.col(text_col).cast("string").alias("_text")), rated.select(id_col), id_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            f = [features(t) for t in pdf["_text"]]
            yield pd.DataFrame({"id": pdf[id_col], "slots": [a for a, _ in f], "vals": [b for _, b in f]})
    made = texts.mapInPandas(run, "id long, slots array<int>, vals array<float>")
    got = made.join(F.broadcast(rated.select(F.col(id_col).alias("id"), "grade")), "id").toPandas().sort_values("id", ignore_index=True)
    return fit([np.asarray(s, np.int32) for s in got["slots"]], [np.asarray(v, np.float32) for v in got["vals"]],
               got["grade"].to_numpy(np.int64), levels)


def grade(spark: SparkSession, docs: DataFrame, model, keep_from: int, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """id_col, expected_grade, tail_probability, keep for every document."""
    shared = spark.sparkContext.broadcast(model)
    kind = docs.select(id_col).dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, cuts = shared.value
        for b in batches:
            z = np.zeros(b.num_rows)
            for i, text in enumerate(b.column(1).to_pylist()):
                s, v = features(text)
                z[i] = (w[s] * v).sum()
            above = _sigmoid(z[:, None] - cuts[None, :])
            tail = above[:, keep_from - 1]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(above.sum(1)), pa.array(tail), pa.array(tail >= keep)],
                                             names=[id_col, "expected_grade", "tail_probability", "keep"])
    return docs.select(id_col, F.col(text_col).cast("string").alias("_text")).mapInArrow(
        run, f"`{id_col}` {kind}, expected_grade double, tail_probability double, keep boolean")


def label_grades(labels: DataFrame) -> DataFrame:
    """Grades of the labels table: 0 toxic, 1 of low quality, 2 good."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2).alias("grade"))
