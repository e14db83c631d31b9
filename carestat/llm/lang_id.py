"""Language identification with a blended-spectrum string kernel.

A text is the set of its character n-grams, n = 1..4, over its lower-cased
letters with every run of other characters as one blank; n-grams are hashed
to DIM slots, so the set is a presence vector. The kernel of two texts is the
size of their sets' intersection over the geometric mean of their sizes.

Nystroem: a bounded sample of labelled texts gives landmarks; a text's
features are its kernel values to them times the inverse root of the
landmarks' kernel matrix. One-versus-rest kernel ridge regression on 0/1
targets is fitted on the sample. The product of landmark presence, inverse
root and ridge weights is one (DIM x languages) matrix, so a batch of texts
is scored by the product of its presence rows with that matrix.

Bounds: PER_LANG labelled texts for each language, the first by a hash of
their id, of at most MAX_LANGS languages, LANDMARKS of them landmarks; prediction
reads every whole text. A letter is a character of a Unicode letter category.

Defined cases: null text or one without a letter is ``und`` with score 0; with
no labelled text at all everything is ``und``; ties go to the language first
in code point order; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, Window

from carestat.llm.common import fresh, keep_ids

ORDERS = (1, 2, 3, 4)
DIM = 1 << 18
PER_LANG = 300
LANDMARKS = 256
MAX_LANGS = 500
RIDGE = 1e-3
_OTHER = re.compile(r"[\W\d_]+")
_BATCH_SLOTS = 1 << 18  # slots of one matrix product, and those of one text
_PIECE = 1 << 20  # characters whose n-grams are formed at a time


def presence(text: str, seen: np.ndarray) -> np.ndarray:
    """Distinct hashed n-gram slots of a text; ``seen`` is a DIM-long work array of zeros, left so."""
    text = " " + _OTHER.sub(" ", text.lower()).strip() + " "
    for at in range(0, len(text), _PIECE):
        part = text[at:at + _PIECE + max(ORDERS) - 1]
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        h = np.zeros(len(code), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            if len(code) < n:
                break
            h = h[:len(code) - n + 1] * np.uint64(0x100000001B3) + code[n - 1:]
            if n in ORDERS:
                seen[((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)] = True
    slots = np.flatnonzero(seen)
    seen[slots] = False
    return slots


def fit(texts: list[str], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE):
    """(languages, DIM x languages weights) from labelled texts."""
    names = sorted(set(langs))
    if not names:
        return [], np.zeros((DIM, 0))
    work = np.zeros(DIM, bool)
    sets = [presence(t, work) for t in texts]
    order = np.random.default_rng(7).permutation(len(texts))
    picked, per = [], max(1, landmarks // len(names))
    for name in names:
        picked += [i for i in order if langs[i] == name][:per]
    slots = np.unique(np.concatenate([sets[i] for i in picked]))  # only these columns are not zero
    column = np.full(DIM, -1, np.int64)
    column[slots] = np.arange(len(slots))
    marks = np.zeros((len(slots), len(picked)), np.float32)
    for r, i in enumerate(picked):
        marks[column[sets[i]], r] = 1.0 / np.sqrt(max(1, len(sets[i])))
    kernel = np.empty((len(sets), len(picked)))
    for r, s in enumerate(sets):
        c = column[s]
        kernel[r] = marks[c[c >= 0]].sum(0) / np.sqrt(max(1, len(s)))
    values, vectors = np.linalg.eigh(kernel[picked])
    root = vectors @ np.diag(np.where(values > 1e-8, 1 / np.sqrt(np.maximum(values, 1e-8)), 0.0)) @ vectors.T
    x = kernel @ root
    y = np.array([[float(a == n) for n in names] for a in langs])
    ridge_w = np.linalg.solve(x.T @ x + ridge * len(x) * np.eye(x.shape[1]), x.T @ y)
    weights = np.zeros((DIM, len(names)))
    weights[slots] = marks @ (root @ ridge_w)
    return names, weights


def product(sets: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """The presence rows of a batch, each over the root of its size, times the weights: a sparse matrix product,
    whose rows are sums of the weights' rows."""
    size = np.array([len(s) for s in sets])
    starts = np.r_[0, np.cumsum(size)[:-1]]
    return np.add.reduceat(weights[np.concatenate(sets)], starts, axis=0) / np.sqrt(size)[:, None]


def labelled_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, may_learn, per_lang: int) -> DataFrame:
    """(lang, text) of up to ``per_lang`` documents of each language, first by a hash of the id."""
    order = F.xxhash64("doc"), F.col("doc")
    dealt = Window.partitionBy("lang", "salt").orderBy(*order)  # a language may hold most rows
    thin = docs.where(may_learn).select(F.col(id_col).alias("doc"), F.col(lang_col).alias("lang")).where("lang is not null and doc is not null").distinct()
    thin = thin.withColumn("salt", F.pmod(F.xxhash64("doc", F.lit(1)), F.lit(256))).withColumn("r", F.row_number().over(dealt)).where(F.col("r") <= per_lang)
    ids = (thin.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("r") <= per_lang)
           .orderBy("r", "lang").limit(MAX_LANGS * per_lang).select("doc").distinct())
    found = docs.where(may_learn).select(F.col(id_col).alias("doc"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return keep_ids(found, ids, "doc").where("lang is not null and text is not null")


def predict(spark: SparkSession, docs: DataFrame, model, text_col: str = "text",
            names_out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` without its text column but with the predicted language and its score."""
    names, weights = model
    shared = spark.sparkContext.broadcast((names, weights.astype(np.float32)))
    rest = [f for f in docs.schema.fields if f.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights = shared.value
        work = np.zeros(DIM, bool)
        for b in batches:
            score = np.zeros((b.num_rows, max(1, len(names))))
            known = np.zeros(b.num_rows, bool)
            held, rows, size = [], [], 0
            for i, text in enumerate(b.column(len(rest)).to_pylist()):
                if names and text and any(map(str.isalpha, text)):
                    held.append(presence(text, work))
                    rows.append(i)
                    size += len(held[-1])
                    if size >= _BATCH_SLOTS:
                        score[rows, :len(names)] = product(held, weights)
                        known[rows] = True
                        held, rows, size = [], [], 0
            if held:
                score[rows, :len(names)] = product(held, weights)
                known[rows] = True
            best = score.argmax(1)
            lang = [names[j] if k else "und" for j, k in zip(best, known)]
            value = np.where(known, np.clip(score[np.arange(len(best)), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(rest))] + [pa.array(lang, pa.string()), pa.array(value)], names=out)
    out = [f.name for f in rest] + list(names_out)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + [f"`{names_out[0]}` string", f"`{names_out[1]}` double"])
    wide = docs.select(*[F.col(f"`{f.name}`") for f in rest], F.col(text_col).cast("string").alias("_text"))
    return wide.mapInArrow(run, schema)


def train(docs: DataFrame, may_learn, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_lang: int = PER_LANG):
    rows = labelled_sample(docs, id_col, text_col, lang_col, may_learn, per_lang).collect()
    rows = sorted({(r["doc"], r["lang"], r["text"]) for r in rows})
    return fit([r[2] for r in rows], [r[1] for r in rows])


def held_out(id_col: str):
    """True for the third of the documents that nothing is learned from."""
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def identify(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document (null id: not held out)."""
    out = F.coalesce(held_out(id_col), F.lit(False))
    model = train(docs, ~out, id_col, text_col, lang_col)
    return predict(spark, docs.select(F.col(id_col).alias("doc_id"), out.alias("held_out"), F.col(text_col).alias("text")), model)


def keep_identified(spark: SparkSession, docs: DataFrame, least_score: float = 0.2) -> DataFrame:
    """``docs`` without documents of no language (``und``) or of a score under ``least_score``."""
    model = train(docs, ~F.coalesce(held_out("doc_id"), F.lit(False)))
    body, lang, score = fresh(docs, "_body", "_lang", "_lang_score")
    both = docs.select("*", F.col("text").alias(body))
    known = predict(spark, both, model, body, (lang, score))
    return known.where(f"`{lang}` <> 'und' and `{score}` >= {least_score}").select(*[F.col(f"`{c}`") for c in docs.columns])
