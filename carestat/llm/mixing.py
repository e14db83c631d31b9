"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target in words. A document's expected number of copies is
its source's target over its source's size; the whole part is certain and the
fraction is a probability. Pivotal rounding pairs fractional documents of a
source and moves word mass between the two, in a random direction that keeps
the expectations, until one is integral. A group of documents leaves one
fractional document at most; these residuals meet again in groups of FAN, and
so on up a tree, until one is left per source. So a source's words miss its
target by less than one document.

Documents are dealt to groups by a seeded hash and each group draws from a
generator seeded with its name: reruns and retried tasks agree.

Defined cases: null text has no words; documents without words are taken once
for each whole copy and never cost mass; a null source is a source of its own
(last in order); a source without words has target 0; an empty table gives an
empty result; equal rows are separate documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from carestat.llm.common import Scratch, fresh, numbered
from carestat.llm.sharding import numbered_copies
from carestat.llm.words import SPACED, text_parts, word_spans

GROUP = 8_192  # documents rounded together in one leaf of the tree
FAN = 1_024  # residuals rounded together in an inner node
SEED = 20_240_229


def word_counts(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc, source, digest, size): words per document; digest tells rows of one id apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.zeros(b.num_rows, np.int64)
            for lo, hi, data, offs in text_parts(b, "text"):
                size[lo:hi] = np.diff(word_spans(data, offs, SPACED)[2])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(size)],
                                             names=["doc", "source", "digest", "size"])
    thin = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(source_col).cast("string").alias("source"),
                       row_digest(docs).alias("digest"), F.col(text_col).cast("string").alias("text"))
    return thin.mapInArrow(run, "doc long, source string, digest long, size long")


def row_digest(docs: DataFrame):
    return F.xxhash64(*[F.col(f"`{c}`").cast("string") if t.startswith("map") else F.col(f"`{c}`") for c, t in docs.dtypes])


def source_targets(counts: DataFrame, scratch: Scratch, max_copies: float = 3.0) -> DataFrame:
    """(source, n, source_size, target): the total size shared by weights 1, 2, 3,
    1, ... over the sources in code point order, no target above ``max_copies``
    times its source; what is above is shared again by weight."""
    sources = counts.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    sources = scratch.put(numbered(sources, [F.asc_nulls_last("source")], scratch, "ranked")
                          .withColumn("weight", F.col("row_no") % 3 + 1.0), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, cap = 0.0, F.col("source_size") * float(max_copies)
    while total:
        full = cap < F.lit(level) * F.col("weight")
        full_sum, free = sources.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(~full, F.col("weight")).otherwise(0.0))).first()
        if not free:
            break
        now = (total - full_sum) / free
        if now <= level * (1 + 1e-12):
            break
        level = now
    return sources.select("source", "n", "source_size", F.least(cap, F.lit(level) * F.col("weight")).alias("target"))


def _pivot(mass: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Round masses in 0..size; at most one stays strictly between, and every
    mass keeps its expectation.

    From the largest on, a document is paired with all smaller open ones at
    once: it rises to its size or falls to 0, with the chances that keep its
    expectation, and each partner takes up a fixed share of the move. Shares
    follow w (s - w) / s, so a move of up to their sum V leaves every partner
    within 0..s. Documents whose move would exceed V are then paired one by
    one. So what stays open in the end is small.
    """
    order = rng.permutation(len(mass))
    order = order[np.argsort(-size[order], kind="stable")]
    w, s, draws = mass[order].astype(float), size[order].astype(float), rng.random((2, len(mass)))

    def settle(x: float, y: float) -> float:
        return 0.0 if x <= 1e-9 * y else y if x >= y * (1 - 1e-9) else x

    late = []
    for i in range(len(w)):
        w[i] = settle(w[i], s[i])
        if not 0 < w[i] < s[i]:
            continue
        rest, full = w[i + 1:], s[i + 1:]
        share = rest * (full - rest) / np.maximum(full, 1e-300)
        total = share.sum()
        if max(w[i], s[i] - w[i]) > total:
            late.append(i)
            continue
        rise = draws[0, i] * s[i] < w[i]
        move = s[i] - w[i] if rise else -w[i]
        rest -= share * (move / total)
        w[i] = s[i] if rise else 0.0
    held = -1
    for j in late:
        w[j] = settle(w[j], s[j])
        if not 0 < w[j] < s[j]:
            continue
        if held >= 0:
            up, down = min(s[held] - w[held], w[j]), min(w[held], s[j] - w[j])
            move = up if draws[1, j] * (up + down) < down else -down
            w[held], w[j] = settle(w[held] + move, s[held]), settle(w[j] - move, s[j])
        held = next((x for x in (held, j) if x >= 0 and 0 < w[x] < s[x]), -1)
    out = np.empty(len(w))
    out[order] = w
    return out


ROWS = "doc long, digest long, source string, source_size long, target double, size long, base long, mass double, node long"


def _round_node(level: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc", "digest", "size", "mass"], ignore_index=True, na_position="last")
        name = pd.util.hash_array(np.array([f"{pdf.source[0]!r}"], object))[0] & 0xFFFFFFFF
        rng = np.random.default_rng([SEED, level, int(name), int(pdf.node[0])])
        return pdf.assign(mass=_pivot(pdf["mass"].to_numpy(float), pdf["size"].to_numpy(float), rng))
    return run


def mixed(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", max_copies: float = 3.0) -> DataFrame:
    """One row per document: doc, digest, source, source_size, target, size, copies."""
    with Scratch(spark, "mixing") as scratch:
        counts = scratch.put(word_counts(docs, id_col, text_col, source_col), "counts")
        targets = scratch.put(source_targets(counts, scratch, max_copies), "targets")
        copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        # both sides are hashed on (source, salt), so a source with a third of the rows spreads out
        salts = 64
        spread = targets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        leaf = F.pmod(F.xxhash64("doc", "digest", "copy", F.lit(SEED)), F.ceil(F.col("n") / GROUP))
        # equal rows are numbered, so that they are dealt to leaves like others
        each = numbered_copies(counts).select("record.*", "copy")
        rows = (each.withColumn("salt", F.pmod(F.xxhash64("doc", "digest", "copy"), F.lit(salts)).cast("int")).alias("c")
                .join(spread.alias("t"), F.expr("c.source <=> t.source and c.salt = t.salt"))
                .select("c.doc", "c.digest", "c.copy", "c.source", "t.source_size", "t.target", "c.size", "t.n")
                .withColumn("copies", copies).withColumn("base", F.floor("copies").cast("long"))
                .select("doc", "digest", "source", "source_size", "target", "size", "base",
                        ((F.col("copies") - F.col("base")) * F.col("size")).alias("mass"), leaf.cast("long").alias("node")))
        open_, level, done = rows, 0, []
        widest = targets.agg(F.max(F.ceil(F.col("n") / GROUP))).first()[0] or 0
        while True:
            state = scratch.put(open_.groupBy("source", "node").applyInPandas(_round_node(level), ROWS), f"level-{level}", keep=True)
            whole = F.expr("mass = 0 or mass = size")
            if widest <= 1:
                last = F.when(F.pmod(F.xxhash64("doc", "digest", F.lit(SEED + 1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
                              < F.col("mass") / F.col("size"), F.col("size").cast("double")).otherwise(F.lit(0.0))
                done.append(state.withColumn("mass", F.when(whole, F.col("mass")).otherwise(last)))
                break
            done.append(state.where(whole))
            open_ = state.where(~whole).withColumn("node", F.floor(F.col("node") / FAN).cast("long"))
            widest, level = -(-widest // FAN), level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    extra = F.when((F.col("size") > 0) & (F.col("mass") > 0), 1).otherwise(0)
    return out.select("doc", "digest", "source", "source_size", "target", "size", (F.col("base") + extra).alias("copies"))


def repeat_rows(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it (not at all included)."""
    plan = mixed(spark, docs, id_col, text_col, source_col)
    doc, none, digest, copies, copy = fresh(docs, "_doc", "_none", "_digest", "_copies", "_copy")
    # both sides are grouped by the columns that they are joined by (a null id is its own key), so texts are shuffled once
    key = {doc: lambda c: F.coalesce(c, F.lit(0).cast("long")), none: lambda c: c.isNull()}
    plan = (plan.select(*[made(F.col("doc")).alias(k) for k, made in key.items()], F.col("digest").alias(digest), F.col("copies").alias(copies))
            .groupBy(doc, none, digest).agg(F.sum(copies).cast("int").alias(copies)).where(f"`{copies}` > 0"))
    keyed = docs.withColumn(digest, row_digest(docs)).withColumns({k: made(F.col(id_col).cast("long")) for k, made in key.items()})
    return (keyed.dropDuplicates([doc, none, digest]).join(plan, [doc, none, digest])
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
            .select(*docs.columns))
