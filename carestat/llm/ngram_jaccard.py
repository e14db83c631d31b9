"""N-gram Jaccard self-join by universe partition and the pigeonhole principle.

A document is the set of its distinct k-word shingles. Two documents link
when their sets' Jaccard similarity reaches ``percent`` / 100. Such sets
differ in at most H elements, H known from the larger set's size band. The
universe of shingles is hashed into segments; a segment compared by its whole
subset earns one credit, one compared by its subset or that subset less one
element (one-deletion neighbourhood) earns two. With H + 1 credits at least
one segment of a linked pair must meet, so pairs that meet nowhere are safe
to skip. How many segments of either kind a band uses is set by an estimated
cost from the number of sets in the band (``allocate``).

Segments that are empty on both sides would meet trivially and are not
indexed. Each band has ``slack`` further credits to make up for them; the few
sets that lose more than that are met under one key of their own.

Every candidate is verified on the exact sets. A bucket of documents that
share a key is compared with its smallest member first. Members that end in
different components then face one another, but only pairs that can still
link: sets with too many elements that no other open set has are left out,
and of two sets that first met the same set (their star) only those that
share an element which the star has not, or whose differences from the star
are small enough without one. So no
pair within a group of copies is expanded, and no link between components is
lost.

Defined cases: null or empty text is the empty set and links with nothing; a
text with fewer than k words is one shingle; a null id gets a null component;
repeated ids are one node and give one result row per input row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from carestat.llm.common import Scratch, components, keep_ids
from carestat.llm.words import SPACED, documents_words, mix, shingles, signed

_U = np.uint64
INDEX_KEYS = 400_000  # keys that a task holds at a time, and those of one set
PAIR_ROWS = 1_000  # pairs whose texts are taken out of an Arrow batch together
KEY_BITS = 48  # of an index key: keys that agree by chance cost a comparison, never a link
SHARED = 0.05  # assumed share of a set's elements that an unrelated set of its band also has


def band_edges(percent: int, largest: int) -> list[int]:
    """First sizes of the bands; a set links only into its own or a neighbouring band."""
    edges = [1]
    while edges[-1] <= max(1, largest):
        edges.append(edges[-1] * 100 // percent + 1)
    return edges


def max_difference(percent: int, a: int, b: int) -> int:
    """Largest symmetric difference of linked sets of sizes a and b."""
    return (100 - percent) * (a + b) // (100 + percent)


def allocate(percent: int, lo: int, hi: int, sets: int) -> tuple[int, int, int]:
    """(one-deletion segments, whole-subset segments, slack) for larger sets of lo..hi elements.

    Cost of a choice: rows indexed per set, times one plus the unrelated sets
    of the band expected to share a segment's subset.
    """
    need = max_difference(percent, hi, hi) + 1
    if need == 1:
        return 0, 1, 0
    best = None
    for dele in range(need // 2 + 1):
        whole, slack = need - 2 * dele, 0
        for _ in range(3):
            size = lo / max(1, dele + whole + slack)
            lost = (whole + slack) * math.exp(-size) + 2 * dele * (1 + size) * math.exp(-size)
            slack = 0 if dele + whole == 1 else math.ceil(lost + 4 * math.sqrt(lost) + 1)
        segments = dele + whole + slack
        size = hi / segments
        cost = (whole + slack + dele * (1 + size)) * (1 + sets * SHARED ** size)
        if best is None or cost < best[0]:
            best = cost, dele, whole + slack, slack
    return best[1:]


def signatures(shingle: np.ndarray, band: int, dele: int, whole: int, slack: int) -> np.ndarray:
    """Keys under which a set is indexed in one band."""
    segments = dele + whole
    h = mix(shingle ^ _U(0xA5A5A5A5 + band))
    seg = (h % _U(segments)).astype(np.int64)
    body = mix(h)
    low, high = body & _U(0xFFFFFFFF), body >> _U(32)
    count = np.bincount(seg, minlength=segments)
    key = (np.bincount(seg, low.astype(np.float64), segments).astype(_U)
           + (np.bincount(seg, high.astype(np.float64), segments).astype(_U) << _U(32)))
    salt = mix(np.arange(segments, dtype=_U) + _U((band + 1) << 32))
    out = [mix(key ^ salt)[count > 0]]
    if dele:
        cut = (seg < dele) & (count[seg] > 1)
        out.append(mix((key[seg[cut]] - body[cut]) ^ salt[seg[cut]]))
    if int((count[dele:] == 0).sum() + 2 * (count[:dele] <= 1).sum()) > slack:
        out.append(mix(np.array([band], _U) ^ _U(0x7417)))
    return np.unique(np.concatenate(out))


def set_digests(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(doc, n, fp1, fp2): set size and a 128-bit digest of each document's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, f1, f2 = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, _U), np.zeros(b.num_rows, _U)
            for i, w, *_ in documents_words(b, "text", SPACED):
                s = shingles(w, k)
                n[i], f1[i], f2[i] = len(s), s.sum(), mix(s ^ _U(77)).sum()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(signed(f1)), pa.array(signed(f2))],
                                             names=["doc", "n", "fp1", "fp2"])
    thin = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    return thin.mapInArrow(run, "doc long, n long, fp1 long, fp2 long")


def index_rows(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int,
               plan: dict[int, tuple[int, int, int]], edges: list[int]) -> DataFrame:
    """(sig, doc, others): documents by key. Within an Arrow batch, INDEX_KEYS keys at a time, the
    documents of a key are already one row, its smallest id with the others beside it."""
    def rows(sigs: list, docs_: list) -> pa.RecordBatch:
        sig = np.concatenate(sigs) & _U((1 << KEY_BITS) - 1)
        doc = np.repeat(np.array(docs_, np.int64), [len(g) for g in sigs])
        order = np.lexsort((doc, sig))
        sig, doc = sig[order], doc[order]
        head = np.r_[True, sig[1:] != sig[:-1]]
        at = np.flatnonzero(head)
        counts = np.diff(np.r_[at, len(sig)]) - 1
        offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32), pa.int32(), mask=np.r_[counts == 0, False])
        others = pa.ListArray.from_arrays(offsets, pa.array(doc[~head]))
        out = pa.RecordBatch.from_arrays([pa.array(signed(sig[at])), pa.array(doc[at]), others], names=["sig", "doc", "others"])
        return out.take(pa.array(np.lexsort((sig[at], doc[at]))))  # neighbours of a document: compresses

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            sigs, docs_, size = [], [], 0
            for i, w, *_ in documents_words(b, "text", SPACED):
                s = shingles(w, k)
                if not len(s):
                    continue
                band = int(np.searchsorted(edges, len(s), "right")) - 1
                for at in (band, band + 1):  # as the larger and as the smaller partner
                    if at in plan:
                        sigs.append(signatures(s, at, *plan[at]))
                        docs_.append(ids[i])
                        size += len(sigs[-1])
                if size >= INDEX_KEYS:
                    yield rows(sigs, docs_)
                    sigs, docs_, size = [], [], 0
            if sigs:
                yield rows(sigs, docs_)
    thin = (docs.where(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")))
    return thin.mapInArrow(run, "sig long, doc long, others array<long>")


def _paired_sets(b: pa.RecordBatch, k: int, state: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, set of ta, set of tb); rows come sorted by the second id, whose text is
    hashed once per run of rows."""
    ids = b.column(1).to_numpy(zero_copy_only=False)
    heads = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, np.int64)
    own = {int(heads[i]): shingles(w, k) for i, w, *_ in documents_words(b.take(pa.array(heads)), "tb", SPACED)}
    for i, w, *_ in documents_words(b, "ta", SPACED):
        state["set"] = own.get(i, state.get("set"))
        yield i, shingles(w, k), state["set"]


def _few_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of PAIR_ROWS rows."""
    for b in batches:
        for lo in range(0, b.num_rows, PAIR_ROWS):
            yield b.slice(lo, PAIR_ROWS)


def _with_texts(pairs: DataFrame, texts: DataFrame, a: str, b: str) -> DataFrame:
    ta = texts.select(F.col("doc").alias(a), F.col("text").alias("ta"))
    tb = texts.select(F.col("doc").alias(b), F.col("text").alias("tb"))
    return pairs.select(a, b).join(ta.hint("merge"), a).join(tb.hint("merge"), b).select(a, b, "ta", "tb")


def overlaps(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(a, b, both, na, nb): exact sizes of the sets of each pair and of their intersection."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for b in _few_pairs(batches):
            size = np.zeros((3, b.num_rows), np.int64)
            for i, x, y in _paired_sets(b, k, state):
                size[:, i] = len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *map(pa.array, size)], names=["a", "b", "both", "na", "nb"])
    return _with_texts(pairs, texts, "a", "b").mapInArrow(run, "a long, b long, both long, na long, nb long")


def own_elements(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(class, rep_class, e): elements of each class's set that the set of rep_class has not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for b in _few_pairs(batches):
            found = [np.setdiff1d(x, y, assume_unique=True) for _, x, y in _paired_sets(b, k, state)]
            at = np.repeat(np.arange(b.num_rows), [len(f) for f in found])
            e = np.concatenate(found) if found else np.zeros(0, _U)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(signed(e))],
                                             names=["class", "rep_class", "e"])
    return _with_texts(pairs, texts, "class", "rep_class").mapInArrow(run, "class long, rep_class long, e long")


def unique_elements(texts: DataFrame, k: int, share: int) -> DataFrame:
    """(class, u): how many elements of each set none of the other given sets has,
    counted in one ``share``-th of the universe."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, b.num_rows, 1_000):
                part = b.slice(lo, 1_000)
                own = [(i, s[s % _U(share) == 0]) for i, w, *_ in documents_words(part, "text", SPACED) for s in [shingles(w, k)]]
                h = np.concatenate([s for _, s in own])
                doc = np.repeat(ids[lo:lo + 1_000], [len(s) for _, s in own])
                order = np.lexsort((doc, h))
                h, doc = h[order], doc[order]
                at = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
                last = np.r_[at[1:], len(h)][:len(at)] - 1
                yield pa.RecordBatch.from_arrays([pa.array(signed(h[at])), pa.array(doc[at]), pa.array(doc[last])], names=["h", "lo", "hi"])
    rows = texts.select("doc", "text").mapInArrow(run, "h long, lo long, hi long")
    alone = rows.groupBy("h").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo = hi")
    return alone.groupBy(F.col("lo").alias("class")).agg(F.count("*").alias("u"))


def ngram_components(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     k: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: ``id_col``, n_shingles, component_id (smallest id
    reachable over links of similarity >= percent / 100)."""
    scratch = Scratch(spark, "ngram-jaccard")
    with scratch:
        digests = scratch.put(set_digests(docs, id_col, text_col, k), "digests", keep=True)
        # copies (equal sets) form a class named by its smallest id
        sets = digests.where("doc is not null and n > 0")
        classes = scratch.put(sets.groupBy("n", "fp1", "fp2").agg(F.min("doc").alias("class")), "classes", keep=True)
        member = scratch.put(sets.join(classes, ["n", "fp1", "fp2"]).select("doc", "class").distinct(), "member", keep=True)

        largest = classes.agg(F.max("n")).first()[0] or 0
        edges = band_edges(percent, largest)
        band = F.lit(0)
        for e in edges[1:]:
            band = band + (F.col("n") >= e).cast("int")
        sizes = {r["band"]: r["sets"] for r in classes.groupBy(band.alias("band")).agg(F.count("*").alias("sets")).collect()}
        plan = {i: allocate(percent, edges[i], edges[i + 1] - 1, sizes.get(i, 0) + sizes.get(i - 1, 0))
                for i in range(len(edges) - 1) if sizes.get(i, 0)}

        rows = index_rows(docs, id_col, text_col, k, percent, plan, edges)
        least = F.min("doc").over(Window.partitionBy("sig"))
        met = (rows.withColumn("rep", least).where("others is not null or doc <> rep")
               .select("sig", "rep", F.explode(F.concat(F.array("doc"), F.coalesce("others", F.array()))).alias("doc")))
        buckets = scratch.put(met.where("doc <> rep"), "buckets")

        def by_class(pairs: DataFrame) -> DataFrame:
            """Pairs (x, y) of documents as distinct pairs (a > b) of classes."""
            return (pairs.join(member.toDF("x", "cx"), "x").join(member.toDF("y", "cy"), "y").where("cx <> cy")
                    .select(F.greatest("cx", "cy").alias("a"), F.least("cx", "cy").alias("b")).distinct())

        texts_of = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))

        def verify(pairs: DataFrame, name: str) -> DataFrame:
            ids = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
            texts = scratch.put(keep_ids(texts_of, ids, "doc").dropDuplicates(["doc"]), f"{name}-texts")
            return scratch.put(overlaps(pairs, texts, k), f"{name}-pairs")

        linked = F.expr(f"100 * both >= {percent} * (na + nb - both)")
        pairs = scratch.put(by_class(buckets.select(F.col("rep").alias("x"), F.col("doc").alias("y")).distinct()), "pairs")
        checked = verify(pairs, "first")
        comps = scratch.put(components(spark, checked.where(linked).select("a", "b"), scratch), "comps-0", keep=True)

        # buckets whose members fell into several components: members other than the smallest meet one another
        named = (member.join(comps.select(F.col("node").alias("class"), "comp"), "class", "left")
                 .select("doc", "class", F.coalesce("comp", "class").alias("comp")))
        open_ = (buckets.join(named, "doc")
                 .join(member.select(F.col("doc").alias("rep"), F.col("class").alias("rep_class")), "rep")
                 .select("sig", "class", "comp", "rep_class", F.greatest("class", "rep_class").alias("a"), F.least("class", "rep_class").alias("b"))
                 .join(checked.select("a", "b", "both"), ["a", "b"], "left").select("sig", "class", "comp", "rep_class", "both").distinct())
        mixed = open_.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("sig")
        open_ = scratch.put(open_.join(mixed, "sig"), "open")
        # elements that no other of these sets has: first in a quarter of the universe, which
        # rules most unrelated sets out, then in all of it
        size_of = classes.select("class", F.col("n").cast("long").alias("n"))
        left = open_.select("class").distinct()
        texts = scratch.spark.read.schema("doc long, text string").parquet(f"{scratch.base}/first-texts")
        for share in (4, 1):
            own = scratch.put(unique_elements(keep_ids(texts, left.select(F.col("class").alias("doc")), "doc"), k, share), f"unique-{share}")
            left = scratch.put(left.join(own, "class", "left").join(size_of, "class").select("class", "n", F.coalesce("u", F.lit(0)).alias("u"))
                               .where(f"100 * u <= {100 - percent} * n"), f"left-{share}").select("class", "n", "u")
            if share > 1:
                left = left.select("class")
        # star: the smallest class that a class met first; own and miss: elements that only the class, only the star has
        star = open_.groupBy("class").agg(F.min(F.struct("rep_class", "both")).alias("s")).select("class", F.col("s.rep_class").alias("star"), "s.both")
        itself = F.col("class") == F.col("star")
        left = scratch.put(left.join(star, "class").join(size_of.select(F.col("class").alias("star"), F.col("n").alias("star_n")), "star")
                           .select("class", "n", "u", "star", F.when(itself, 0).otherwise(F.col("n") - F.col("both")).alias("own"),
                                   F.when(itself, 0).otherwise(F.col("star_n") - F.col("both")).alias("miss")), "left")
        comp_of = open_.select("class", "comp").distinct()
        open_ = scratch.put(open_.select("sig", "class", "comp").join(left, "class"), "open-left")

        def facing(rows: DataFrame, key: list[str], least: str) -> DataFrame:
            """Pairs of classes under a key, in different components, of sizes that can
            link and with ``least`` a lower bound of their difference."""
            other = rows.select(*key, *[F.col(c).alias(f"{c}2") for c in rows.columns if c not in key])
            met = (rows.join(other, key).where("comp < comp2").where(f"100 * least(n, n2) >= {percent} * greatest(n, n2)")
                   .where(f"{100 + percent} * ({least}) <= {100 - percent} * (n + n2)"))
            return met.select(F.greatest("class", "class2").alias("a"), F.least("class", "class2").alias("b")).distinct()

        # under one star a pair either differs in all its own elements or shares one of them.
        # u may hold elements of the star that the other set misses, so u and miss do not add up
        apart = facing(open_, ["sig"], "greatest(u + u2, if(star = star2, own + own2 + abs(miss - miss2), 0))")
        elements = scratch.put(own_elements(left.where("class <> star").select("class", F.col("star").alias("rep_class")), texts, k), "own-elements")
        # v: elements outside the star that no other set under it has
        alone = (elements.groupBy("rep_class", "e").agg(F.count("*").alias("sets"), F.min("class").alias("class")).where("sets = 1")
                 .groupBy("class").agg(F.count("*").alias("v")))
        rest = (elements.select("class", "e").join(left.join(alone, "class", "left").withColumn("v", F.coalesce("v", F.lit(0))), "class")
                .join(comp_of, "class"))
        sharing = facing(rest, ["star", "e"], "greatest(u + u2, v + v2 + abs(miss - miss2))")
        cross = apart.unionByName(sharing).distinct().join(checked.select("a", "b"), ["a", "b"], "left_anti")
        cross = scratch.put(cross, "cross")
        more = verify(cross, "second")
        edges_ = checked.where(linked).select("a", "b").unionByName(more.where(linked).select("a", "b"))
        comps = scratch.put(components(spark, edges_, scratch), "comps-1", keep=True)

    named = (member.join(comps.select(F.col("node").alias("class"), "comp"), "class", "left")
             .select("doc", F.coalesce("comp", "class").alias("component_id")))
    # a repeated id with differing sets is one node: its smallest component holds
    named = named.groupBy("doc").agg(F.min("component_id").alias("component_id"))
    return (digests.join(named, "doc", "left")
            .select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "doc").alias("component_id")))


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest id.
    Rows with a null id, and documents without words, stay."""
    comp = ngram_components(spark, docs, id_col, text_col, k, percent).where(f"{id_col} is not null")
    gone = comp.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti")
