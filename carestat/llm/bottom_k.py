"""Document fingerprints: bottom-k sketches of shingle hashes, in SQL functions only.

A text's sketch is the sorted list of the K smallest hashes of its distinct
five-word shingles (the whole sequence when it has fewer words, none without
words). Sketches of parts merge into the sketch of the whole. The K smallest
hashes of two sketches' union are a sample of the union of the sets, from
which resemblance, containment and distinct counts are estimated; with fewer
than K shingles all are exact.

Nothing here runs Python on the executors. The next document in id order is
found by a window within ranges of ids; a range's last row gets the first row
of the next range by a join, so no task sorts the whole table.

Defined cases: null text is empty; an empty sketch has fingerprint '' and
likeness 1 with another empty one, 0 with any other; rows with a null id come
first; rows of equal id are ordered by their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

K = 128
WORDS = 5
RANGE_ROWS = 4_096  # documents in a range of ids, about


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Distinct 48-bit hashes of the text's word shingles."""
    tokens = F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    hashed = F.transform(tokens, lambda w: F.xxhash64(w))
    # a one-element array carries the hashed words, so they are computed once
    rolled = F.transform(F.array(hashed), lambda h: F.when(
        F.size(h) >= words,
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - words, F.lit(0))),
                    lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(words)])))
        .when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>")))
    return F.array_distinct(F.transform(F.get(rolled, F.lit(0)), lambda x: F.shiftrightunsigned(x, 16)))


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    return F.slice(F.sort_array(shingle_hashes(text, words)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the sets behind two sketches."""
    union = merge(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(shared / F.size(union))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * F.lit(float(1 << 48)) / F.element_at(a, -1))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's set that is in b's."""
    both = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_count(a, k)))


def merge_groups(sketches: DataFrame, keys: list[str], column: str, k: int = K) -> DataFrame:
    """One sketch per group of any size: hashes are cut to the k smallest before the shuffle."""
    values = sketches.select(*keys, F.explode(column).alias("_h")).distinct()
    low = values.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))).where(F.col("_r") <= k)
    return low.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(column))


def fingerprint(a: Column) -> Column:
    """A sketch as text: 12 hexadecimal digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 12, "0"))), "")


def id_ranges(docs: DataFrame, id_col: str) -> list[int]:
    """First ids of ranges of about RANGE_ROWS documents."""
    ids = docs.select(F.col(id_col).alias("i")).where("i is not null")
    n = ids.count()
    parts = max(1, min(10_000, n // RANGE_ROWS))
    if n == 0 or parts == 1:
        return []
    cuts = ids.agg(F.percentile_approx("i", [j / parts for j in range(1, parts)], 20 * parts)).first()[0]
    return sorted(set(cuts))


def with_next(docs: DataFrame, id_col: str, text_col: str, derived: dict[str, Column]) -> DataFrame:
    """``docs`` and its ``derived`` columns, with next_<column> of the text and the
    derived columns: those of the document after it in id order, after the last the first."""
    cuts = id_ranges(docs, id_col)
    at = F.coalesce(F.size(F.filter(F.lit(cuts).cast("array<bigint>"), lambda c: c <= F.col(id_col))), F.lit(0)) if cuts else F.lit(0)
    part = docs.withColumn("_range", at)
    columns = [text_col, *derived]
    order = Window.partitionBy("_range").orderBy(F.asc_nulls_first(id_col), text_col)
    body = part.withColumns(derived).withColumn("_next", F.lead(F.struct(*columns)).over(order))
    # first rows of the ranges: their ids from the id column alone, then their texts
    thin = part.groupBy("_range").agg(F.min(F.struct(F.col(id_col).isNotNull().alias("k"), F.col(id_col).alias("i"))).alias("m"))
    used = [(r["_range"], r["m"]["i"]) for r in thin.orderBy("_range").collect()]  # a row a range
    if not used:
        return body.select(*docs.columns, *derived, *[F.col(f"_next.{c}").alias(f"next_{c}") for c in columns])
    before = [(used[j - 1][0], r, i) for j, (r, i) in enumerate(used)]
    first = docs.sparkSession.createDataFrame(before, "_before int, _r int, _i long")
    heads = part.join(F.broadcast(first), F.expr(f"_range = _r and `{id_col}` <=> _i"))
    heads = (heads.withColumn("_n", F.row_number().over(order)).where("_n = 1").withColumns(derived)
             .select(F.col("_before").alias("_range"), F.struct(*columns).alias("_head")))
    out = body.join(heads, "_range", "left").withColumn("_next", F.coalesce("_next", "_head"))
    return out.select(*docs.columns, *derived, *[F.col(f"_next.{c}").alias(f"next_{c}") for c in columns])


def fingerprints(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_distinct, contained_in_next."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    thin = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    both = with_next(thin, "id", "text", {"sk": sketch(F.col("text"))}).withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")), F.substring("next_text", F.lit(1), cut))
    both = (both.withColumn("edited", edited).withColumn("esk", sketch(F.col("edited"))))
    return both.select(
        F.col("id").alias(id_col), "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        fingerprint(F.col("sk")).alias("fingerprint"), fingerprint(F.col("esk")).alias("edited_fingerprint"),
        resemblance(F.col("sk"), F.col("esk")).alias("near_edited"), resemblance(F.col("sk"), F.col("next_sk")).alias("near_next"),
        distinct_count(F.col("sk")).alias("n_distinct"), containment(F.col("sk"), F.col("next_sk")).alias("contained_in_next"))
