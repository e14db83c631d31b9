"""Model preparation (M1-M11): feature selection, exact stratified split,
train-fitted imputation / scaling / one-hot encoding, assembled vectors.

Scale notes
-----------
* The split never ranks a whole class in one task. The test quota of each
  class is the k-th smallest md5(seed-id) within the class; it is found by
  histogram refinement over 4-hex-digit hash prefixes (one aggregation per
  level over at most 65,536 buckets) until the boundary bucket is small,
  and only that bucket is ranked. Membership is then a column predicate.
* Imputation and scaling statistics are one aggregate over the training
  rows; only those scalars (one per feature) reach the driver.
* One-hot encoding uses ``StringIndexer`` + ``OneHotEncoder`` (sparse
  vectors); the dropped last slot is the unknown bucket, so unseen
  categories encode as all zeros.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, r6, values_table
from .ranks import quantiles, value_counts
from ..schema import BINARY_FEATURES, CATEGORICAL_FEATURES, MED_USED_FEATURES, NUMERIC_FEATURES

TARGET = "readmitted_30d"
SEED = 42
TEST_SIZE = 0.2
FINAL_BUCKET_ROWS = 100_000   # rank directly once the boundary bucket is this small
PREFIX_DIGITS = 4             # hex digits per refinement level (65,536 buckets)


# -------------------------------------------------------------- M1, M2 ----
def feature_groups(df: DataFrame, target: str = TARGET) -> dict[str, list[str]]:
    """M1: present features per group, order kept, first occurrence wins."""
    if target not in df.columns:
        raise ValueError(f"Target column '{target}' not found in dataset")
    seen: list[str] = []
    groups = {}
    for name, cols in (("categorical", CATEGORICAL_FEATURES), ("numeric", NUMERIC_FEATURES),
                       ("binary", BINARY_FEATURES), ("medication", MED_USED_FEATURES)):
        groups[name] = [c for c in cols if c in df.columns and c not in seen]
        seen += groups[name]
    return groups


def unique_names(names: list[str]) -> list[str]:
    """M2: rename repeated names to name_1, name_2, ... (plan time).

    The suffix counts earlier occurrences of the same original name, so a
    third copy becomes name_2 (never a second name_1); a suffix already in
    use is skipped.
    """
    out: list[str] = []
    seen: dict[str, int] = {}
    for n in names:
        k = seen.get(n, 0)
        new = n if k == 0 else f"{n}_{k}"
        while new in out:
            k += 1
            new = f"{n}_{k}"
        seen[n] = k + 1
        out.append(new)
    return out


def dedupe_columns(df: DataFrame) -> DataFrame:
    """M2 on a DataFrame whose column names repeat (e.g. after a join)."""
    return df.toDF(*unique_names(df.columns))


# ------------------------------------------------------------------ M3 ----
def approximate_mode(counts: dict, n_draws: int) -> dict:
    """Per-class draw counts proportional to ``counts`` summing to n_draws:
    floors first, leftovers to the largest remainders (ties: class order)."""
    total = sum(counts.values())
    cont = {c: n * n_draws / total for c, n in counts.items()}
    out = {c: math.floor(v) for c, v in cont.items()}
    need = n_draws - sum(out.values())
    for c in sorted(counts, key=lambda c: (-(cont[c] - out[c]), c))[:need]:
        out[c] += 1
    return out


def split_quotas(counts: dict, test_size: float = TEST_SIZE) -> dict:
    """Test rows per class: train quota first, the rest of each class is test."""
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    train = approximate_mode(counts, n - n_test)
    return {c: counts[c] - train[c] for c in counts}


def _hash(key: str, seed: int):
    return F.md5(F.concat(F.lit(f"{seed}-"), col(key).cast("string")))


def kth_smallest(df: DataFrame, h: str, key: str, k: int, n: int) -> tuple[str, object]:
    """The k-th smallest (h, key) pair (1-based) of ``df`` with ``n`` rows.

    Refines a hex prefix of ``h`` level by level; each level is one grouped
    count over <= 16^PREFIX_DIGITS buckets with a cumulative window over
    those buckets. Only the final bucket (<= FINAL_BUCKET_ROWS rows, or all
    rows sharing a full hash) is ranked row by row.
    """
    prefix, rest, rows = "", k, n
    while rows > FINAL_BUCKET_ROWS and len(prefix) < 32:
        sub = df.filter(F.col(h).startswith(prefix)) if prefix else df
        width = min(PREFIX_DIGITS, 32 - len(prefix))
        buckets = sub.groupBy(F.substring(h, len(prefix) + 1, width).alias("b")).agg(
            F.count(F.lit(1)).alias("n"))
        cum = F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
        hit = (buckets.withColumn("cum", cum)
               .filter((F.col("cum") - F.col("n") < rest) & (F.col("cum") >= rest))
               .select("b", "n", (F.col("cum") - F.col("n")).alias("before")).first())
        prefix += hit["b"]
        rest -= hit["before"]
        rows = hit["n"]
    sub = df.filter(F.col(h).startswith(prefix)) if prefix else df
    ranked = sub.withColumn("__rn", F.row_number().over(Window.orderBy(h, key)))
    row = ranked.filter(F.col("__rn") == rest).select(h, key).first()
    return row[h], row[key]


def stratified_split(df: DataFrame, *, label: str = TARGET, key: str = "encounter_id",
                     test_size: float = TEST_SIZE, seed: int = SEED) -> DataFrame:
    """M3: exact stratified holdout; adds ``split`` = 'train' / 'test'.

    Within each class the first quota rows in (md5(seed-key), key) order are
    test rows; the quota follows the proportional rule above.
    """
    hashed = df.withColumn("__h", _hash(key, seed))
    counts = {r[label]: r["n"] for r in hashed.groupBy(label).agg(
        F.count(F.lit(1)).alias("n")).collect()}            # one row per class
    quotas = split_quotas(counts, test_size)
    test = F.lit(False)
    slim = hashed.select(label, "__h", key)
    for cls, q in quotas.items():
        if q <= 0:
            continue
        hb, kb = kth_smallest(slim.filter(F.col(label) == cls), "__h", key, q, counts[cls])
        test = test | ((F.col(label) == cls) &
                       ((F.col("__h") < hb) | ((F.col("__h") == hb) & (col(key) <= kb))))
    return hashed.withColumn("split", F.when(test, "test").otherwise("train")).drop("__h")


# ---------------------------------------------------------- M4-M10 --------
STATISTICS = ("numeric", "categorical", "passthrough", "medians", "means", "stds", "modes", "feature_names")


@dataclass
class Preparation:
    """Fitted preparation: train statistics + fitted encoder pipeline."""
    numeric: list[str]
    categorical: list[str]
    passthrough: list[str]
    medians: dict
    means: dict
    stds: dict
    modes: dict
    encoder: PipelineModel
    feature_names: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """Impute (train medians / modes), standardise (train mean, population
        std), one-hot and assemble ``features``."""
        exprs = {}
        for c in self.numeric:
            x = F.coalesce(col(c).cast("double"), F.lit(self.medians[c]))
            sd = self.stds[c]
            exprs[f"__num_{c}"] = (x - F.lit(self.means[c])) / F.lit(sd) if sd else x - F.lit(self.means[c])
        for c in self.categorical:
            exprs[f"__cat_{c}"] = F.coalesce(col(c).cast("string"), F.lit(self.modes[c]))
        for c in self.passthrough:
            exprs[f"__pass_{c}"] = F.coalesce(F.trim(col(c).cast("string")).try_cast("double"), F.lit(0.0)) if isinstance(
                df.schema[c].dataType, T.StringType) else F.coalesce(col(c).cast("double"), F.lit(0.0))
        return self.encoder.transform(df.withColumns(exprs))

    def save(self, spark: SparkSession, path: str) -> str:
        """The statistics and names as one JSON line, the encoder beside them.
        Python writes a double so that it reads back as the same double."""
        line = json.dumps({n: getattr(self, n) for n in STATISTICS})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/statistics")
        self.encoder.write().overwrite().save(f"{path}/encoder")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Preparation":
        """The preparation that ``save`` wrote; it transforms as the fitted one."""
        line = spark.read.text(f"{path}/statistics").first()["value"]
        return cls(encoder=PipelineModel.load(f"{path}/encoder"), **json.loads(line))


def train_medians(train: DataFrame, numeric: list[str]) -> dict[str, float]:
    """M4: median of each column's non-null values, 0 without any. Distinct values are counted
    map-side and ranked in range partitions; one row per column reaches the driver."""
    if not numeric:
        return {}
    long = train.select(*[col(c).cast("double").alias(c) for c in numeric]).unpivot([], numeric, "feature", "x")
    found = quantiles(value_counts(long, "x", ["feature"]), "x", ["feature"], {"median": 0.5}).collect()
    medians = {r["feature"]: float(r["median"]) for r in found}
    return {c: medians.get(c, 0.0) for c in numeric}


def train_modes(train: DataFrame, categorical: list[str]) -> dict[str, str]:
    """M6: each column's most frequent text, ties to the smallest; empty without any."""
    if not categorical:
        return {}
    long = train.select(*[col(c).cast("string").alias(c) for c in categorical]).unpivot([], categorical, "feature", "v")
    counts = long.where("v is not null").groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"))
    found = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("m")).select("feature", "m.v").collect()
    modes = {r["feature"]: r["v"] for r in found}
    return {c: modes.get(c, "") for c in categorical}


# ----------------------------------------------------------------- M11 ----
# a decimal number with an optional exponent, blanks around it allowed
NUMBER_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def residual_text_kinds(train: DataFrame, test: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, kind, not_numbers_train, not_numbers_test): 'numeric' where every non-null text of both
    parts is a number, else 'category'. One aggregate over both parts."""
    if not columns:
        return values_table(train.sparkSession, [("feature", "string"), ("kind", "string"), ("not_numbers_train", "long"), ("not_numbers_test", "long")], [])
    text = [col(c).cast("string").alias(c) for c in columns]
    both = train.select(F.lit(True).alias("__train"), *text).unionByName(test.select(F.lit(False).alias("__train"), *text))
    other = {c: ~col(c).rlike(NUMBER_TEXT) for c in columns}
    counts = both.agg(*[F.count_if(bad & (F.col("__train") == part)).alias(f"{name}_{i}")
                        for i, bad in enumerate(other.values()) for name, part in (("train", True), ("test", False))])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.when((F.col(f"train_{i}") == 0) & (F.col(f"test_{i}") == 0), "numeric").otherwise("category").alias("kind"),
                              F.col(f"train_{i}").alias("not_numbers_train"), F.col(f"test_{i}").alias("not_numbers_test"))
                     for i, c in enumerate(columns)])
    return counts.select(F.inline(rows))


def resolve_residual_text(train: DataFrame, test: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both parts with the numeric ones of the text columns as double, and the names that stay text (to be
    one-hot encoded, unseen values as all zeros)."""
    kinds = {r["feature"]: r["kind"] for r in residual_text_kinds(train, test, columns).collect()}  # a row a column
    numbers = {c: F.trim(col(c)).cast("double") for c in columns if kinds[c] == "numeric"}
    return train.withColumns(numbers), test.withColumns(numbers), [c for c in columns if c not in numbers]


def fit_preparation(train: DataFrame, groups: dict[str, list[str]] | None = None, test: DataFrame | None = None) -> Preparation:
    """M4-M11 fitted on the training rows only; ``test`` takes part in nothing but the choice of M11:
    a text column among the flags whose values are numbers in both parts is a number."""
    groups = groups or feature_groups(train)
    numeric = list(groups["numeric"])
    categorical = list(groups["categorical"])
    passthrough = []
    leftovers = [c for c in groups["binary"] + groups["medication"] if isinstance(train.schema[c].dataType, T.StringType)]
    _, _, texts = resolve_residual_text(train, train if test is None else test, leftovers)
    for c in groups["binary"] + groups["medication"]:
        # M8: text leftovers (diabetesMed, change) become categorical
        if c in texts:
            categorical.append(c)
        else:
            passthrough.append(c)
    medians, modes = train_medians(train, numeric), train_modes(train, categorical)
    # mean and population std of the imputed column
    imputed = {c: F.coalesce(col(c).cast("double"), F.lit(medians[c])) for c in numeric}
    mom = train.agg(*[F.avg(v).alias(f"m__{c}") for c, v in imputed.items()],
                    *[F.stddev_pop(v).alias(f"s__{c}") for c, v in imputed.items()]).first().asDict() if numeric else {}
    means = {c: float(mom[f"m__{c}"]) for c in numeric}
    stds = {c: float(mom[f"s__{c}"] or 0.0) for c in numeric}

    cat_in = [f"__cat_{c}" for c in categorical]
    idx_out = [f"__idx_{c}" for c in categorical]
    ohe_out = [f"__ohe_{c}" for c in categorical]
    stages = [
        StringIndexer(inputCols=cat_in, outputCols=idx_out, handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        # the indexer already maps unseen values to its extra last index, which
        # dropLast removes: unknown categories encode as all zeros
        OneHotEncoder(inputCols=idx_out, outputCols=ohe_out, dropLast=True),
        VectorAssembler(inputCols=[f"__num_{c}" for c in numeric] + ohe_out
                        + [f"__pass_{c}" for c in passthrough], outputCol="features"),
    ]
    prep = Preparation(numeric, categorical, passthrough, medians, means, stds, modes, None)
    staged = train.withColumns({**{f"__num_{c}": F.lit(0.0) for c in numeric},
                                **{f"__cat_{c}": F.coalesce(col(c).cast("string"), F.lit(modes[c]))
                                   for c in categorical},
                                **{f"__pass_{c}": F.lit(0.0) for c in passthrough}})
    prep.encoder = Pipeline(stages=stages).fit(staged)
    labels = prep.encoder.stages[0].labelsArray
    prep.feature_names = (numeric + [f"{c}_{v}" for c, labs in zip(categorical, labels) for v in labs]
                          + passthrough)
    return prep


def feature_name_table(prep: Preparation, spark) -> DataFrame:
    """(idx, feature) in vector order."""
    return values_table(spark, [("idx", "int"), ("feature", "string")], list(enumerate(prep.feature_names)))


def matrix_rows(matrix: DataFrame, prep: Preparation, *, key: str = "encounter_id", features: str = "features") -> DataFrame:
    """M7, M9: (key, split, slots, one column per numeric feature): the standardised numbers, and the places
    of the matrix that hold another value than 0 among the one-hot slots and flags, as place=value."""
    x = vector_to_array(features)
    first = len(prep.numeric)
    rest = F.filter(F.transform(F.slice(x, first + 1, len(prep.feature_names)), lambda v, i: F.struct((i + first).alias("i"), v.alias("v"))), lambda s: s["v"] != 0.0)
    slots = F.array_join(F.transform(rest, lambda s: F.concat(s["i"].cast("string"), F.lit("="), s["v"].cast("long").cast("string"))), ",")
    return matrix.select(key, "split", slots.alias("slots"), *[r6(F.get(x, F.lit(i))).alias(c) for i, c in enumerate(prep.numeric)])


def numeric_statistics(prep: Preparation, spark) -> DataFrame:
    """M4, M5: (feature, median, mean, std) of the training rows; mean and
    population std are those of the imputed column."""
    rows = [(c, prep.medians[c], prep.means[c], prep.stds[c]) for c in prep.numeric]
    df = values_table(spark, [("feature", "string"), ("median", "double"), ("mean", "double"), ("std", "double")], rows)
    return df.select("feature", *[r6(F.col(c)).alias(c) for c in ("median", "mean", "std")])


def categorical_modes(prep: Preparation, spark) -> DataFrame:
    """M6: (feature, mode) of the training rows, ties to the smallest text."""
    return values_table(spark, [("feature", "string"), ("mode", "string")], list(prep.modes.items()))
