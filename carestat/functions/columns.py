"""Column-expression building blocks (all JVM-side, codegen friendly).

Every helper returns a ``Column``; none of them runs Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column reference that tolerates hyphenated names."""
    return F.col(f"`{name}`")


def r6(c: Column) -> Column:
    """Round a double to 6 places (both engines agree on the result)."""
    return F.round(c.cast("double"), 6)


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI-safe)."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def zero_div(num: Column, den: Column) -> Column:
    """num / den, 0 when undefined (the convention for precision/recall)."""
    return F.coalesce(safe_div(num, den), F.lit(0.0))


def sql_lit(v) -> str:
    """Spark SQL literal text."""
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def case_sql(expr: str, mapping: dict, default=None) -> str:
    """``CASE expr WHEN k THEN v ... ELSE default END`` as Spark SQL text."""
    whens = " ".join(f"WHEN {sql_lit(k)} THEN {sql_lit(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {sql_lit(default)} END"


def lookup_col(name: str, mapping: dict, default=None) -> Column:
    """Literal lookup on a named column, built as one SQL expression (a single
    JVM parse instead of one py4j call per branch)."""
    return F.expr(case_sql(f"`{name}`", mapping, default))


def lookup(c: Column, mapping: dict, default=None) -> Column:
    """Literal CASE lookup ``mapping[c]`` with a default for misses and NULL."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None
                else expr.when(c == F.lit(k), F.lit(v)))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def cut_right_closed(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Interval label for right-closed bins (e0,e1], (e1,e2], ...; outside -> NULL."""
    assert len(labels) == len(edges) - 1
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def bin_left_closed(x: Column, edges: Sequence[float]) -> Column:
    """0-based bin index for left-closed bins [e0,e1), [e1,e2), ...; outside -> NULL.

    The last edge may be ``float('inf')`` for an open last bin.
    """
    expr = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = x >= F.lit(lo)
        if hi != float("inf"):
            cond = cond & (x < F.lit(hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


# --- fixed values: ICD-9 chapter ranges [lo, hi) and their names -----------
ICD9_CHAPTERS = [
    (1, 140, "Infectious"),
    (140, 240, "Neoplasms"),
    (240, 280, "Endocrine"),
    (280, 290, "Blood"),
    (290, 320, "Mental"),
    (320, 390, "Nervous"),
    (390, 460, "Circulatory"),
    (460, 520, "Respiratory"),
    (520, 580, "Digestive"),
    (580, 630, "Genitourinary"),
    (630, 680, "Pregnancy"),
    (680, 710, "Skin"),
    (710, 740, "Musculoskeletal"),
    (740, 760, "Congenital"),
    (760, 780, "Perinatal"),
    (780, 800, "Symptoms"),
    (800, 1000, "Injury"),
]

# Chapter of every integer code 1..999, built from the ranges above: all range
# bounds are integers, so floor(code) decides the chapter (one array lookup
# instead of a 17-branch ladder per value).
CHAPTER_BY_INT = [next(name for lo, hi, name in ICD9_CHAPTERS if lo <= k < hi)
                  for k in range(1, 1000)]

# decimal literal the way a float parser accepts it (after stripping blanks)
NUMERIC_RE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_NONFINITE_RE = r"(?i)^[+-]?(nan|inf|infinity)$"


# every character a Python-style ``str.strip()`` removes, derived by rule
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip_ws(c: Column) -> Column:
    """Strip leading/trailing whitespace of any kind (not only blanks); no regex."""
    return F.btrim(c, F.lit(WHITESPACE))


NUMERIC_CHARS = "0123456789.+-eE"
NONFINITE = ["nan", "inf", "infinity", "+nan", "+inf", "+infinity", "-nan", "-inf", "-infinity"]


def numeric_value(s: Column) -> Column:
    """Double value of a stripped code when it is a plain decimal literal
    (digits, sign, point, exponent only), else NULL; no regex."""
    plain = (F.length(s) > 0) & (F.translate(s, NUMERIC_CHARS, "") == F.lit(""))
    return F.when(plain, s).try_cast("double")


def code_parts(code: Column) -> tuple[Column, Column]:
    """(stripped text, numeric value or NULL) of a diagnosis code."""
    s = strip_ws(code)
    return s, numeric_value(s)


def icd9_chapter(code: Column, stripped: Column | None = None,
                 num: Column | None = None) -> Column:
    """ICD-9 chapter of a diagnosis code string.

    NULL or '?' -> Unknown; V*/E* -> V_codes/E_codes; numeric codes by chapter
    range; numeric outside [1, 1000) (and nan/inf) -> Other; anything else
    that does not parse as a number -> Unknown. Pass the precomputed parts
    (``code_parts``) to keep the generated code small.
    """
    if stripped is None or num is None:
        stripped, num = code_parts(code)
    s = stripped
    in_range = (num >= F.lit(1)) & (num < F.lit(1000))
    by_int = F.element_at(F.lit(CHAPTER_BY_INT), F.floor(num).cast("int"))
    return (F.when(code.isNull() | (code == F.lit("?")), F.lit("Unknown"))
            .when(s.startswith("V"), F.lit("V_codes"))
            .when(s.startswith("E"), F.lit("E_codes"))
            .when(F.lower(s).isin(*NONFINITE), F.lit("Other"))
            .when(num.isNull(), F.lit("Unknown"))
            .when(in_range, by_int)
            .otherwise(F.lit("Other")))


def pair_masked(x: Column, y: Column) -> tuple[Column, Column]:
    """Pairwise-complete masking: keep x only where y is present and vice versa."""
    xd, yd = x.cast("double"), y.cast("double")
    return (F.when(yd.isNotNull(), xd), F.when(xd.isNotNull(), yd))


def corr_parts(x: Column, y: Column, prefix: str) -> list[Column]:
    """Aggregates whose combination is a NULL-safe Pearson correlation.

    A constant column gives NULL (never a division error), matching the
    "NaN sorted last" behaviour of the source analysis.
    """
    mx, my = pair_masked(x, y)
    return [F.covar_pop(mx, my).alias(f"{prefix}__cov"),
            F.var_pop(mx).alias(f"{prefix}__vx"),
            F.var_pop(my).alias(f"{prefix}__vy")]


def corr_from_parts(prefix: str) -> Column:
    cov, vx, vy = (F.col(f"{prefix}__cov"), F.col(f"{prefix}__vx"), F.col(f"{prefix}__vy"))
    return safe_div(cov, F.sqrt(vx * vy))


def rows_of(names, *rows) -> Column:
    """Array of structs with the same field names (for ``inline`` unpivots)."""
    return F.array(*[F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(n)
                                for n, v in zip(names, r)]) for r in rows])


def values_table(spark, columns: list[tuple[str, str]], rows) -> "DataFrame":
    """Small literal table as a SQL ``VALUES`` relation: planned as a JVM local
    relation (no Python RDD, no Python workers at execution)."""
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in columns])
    names = ", ".join(n for n, _ in columns)
    body = ", ".join("(" + ", ".join(sql_lit(v) for v in r) + ")" for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in columns])
