"""Cleaning projections: sentinel -> NULL, code decoding, medication,
diagnosis, lab and target recoding (C1-C13).

All steps are narrow column expressions except the code decode, which is a
left join against the (size-checked) code dimension, broadcast so the
encounter table is never shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import code_parts, col, icd9_chapter, lookup_col, numeric_value, sql_lit
from ..schema import CODE_COLUMNS, DIAG_COLUMNS, MEDICATIONS, NUMERIC_COLUMNS
from ..sources.codes import category_codes, is_small

# --- fixed values: recoding tables ----------------------------------------
DOSAGE = {"No": 0, "Steady": 1, "Up": 2, "Down": -1}
A1C_LEVEL = {">8": 3, ">7": 2, "Norm": 1, "None": 0}
GLUCOSE_LEVEL = {">300": 3, ">200": 2, "Norm": 1, "None": 0}
READMIT_CLASS = {"<30": 2, ">30": 1, "NO": 0}


def replace_sentinel(df: DataFrame, sentinel: str = "?") -> DataFrame:
    """The sentinel string becomes NULL in every string column."""
    lit_ = sql_lit(sentinel)
    return df.withColumns({
        f.name: F.expr(f"nullif(`{f.name}`, {lit_})")
        for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    })


def decode_codes(df: DataFrame, codes: DataFrame, *, codes_bounded: bool = False,
                 drop_ids: bool = True) -> DataFrame:
    """C2 + C13: id columns -> descriptions (unmatched -> NULL), ids dropped.

    The code dimension is broadcast only behind a size proof; a code list
    past the limit falls back to a shuffled join.
    """
    small = codes_bounded or is_small(codes)
    out = df
    for id_col, name in CODE_COLUMNS.items():
        if id_col not in df.columns:
            continue
        dim = category_codes(codes, name).select(
            F.col("id").alias(f"__{id_col}"), F.col("description").alias(name))
        if small:
            dim = F.broadcast(dim)
        out = out.join(dim, out[id_col] == dim[f"__{id_col}"], "left").drop(f"__{id_col}")
    if drop_ids:
        out = out.drop(*[c for c, name in CODE_COLUMNS.items() if name in out.columns])
    return out


def coerce_numeric(df: DataFrame) -> DataFrame:
    """Numeric count columns; unparsable text becomes NULL (never an error)."""
    fix = {}
    for c in NUMERIC_COLUMNS:
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType):
            fix[c] = col(c).try_cast("double")
    return df.withColumns(fix) if fix else df


def medication_columns(df: DataFrame) -> dict:
    """C4 + C5: ``{med}_used`` (anything but 'No', NULL included, is 1) and
    ``{med}_dosage`` (No 0, Steady 1, Up 2, Down -1, other NULL)."""
    out = {}
    for m in MEDICATIONS:
        if m in df.columns:
            out[f"{m}_used"] = F.expr(f"CASE WHEN `{m}` = 'No' THEN 0 ELSE 1 END")
            out[f"{m}_dosage"] = lookup_col(m, DOSAGE)
    return out


def add_diagnosis_columns(df: DataFrame) -> DataFrame:
    """Chapter, diabetes flag (raw code starts with 250), circulatory
    and respiratory flags per diagnosis column.

    Staged projections: the code is stripped and parsed once into helper
    columns, the chapter ladder reads those, the flags read the chapter.
    """
    diags = [d for d in DIAG_COLUMNS if d in df.columns]
    if not diags:
        return df
    parts = {}
    for d in diags:
        s, n = code_parts(col(d))
        parts[f"__{d}_s"] = s
    df = df.withColumns(parts)
    df = df.withColumns({f"__{d}_n": numeric_value(F.col(f"__{d}_s")) for d in diags})
    df = df.withColumns({f"{d}_category": icd9_chapter(col(d), F.col(f"__{d}_s"), F.col(f"__{d}_n"))
                         for d in diags})
    flags = {}
    for d in diags:
        chapter = F.col(f"{d}_category")
        flags[f"{d}_is_diabetes"] = F.coalesce(col(d).startswith("250"), F.lit(False)).cast("int")
        flags[f"{d}_is_circulatory"] = (chapter == "Circulatory").cast("int")
        flags[f"{d}_is_respiratory"] = (chapter == "Respiratory").cast("int")
    return df.withColumns(flags).drop(*[f"__{d}_{x}" for d in diags for x in ("s", "n")])


def lab_and_target_columns(df: DataFrame) -> dict:
    """Ordinal A1C and glucose levels, binary and 3-class targets."""
    out = {}
    if "A1Cresult" in df.columns:
        out["A1C_value"] = lookup_col("A1Cresult", A1C_LEVEL)
    if "max_glu_serum" in df.columns:
        out["glucose_value"] = lookup_col("max_glu_serum", GLUCOSE_LEVEL)
    if "readmitted" in df.columns:
        out["readmitted_30d"] = F.when(col("readmitted") == "<30", F.lit(1)).otherwise(F.lit(0))
        out["readmitted_class"] = lookup_col("readmitted", READMIT_CLASS)
    return out


def clean(df: DataFrame, codes: DataFrame, *, codes_bounded: bool = False,
          drop_ids: bool = True) -> DataFrame:
    """Full cleaning step: adds 65 columns and drops the 3 decoded ids."""
    df = replace_sentinel(df)
    df = decode_codes(df, codes, codes_bounded=codes_bounded, drop_ids=drop_ids)
    df = coerce_numeric(df)
    df = df.withColumns(medication_columns(df))
    df = add_diagnosis_columns(df)
    return df.withColumns(lab_and_target_columns(df))
