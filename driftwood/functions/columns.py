"""Column-level helpers: name normalisation, coercion, regex features, NaN handling, label maps.

All return native Columns (JVM-side, inside whole-stage codegen); none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns the feature transforms must reproduce exactly.
TITLE_PATTERN = r"([A-Za-z]+)\."
SECONDARY_NAME_PATTERN = r"\(([A-Za-z ]+)\)"


def normalize_name(name: str) -> str:
    """One character at a time: a capital opens a new part ('CustomerID' -> 'customer_i_d'), spaces and
    dashes become '_', parentheses go, the rest is lowered."""
    out = ""
    for at, char in enumerate(name):
        if char in "()":
            continue
        if "A" <= char <= "Z" and at and not name[at - 1] == "_":
            out += "_"
        out += "_" if char in " -" else char.lower()
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with ``normalize_name`` in one projection."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def replace_spaces(df: DataFrame) -> DataFrame:
    """Spaces in column names -> underscores, as one plan node."""
    return df.withColumnsRenamed({c: c.replace(" ", "_") for c in df.columns if " " in c})


def coerce_numeric(c: Column | str) -> Column:
    """Text to double; unparsable text and '' become NULL (never an error under ANSI mode)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.trim(col).try_cast("double")


def title_prefix(c: Column | str) -> Column:
    """First word followed by a period ('Mr' in 'Braund, Mr. Owen'); no match gives ''."""
    return F.regexp_extract(c, TITLE_PATTERN, 1)


def secondary_name(c: Column | str) -> Column:
    """Text inside the first parenthesis pair of letters/spaces; no match gives NULL."""
    return F.nullif(F.regexp_extract(c, SECONDARY_NAME_PATTERN, 1), F.lit(""))


def presence_flag(c: Column | str) -> Column:
    """'1' when the value is present, '0' when NULL (string typed)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isNotNull(), F.lit("1")).otherwise(F.lit("0"))


def nan_to_null(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(col), col)


def mean_of(*cols: str) -> Column:
    """Arithmetic mean of several numeric columns (NULL if any is NULL)."""
    total = F.col(cols[0])
    for c in cols[1:]:
        total = total + F.col(c)
    return total / F.lit(float(len(cols)))


def label_map(c: Column | str, mapping: Mapping[str, int]) -> Column:
    """Map text labels to integers; values outside the mapping become NULL."""
    col = F.col(c) if isinstance(c, str) else c
    out = None
    for k, v in mapping.items():
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    return out.cast("int")


def unmapped(df: DataFrame, col: str, mapping: Mapping[str, int]) -> DataFrame:
    """(value, n) of the non-NULL labels that ``label_map`` turns to NULL."""
    return (df.where(F.col(col).isNotNull() & ~F.col(col).isin(*mapping)).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def parse_timestamp(c: Column | str, fmt: str = "MM/dd/yyyy") -> Column:
    """Zone-less timestamp from text; independent of the session time zone."""
    return F.to_timestamp_ntz(F.col(c) if isinstance(c, str) else c, F.lit(fmt))


def user_prefix() -> Column:
    """Part of the current user name before the first '.'."""
    return F.substring_index(F.current_user(), ".", 1)
