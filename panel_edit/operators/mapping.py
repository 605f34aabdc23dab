"""Mapping results from lower-level units to another geography."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Column names of the geography lookup (fixed values).
MAPPER_COLUMNS = ("mapper_lad_code", "mapper_lad_name", "mapper_lau_code", "mapper_lau_name")
DATA_UNIT_COLUMNS = ("data_lau_code", "data_lau_name")
#: Value columns are four-digit years starting with 1 or 2 (fixed value: the file format's).
PERIOD_COLUMN = re.compile(r"^[12]\d{3}$")


def prefix_rename(
    df: DataFrame,
    code_col: str = "parent",
    name_col: str = "parent_name",
    prefix: str = "S30",
) -> tuple[DataFrame, bool]:
    """If any code starts with ``prefix``, rename the code/name columns to unit columns for *all* rows.

    Returns ``(df, need_mapping)``. One action that stops at the first match.
    A frame without ``code_col`` needs no mapping.
    """
    if code_col not in df.columns:
        return df, False
    found = not df.where(F.col(code_col).cast("string").startswith(prefix)).select(code_col).isEmpty()
    if not found:
        return df, False
    return df.withColumnsRenamed({code_col: DATA_UNIT_COLUMNS[0], name_col: DATA_UNIT_COLUMNS[1]}), True


def clean_mapper(mapper: DataFrame, columns: Sequence[str] = MAPPER_COLUMNS) -> tuple[DataFrame, bool]:
    """The lookup's four columns, duplicates removed. The flag is always true."""
    return mapper.select(*columns).distinct(), True


def join_mapper(df: DataFrame, mapper: DataFrame) -> DataFrame:
    """Left-join the lookup on unit code, then drop the data's unit columns.

    Rows without a lookup entry keep NULL mapper columns (see :func:`unmatched`).
    """
    keyed = mapper.withColumn(DATA_UNIT_COLUMNS[0], F.col(MAPPER_COLUMNS[2]))
    out = df.join(keyed, [DATA_UNIT_COLUMNS[0]], "left")
    return out.drop(*DATA_UNIT_COLUMNS)


def ambiguous_units(mapper: DataFrame) -> DataFrame:
    """Unit codes the lookup maps to more than one geography (each such row multiplies data rows)."""
    return (mapper.groupBy(MAPPER_COLUMNS[2])
            .agg(F.countDistinct(MAPPER_COLUMNS[0], MAPPER_COLUMNS[1]).alias("n_targets"))
            .where(F.col("n_targets") > 1))


def unmatched(joined: DataFrame) -> DataFrame:
    """Rows the lookup did not map (NULL mapped code)."""
    return joined.where(F.col(MAPPER_COLUMNS[0]).isNull())


def period_value_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if PERIOD_COLUMN.match(c)]


def aggregate(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Sum every year column by the mapped geography.

    ``keys=None`` groups by the mapped code and name *and every other
    non-year column* (so the result stays at the data's own level when its
    identifiers are present). Rows with a NULL key are dropped, as a group-by
    on missing keys does; an all-missing sum is 0. Aggregation is partial
    (map-side) before the shuffle.
    """
    values = period_value_columns(df)
    geo = list(MAPPER_COLUMNS[:2])
    if keys is None:
        keys = geo + [c for c in df.columns if c not in geo and c not in values]
    keys = list(keys)
    present = df
    for k in keys:
        present = present.where(F.col(k).isNotNull())
    return present.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.col(f"`{v}`")), F.lit(0).cast(df.schema[v].dataType)).alias(v) for v in values]
    )


def reformat(df: DataFrame, original_columns: Sequence[str], code_col: str = "parent",
             name_col: str = "parent_name") -> DataFrame:
    """Mapped code/name take the original parent column names; original column order.

    Original columns an explicit-key rollup no longer has are left out.
    """
    renamed = df.withColumnsRenamed({MAPPER_COLUMNS[0]: code_col, MAPPER_COLUMNS[1]: name_col})
    return renamed.select(*[F.col(f"`{c}`") for c in original_columns if c in renamed.columns])
