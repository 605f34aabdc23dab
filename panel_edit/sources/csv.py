"""Schema-bound CSV sources and sinks.

A schema is a mapping ``new_name -> {"old_name": source column, "type": ...}``
with types ``int``, ``float``, ``str``, ``bool``; any other type string means
"neither converted nor validated". Only listed columns are renamed,
converted and validated; other columns pass through. Files are read with
every column as text (no inference pass over the data); period columns
(names starting with a digit) are read as doubles, like the numbers they hold.
"""

from __future__ import annotations

import tomllib
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panel_edit.session import cut_lineage_counting


SPARK_TYPES = {"int": "bigint", "float": "double", "str": "string", "bool": "boolean"}
#: Spark types that satisfy a declared type.
ACCEPTED = {"int": ("tinyint", "smallint", "int", "bigint"), "float": ("float", "double"), "str": ("string",), "bool": ("boolean",)}
#: Cells read as missing (fixed values: those of the usual CSV readers).
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
           "NaN", "None", "n/a", "nan", "null")


def load_schema(path: str) -> dict[str, dict[str, str]]:
    """Schema from a TOML file: one table per column with ``old_name`` and ``Deduced_Data_Type``."""
    with open(path, "rb") as fh:
        raw = tomllib.load(fh)
    return {new: {"old_name": props["old_name"], "type": props["Deduced_Data_Type"]} for new, props in raw.items()}


def rename_columns(df: DataFrame, schema: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Rename ``old_name -> new name``; a source column that does not exist is an error."""
    missing = [p["old_name"] for p in schema.values() if p["old_name"] not in df.columns]
    if missing:
        raise ValueError(f"the schema names columns that the data lacks: {missing}")
    return df.withColumnsRenamed({p["old_name"]: new for new, p in schema.items() if p["old_name"] != new})


def _casts(df: DataFrame, schema: Mapping[str, Mapping[str, str]], period_type: str | None = None) -> dict[str, Column]:
    """The converted form of each listed column, and of each period column where a type is given for them."""
    casts = {}
    for name in df.columns:
        target = SPARK_TYPES.get(schema[name].get("type")) if name in schema else None
        cell = F.col(f"`{name}`")
        if target:
            casts[name] = cell.try_cast(target)
            if target == "bigint":
                as_double = cell.try_cast("double")
                casts[name] = F.coalesce(F.when(as_double.isNull() | (as_double == F.floor(as_double)), casts[name]),
                                         F.when(as_double == F.floor(as_double), as_double.try_cast("bigint")))
        if period_type and name[:1].isdigit():
            casts[name] = casts.get(name, cell).try_cast(period_type)
    return casts


def convert_types(df: DataFrame, schema: Mapping[str, Mapping[str, str]], period_type: str | None = None) -> DataFrame:
    """Cast listed columns; a cell that doesn't parse, or isn't a whole number in an ``int`` column, becomes NULL.

    A whole number may be written as "12.0".
    """
    casts = _casts(df, schema, period_type)
    return df.withColumns(casts) if casts else df


@dataclass
class Conversion:
    """A converted table, the ledger of the cells that did not parse (column, value, n), and counts by column."""

    frame: DataFrame
    ledger: DataFrame
    lost: dict[str, int]  # cells that did not parse
    missing: dict[str, int]  # NULLs in each ``int`` column


def convert_with_ledger(df: DataFrame, schema: Mapping[str, Mapping[str, str]], period_type: str | None = None) -> Conversion:
    """:func:`convert_types`, with a record of the cells that it set to NULL.

    All of it comes from one pass: each row is converted and written once,
    together with the cells it lost, and the counts are taken as it is written.
    """
    casts = _casts(df, schema, period_type)
    lost = "_lost"
    while lost in df.columns:
        lost += "_"
    failed = {c: F.col(f"`{c}`").isNotNull() & cast.isNull() for c, cast in casts.items()}
    entries = [F.when(f, F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))) for c, f in failed.items()]
    empty = F.array().cast("array<struct<column:string,value:string>>")
    record = df.withColumns({**casts, lost: F.array_compact(F.array(*entries)) if entries else empty})
    counts = {f"lost {c}": F.array_contains(F.col(lost)["column"], c) for c in casts}
    counts |= {f"missing {c}": F.col(f"`{c}`").isNull() for c in _int_columns(record, schema)}
    both, found = cut_lineage_counting(record, counts)
    ledger = both.select(F.inline(lost)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    by = {kind: {c.removeprefix(f"{kind} "): n for c, n in found.items() if c.startswith(f"{kind} ")} for kind in ("lost", "missing")}
    return Conversion(both.drop(lost), ledger, {c: n for c, n in by["lost"].items() if n}, by["missing"])


def _int_columns(df: DataFrame, schema: Mapping[str, Mapping[str, str]]) -> list[str]:
    """Columns declared ``int`` that hold whole numbers: they may have no missing values."""
    types = dict(df.dtypes)
    return [c for c, props in schema.items() if props.get("type") == "int" and types.get(c) in ACCEPTED["int"]]


def _declared_wrong(df: DataFrame, schema: Mapping[str, Mapping[str, str]], missing: Mapping[str, int]) -> list[tuple[str, str, str, int]]:
    """(column, declared, problem, n), from the schema and the counts of missing values."""
    types, found = dict(df.dtypes), []
    for name, props in schema.items():
        declared = props.get("type")
        if name not in types:
            found.append((name, declared, "no such column", 0))
        elif declared in ACCEPTED and types[name] not in ACCEPTED[declared]:
            found.append((name, declared, f"type {types[name]}", 0))
        elif missing.get(name):
            found.append((name, declared, "missing values", missing[name]))
    return found


def schema_report(df: DataFrame, schema: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Violations as rows (column, declared, problem, n): missing column, other type, missing values in ``int`` columns.

    One aggregate job over the data, when it is run.
    """
    ints = _int_columns(df, schema)
    fixed = df.sparkSession.createDataFrame(_declared_wrong(df, schema, {}), "column string, declared string, problem string, n bigint")
    if not ints:
        return fixed
    counts = df.agg(*[F.count_if(F.col(f"`{n}`").isNull()).alias(f"_{i}") for i, n in enumerate(ints)])
    rows = counts.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), F.lit("int").alias("declared"), F.lit("missing values").alias("problem"), F.col(f"_{i}").alias("n"))
        for i, n in enumerate(ints)])).alias("r")).select("r.*")
    return fixed.unionByName(rows.where("n > 0"))


def schema_violations(df: DataFrame, schema: Mapping[str, Mapping[str, str]], missing: Mapping[str, int] | None = None) -> None:
    """Raise on the first of :func:`schema_report`: every column listed, of its type, ``int`` without missing values.

    Runs no job where ``missing`` has the counts already (of :class:`Conversion`).
    """
    absent = [name for name in schema if name not in df.columns]
    if absent:
        raise ValueError(f"the file has no column for {absent[0]}")
    found = (_declared_wrong(df, schema, missing) if missing is not None
             else [tuple(r) for r in schema_report(df, schema).collect()])  # at most one row per listed column
    if found:
        raise TypeError("columns do not match their declared types: " + "; ".join(
            f"{column}: {problem}" + (f" ({n})" if n else "") + f", declared {declared}" for column, declared, problem, n in found))


def spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether any record of the files goes over several lines.

    Quotes inside a quoted cell are doubled, so a record on one line has an even
    number of quotes, and the first line of a longer record an odd one. The
    lines are read in splits; the search ends at the first odd line.
    """
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    return bool(spark.read.text(path).where(quotes % 2 == 1).take(1))


def _text_cells(spark: SparkSession, path: str, schema: Mapping[str, Mapping[str, str]], multi_line: bool | None) -> DataFrame:
    """The renamed columns of a file as text, ``MISSING`` cells NULL."""
    if multi_line is None:
        multi_line = spans_lines(spark, path)
    df = (spark.read.option("header", True).option("inferSchema", False).option("quote", '"').option("escape", '"')
          .option("multiLine", multi_line).csv(path))
    df = df.select(*[F.when(~F.col(f"`{c}`").isin(*MISSING), F.col(f"`{c}`")).alias(c) for c in df.columns])
    return rename_columns(df, schema)


def read_with_schema(
    spark: SparkSession,
    path: str,
    schema: Mapping[str, Mapping[str, str]] | str,
    period_type: str | None = "double",
    validate: bool = True,
    multi_line: bool | None = None,
) -> DataFrame:
    """Read a headered CSV (file or folder), then rename, convert and validate against ``schema``.

    Quotes inside quoted cells are doubled, and a quoted cell may hold newlines:
    whether one does is looked up first (:func:`spans_lines`), so that files
    without any are read in splits; ``multi_line`` states it instead. Cells of
    ``MISSING`` are NULL. ``period_type=None`` keeps period columns as text
    (e.g. "1,234.5", parsed later).
    """
    if isinstance(schema, str):
        schema = load_schema(schema)
    df = convert_types(_text_cells(spark, path, schema, multi_line), schema, period_type)
    if validate:
        schema_violations(df, schema)
    return df


def read_with_ledger(
    spark: SparkSession,
    path: str,
    schema: Mapping[str, Mapping[str, str]] | str,
    period_type: str | None = "double",
    validate: bool = False,
    multi_line: bool | None = None,
) -> Conversion:
    """:func:`read_with_schema` with the ledger of the cells that became NULL because they did not parse.

    Validation reads the counts that were taken as the rows were written: no job of its own.
    """
    if isinstance(schema, str):
        schema = load_schema(schema)
    out = convert_with_ledger(_text_cells(spark, path, schema, multi_line), schema, period_type)
    if validate:
        schema_violations(out.frame, schema, out.missing)
    return out


def write_with_schema(
    df: DataFrame,
    path: str,
    schema: Mapping[str, Mapping[str, str]] | str | None = None,
    fmt: str = "csv",
    single_file: bool = False,
) -> None:
    """Rename/validate against ``schema`` and write with a header (overwrite).

    ``single_file`` coalesces to one task - only for small outputs.
    """
    if isinstance(schema, str):
        schema = load_schema(schema)
    if schema:
        df = rename_columns(df, schema)
        schema_violations(df, schema)
    if single_file:
        df = df.coalesce(1)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)
