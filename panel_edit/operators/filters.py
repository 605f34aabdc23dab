"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panel_edit.operators import checks


def filter_period(df: DataFrame, start: int, end: int, period: str = "period") -> DataFrame:
    """Inclusive period range (pushed into the parquet scan when ``period`` is a stored column)."""
    return df.where(F.col(period).between(start, end))


COMPONENT_LABELS = ("SAS code", "CORD code", "Credit/Debit code")


def component_presence(
    df: DataFrame, codes: tuple[str, str, str], columns: tuple[str, str, str] = ("sas_code", "cord_code", "credit_debit")
) -> DataFrame:
    """Report rows (label, code, present) of the three component codes, from one aggregate."""
    has = [F.coalesce(F.max((F.col(c) == F.lit(v)).cast("int")), F.lit(0)).alias(f"_has{i}") for i, (c, v) in enumerate(zip(columns, codes))]
    return df.agg(*has).select(F.explode(F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(code).alias("code"), (F.col(f"_has{i}") == 1).alias("present"))
        for i, (label, code) in enumerate(zip(COMPONENT_LABELS, codes))])).alias("r")).select("r.*")


def filter_component(
    df: DataFrame,
    sas_code: str,
    cord_code: str,
    credit_debit: str,
    columns: tuple[str, str, str] = ("sas_code", "cord_code", "credit_debit"),
) -> DataFrame:
    """Rows matching all three component codes; a code absent from its column is an error.

    The three presence tests run as one aggregate job, checked in order.
    """
    for r in component_presence(df, (sas_code, cord_code, credit_debit), columns).collect():  # 3 rows
        if not r["present"]:
            raise checks.CheckFailed(f"{r['label']} '{r['code']}' not found in data.")
    cond = (F.col(columns[0]) == sas_code) & (F.col(columns[1]) == cord_code) & (F.col(columns[2]) == credit_debit)
    return df.where(cond)
