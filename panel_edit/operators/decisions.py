"""The analyst's decisions: which areas to adjust and in which periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panel_edit.functions.lists import parse_year_list
from panel_edit.operators import checks

#: Identifier columns that keep their names through the decision joins.
KEEP_NAMES = ("area", "area_name", "parent", "parent_name", "adjust", "year")


def adjust_flag(df: DataFrame, adjust: str = "adjust") -> DataFrame:
    """``adjust`` text "TRUE", in any case and with spaces around, or a true boolean -> true; else false."""
    return df.withColumn(adjust, F.coalesce(F.upper(F.trim(F.col(adjust).cast("string"))) == F.lit("TRUE"), F.lit(False)))


def year_list(df: DataFrame, listed: str = "year") -> DataFrame:
    """Parse the listed-periods text into ``array<int>`` (see :func:`parse_year_list`)."""
    return df.withColumn(listed, parse_year_list(listed))


def year_list_violations(df: DataFrame, start: int, end: int, listed: str = "year") -> tuple[DataFrame, DataFrame]:
    """(rows listing a period twice, rows listing a period outside [start, end])."""
    return checks.duplicate_years(df, listed), checks.years_out_of_range(df, listed, start, end)


def check_year_lists(df: DataFrame, start: int, end: int, listed: str = "year") -> None:
    """All list checks from one aggregate, in this order: unreadable item, duplicate, out of range.

    An item that is not a number raises already under ANSI casts; without
    ANSI it parses to NULL, which is reported here instead.
    """
    bad = F.exists(listed, lambda k: k.isNull())
    dup = F.size(listed) != F.size(F.array_distinct(listed))
    out = F.exists(listed, lambda k: (k < start) | (k > end))
    kinds = [("a listed year is not a number", bad), ("a year is listed twice (duplicate years)", dup),
             (f"a listed year is out of the valid range {start}-{end}", out)]
    totals = df.agg(*[F.sum(F.coalesce(k, F.lit(False)).cast("long")).alias(f"_k{i}") for i, (_, k) in enumerate(kinds)]).first()
    for i, (name, kind) in enumerate(kinds):
        if totals[f"_k{i}"]:
            sample = [r[0] for r in df.where(kind).select(listed).take(checks.SHOWN)]
            raise checks.CheckFailed(f"{name} in {totals[f'_k{i}']} rows; {len(sample)} of them: {sample}")


def filter_adjust(
    df: DataFrame, area: str = "area", parent: str = "parent", adjust: str = "adjust", listed: str = "year"
) -> DataFrame:
    """Rows to adjust (NULL counts as false), projected to area, parent, adjust, listed periods."""
    return df.where(F.coalesce(F.col(adjust).cast("boolean"), F.lit(False))).select(area, parent, adjust, listed)


def join_decisions_con(
    con: DataFrame,
    decisions: DataFrame,
    keys: Sequence[str] = ("area", "parent"),
    keep_names: Sequence[str] = KEEP_NAMES,
    prefix: str = "CON_",
    adjust: str = "adjust",
    check: bool = True,
) -> DataFrame:
    """Left-join decisions onto constrained wide rows and prefix every other column with ``CON_``.

    Checks (when ``check``): the number of rows to adjust is unchanged by the
    join, and the join adds no rows.
    """
    joined = con.join(decisions, list(keys), "left")
    joined = joined.withColumnsRenamed({c: f"{prefix}{c}" for c in joined.columns if c not in keep_names})
    if check:
        _check_join(con, decisions, keys, adjust, "constrained")
    return joined


def join_decisions_uncon(
    uncon: DataFrame,
    decisions: DataFrame,
    keys: Sequence[str] = ("area", "area_name", "parent", "parent_name"),
    adjust: str = "adjust",
    check: bool = True,
) -> DataFrame:
    """Left-join (decisions + constrained columns) onto unconstrained wide rows; NULL adjust -> false.

    Both sides are area-level tables, so this is a shuffle join on the ids
    (AQE turns it into a broadcast when one side is small at run time).
    """
    joined = uncon.join(decisions, list(keys), "left").withColumn(
        adjust, F.coalesce(F.col(adjust).cast("boolean"), F.lit(False))
    )
    if check:
        _check_join(uncon, decisions, keys, adjust, "unconstrained")
    return joined


def join_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], adjust: str = "adjust") -> DataFrame:
    """Report rows (measure, value) of ``left LEFT JOIN right ON keys`` without running the join.

    Per key: ``l`` left rows, ``r`` right rows, ``a`` right rows to adjust.
    Rows after the join are ``sum(l * max(r, 1))``; rows to adjust after it
    are ``sum(l * a)``. Both sides are reduced to one row per key first
    (partial aggregation), so nothing is gathered per hot key.
    """
    keys = list(keys)
    flag = F.coalesce(F.col(adjust).cast("boolean"), F.lit(False)).cast("long")
    lc = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_l"))
    rc = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_r"), F.sum(flag).alias("_a"))
    both = lc.join(rc, keys, "full")  # a NULL key never matches, exactly as in the join itself
    matched = F.coalesce(F.col("_l"), F.lit(0))
    totals = both.agg(
        F.sum(matched).alias("rows_before"),
        F.sum(matched * F.greatest(F.coalesce(F.col("_r"), F.lit(0)), F.lit(1))).alias("rows_after"),
        F.sum(F.coalesce(F.col("_a"), F.lit(0))).alias("adjust_before"),
        F.sum(matched * F.coalesce(F.col("_a"), F.lit(0))).alias("adjust_after"),
    )
    return totals.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.coalesce(F.col(m), F.lit(0)).cast("long").alias("value"))
        for m in ("rows_before", "rows_after", "adjust_before", "adjust_after")
    ])).alias("_m")).select("_m.measure", "_m.value")


def _check_join(left: DataFrame, right: DataFrame, keys: Sequence[str], adjust: str, name: str) -> None:
    check_joins([(left, right, keys, name)], adjust)


def check_joins(joins, adjust: str = "adjust") -> None:
    """Row-count and adjust-count checks of several decision joins in one action.

    ``joins``: ``(left, right, keys, name)`` tuples, checked in order.
    """
    reports = [join_counts(l, r, k, adjust).withColumn("_join", F.lit(i)) for i, (l, r, k, _) in enumerate(joins)]
    union = reports[0]
    for rep in reports[1:]:
        union = union.unionByName(rep)
    got = {(row["_join"], row["measure"]): row["value"] for row in union.collect()}  # 4 rows per join
    for i, (_, _, _, name) in enumerate(joins):
        if got[(i, "adjust_before")] != got[(i, "adjust_after")]:
            raise checks.CheckFailed(f"the {name} join changed how many rows are marked for adjustment: {got[(i, 'adjust_before')]} before, {got[(i, 'adjust_after')]} after; counts do not match")
        if got[(i, "rows_before")] != got[(i, "rows_after")]:
            raise checks.CheckFailed(f"the {name} join added rows: {got[(i, 'rows_before')]} before, {got[(i, 'rows_after')]} after")
