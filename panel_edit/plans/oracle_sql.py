"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each query is a chain of common table expressions over the driver's tables;
the chain for an operator extends the chain of the operators it builds on.
Values are rounded exactly as in :mod:`panel_edit.plans.catalog`.
"""

from __future__ import annotations

# Fixed parameters of the derived fixture, as in panel_edit.plans.fixtures.
PANEL = """
sums AS (
  SELECT l_suppkey AS area_key, CAST(year(l_shipdate) AS INTEGER) AS period,
         sum(round(l_extendedprice)) AS v
  FROM lineitem GROUP BY l_suppkey, CAST(year(l_shipdate) AS INTEGER)),
geo AS (
  SELECT s.s_suppkey AS area_key, s.s_name AS area_name, n.n_regionkey AS parent_key,
         r.r_name AS parent_name
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey),
base AS (
  SELECT s.area_key, g.area_name, g.parent_key, g.parent_name, s.period, s.v,
         max(CASE WHEN s.period = 1997 THEN s.v END) OVER (PARTITION BY s.area_key) AS copy_value,
         fa.first_area
  FROM sums s JOIN geo g ON s.area_key = g.area_key
  JOIN (SELECT parent_key, min(area_key) AS first_area FROM geo GROUP BY parent_key) fa ON fa.parent_key = g.parent_key),
panel AS (
  SELECT 'A' || CAST(area_key AS VARCHAR) AS area, area_name,
         CASE WHEN parent_key = 1 THEN 'S30' ELSE 'E06' END || CAST(parent_key AS VARCHAR) AS parent,
         parent_name, period,
         CASE WHEN area_key % 17 = 5 AND period = 2000 THEN NULL WHEN area_key % 13 = 4 AND period = 1999 THEN 0.0
              WHEN parent_key % 2 = 0 AND period <= 1996 THEN copy_value ELSE v END AS uncon,
         CASE WHEN parent_key = 1 AND period = 1997 THEN floor(v / 1000) ELSE v END * (parent_key + 1) AS con,
         CASE WHEN area_key = first_area OR area_key % 3 <> 0 THEN ''
              WHEN area_key % 4 = 0 THEN '1995'
              WHEN area_key % 4 = 1 THEN '1998, 1999'
              WHEN area_key % 20 = 6 THEN '1998,1999,2000,2001'
              WHEN area_key % 4 = 2 THEN '2001.0'
              ELSE '1997' END AS listed,
         area_key, parent_key
  FROM base)"""

RATIOS = PANEL + """,
filled AS (
  SELECT *,
    last_value(uncon IGNORE NULLS) OVER (PARTITION BY area ORDER BY period
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fill_up,
    first_value(uncon IGNORE NULLS) OVER (PARTITION BY area ORDER BY period
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fill_down
  FROM panel),
ratios AS (
  SELECT * EXCLUDE (fill_up, fill_down),
    (fill_down / nullif(lead(fill_down) OVER (PARTITION BY area ORDER BY period), 0) - 1.0) + 1.0
      AS backward_pct_change,
    (fill_up / nullif(lag(fill_up) OVER (PARTITION BY area ORDER BY period), 0) - 1.0) + 1.0
      AS forward_pct_change
  FROM filled),
rolled AS (
  SELECT *, coalesce(backward_pct_change = 1.0 OR forward_pct_change = 1.0, false)
            AND period BETWEEN 1995 AND 1996 AS rollback_flag
  FROM ratios)"""


def _zscore(src: str, dst: str, prefix: str, value: str, group: str = "parent",
            upper: float = 2.0, lower: float = -2.0) -> str:
    return f""",
{dst}_x AS (SELECT *, CASE WHEN NOT rollback_flag THEN {value} END AS {prefix}_x FROM {src}),
{dst}_s AS (SELECT {group}, avg({prefix}_x) AS {prefix}_m, stddev_samp({prefix}_x) AS {prefix}_sd
            FROM {dst}_x GROUP BY {group}),
{dst}_z AS (SELECT {dst}_x.*, ({prefix}_x - {prefix}_m) / nullif({prefix}_sd, 0) AS {prefix}_zscore
            FROM {dst}_x LEFT JOIN {dst}_s USING ({group})),
{dst} AS (
  SELECT * EXCLUDE ({prefix}_x),
    CASE WHEN {prefix}_zscore > {upper} THEN 'upper' WHEN {prefix}_zscore < {lower} THEN 'lower' END
      AS {prefix}_zscore_threshold,
    coalesce({prefix}_zscore > {upper} OR {prefix}_zscore < {lower}, false) AS z_{prefix}_flag
  FROM {dst}_z)"""


ZSCORES = RATIOS + _zscore("rolled", "zb", "bkwd", "backward_pct_change") + _zscore(
    "zb", "zf", "frwd", "forward_pct_change"
)


YEARS = list(range(1995, 2002))
FLAGS = "master_z_flag, master_iqr_flag, master_flag"
IDS = "area, area_name, parent, parent_name"

FLAGGED = ZSCORES + """,
iq_x AS (SELECT *, CASE WHEN NOT rollback_flag THEN uncon END AS iqr_x FROM zf),
iq_q AS (SELECT parent, period, quantile_cont(iqr_x, 0.25) AS raw_q1, quantile_cont(iqr_x, 0.75) AS raw_q3
         FROM iq_x WHERE iqr_x IS NOT NULL GROUP BY parent, period),
iq_b AS (SELECT iq_x.* EXCLUDE (iqr_x), raw_q1, raw_q3, raw_q3 - raw_q1 AS raw_iqr
         FROM iq_x LEFT JOIN iq_q USING (parent, period)),
iq AS (SELECT *, raw_q1 - 1.0 * raw_iqr AS raw_lower_bound, raw_q3 + 1.0 * raw_iqr AS raw_upper_bound FROM iq_b),
iqf AS (SELECT *,
          CASE WHEN uncon > raw_upper_bound THEN 'upper' WHEN uncon < raw_lower_bound THEN 'lower' END
            AS raw_iqr_threshold,
          coalesce(uncon > raw_upper_bound OR uncon < raw_lower_bound, false) AS iqr_raw_flag
        FROM iq),
mf AS (SELECT *, bool_or(z_bkwd_flag OR z_frwd_flag) OVER (PARTITION BY area) AS master_z_flag,
              bool_or(iqr_raw_flag) OVER (PARTITION BY area) AS master_iqr_flag FROM iqf),
mf2 AS (SELECT *, master_z_flag AND master_iqr_flag AS master_flag FROM mf),
pm_s AS (SELECT parent, period, avg(uncon) AS mean_non_outlier FROM mf2 WHERE NOT master_flag
         GROUP BY parent, period),
pm AS (SELECT area, area_name, parent, parent_name, period, uncon, master_z_flag, master_iqr_flag,
              master_flag, mean_non_outlier
       FROM mf2 LEFT JOIN pm_s USING (parent, period) WHERE master_flag)"""

TOTALS = """,
ptot AS (SELECT parent, parent_key, parent_name, period, sum(con) AS total FROM panel
         GROUP BY parent, parent_key, parent_name, period),
totals_long AS (
  SELECT 'R' || CAST(parent_key AS VARCHAR) AS region, parent, parent_name AS region_name,
         'D1' AS transaction_code, 'Household income' AS "transaction", period,
         format('{:,.2f}', round(total * 1, 2)) AS uncon FROM ptot
  UNION ALL
  SELECT 'R' || CAST(parent_key AS VARCHAR), parent, parent_name, 'D2', 'Other income', period,
         format('{:,.2f}', round(total * 2, 2)) FROM ptot)"""

CONSTRAINED = FLAGGED + TOTALS + """,
tl AS (SELECT parent, period, CAST(replace(uncon, ',', '') AS DOUBLE) AS parent_total FROM totals_long
       WHERE "transaction" = 'Household income'),
cs AS (SELECT pm.*, parent_total, uncon + mean_non_outlier AS den FROM pm LEFT JOIN tl USING (parent, period)),
cs2 AS (SELECT * EXCLUDE (parent_total, den, master_flag),
          uncon * (CASE WHEN den = 0 THEN 0 ELSE parent_total / den END) AS con_area,
          mean_non_outlier * (CASE WHEN den = 0 THEN 0 ELSE parent_total / den END) AS con_mean,
          CASE WHEN master_flag THEN 'TRUE' ELSE 'MEAN' END AS master_flag
        FROM cs)"""


def _years_list(text: str) -> str:
    return (f"list_transform(list_filter(string_split(replace(coalesce({text}, ''), ' ', ''), ','), "
            f"lambda x: x <> '' AND lower(x) <> 'nan'), lambda x: CAST(trunc(CAST(x AS DOUBLE)) AS INTEGER))")


def _prev_free(period: str, lst: str, start: int) -> str:
    stop = start - 1
    return (f"CASE WHEN NOT list_contains({lst}, {period}) OR {period} <= {stop} THEN {period} "
            f"ELSE coalesce(list_max(list_filter(range({stop}, {period} + 1), "
            f"lambda k: NOT list_contains({lst}, k))), {stop}) END")


def _next_free(period: str, lst: str, end: int) -> str:
    stop = end + 1
    return (f"CASE WHEN NOT list_contains({lst}, {period}) OR {period} >= {stop} THEN {period} "
            f"ELSE coalesce(list_min(list_filter(range({period}, {stop} + 1), "
            f"lambda k: NOT list_contains({lst}, k))), {stop}) END")


DECISIONS = PANEL + f""",
dec AS (
  SELECT DISTINCT area, area_name, parent, parent_name,
         CASE WHEN listed <> '' THEN 'TRUE' WHEN area_key % 3 = 1 THEN 'FALSE'
              WHEN area_key % 3 = 2 THEN NULL ELSE 'no' END AS adjust_text,
         CASE WHEN listed <> '' THEN listed WHEN area_key % 3 = 1 THEN '1999' END AS year_text
  FROM panel),
p9 AS (SELECT area, area_name, parent, parent_name, coalesce(adjust_text = 'TRUE', false) AS adjust,
              {_years_list("year_text")} AS year FROM dec),
f2 AS (SELECT area, parent, adjust, year FROM p9 WHERE adjust)"""

ADJUST = DECISIONS + f""",
along AS (
  SELECT p.area, p.area_name, p.parent, p.parent_name, coalesce(f2.adjust, false) AS adjust,
         f2.year AS year_to_adjust, p.period, p.uncon, p.con
  FROM panel p LEFT JOIN f2 ON p.area = f2.area AND p.parent = f2.parent),
afilled AS (
  SELECT *,
    last_value(uncon IGNORE NULLS) OVER (PARTITION BY area ORDER BY period
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fill_up,
    first_value(uncon IGNORE NULLS) OVER (PARTITION BY area ORDER BY period
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fill_down
  FROM along),
aratios AS (
  SELECT * EXCLUDE (fill_up, fill_down),
    (fill_down / nullif(lead(fill_down) OVER (PARTITION BY area ORDER BY period), 0) - 1.0) + 1.0
      AS backward_pct_change,
    (fill_up / nullif(lag(fill_up) OVER (PARTITION BY area ORDER BY period), 0) - 1.0) + 1.0
      AS forward_pct_change
  FROM afilled),
arolled AS (
  SELECT * EXCLUDE (year_to_adjust), coalesce(year_to_adjust, CAST([] AS INTEGER[])) AS year_to_adjust,
         coalesce(backward_pct_change = 1.0 OR forward_pct_change = 1.0, false)
           AND period BETWEEN 1995 AND 1996 AS rollback_flag
  FROM aratios),
safe0 AS (
  SELECT *, {_prev_free("period", "year_to_adjust", 1995)} AS prev_safe_year,
            {_next_free("period", "year_to_adjust", 2001)} AS next_safe_year
  FROM arolled WHERE list_contains(year_to_adjust, period)),
safe AS (
  SELECT s.*, pv.con AS prev_con, nx.con AS next_con FROM safe0 s
  LEFT JOIN arolled pv ON pv.area = s.area AND pv.period = s.prev_safe_year
  LEFT JOIN arolled nx ON nx.area = s.area AND nx.period = s.next_safe_year),
interp AS (
  SELECT *, CASE WHEN prev_con IS NOT NULL AND next_con IS NOT NULL AND NOT rollback_flag
                 THEN (next_con - prev_con) / (next_safe_year - prev_safe_year) * (period - prev_safe_year)
                      + prev_con END AS imputed
  FROM safe),
extra0 AS (
  SELECT *, CASE WHEN prev_con IS NULL OR rollback_flag THEN next_safe_year + 4
                 WHEN next_con IS NULL THEN prev_safe_year - 4 END AS extra_year
  FROM interp),
extra AS (
  SELECT e.* EXCLUDE (imputed),
    CASE WHEN e.imputed IS NULL AND x.con IS NOT NULL THEN
      CASE WHEN e.prev_con IS NULL OR e.rollback_flag
           THEN e.next_con - ((x.con - e.next_con) / (e.extra_year - e.next_safe_year)) * (e.next_safe_year - e.period)
           ELSE e.prev_con + ((e.prev_con - x.con) / (e.prev_safe_year - e.extra_year)) * (e.period - e.prev_safe_year)
      END
    ELSE e.imputed END AS imputed
  FROM extra0 e LEFT JOIN arolled x ON x.area = e.area AND x.period = e.extra_year),
d10_s AS (
  SELECT parent, period, coalesce(sum(con), 0) AS parent_total,
         coalesce(sum(CASE WHEN NOT list_contains(year_to_adjust, period) THEN con END), 0) AS non_out
  FROM arolled GROUP BY parent, period),
d10 AS (
  SELECT a.*, parent_total,
         CASE WHEN NOT list_contains(year_to_adjust, period) THEN non_out END AS non_outlier_total
  FROM arolled a JOIN d10_s USING (parent, period)),
d10p AS (SELECT *, con / nullif(non_outlier_total, 0) AS proportion FROM d10),
d11a AS (SELECT d10p.*, i.imputed FROM d10p LEFT JOIN extra i USING (area, period)),
d11s AS (SELECT parent, period, coalesce(sum(imputed), 0) AS imp_sum FROM d11a GROUP BY parent, period),
d11 AS (
  SELECT d11a.*, parent_total - imp_sum AS adjusted_total,
         CASE WHEN imputed IS NOT NULL THEN imputed ELSE proportion * (parent_total - imp_sum) END AS adjusted_con
  FROM d11a JOIN d11s USING (parent, period)),
d12s AS (
  SELECT parent, period, min(adjusted_con) AS min_adjusted, sum(adjusted_con) AS adj_sum,
         count(adjusted_con) AS adj_n
  FROM d11 GROUP BY parent, period),
d12a AS (
  SELECT d11.*, min_adjusted, CASE WHEN min_adjusted < 0 THEN abs(min_adjusted) ELSE 0.0 END AS abs_adjustment,
         adj_sum, adj_n
  FROM d11 JOIN d12s USING (parent, period)),
d12 AS (
  SELECT * EXCLUDE (adj_sum, adj_n), adjusted_con + abs_adjustment AS over_adjusted,
         (adjusted_con + abs_adjustment) / nullif(adj_sum + adj_n * abs_adjustment, 0) * parent_total
           AS readjusted_con
  FROM d12a),
mlast AS (SELECT max(period) AS m FROM d12 WHERE rollback_flag),
d13a AS (
  SELECT d12.*, min(CASE WHEN period = (SELECT m FROM mlast) THEN readjusted_con END)
                  OVER (PARTITION BY area) AS area_m
  FROM d12),
pm13 AS (SELECT parent, sum(readjusted_con) AS parent_m FROM d12 WHERE period = (SELECT m FROM mlast)
         GROUP BY parent),
d13 AS (
  SELECT d13a.*, CASE WHEN rollback_flag THEN parent_total * (area_m / nullif(parent_m, 0))
                      ELSE readjusted_con END AS rollback_con
  FROM d13a LEFT JOIN pm13 USING (parent))"""

IMPUTED_COLS = "area, period, rollback_flag, prev_safe_year, round(prev_con, 4) AS prev_con, next_safe_year, " \
               "round(next_con, 4) AS next_con"


def _pivot(value: str, prefix: str = "", digits: int = 4) -> str:
    return ", ".join(
        f'round(max(CASE WHEN period = {y} THEN {value} END), {digits}) AS "{prefix}{y}"' for y in YEARS
    )


def _wide_metrics(src: str, first: str, second: str, flag: str = "master_flag", digits: int = 4) -> str:
    return f"""SELECT {IDS}, master_z_flag, master_iqr_flag, {flag} AS master_flag,
  {_pivot(first, digits=digits)}, {_pivot(second, "CONLSOA_")}
FROM {src} GROUP BY {IDS}, master_z_flag, master_iqr_flag, master_flag"""


def _with(ctes: str, select: str) -> str:
    return "WITH " + ctes.strip() + "\n" + select.strip()


MAPPING = PANEL + f""",
wcon AS (SELECT {IDS}, {", ".join(f'max(CASE WHEN period = {y} THEN con END) AS "{y}"' for y in YEARS)}
         FROM panel GROUP BY {IDS}),
lk AS (
  SELECT DISTINCT 'L' || CAST(n_regionkey // 2 AS VARCHAR) AS mapper_lad_code,
         'Group ' || CAST(n_regionkey // 2 AS VARCHAR) AS mapper_lad_name,
         CASE WHEN n_regionkey = 1 THEN 'S30' ELSE 'E06' END || CAST(n_regionkey AS VARCHAR) AS mapper_lau_code,
         r_name AS mapper_lau_name
  FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_regionkey < 4),
mj AS (SELECT w.area, w.area_name, {", ".join(f'w."{y}"' for y in YEARS)}, lk.*
       FROM wcon w LEFT JOIN lk ON w.parent = lk.mapper_lau_code)"""

_YCOLS = ", ".join(f'round("{y}", 4) AS "{y}"' for y in YEARS)
_YSUMS = ", ".join(f'round(coalesce(sum("{y}"), 0), 4) AS "{y}"' for y in YEARS)

ORACLE: dict[str, str] = {
    "io1_csv_roundtrip": _with(PANEL, f"""
SELECT {IDS}, {_pivot('uncon')}, area_name || ', "quoted"' || chr(10) || 'and ' || chr(92) || ' more' AS note,
       CAST(area_key AS BIGINT) AS rank, round(area_key / 4.0, 4) AS share, area_key % 2 = 0 AS even
FROM panel GROUP BY {IDS}, area_key"""),
    "io4_coercions": _with(PANEL, """,
k AS (SELECT DISTINCT area_key AS key, CAST(area_key AS VARCHAR) AS t FROM panel),
cells AS (
  SELECT 'rank' AS "column", CASE WHEN key % 5 = 1 THEN t || '.5' WHEN key % 7 = 2 THEN 'not known' END AS value FROM k
  UNION ALL SELECT 'share', CASE WHEN key % 4 = 3 THEN '1,' || t END FROM k
  UNION ALL SELECT 'even', CASE WHEN key % 6 = 2 THEN 'perhaps' END FROM k
  UNION ALL SELECT '1995', CASE WHEN key % 9 = 4 THEN '12 500' END FROM k)
SELECT "column", value, count(*) AS n FROM cells WHERE value IS NOT NULL GROUP BY ALL"""),
    "v3_negatives": _with(PANEL, """
SELECT area, parent, period, round(x, 4) AS readjusted_con
FROM (SELECT *, con - 1.25 * min(con) OVER (PARTITION BY parent, period) AS x FROM panel) WHERE x < 0"""),
    "v4_missing_columns": _with(PANEL + TOTALS, """,
one AS (SELECT * FROM totals_long WHERE "transaction" = 'Household income')
SELECT 'transaction_code' AS "column", count(transaction_code) AS n_values FROM one
UNION ALL SELECT 'transaction', count("transaction") FROM one"""),
    "v7_duplicate_years": _with(PANEL, """
SELECT DISTINCT area, '1999,1999' AS years FROM panel WHERE area_key % 5 = 1"""),
    "v8_years_out_of_range": _with(PANEL, """
SELECT DISTINCT area, '1990,2001' AS years FROM panel WHERE area_key % 7 = 2 AND area_key % 5 <> 1"""),
    "v9_component_presence": """
SELECT 'SAS code' AS label, 'R' AS code, count(*) > 0 AS present FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT 'CORD code', 'F', count(*) > 0 FROM lineitem WHERE l_linestatus = 'F'
UNION ALL SELECT 'Credit/Debit code', 'no such code', count(*) > 0 FROM lineitem WHERE l_linestatus = 'no such code'""",
    "v10_schema_violations": _with(PANEL, """
SELECT 'uncon' AS "column", 'int' AS declared, 'missing values' AS problem, count(*) AS n FROM panel
WHERE uncon IS NULL HAVING count(*) > 0
UNION ALL VALUES ('area', 'int', 'type string', 0), ('absent', 'str', 'no such column', 0)"""),
    "p4_prefix_rename": _with(MAPPING, f"""
SELECT area, area_name, parent AS data_lau_code, parent_name AS data_lau_name, {_YCOLS},
       (SELECT bool_or(starts_with(parent, 'S30')) FROM wcon) AS need_mapping FROM wcon"""),
    "a11_mapper_distinct": _with(MAPPING, "SELECT * FROM lk"),
    "j13_mapper_join": _with(MAPPING, f"""
SELECT area, area_name, {_YCOLS}, mapper_lad_code, mapper_lad_name, mapper_lau_code, mapper_lau_name FROM mj"""),
    "v12_unmatched": _with(MAPPING, "SELECT area, area_name FROM mj WHERE mapper_lad_code IS NULL"),
    "a10_rollup": _with(MAPPING, f"""
SELECT mapper_lad_code, mapper_lad_name, {_YSUMS} FROM mj
WHERE mapper_lad_code IS NOT NULL AND mapper_lad_name IS NOT NULL GROUP BY mapper_lad_code, mapper_lad_name"""),
    "e3_mapping": _with(MAPPING, f"""
SELECT area, area_name, mapper_lad_code AS parent, mapper_lad_name AS parent_name, {_YSUMS} FROM mj
WHERE mapper_lad_code IS NOT NULL AND mapper_lad_name IS NOT NULL AND area IS NOT NULL AND area_name IS NOT NULL
  AND mapper_lau_code IS NOT NULL AND mapper_lau_name IS NOT NULL
GROUP BY area, area_name, mapper_lad_code, mapper_lad_name, mapper_lau_code, mapper_lau_name"""),
    "p8_adjust_flag": _with(DECISIONS, "SELECT area, adjust FROM p9"),
    "p9_year_list": _with(DECISIONS, """
SELECT area, array_to_string(year, ',') AS years, CAST(len(year) AS INTEGER) AS n_years FROM p9"""),
    "f2_adjust_rows": _with(DECISIONS, "SELECT area, parent, adjust, array_to_string(year, ',') AS year FROM f2"),
    "f1_period_range": _with(PANEL, """
SELECT area, period, round(uncon, 4) AS uncon FROM panel WHERE period BETWEEN 1996 AND 2000"""),
    "f3_component_filter": """
WITH comp AS (
  SELECT l_suppkey AS supplier, CAST(year(l_shipdate) AS INTEGER) AS period, l_returnflag AS sas_code,
         l_linestatus AS cord_code, CASE WHEN l_discount > 0.05 THEN 'D' ELSE 'C' END AS credit_debit,
         sum(round(l_extendedprice)) AS value
  FROM lineitem GROUP BY ALL)
SELECT supplier, period, sas_code, cord_code, credit_debit, round(value, 4) AS value FROM comp
WHERE sas_code = 'R' AND cord_code = 'F' AND credit_debit = 'C'""",
    "j1_decision_con": _with(DECISIONS, f"""
SELECT {IDS}, {_pivot("p.con", "CON_")}, any_value(f2.adjust) AS adjust,
       array_to_string(any_value(f2.year), ',') AS year
FROM (SELECT * FROM panel) p LEFT JOIN f2 USING (area, parent) GROUP BY {IDS}"""),
    "j2_decision_uncon": _with(DECISIONS, f"""
SELECT {IDS}, {_pivot("p.uncon")}, {_pivot("p.con", "CON_")}, coalesce(any_value(f2.adjust), false) AS adjust,
       array_to_string(any_value(f2.year), ',') AS year
FROM panel p LEFT JOIN f2 USING (area, parent) GROUP BY {IDS}"""),
    "v6_row_growth": _with(DECISIONS, """,
areas AS (SELECT count(*) AS n FROM dec),
adj AS (SELECT count(*) AS n FROM f2)
SELECT 'rows_before' AS measure, n AS value, 'constrained' AS "join" FROM areas
UNION ALL SELECT 'rows_after', n, 'constrained' FROM areas
UNION ALL SELECT 'adjust_before', n, 'constrained' FROM adj
UNION ALL SELECT 'adjust_after', n, 'constrained' FROM adj
UNION ALL SELECT 'rows_before', n, 'unconstrained' FROM areas
UNION ALL SELECT 'rows_after', n, 'unconstrained' FROM areas
UNION ALL SELECT 'adjust_before', n, 'unconstrained' FROM adj
UNION ALL SELECT 'adjust_after', n, 'unconstrained' FROM adj"""),
    "r4_adjust_long": _with(ADJUST, f"""
SELECT {IDS}, adjust, array_to_string(year_to_adjust, ',') AS year_to_adjust, period,
       round(uncon, 4) AS uncon, round(con, 4) AS con FROM along"""),
    "s3_next_free_year": _with(PANEL, f""",
pl AS (SELECT area, period, {_years_list("listed")} AS lst FROM panel)
SELECT area, period, array_to_string(lst, ',') AS years, {_prev_free("period", "lst", 1995)} AS prev_free_year,
       {_next_free("period", "lst", 2001)} AS next_free_year FROM pl"""),
    "d7_safe_years": _with(ADJUST, f"""
SELECT {IMPUTED_COLS}, array_to_string(year_to_adjust, ',') AS year_to_adjust FROM safe"""),
    "d8_interpolate": _with(ADJUST, f"SELECT {IMPUTED_COLS}, round(imputed, 4) AS imputed FROM interp"),
    "d9_extrapolate": _with(ADJUST, f"SELECT {IMPUTED_COLS}, round(imputed, 4) AS imputed FROM extra"),
    "d10_proportions": _with(ADJUST, """
SELECT area, parent, period, round(con, 4) AS con, round(parent_total, 4) AS parent_total,
       round(non_outlier_total, 4) AS non_outlier_total, round(proportion, 12) AS proportion FROM d10p"""),
    "d11_apportion": _with(ADJUST, """
SELECT area, parent, period, round(con, 4) AS con, round(imputed, 4) AS imputed,
       round(adjusted_total, 3) AS adjusted_total, round(adjusted_con, 3) AS adjusted_con FROM d11"""),
    "d12_no_negatives": _with(ADJUST, """
SELECT area, parent, period, round(min_adjusted, 3) AS min_adjusted, round(abs_adjustment, 3) AS abs_adjustment,
       round(over_adjusted, 3) AS over_adjusted, round(readjusted_con, 3) AS readjusted_con FROM d12"""),
    "d13_rollback_years": _with(ADJUST, """
SELECT area, parent, period, rollback_flag, round(readjusted_con, 3) AS readjusted_con,
       round(rollback_con, 3) AS rollback_con FROM d13"""),
    "v1_sum_match": _with(ADJUST, """,
after AS (SELECT parent, period, con, rollback_con AS v, 'rollback_con' AS "values" FROM d13
          UNION ALL SELECT parent, period, con, coalesce(imputed, con), 'imputed_only' FROM d13),
v1 AS (SELECT parent, period, "values", coalesce(sum(con), 0) AS sum_before, coalesce(sum(v), 0) AS sum_after
       FROM after GROUP BY parent, period, "values")
SELECT parent, period, "values", round(sum_before, 2) AS sum_before, round(sum_after, 2) AS sum_after,
       abs(sum_before - sum_after) <= 1e-6 + 1e-12 * abs(sum_before) AS within_tolerance FROM v1"""),
    "v2_zero_total": _with(PANEL, f""",
z AS (SELECT parent, period, {_years_list("listed")} AS lst,
             CASE WHEN parent_key = 3 AND period = 1999 THEN 0.0 ELSE con END AS con FROM panel),
zs AS (SELECT parent, period, coalesce(sum(CASE WHEN NOT list_contains(lst, period) THEN con END), 0) AS non_out,
              bool_or(NOT list_contains(lst, period)) AS has_unlisted
       FROM z GROUP BY parent, period)
SELECT parent, period FROM zs WHERE has_unlisted AND non_out = 0"""),
    "r5_final_wide": _with(ADJUST, f"SELECT {IDS}, {_pivot('rollback_con', digits=3)} FROM d13 GROUP BY {IDS}"),
    "e2_adjust": _with(ADJUST, f"SELECT {IDS}, {_pivot('readjusted_con', digits=3)} FROM d13 GROUP BY {IDS}"),
    "d2_iqr": _with(FLAGGED, """
SELECT area, parent, period, round(raw_q1, 4) AS raw_q1, round(raw_q3, 4) AS raw_q3,
       round(raw_iqr, 4) AS raw_iqr, round(raw_lower_bound, 4) AS raw_lower_bound,
       round(raw_upper_bound, 4) AS raw_upper_bound, raw_iqr_threshold, iqr_raw_flag FROM iqf"""),
    "d3_master": _with(FLAGGED, """
SELECT area, period, master_z_flag, master_iqr_flag, master_flag FROM mf2"""),
    "d4_parent_mean": _with(FLAGGED, """
SELECT area, parent, period, round(uncon, 4) AS uncon, round(mean_non_outlier, 6) AS mean_non_outlier FROM pm"""),
    "d5_constrain": _with(CONSTRAINED, """
SELECT area, parent, period, round(uncon, 4) AS uncon, round(mean_non_outlier, 4) AS mean_non_outlier,
       round(con_area, 4) AS con_area, round(con_mean, 4) AS con_mean, master_flag FROM cs2"""),
    "r1_wide_to_long": _with(PANEL, f"""
SELECT {IDS}, period, round(uncon, 4) AS uncon FROM panel"""),
    "f4_transaction_filter": _with(PANEL + TOTALS, """
SELECT parent, period, uncon FROM totals_long WHERE "transaction" = 'Household income'"""),
    "v11_pivot_dups": _with(PANEL + TOTALS, """
SELECT parent, period, count(*) AS n_rows FROM totals_long GROUP BY parent, period HAVING count(*) > 1"""),
    "p2_thousands": _with(PANEL + TOTALS, """
SELECT parent, "transaction", period, round(CAST(replace(uncon, ',', '') AS DOUBLE), 2) AS value
FROM totals_long"""),
    "r2_metrics_long": _with(CONSTRAINED, f"""
SELECT {IDS}, period, {FLAGS}, 'uncon' AS metric, round(uncon, 4) AS value,
       'uncon_' || CAST(period AS VARCHAR) AS metric_date FROM cs2
UNION ALL
SELECT {IDS}, period, {FLAGS}, 'CONLSOA', round(con_area, 4), 'CONLSOA_' || CAST(period AS VARCHAR) FROM cs2"""),
    "r3_metrics_wide": _with(CONSTRAINED, _wide_metrics("cs2", "uncon", "con_area")),
    "d6_union_sorted": _with(CONSTRAINED, _wide_metrics("cs2", "uncon", "con_area") + "\nUNION ALL\n"
                             + _wide_metrics("cs2", "mean_non_outlier", "con_mean", "'MEAN'")),
    "e1_preprocess": _with(CONSTRAINED, _wide_metrics("cs2", "uncon", "con_area", digits=6) + "\nUNION ALL\n"
                           + _wide_metrics("cs2", "mean_non_outlier", "con_mean", "'MEAN'", digits=6)),
    "w1_forward": _with(RATIOS, """
SELECT area, period, round(forward_pct_change, 6) AS forward_pct_change FROM ratios"""),
    "w2_backward": _with(RATIOS, """
SELECT area, period, round(backward_pct_change, 6) AS backward_pct_change FROM ratios"""),
    "d1_rollback": _with(RATIOS, """
SELECT area, parent, period, rollback_flag FROM rolled"""),
    "w3_zscore": _with(ZSCORES, """
SELECT area, parent, period, round(bkwd_zscore, 6) AS bkwd_zscore, bkwd_zscore_threshold,
       z_bkwd_flag, round(frwd_zscore, 6) AS frwd_zscore, frwd_zscore_threshold, z_frwd_flag
FROM zf"""),
}


def _scaled_rounds(sql: str) -> str:
    """Rewrite every ``round(x, d)`` as ``(round((x) * 1ed) / 1ed + 0.0)`` (see catalog.scaled_round).

    ``round(x)`` without digits and the text formatting inside ``format(...)``
    are left as they are.
    """
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner_end = k - 1
        inside_format = sql.rfind("format(", 0, j) > sql.rfind(")", 0, j)
        if comma is None or inside_format or not sql[comma + 1:inner_end].strip().isdigit():
            out.append(sql[i:k])
        else:
            digits = int(sql[comma + 1:inner_end].strip())
            expr = _scaled_rounds(sql[j + 6:comma])
            out.append(sql[i:j] + f"(round(({expr}) * 1e{digits}) / 1e{digits} + 0.0)")
        i = k


ORACLE = {name: _scaled_rounds(sql) for name, sql in ORACLE.items()}
