"""panel_edit: statistical editing of small-area panels on Spark DataFrames.

A panel holds one value per area and period; every area sits inside one parent
whose totals are trusted. The operators find outlier areas, constrain them to
parent totals, impute analyst-listed area-periods, re-apportion differences so
parent totals hold, and map results to another geography.

Every operator is a plain function ``DataFrame -> DataFrame`` built from
``pyspark.sql.functions`` expressions, windows bounded by one area's periods,
partial aggregations and size-checked broadcast joins.
"""

__version__ = "0.1.0"
