"""Project counts per product, version and dongle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagetally.operators.clean import named_projects


def project_summary(facts: DataFrame, named_only: bool = False) -> DataFrame:
    """``product_id ver lock_number project_cnt`` over a fact table.

    ``named_only`` applies the optional P16 filter (a name without ``tmp``).
    """
    src = named_projects(facts) if named_only else facts
    return src.groupBy(
        F.col("pcode").cast("string").alias("product_id"),
        F.col("ver"),
        F.col("dognum").alias("lock_number"),
    ).agg(F.count(F.lit(1)).alias("project_cnt"))
