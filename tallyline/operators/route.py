"""Split rows over numbered outputs by a function of the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_company(company: str) -> Column:
    """Output 0 for the given company, output 1 for all others."""
    return F.when(F.col("company") == company, 0).otherwise(1)


def route(rows: DataFrame, target: Column, outputs: int) -> DataFrame:
    """Add the output number as ``route``; a number outside ``0 .. outputs-1`` is an error."""
    in_range = (target >= 0) & (target < outputs)
    message = F.concat(F.lit(f"route outside 0..{outputs - 1}: "), F.coalesce(target.cast("string"), F.lit("null")))
    return rows.withColumn("route", F.when(in_range, target).otherwise(F.raise_error(message).cast("int")))


def split(rows: DataFrame, target: Column, outputs: int) -> list[DataFrame]:
    """The outputs as separate DataFrames over the same rows."""
    routed = route(rows, target, outputs)
    return [routed.where(F.col("route") == i).drop("route") for i in range(outputs)]
