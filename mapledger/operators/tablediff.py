"""Structure and row comparison of two tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def describe_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows (table_name, column_name, data_type, ordinal) of the given tables' schemas."""
    rows = [
        (name, field.name, field.dataType.simpleString(), position)
        for name, df in tables.items()
        for position, field in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, "table_name STRING, column_name STRING, data_type STRING, ordinal BIGINT")


def compare_structure(columns_a: DataFrame, columns_b: DataFrame) -> DataFrame:
    """Columns that one table lacks, types differently or (where both state it) by another length.

    Many table pairs at once. Column names compare without case.
    """
    names = ["table_name", "column_name", "data_type", "ordinal"]
    if "data_length" in columns_a.columns and "data_length" in columns_b.columns:
        names.append("data_length")
    a, b = (df.select(*names, F.lit(mark).alias("mark")) for df, mark in ((columns_a, "a"), (columns_b, "b")))
    return compare_sides(a.unionByName(b))


def compare_sides(columns: DataFrame) -> DataFrame:
    """D1 over one table of both sides' columns, told apart by `mark` (a, b): one grouping, one exchange."""
    facts = {"column": "column_name", "type": "data_type", "ordinal": "ordinal"}
    if "data_length" in columns.columns:
        facts["length"] = "data_length"
    fact = F.struct(*[F.col(name).alias(short) for short, name in facts.items()])
    key = F.lower("column_name")
    # what has no name equals nothing on the other side
    apart = F.when(F.col("table_name").isNull() | key.isNull(), F.col("mark"))
    grouped = columns.groupBy("table_name", key.alias("column_key"), apart.alias("_apart")).agg(
        *[F.collect_list(F.when(F.col("mark") == mark, fact)).alias(mark) for mark in ("a", "b")]
    )
    for mark in ("a", "b"):  # a column named twice pairs with every one of the other side
        grouped = grouped.withColumn(mark, F.explode_outer(mark))
    problem = (
        F.when(F.col("b").isNull(), "only in a")
        .when(F.col("a").isNull(), "only in b")
        .when(~F.col("a.type").eqNullSafe(F.col("b.type")), "type")
    )
    if "length" in facts:
        problem = problem.when(~F.col("a.length").eqNullSafe(F.col("b.length")), "length")
    sides = [F.col(f"{mark}.{name}").alias(f"{name}_{mark}") for name in facts for mark in ("a", "b")]
    return grouped.select("table_name", "column_key", *sides, problem.alias("problem")).where(F.col("problem").isNotNull())


def compare_rows(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that the two tables do not hold equally often, NULL being equal to NULL.

    Both sides are counted in one grouping over their common columns: one
    exchange, and equal rows collapse before it. A column of two kinds of type
    (a number and a text) is compared by its text: `01` and 1 differ, and a
    text that is no number is a difference, not an error. Whole numbers,
    floating ones and decimals of different widths compare as numbers.
    """
    names = list(columns) if columns else common_columns(a, b)
    counted = tagged_rows(a, b, names).groupBy(*names).agg(F.sum("_a").alias("count_a"), F.sum("_b").alias("count_b"))
    return counted.where(F.col("count_a") != F.col("count_b"))


def tagged_rows(a: DataFrame, b: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of both tables by the named columns, in types that compare, with the counts `_a` and `_b`."""
    mine, other = _types(a), _types(b)
    by_text = {name for name in names if type_family(mine[name.lower()]) != type_family(other[name.lower()])}

    def side(df: DataFrame, in_a: int) -> DataFrame:
        values = [F.col(name).cast("string").alias(name) if name in by_text else F.col(name) for name in names]
        return df.select(*values, F.lit(in_a).alias("_a"), F.lit(1 - in_a).alias("_b"))

    return side(a, 1).union(side(b, 0))


def type_family(kind: str) -> str:
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return "whole"
    if kind in ("float", "double"):
        return "floating"
    return kind.split("(")[0]


def _types(df: DataFrame) -> dict[str, str]:
    return {field.name.lower(): field.dataType.simpleString() for field in df.schema}


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    other = {name.lower() for name in b.columns}
    return [name for name in a.columns if name.lower() in other]


def comparison_summary(structure: DataFrame, rows: DataFrame) -> DataFrame:
    """D3: one row of counts and flags over the results of D1 and D2."""
    sides = rows.select(
        F.lit(0).alias("_columns"),
        F.greatest(F.col("count_a") - F.col("count_b"), F.lit(0)).alias("_a"),
        F.greatest(F.col("count_b") - F.col("count_a"), F.lit(0)).alias("_b"),
    )
    columns = structure.select(F.lit(1).alias("_columns"), F.lit(0).alias("_a"), F.lit(0).alias("_b"))
    total = columns.unionByName(sides).agg(
        *[
            F.coalesce(F.sum(name).cast("bigint"), F.lit(0).cast("bigint")).alias(alias)
            for name, alias in (("_columns", "column_differences"), ("_a", "rows_only_in_a"), ("_b", "rows_only_in_b"))
        ]
    )
    return total.select(
        (F.col("column_differences") > 0).cast("int").alias("has_template_difference"),
        ((F.col("rows_only_in_a") + F.col("rows_only_in_b")) > 0).cast("int").alias("has_data_difference"),
        "*",
    )
