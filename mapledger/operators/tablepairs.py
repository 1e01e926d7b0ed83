"""Comparison of many table pairs in one job, and of large tables by checksums of buckets.

Rows of any schema take one form: the pair they belong to and their cells as
texts. All pairs then share one grouping. Before it, order-free checksums of
hash buckets and of rows tell which rows can differ at all, so equal parts of
two tables are read but never shuffled as rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapledger.operators.tablediff import common_columns, compare_structure, describe_columns, tagged_rows, type_family

Pair = tuple[DataFrame | None, DataFrame | None]

BUCKETS = 1 << 16
# bits of the map of unequal rows' hashes: eight megabytes for any number of rows; beyond some
# hundred million unequal ones it spares less, and nothing else changes
FILTER_BITS = 1 << 26
_CHUNK_BITS = 32768  # of a bitmap of Spark's
_MOST_BUCKETS = 1 << 20  # eight bytes each, sent to every executor
# sixteen bits at a time: sums stay in 64 bits up to 2^47 rows of a bucket
_PIECES = [("_h1", 32), ("_h1", 48), ("_h2", 0), ("_h2", 16), ("_h2", 32), ("_h2", 48)]


# --- checksums ------------------------------------------------------------


def _hashed(values: list[Column]) -> list[Column]:
    """Two hashes of a row; NULL is told from an absent value by a flag, as a hash skips it."""
    marked = [part for value in values for part in (value, value.isNull())]
    return [F.xxhash64(F.lit(seed), *marked).alias(name) for seed, name in ((1, "_h1"), (2, "_h2"))]


def keep_unequal(tagged: DataFrame, names: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows that may not be there equally often on both sides; `tagged` holds the named columns and the counts `_a` and `_b`.

    The sides of a bucket are equal if 96 bits of sums of row hashes are, so a
    difference goes unseen once in 2^96 buckets; equal rows always cancel,
    whatever their order and number. Of the buckets that differ only two
    hashes a row are grouped, and rows whose 128 bits come equally often on
    both sides are left out too; so is no row with a difference, unless both of
    its hashes meet those of another one. The table is read three times. What
    travels between the passes are at most `buckets` numbers (a power of two)
    and FILTER_BITS bits.
    """
    hashed = tagged.select("*", *_hashed([F.col(f"`{name}`") for name in names]))
    return _unequal(hashed, buckets).select(*tagged.columns)


def _unequal(hashed: DataFrame, buckets: int) -> DataFrame:
    """`keep_unequal` of rows that come with their hashes."""
    if buckets & (buckets - 1) or not 0 < buckets <= _MOST_BUCKETS:
        raise ValueError(f"buckets must be a power of two up to {_MOST_BUCKETS}")
    placed = hashed.withColumn("_bucket", F.col("_h1").bitwiseAND(F.lit(buckets - 1)))
    sign = (F.col("_a") - F.col("_b")).cast("bigint")
    sums = [
        F.sum(sign * F.shiftrightunsigned(F.col(h), shift).bitwiseAND(F.lit(0xFFFF))).alias(f"s{n}")
        for n, (h, shift) in enumerate(_PIECES)
    ]
    totals = placed.groupBy("_bucket").agg(*sums)
    unequal = totals.where(" OR ".join(f"s{n} <> 0" for n in range(len(_PIECES)))).select("_bucket")
    differing = placed.join(F.broadcast(unequal), "_bucket", "left_semi")
    rows = differing.groupBy("_h1", "_h2").agg(F.sum(sign).alias("_more")).where("_more <> 0")
    chunk, bit = _bit_place("_h1")
    bitmaps = rows.select(chunk.alias("_chunk"), bit.alias("_bit")).groupBy("_chunk").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    kept = differing.withColumn("_chunk", chunk).join(F.broadcast(bitmaps), "_chunk")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return kept.where(F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1)


def _bit_place(name: str) -> tuple[Column, Column]:
    """Where the bit of a hash stands: the number of the bitmap, and the place in it."""
    place = F.col(name).bitwiseAND(F.lit(FILTER_BITS - 1))
    return F.shiftright(place, _CHUNK_BITS.bit_length() - 1), place.bitwiseAND(F.lit(_CHUNK_BITS - 1))


def _counted(tagged: DataFrame, names: list[str]) -> DataFrame:
    counted = tagged.groupBy(*[f"`{name}`" for name in names]).agg(F.sum("_a").alias("count_a"), F.sum("_b").alias("count_b"))
    return counted.where(F.col("count_a") != F.col("count_b"))


def compare_rows_by_bucket(a: DataFrame, b: DataFrame, columns: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """D2 for large tables with few differences: the rows of `compare_rows`, but only unequal buckets are shuffled.

    Where nearly all buckets differ it costs one more reading than
    `compare_rows`. Empty tables and repeated rows are treated as there.
    """
    names = list(columns) if columns else common_columns(a, b)
    return _counted(keep_unequal(tagged_rows(a, b, names), names, buckets), names)


# --- many pairs -----------------------------------------------------------


def _cell(name: str, mine: T.DataType, other: T.DataType) -> Column:
    """The text of a value, equal for two values just if `compare_rows` takes them as equal."""
    value, kind, against = F.col(f"`{name}`"), mine.simpleString(), other.simpleString()
    if type_family(kind) != type_family(against):
        return value.cast("string")
    family = type_family(kind)
    if family == "floating":  # adding zero makes -0.0 the same as 0.0
        return (value.cast("double") + F.lit(0.0)).cast("string")
    if family == "decimal":
        scale = max(mine.scale, other.scale)
        digits = max(mine.precision - mine.scale, other.precision - other.scale)
        return value.cast(f"decimal({min(38, digits + scale)},{min(scale, max(0, 38 - digits))})").cast("string")
    if kind == "timestamp":
        return F.unix_micros(value).cast("string")
    if kind == "binary":
        return F.hex(value)
    if isinstance(mine, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    return value.cast("string")


def _sides(pair: Pair) -> tuple[list[str], list[tuple[DataFrame, int]]]:
    """The columns that a pair is compared by and its tables; a single table is compared by all of its own."""
    a, b = pair
    if a is not None and b is not None:
        return common_columns(a, b), [(a, 1), (b, 0)]
    return (a or b).columns, [(a, 1) if b is None else (b, 0)]


def row_forms(spark: SparkSession, pairs: Mapping[str, Pair], hashed: bool = False) -> DataFrame:
    """Every row of all tables as pair_id, cells and the counts `_a` and `_b`; each table is one narrow branch.

    With `hashed` also the two hashes of pair and cells.
    """
    forms = None
    for pair_id, pair in pairs.items():
        names, sides = _sides(pair)
        fields = [{f.name.lower(): f.dataType for f in df.schema} for df, _ in sides]
        if not names:  # nothing to tell rows by: their number
            sides = [(df.agg(F.count(F.lit(1)).alias("_n")), in_a) for df, in_a in sides]
        n = F.lit(1).cast("bigint") if names else F.col("_n")
        for (df, in_a), mine in zip(sides, fields, strict=True):
            other = fields[0] if mine is fields[-1] else fields[-1]
            cells = [_cell(name, mine[name.lower()], other[name.lower()]) for name in names]
            counts = [(n * F.lit(times)).alias(name) for name, times in (("_a", in_a), ("_b", 1 - in_a))]
            texts = [f"_{n}" for n in range(len(cells))]
            placed = df.select(*[cell.alias(text) for cell, text in zip(cells, texts, strict=True)], *counts)
            hashes = _hashed([F.lit(pair_id), *map(F.col, texts)]) if hashed else []
            form = placed.select(F.lit(pair_id).alias("pair_id"), F.array(*texts).cast("array<string>").alias("cells"), "_a", "_b", *hashes)
            forms = form if forms is None else forms.unionByName(form)
    if forms is None:
        forms = spark.createDataFrame([], "pair_id STRING, cells ARRAY<STRING>, _a BIGINT, _b BIGINT" + ", _h1 BIGINT, _h2 BIGINT" * hashed)
    return forms


def compare_pairs_structure(spark: SparkSession, pairs: Mapping[str, Pair]) -> DataFrame:
    """D1 of every pair; all columns of a table without a counterpart differ. Schemas only, no rows are read."""
    sides = [{pair_id: pair[side] for pair_id, pair in pairs.items() if pair[side] is not None} for side in (0, 1)]
    found = compare_structure(*[describe_columns(spark, side) for side in sides])
    return found.withColumnRenamed("table_name", "pair_id")


def compare_pairs_rows(spark: SparkSession, pairs: Mapping[str, Pair], buckets: int = BUCKETS) -> DataFrame:
    """D2 of every pair in one grouping: pair_id, columns, cells (texts), count_a, count_b.

    A pair of a table and None has all rows of the one as differences. A table
    may stand in any number of pairs; a hot pair or a row repeated often spreads
    like any other, as rows are counted before they travel. A moment in time is
    compared by its microseconds, a nested value by its JSON. A pair without
    common columns is compared by its number of rows.
    """
    named = {pair_id: pair for pair_id, pair in pairs.items() if _sides(pair)[0]}
    bare = {pair_id: pair for pair_id, pair in pairs.items() if pair_id not in named}
    rows = _unequal(row_forms(spark, named, hashed=True), buckets).select("pair_id", "cells", "_a", "_b")
    if bare:
        rows = rows.unionByName(row_forms(spark, bare))
    counted = _counted(rows, ["pair_id", "cells"])
    compared = spark.createDataFrame(
        [(pair_id, _sides(pair)[0]) for pair_id, pair in pairs.items()], "pair_id STRING, columns ARRAY<STRING>"
    )
    return counted.join(compared, "pair_id").select("pair_id", "columns", "cells", "count_a", "count_b")


def pairs_summary(spark: SparkSession, pair_ids: list[str], structure: DataFrame, rows: DataFrame) -> DataFrame:
    """D3 of every pair over the results of D1 and D2; a pair without differences has zeros."""
    zero = F.lit(0).cast("bigint")
    more = [F.greatest(F.col(f"count_{x}") - F.col(f"count_{y}"), zero).alias(f"_{x}") for x, y in (("a", "b"), ("b", "a"))]
    listed = spark.createDataFrame([(pair_id,) for pair_id in pair_ids], "pair_id STRING")
    parts = [
        listed.select("pair_id", zero.alias("_columns"), zero.alias("_a"), zero.alias("_b")),
        structure.select("pair_id", F.lit(1).cast("bigint").alias("_columns"), zero.alias("_a"), zero.alias("_b")),
        rows.select("pair_id", zero.alias("_columns"), *more),
    ]
    total = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("pair_id")
    sums = {"_columns": "column_differences", "_a": "rows_only_in_a", "_b": "rows_only_in_b"}
    found = total.agg(*[F.sum(name).alias(alias) for name, alias in sums.items()])
    return found.select(
        "pair_id",
        (F.col("column_differences") > 0).cast("int").alias("has_template_difference"),
        ((F.col("rows_only_in_a") + F.col("rows_only_in_b")) > 0).cast("int").alias("has_data_difference"),
        *sums.values(),
    )


def compare_pairs(spark: SparkSession, pairs: Mapping[str, Pair], buckets: int = BUCKETS) -> dict[str, DataFrame]:
    """D1 to D3 of many pairs, tagged with their `pair_id`."""
    structure, rows = compare_pairs_structure(spark, pairs), compare_pairs_rows(spark, pairs, buckets)
    return {
        "compare_structure": structure,
        "compare_rows": rows,
        "comparison_summary": pairs_summary(spark, list(pairs), structure, rows),
    }
