"""String, path and flag expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.schemas import MAP_SUFFIX, TABLE_PREFIX, TF_SUFFIX

# An invented share; callers pass the mapping of their own site.
DEFAULT_MAPPINGS = {"Y:\\": "\\\\files.example\\share\\"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key(c: Column | str, collation: str | None = None) -> Column:
    """A comparison key; a collation such as UTF8_LCASE_RTRIM widens equality."""
    return F.collate(_col(c), collation) if collation else _col(c)


def derive_paths(registry: DataFrame) -> DataFrame:
    """Path of the transformation document and of its map sibling."""
    tf_path = F.concat("map_folder", F.lit("\\"), "map_name")
    return registry.withColumns({"tf_path": tf_path, "map_path": sibling_path(tf_path)})


def sibling_path(tf_path: Column | str) -> Column:
    return F.replace(_col(tf_path), F.lit(TF_SUFFIX[1:]), F.lit(MAP_SUFFIX[1:]))


def normalize_path(c: Column | str, mappings: Mapping[str, str] = DEFAULT_MAPPINGS) -> Column:
    """Drive letters to share roots, anywhere in the string."""
    out = _col(c)
    for drive, root in mappings.items():
        out = F.replace(out, F.lit(drive), F.lit(root))
    return out


def as_tf_path(c: Column | str) -> Column:
    """Name of the transformation document of a logged map document."""
    return F.replace(_col(c), F.lit(MAP_SUFFIX[1:]), F.lit(TF_SUFFIX[1:]))


def base_name(c: Column | str) -> Column:
    """Text after the last backslash, or the whole text without one."""
    return F.substring_index(_col(c), "\\", -1)


def map_stem(c: Column | str, suffix: str) -> Column:
    """Base name without a document suffix."""
    return F.replace(base_name(c), F.lit(suffix), F.lit(""))


def strip_schema(c: Column | str) -> Column:
    """Table name without its schema prefix."""
    return F.replace(_col(c), F.lit(TABLE_PREFIX), F.lit(""))


def diff_flag(difference: Column | str) -> Column:
    """0 for an equal count, 1 for a different or unknown one."""
    return F.when(_col(difference) == 0, 0).otherwise(1)


def same_text(c: Column | str, text: str) -> Column:
    """Equality that ignores trailing spaces; the first condition reaches the files."""
    bare = text.rstrip(" ")
    return F.startswith(_col(c), F.lit(bare)) & (F.rtrim(_col(c)) == bare)


_ESCAPE = "~"


def like_contains(c: Column | str, part: Column | str, match: str = "like") -> Column:
    """`c LIKE '%part%'`, in which `%` and `_` of the part stay wildcards.

    The pattern language has no escape character: the one Spark wants is
    doubled, so that it means itself. A Column part compares row by row.
    `match` is "like", "ilike" (without case), or "literal" (a plain substring).
    """
    part = F.lit(part) if isinstance(part, str) else part
    if match == "literal":
        return F.contains(_col(c), part)
    if match not in ("like", "ilike"):
        raise ValueError(f"match must be 'like', 'ilike' or 'literal', not {match!r}")
    pattern = F.concat(F.lit("%"), F.replace(part, F.lit(_ESCAPE), F.lit(_ESCAPE * 2)), F.lit("%"))
    compare = F.like if match == "like" else F.ilike
    return compare(_col(c), pattern, F.lit(_ESCAPE))


def overlong_values(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Rows with a value wider than its declared column; nothing is cut."""
    too_long = F.array_compact(
        F.array(*[F.when(F.length(name) > width, F.lit(name)) for name, width in widths.items()])
    )
    return df.withColumn("overlong_columns", too_long).where(F.size("overlong_columns") > 0)
