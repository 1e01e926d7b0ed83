"""Near-duplicate vectors by comparing tiles in the order of their principal components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.llm.components import connected_components
from mapledger.session import stage

# vectors of one tile; a task holds two tiles
TILE = 1024
# leading dimensions added up before the bound is tested again
STEP = 8
# what rounding may take from a bound; exact cosines decide at the end
_ROUNDING = 1e-9


def _usable() -> Column:
    """Whether a vector has a direction: components without null, NaN and infinity, not all zero."""
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(
        F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False)
    )


def principal_axes(vectors: DataFrame, dimension: int) -> np.ndarray:
    """Orthonormal axes by falling variance of all unit vectors of that dimension.

    The sums of products are gathered over all vectors; what reaches the
    driver is one dimension-by-dimension table.
    """

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension))
        for batch in batches:
            unit = _unit(_matrix(batch.column("embedding")))
            total += unit.T @ unit
        place = np.arange(dimension * dimension, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel())], ["place", "total"])

    sums = vectors.select("embedding").mapInArrow(products, "place BIGINT, total DOUBLE")
    rows = sums.groupBy("place").agg(F.sum("total").alias("total")).collect()
    table = np.zeros(dimension * dimension)
    for row in rows:
        table[row.place] = row.total
    _, axes = np.linalg.eigh(table.reshape(dimension, dimension))
    return axes[:, ::-1]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _unit(matrix: np.ndarray) -> np.ndarray:
    # the largest component first, so that no square overflows or vanishes
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def links_of_tiles(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) with cosine of a[i] and b[j] of at least the threshold.

    In the order of the axes the first dimensions hold most of a product.
    They are added up first; what the others can still add is at most the
    product of the suffix norms, and a pair stops when that can't reach the
    threshold.
    """
    ua, ub = _unit(a), _unit(b)
    ra, rb = ua @ axes, ub @ axes
    sa, sb = (np.sqrt(np.cumsum((r * r)[:, ::-1], axis=1)[:, ::-1]) for r in (ra, rb))
    least, width = threshold - _ROUNDING, ra.shape[1]
    first = min(STEP, width)
    partial = ra[:, :first] @ rb[:, :first].T
    bound = partial + (np.outer(sa[:, first], sb[:, first]) if first < width else 0)
    i, j = np.nonzero(bound >= least)
    partial = partial[i, j]
    for start in range(first, width, STEP):
        stop = min(start + STEP, width)
        partial = partial + np.einsum("nd,nd->n", ra[i, start:stop], rb[j, start:stop])
        rest = sa[i, stop] * sb[j, stop] if stop < width else 0
        alive = partial + rest >= least
        i, j, partial = i[alive], j[alive], partial[alive]
    # the cosine itself, in double precision on the vectors as they are given
    dots = np.einsum("nd,nd->n", a[i], b[j])
    norms = [np.sqrt(np.einsum("nd,nd->n", x, x)) for x in (a, b)]
    exact = dots / (norms[0][i] * norms[1][j]) >= threshold
    return i[exact], j[exact]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component."""
    root = np.arange(n)
    while True:
        least = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(least, i, low)
        np.minimum.at(least, j, low)
        least = np.minimum(least, least[least])
        if (least == root).all():
            return root
        root = least


def _tile_links(axes: np.ndarray, threshold: float):
    """For one pair of tiles: links of each vector there, and one edge to another one of its component."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["first", "content"], kind="stable")
        left, right = rows[rows["side"] <= 1], rows[rows["side"] != 1]
        a, b = (np.stack(x["embedding"].to_numpy()).astype(np.float64) if len(x) else np.zeros((0, len(axes))) for x in (left, right))
        own = rows["side"].iloc[0] == 0
        found = links_of_tiles(a, b, axes, threshold) if len(a) and len(b) else (np.zeros(0, int), np.zeros(0, int))
        place = np.arange(len(rows))
        at_left, at_right = place[(rows["side"] <= 1).to_numpy()], place[(rows["side"] != 1).to_numpy()]
        i, j = at_left[found[0]], at_right[found[1]]
        if own:
            i, j = i[i < j], j[i < j]
        copies = rows["copies"].to_numpy()
        n = np.bincount(i, copies[j], len(rows)) + np.bincount(j, copies[i], len(rows))
        root = _roots(len(rows), i, j)
        touched = np.flatnonzero(n)
        ids, content = rows["first"].to_numpy(), rows["content"].to_numpy()
        return pd.DataFrame(
            {
                "first": ids[touched], "content": content[touched], "n": n[touched].astype(np.int64),
                "root_first": ids[root[touched]], "root_content": content[root[touched]],
            }
        )

    return compare


_TILE_LINKS = "first BIGINT, content BIGINT, n BIGINT, root_first BIGINT, root_content BIGINT"


def _tile_pairs(vectors: DataFrame, tile: int) -> DataFrame:
    """Each vector once for every pair of tiles it takes part in.

    Vectors lie in cells of the first two axes, as wide as linked vectors can
    be apart, so links join neighbouring cells only. A full cell is dealt to
    tiles of about `tile` vectors.
    """
    cell = ["label", "c1", "c2"]
    tiles = vectors.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    placed = vectors.join(tiles, cell).withColumn("t", F.pmod(F.xxhash64("embedding", F.lit(1)), F.col("tiles")).cast("int"))
    each = tiles.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    steps = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a, b in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    reached = each.withColumn("step", F.explode(steps)).select(
        "label", F.col("c1").alias("a1"), F.col("c2").alias("a2"), F.col("t").alias("at"),
        (F.col("c1") + F.col("step.x")).alias("c1"), (F.col("c2") + F.col("step.y")).alias("c2"),
    )
    same_cell = (F.col("a1") == F.col("c1")) & (F.col("a2") == F.col("c2"))
    pairs = reached.join(each.select(*cell, "t"), cell).where(~same_cell | (F.col("at") <= F.col("t")))
    pairs = pairs.withColumn("own", same_cell & (F.col("at") == F.col("t"))).withColumn("pair", F.xxhash64("label", "a1", "a2", "at", "c1", "c2", "t"))
    left = pairs.select("label", F.col("a1").alias("c1"), F.col("a2").alias("c2"), F.col("at").alias("t"), F.when(F.col("own"), 0).otherwise(1).alias("side"), "pair")
    right = pairs.where(~F.col("own")).select(*cell, "t", F.lit(2).alias("side"), "pair")
    return placed.join(left.unionByName(right), [*cell, "t"]).select(
        "pair", "label", "side", "first", "content", "copies", "embedding"
    )


def link_vectors(embeddings: DataFrame, threshold: float = 0.98, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of (vec_id, embedding, label).

    Vectors of equal, non-null labels and equal length are linked if their
    cosine in double precision is at least `threshold`. n_links counts the
    other rows linked directly, component_id is the smallest vec_id reachable,
    and kept says that it is the row's own. A vector that is null, empty,
    zero or holds null or non-finite components is linked with nothing, and
    neither is one without a label. Equal vectors of a label are compared
    once. A repeated row counts as another vector; rows with a null id take
    part in links. An empty table gives no rows; further columns are ignored.
    """
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", "label")
    rows = rows.withColumn("usable", _usable()).withColumn("content", F.xxhash64("embedding", "label"))
    usable = rows.where("usable")
    classes = stage(
        usable.groupBy("label", "embedding", "content").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies")),
        "vectors",
    )
    parts = []
    for row in classes.select(F.size("embedding").alias("d")).distinct().collect():  # a few lengths at most
        of_length = classes.where(F.size("embedding") == row.d)
        parts.append(_linked_tiles(of_length, principal_axes(of_length, row.d), threshold, tile))
    if parts:
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
    else:
        found = rows.sparkSession.createDataFrame([], _TILE_LINKS)
    found = stage(found, "links")
    node, root = (F.struct(F.col(f"{p}first").alias("first"), F.col(f"{p}content").alias("content")) for p in ("", "root_"))
    joined = connected_components(found.select(node.alias("u"), root.alias("v")))
    links = found.groupBy(node.alias("node")).agg(F.sum("n").alias("linked"))
    key = ["label", "embedding", "content"]
    result = (
        classes.select(*key, "copies", node.alias("node")).join(links, "node", "left").join(joined, "node", "left")
        .select(
            *key,
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component.first", "node.first").alias("component_id"),
        )
    )
    some = usable.join(result, key).select("vec_id", "n_links", "component_id")
    none = rows.where(~F.col("usable")).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return some.unionByName(none).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _linked_tiles(classes: DataFrame, axes: np.ndarray, threshold: float, tile: int) -> DataFrame:
    width = float(np.sqrt(2 - 2 * threshold) + 1e-6)

    def rotated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lead = _unit(_matrix(batch.column("embedding"))) @ axes[:, :2]
                cells = np.floor(np.pad(lead, ((0, 0), (0, max(0, 2 - lead.shape[1])))) / width).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cells[:, 0]), pa.array(cells[:, 1])], [*batch.schema.names, "c1", "c2"]
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema) + ", c1 INT, c2 INT"
    celled = stage(classes.mapInArrow(rotated, schema), "cells")
    return _tile_pairs(celled, tile).groupBy("pair").applyInPandas(_tile_links(axes, threshold), _TILE_LINKS)
