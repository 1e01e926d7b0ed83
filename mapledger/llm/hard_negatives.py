"""Hard negatives by exact integer products of many candidates at once.

The components of all candidates of a block, in one dimension, are moved to
be non-negative and set side by side as fields of one wide integer. Multiplied
by an anchor's component and added up over the dimensions, the fields hold all
inner products without touching each other; the moves are taken back after
unpacking, so every score is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapledger.session import stage

# candidates of one block; a task holds one block and one batch of anchors
BLOCK = 16_384

_ROW = "block INT, side INT, vec_id BIGINT, label BIGINT, embedding ARRAY<DOUBLE>, content BIGINT, bounds ARRAY<BIGINT>"
_POSITIVES = "anchor_id BIGINT, content BIGINT, positive_id BIGINT, positive_score BIGINT"
_NEGATIVES = "anchor_id BIGINT, content BIGINT, place INT, negative_id BIGINT, negative_score BIGINT"


def whole_numbers(embedding: np.ndarray, scale: int) -> list[int] | np.ndarray:
    """floor(scale * x) of each component, exact at any size."""
    floors = np.floor(embedding * float(scale))
    small = not floors.size or np.abs(floors).max() < 2.0**52
    return floors.astype(np.int64) if small else np.array([int(x) for x in floors.ravel()], object).reshape(floors.shape)


class Packed:
    """Candidates of equal length, their components packed by dimension."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.n, self.dimension = vectors.shape
        self.least = int(vectors.min()) if vectors.size else 0
        self.moved = vectors - self.least
        self.most = int(self.moved.max()) if vectors.size else 0
        self.sums = vectors.sum(axis=1) if vectors.size else np.zeros(self.n, np.int64)
        self.most_sum = max((abs(int(x)) for x in self.sums), default=0)
        self._packs: dict[int, list[int]] = {}

    def _pack(self, width: int) -> list[int]:
        """One integer for each dimension, with a field of `width` bytes for each candidate."""
        if width not in self._packs:
            if width <= 8:
                fields = self.moved.astype(f"<u{width}").T
                self._packs[width] = [int.from_bytes(np.ascontiguousarray(one).tobytes(), "little") for one in fields]
            else:
                self._packs[width] = [
                    int.from_bytes(b"".join(int(x).to_bytes(width, "little") for x in one), "little") for one in self.moved.T
                ]
        return self._packs[width]

    def products(self, anchor: np.ndarray) -> np.ndarray:
        """Inner product of the anchor with every candidate."""
        least = int(anchor.min()) if anchor.size else 0
        moved = [int(x) - least for x in anchor]
        bits = (sum(moved) * self.most).bit_length()
        width = 4 if bits <= 32 else 8 if bits <= 64 else bits // 8 + 1
        # one wide product for each component of the anchor
        wide = sum(map(mul, moved, self._pack(width)))
        held = wide.to_bytes(width * self.n, "little")
        # sum (a - l)(c - m) = sum ac - l sum c - m sum a + d l m, with l and m the least components
        total = sum(int(x) for x in anchor)
        rest, sums = self.least * total - self.dimension * least * self.least, self.sums
        if bits + 2 < 62 and abs(rest) + abs(least) * self.most_sum < 1 << 61:
            return np.frombuffer(held, f"<u{width}").astype(np.int64) + least * sums + rest
        fields = np.array([int.from_bytes(held[i : i + width], "little") for i in range(0, len(held), width)], object)
        return fields + least * sums.astype(object) + rest


def first_of(scores: np.ndarray, wanted: np.ndarray, n: int) -> np.ndarray:
    """Of the wanted places the `n` of highest score; of equal scores, the first places."""
    chosen = scores[wanted]
    if len(wanted) > n:
        least = np.partition(chosen, len(chosen) - n)[len(chosen) - n]
        wanted = wanted[chosen >= least]
        chosen = scores[wanted]
    return wanted[np.argsort(-chosen, kind="stable")][:n]


class _Candidates:
    """The rows of one block by length of vector and, where asked, by label; all in order of their ids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray], scale: int) -> None:
        self.parts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        lengths = np.array([len(v) for v in vectors], np.int64)
        for length in np.unique(lengths):
            here = np.flatnonzero(lengths == length)
            here = here[np.argsort(ids[here], kind="stable")]
            matrix = np.stack([vectors[i] for i in here])
            self.parts[int(length)] = ids[here], labels[here], whole_numbers(matrix, scale)
        self._packed: dict[tuple[int, int | None], tuple[np.ndarray, np.ndarray, Packed]] = {}

    def get(self, length: int, label: int | None = None) -> tuple[np.ndarray, np.ndarray, Packed] | None:
        """(ids, labels, packed vectors) of that length, of one label if given."""
        if length not in self.parts:
            return None
        key = length, label
        if key not in self._packed:
            ids, labels, matrix = self.parts[length]
            rows = slice(None) if label is None else np.flatnonzero(labels == label)
            self._packed[key] = ids[rows], labels[rows], Packed(matrix[rows])
        return self._packed[key]


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.array(column.value_lengths().to_pylist(), np.int64)
    return np.split(flat, np.cumsum(lengths)[:-1]) if len(lengths) else []


def _blocks(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[_Candidates, pa.RecordBatch]]:
    """Anchors in batches, each with the candidates of its block, from rows sorted by (block, side)."""
    current, waiting, candidates = None, [], None
    for batch in batches:
        block, side = (batch.column(name).to_numpy() for name in ("block", "side"))
        starts = np.flatnonzero(np.diff(block, prepend=block[:1] - 1) | np.diff(side, prepend=side[:1] - 1))
        for start, stop in zip(starts, [*starts[1:], len(block)], strict=True):
            if block[start] != current:
                current, waiting, candidates = block[start], [], None
            rows = batch.slice(start, stop - start)
            if side[start] == 0:
                waiting.append((rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), _vectors(rows.column("embedding"))))
            elif waiting or candidates:
                if candidates is None:
                    ids, labels, vectors = zip(*waiting, strict=True)
                    candidates = _Candidates(np.concatenate(ids), np.concatenate(labels), [v for part in vectors for v in part], scale)
                    waiting = []
                yield candidates, rows


def _positives_of(scale: int, n: int):
    """The first `n` rows of the anchor's label in each block."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for candidates, anchors in _blocks(batches, scale):
            rows: list[tuple] = []
            for vec_id, label, content, vector in zip(
                anchors.column("vec_id").to_pylist(), anchors.column("label").to_pylist(), anchors.column("content").to_pylist(),
                _vectors(anchors.column("embedding")), strict=True,
            ):
                some = candidates.get(len(vector), label)
                if some is None or not len(some[0]):
                    continue
                ids, _, packed = some
                scores = packed.products(whole_numbers(vector, scale))
                for place in first_of(scores, np.flatnonzero(ids != vec_id), n):
                    rows.append((vec_id, content, int(ids[place]), int(scores[place])))
            yield _batch(rows, _POSITIVES)

    return found


def _negatives_of(scale: int, n: int, low: int, high: int):
    """For each positive of an anchor the first `n` rows of another label within the bounds, in each block."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for candidates, anchors in _blocks(batches, scale):
            rows: list[tuple] = []
            for vec_id, label, content, bounds, vector in zip(
                anchors.column("vec_id").to_pylist(), anchors.column("label").to_pylist(), anchors.column("content").to_pylist(),
                anchors.column("bounds").to_pylist(), _vectors(anchors.column("embedding")), strict=True,
            ):
                some = candidates.get(len(vector))
                if some is None:
                    continue
                ids, labels, packed = some
                scores = packed.products(whole_numbers(vector, scale))
                other = labels != label
                for place, positive in enumerate(bounds):
                    # low * positive <= 100 * score <= high * positive, in whole numbers
                    least, most = -(-low * positive // 100), high * positive // 100
                    for at in first_of(scores, np.flatnonzero(other & (scores >= least) & (scores <= most)), n):
                        rows.append((vec_id, content, place, int(ids[at]), int(scores[at])))
            yield _batch(rows, _NEGATIVES)

    return found


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split(" ") for field in schema.split(", ")]
    kinds = {"BIGINT": pa.int64(), "INT": pa.int32()}
    columns = [pa.array([row[k] for row in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


def _in_blocks(candidates: DataFrame, anchors: DataFrame, blocks: int) -> DataFrame:
    """Each candidate in its block, each anchor in all of them, behind the candidates.

    The anchors are the smaller side: they travel once for each block, the
    candidates once. A task reads anchors batch by batch.
    """
    own = candidates.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("side"),
        "vec_id", "label", "embedding", "content", F.lit(None).cast("array<bigint>").alias("bounds"),
    )
    every = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("side"),
        "vec_id", "label", "embedding", "content", "bounds",
    )
    return own.unionByName(every).repartition(blocks, "block").sortWithinPartitions("block", "side")


def mine_negatives(
    embeddings: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, scale: int = 256, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for (vec_id, label, embedding).

    A component x counts as floor(scale * x); a score is the integer inner
    product with the anchor. Higher scores come first, ties by smaller
    vec_id. An anchor's positives are its first rows of the same label and
    another vec_id; for each the first rows of another label whose score lies
    between `low` and `high` percent of the positive's are returned, fewer if
    there are no more. Every row is compared with every anchor.

    Rows with a null id, label or vector, or a null or non-finite component,
    take no part, and vectors are compared with those of equal length only.
    Repeated rows are rows of their own among positives and negatives, but
    one anchor. An empty table, or one without anchors, gives no rows;
    further columns are ignored. Scores beyond 64 bits stop the job.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite, F.lit(False))
    rows = embeddings.where(usable).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"), is_anchor.alias("is_anchor"),
    ).withColumn("content", F.xxhash64("label", "embedding"))
    anchors = rows.where("is_anchor").dropDuplicates(["vec_id", "label", "embedding"])
    blocks = max(1, -(-rows.count() // block))
    key = ["anchor_id", "content"]

    unbounded = anchors.withColumn("bounds", F.lit(None).cast("array<bigint>"))
    near = _in_blocks(rows, unbounded, blocks).mapInArrow(_positives_of(scale, positives), _POSITIVES)
    best = Window.partitionBy(*key).orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("place", F.row_number().over(best) - 1).where(F.col("place") < positives)
    near = stage(near, "positives")

    bounds = near.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("bounds"))
    bounds = bounds.select(F.col("anchor_id").alias("vec_id"), "content", F.col("bounds.positive_score").alias("bounds"))
    bounded = anchors.join(bounds, ["vec_id", "content"])
    far = _in_blocks(rows, bounded, blocks).mapInArrow(_negatives_of(scale, negatives, low, high), _NEGATIVES)
    first = Window.partitionBy(*key, "place").orderBy(F.desc("negative_score"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    return far.join(near, [*key, "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
