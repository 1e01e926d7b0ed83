"""Benchmark passages in documents: SimHash of item-sized windows, Hamming blocks, weighted shingles.

DataFrame functions only. Words are runs of letters and digits in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.session import stage

WIDTH = 5
SIMILARITY = 0.8
# Two windows of weighted Jaccard similarity 0.8 have a cosine of 0.889, so each
# bit differs with probability 0.15: 10 of 64 on average; 19 is more than three
# standard deviations above that.
RADIUS = 19
BLOCKS = 5

# Rows of two numbers that are sent to every executor: distinct item shingles, keys
# of documents with a leak. More of them are joined by sorting instead.
BROADCAST_ROWS = 2_000_000


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda word: word != "")


def _shingles(words: str, width: int = WIDTH) -> Column:
    """Hashes of all runs of `width` words; a shorter text is one shingle, one without words none."""
    n = F.size(words)
    hashed = F.transform(
        words, lambda word, i: F.xxhash64(word, *[F.get(F.col(words), i + k) for k in range(1, width)])
    )
    return F.when(n >= width, F.slice(hashed, 1, n - width + 1)).when(n > 0, F.array(F.xxhash64(*[F.get(words, F.lit(k)) for k in range(width)])))


def _fingerprint(shingles: str) -> Column:
    """SimHash of a window: a bit is set if most of its shingles, each as often as it occurs, have it set."""

    def with_bit(value: Column, k: Column) -> Column:
        ones = F.aggregate(shingles, F.lit(0), lambda total, h: total + F.getbit(h, k).cast("int"))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), k)
        return F.when(2 * ones > F.size(shingles), value.bitwiseOR(bit)).otherwise(value)

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), with_bit)


def _block_bits(blocks: int) -> list[tuple[int, int]]:
    """First bit and number of bits of each block of a fingerprint."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _block(fingerprint: str, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(fingerprint, first).bitwiseAND(F.lit((1 << bits) - 1))


def _window_keys(windows: DataFrame, blocks: int) -> DataFrame:
    """A row for each block of a fingerprint."""
    keys = [F.struct(F.lit(i).alias("block"), _block("fp", *b).alias("value")) for i, b in enumerate(_block_bits(blocks))]
    return windows.select("*", F.explode(F.array(*keys)).alias("key")).select("*", "key.*").drop("key")


def _item_keys(items: DataFrame, radius: int, blocks: int) -> DataFrame:
    """Of each block of an item, all values within the block's share of the radius.

    Of two fingerprints that differ in at most `radius` bits, one block at
    least differs in no more than radius // blocks: the index misses none.
    """
    share, parts = radius // blocks, []
    for i, (first, bits) in enumerate(_block_bits(blocks)):
        masks = F.filter(F.sequence(F.lit(0), F.lit((1 << bits) - 1)), lambda mask: F.bit_count(mask) <= share)
        near = F.transform(masks, lambda mask: mask.cast("bigint").bitwiseXOR(F.col(f"_block{i}")))
        parts.append(F.transform(near, lambda value: F.struct(F.lit(i).alias("block"), value.alias("value"))))
    blocked = items.select("*", *[_block("fp", *b).alias(f"_block{i}") for i, b in enumerate(_block_bits(blocks))])
    keyed = blocked.select("item_id", F.col("m").alias("item_m"), F.col("fp").alias("item_fp"), F.explode(F.concat(*parts)).alias("key"))
    return keyed.select("*", "key.*").drop("key")


def _weighted_similarity(a: str, b: str, size: str) -> Column:
    """Sum of the smaller over sum of the larger weights, a shingle's weight being how often it occurs.

    `a` holds those of its `size` shingles that can be shared.
    """

    def occurrences(x: str) -> Column:
        numbered = F.transform(x, lambda h, i: F.xxhash64(h, F.size(F.filter(F.slice(x, F.lit(1), i), lambda y: y == h))))
        once = F.transform(x, lambda h: F.xxhash64(h, F.lit(0)))
        return F.when(F.size(F.array_distinct(x)) < F.size(x), numbered).otherwise(once)

    shared = F.size(F.array_intersect(occurrences(a), occurrences(b)))
    return shared / (F.col(size) + F.size(b) - shared)


def _item_windows(hits: DataFrame, similarity: float) -> DataFrame:
    """Windows as large as an item whose shingles they may hold often enough.

    `hits` are the places of a document whose shingle occurs in an item of m
    shingles. A window that reaches the similarity has its share of them.
    Only windows with that many are formed, from the starts between one such
    place and the next: no other can reach it. Of a window just those
    shingles are kept, as the others match no item of its size; without them
    its fingerprint only comes nearer to those of the items.
    """
    rows = hits.groupBy("doc_id", "text_hash", "n", "m").agg(
        F.array_sort(F.collect_set(F.struct("at", "h"))).alias("hits")
    )
    rows = rows.withColumn("at", F.transform("hits", lambda hit: hit["at"])).withColumn("w", F.least("m", "n"))
    share = similarity / (1 + similarity)
    rows = rows.withColumn("need", F.greatest(F.lit(1), F.ceil(share * (F.col("m") + F.col("w")) - 1e-9).cast("int")))

    def starts(at: Column, j: Column) -> Column:
        before = F.when(j > 0, F.get("at", j - 1)).otherwise(-1)
        low = F.greatest(before + 1, at - (F.col("w") - F.col("need")), F.lit(0))
        high = F.least(at, F.col("n") - F.col("w"))
        # the last of the needed hits must still lie in the window
        last = F.get("at", j + F.col("need") - 1)
        full = F.filter(F.sequence(low, high), lambda start: F.coalesce(last < start + F.col("w"), F.lit(False)))
        return F.when(low <= high, F.transform(full, lambda start: F.struct(start.alias("start"), j.alias("first")))).otherwise(
            F.array().cast("array<struct<start:int,first:int>>")
        )

    found = rows.select("*", F.explode(F.flatten(F.transform("at", starts))).alias("place")).select("*", "place.*")
    within = F.filter(
        F.slice("hits", F.col("first") + 1, F.col("w")), lambda hit: hit["at"] < F.col("start") + F.col("w")
    )
    return found.select(
        "doc_id", "text_hash", F.col("m").alias("item_m"), "start", "w", F.transform(within, lambda hit: hit["h"]).alias("window")
    )


def _leaks_of_width(
    documents: DataFrame, items: DataFrame, width: int, similarity: float, radius: int, blocks: int
) -> DataFrame:
    own = items.select("item_id", _shingles("words", width).alias("item_shingles"))
    own = stage(own.withColumn("m", F.size("item_shingles")).withColumn("fp", _fingerprint("item_shingles")), "items")
    sizes = stage(own.select(F.explode("item_shingles").alias("h"), "m").distinct(), "item-shingles")
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes.hint("merge")
    # as the output of a generator the words are cut once
    cut = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(F.array(_words("text"))).alias("words"))
    cut = cut.where(F.size("words") >= width).withColumn("n", F.size("words") - (width - 1))
    placed = cut.select("doc_id", "text_hash", "n", F.posexplode(_shingles("words", width)).alias("at", "h"))
    windows = _item_windows(placed.join(sizes, "h"), similarity)
    # repeated rows have given equal windows, which the set of hits holds once; a window is
    # few bytes and much work, so they are dealt out by number, not by size
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    windows = windows.repartition(parts, "text_hash", "item_m", "start")
    keyed = _window_keys(windows.withColumn("fp", _fingerprint("window")), blocks)
    near = keyed.join(_item_keys(own, radius, blocks).hint("merge"), ["item_m", "block", "value"])
    near = near.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    texts = own.select(F.col("item_id").alias("_own_id"), "item_shingles")
    near = near.join(texts, F.col("item_id").eqNullSafe(F.col("_own_id")))
    verified = near.withColumn("similarity", _weighted_similarity("window", "item_shingles", "w"))
    return verified.where(F.col("similarity") >= similarity).groupBy("doc_id", "text_hash", "item_id").agg(
        F.max("similarity").alias("similarity"),
        (F.max_by("start", F.struct("similarity", -F.col("start"))) + 1).cast("bigint").alias("start_word"),
        (F.first("item_m") + (width - 1)).cast("bigint").alias("n_words"),
    )


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
) -> DataFrame:
    """doc_id, text_hash, item_id, similarity, start_word and n_words of every passage of a benchmark item.

    One row for each document and item of which some window of the item's
    size (or the whole document, if shorter) has a weighted Jaccard
    similarity of at least `similarity` over five-word shingles; the best
    window is told, its first word counted from 1. An item of fewer than five
    words is one shingle. Null, empty and wordless texts match nothing.
    Repeated rows give one row; rows with a null id are told apart by their
    text. Empty tables give no rows; further columns are ignored.
    """
    items = benchmark.select("item_id", _words("text").alias("words")).where(F.size("words") > 0)
    items = items.withColumn("width", F.least(F.size("words"), F.lit(WIDTH)))
    docs = documents.select("doc_id", "text")
    found = [
        _leaks_of_width(docs, items.where(F.col("width") == row.width), row.width, similarity, radius, blocks)
        for row in items.select("width").distinct().collect()  # five widths at most
    ]
    if not found:
        schema = "text_hash BIGINT, item_id BIGINT, similarity DOUBLE, start_word BIGINT, n_words BIGINT"
        kind = documents.schema["doc_id"].dataType.simpleString()
        return documents.sparkSession.createDataFrame([], f"doc_id {kind}, {schema}")
    leaks = found[0]
    for other in found[1:]:
        leaks = leaks.unionByName(other)
    return leaks


def without_leaks(documents: DataFrame, benchmark: DataFrame, **settings: float) -> DataFrame:
    """The documents that hold no benchmark passage, all their columns; rows with null ids included."""
    leaks = find_leaks(documents, benchmark, **settings).select(
        F.col("doc_id").alias("_leak_id"), F.col("text_hash").alias("_leak_hash")
    )
    leaks = stage(leaks.distinct(), "leaks")
    same = F.xxhash64(documents["text"]).eqNullSafe(F.col("_leak_hash")) & documents["doc_id"].eqNullSafe(F.col("_leak_id"))
    few = leaks.count() <= BROADCAST_ROWS
    return documents.join(F.broadcast(leaks) if few else leaks.hint("merge"), same, "left_anti")
