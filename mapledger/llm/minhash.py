"""Near-duplicate documents by MinHash bands and odd sketches, with links confirmed on full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mapledger.llm.batches import slices
from mapledger.llm.components import connected_components
from mapledger.session import stage

WIDTH = 5
# A pair of similarity s shares a band with probability 1 - (1 - s^ROWS)^BANDS:
# at 0.85 all but one in four million, at 0.8 all but one in ten thousand.
BANDS, ROWS = 32, 6
SKETCH_WORDS = 16  # odd sketch of 1,024 bits
# a candidate's estimate may lie so many standard errors below the threshold: one
# link in ten thousand at the very threshold is missed
SLACK = 3.72
# nearest candidates of a text that are confirmed before all others, out of about so many of a bucket
NEAREST, LOOKED_AT = 4, 64
# parity bitmap of a whole shingle set, 2,048 bits, and standard errors up to which it keeps a pair:
# one link in three million at the very threshold is missed, none of sets with few differences
PARITY_WORDS = 32
PARITY_SLACK = 5.0
# bits of the map that spares documents without a partner in a join the shuffle: two megabytes
# for any number of keys; beyond some ten million keys it spares less, and nothing else changes
FILTER_BITS = 1 << 24

_REMEMBERED = 100_000  # words with their hashes, about 13 MB in each Python worker
_CHUNK_BITS = 32768  # of a bitmap of Spark's
_SIGNATURES = (
    "doc_id BIGINT, text_hash BIGINT, digest BINARY, n_shingles BIGINT, bands ARRAY<BIGINT>, sketch ARRAY<BIGINT>"
)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _constants(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value


def shingle_set(words: list[bytes], hashes: dict[bytes, int], width: int = WIDTH) -> np.ndarray:
    """The distinct shingles of a word sequence as sorted 64-bit hashes; a short sequence is one shingle."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    k = min(width, n)
    total = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        total = (total ^ own[i : n - k + 1 + i]) * np.uint64(0xD6E8FEB86659FD93)
        total ^= total >> np.uint64(32)
    total.sort()
    distinct = np.ones(len(total), bool)
    distinct[1:] = total[1:] != total[:-1]
    return total[distinct]


class Signer:
    """Band keys and odd sketch of shingle sets."""

    def __init__(self, bands: int, rows: int, sketch_words: int) -> None:
        self.bands, self.rows, self.sketch_words = bands, rows, sketch_words
        n = bands * rows
        self.a = (_constants(n, 1) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        self.b = (_constants(n, 2) >> np.uint64(32)).astype(np.uint32)
        self.seeds = _constants(n, 3)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        """The smallest value of each hash function over the set."""
        x = _mix(shingles).astype(np.uint32)
        best = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for start in range(0, len(x), 512):  # the table stays in the cache
            table = self.a[:, None] * x[None, start : start + 512] + self.b[:, None]
            np.minimum(best, table.min(axis=1), out=best)
        return best

    def sign(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        samples = self.minima(shingles).astype(np.uint64)
        spread = _mix(samples ^ self.seeds)
        key = np.zeros(self.bands, np.uint64) + np.arange(self.bands, dtype=np.uint64)
        table = spread.reshape(self.bands, self.rows)
        for i in range(self.rows):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + table[:, i])
        # each sample flips one bit: what two sets share cancels out in the XOR of their sketches
        bits = np.bincount((spread >> np.uint64(7)).astype(np.int64) % (64 * self.sketch_words), minlength=64 * self.sketch_words) & 1
        sketch = np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)
        return key.view(np.int64), sketch


def signatures(
    documents: DataFrame, bands: int = BANDS, rows: int = ROWS, sketch_words: int = SKETCH_WORDS, width: int = WIDTH
) -> DataFrame:
    """doc_id, digest of the word sequence, size of the shingle set, band keys and odd sketch of every row."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, hashes = Signer(bands, rows, sketch_words), _WordHashes()
        for batch in slices(batches, "text"):
            if len(hashes) > _REMEMBERED:
                hashes.clear()
            columns: tuple[list, ...] = ([], [], [], [])
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = (text or b"").lower().split()  # of bytes: A-Z, and ASCII white space
                shingles = shingle_set(words, hashes, width)
                key, sketch = signer.sign(shingles) if len(shingles) else (None, None)
                digest = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
                for column, value in zip(columns, (digest, len(shingles), key, sketch), strict=True):
                    column.append(value)
            kinds = [pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), *arrays],
                ["doc_id", "text_hash", "digest", "n_shingles", "bands", "sketch"],
            )

    return _rows(documents).select("doc_id", "text_hash", "text").mapInArrow(signed, _SIGNATURES)


def _rows(documents: DataFrame) -> DataFrame:
    """Texts with a key that holds for null and repeated ids too."""
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )


def _key_bitmaps(keys: DataFrame, name: str) -> DataFrame:
    """Which remainders of a 64-bit hash occur: rows (_chunk, _bits), FILTER_BITS bits at most."""
    place = F.pmod(name, F.lit(FILTER_BITS))
    chunk, bit = F.floor(place / _CHUNK_BITS).alias("_chunk"), F.pmod(name, F.lit(_CHUNK_BITS)).alias("_bit")
    return keys.select(chunk, bit).groupBy("_chunk").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def _may_occur(text: Column, bitmaps: DataFrame) -> Column:
    """Whether the hash of a text may be among the keys of the bitmaps; none that is gets lost."""
    text_hash = F.xxhash64(text)
    bit = F.pmod(text_hash, F.lit(_CHUNK_BITS))
    byte = F.conv(F.hex(F.substring(bitmaps["_bits"], F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    same_chunk = F.floor(F.pmod(text_hash, F.lit(FILTER_BITS)) / _CHUNK_BITS) == bitmaps["_chunk"]
    return same_chunk & (F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1)


def _flipped(a: str, b: str, sketch_words: int) -> Column:
    """Bits in which two odd sketches differ."""
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(sketch_words)), F.lit(0))


def flip_bound(similarity: float, samples: int, bits: int, slack: float = SLACK) -> int:
    """Most bits in which the sketches of a pair of that similarity differ, up to `slack` standard errors.

    About samples * (1 - similarity) MinHash values differ. Each of them flips
    a bit in either sketch, and m flips leave bits / 2 * (1 - (1 - 2 / bits)^m)
    bits set; flips that meet add to the spread.
    """
    flips = 2 * samples * (1 - similarity)
    kept = (1 - 2 / bits) ** flips
    spread = 4 * samples * similarity * (1 - similarity) * kept**2 + 2 * flips**2 / bits
    return int(np.ceil(bits / 2 * (1 - kept) + slack * np.sqrt(spread)))


def with_parity(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """node, text, size of the shingle set and a parity bitmap of all its members.

    The set is told exactly by its differences: two bitmaps differ in at most
    as many bits as the sets differ in members.
    """
    bits = 64 * PARITY_WORDS

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in slices(batches, "text"):
            if len(hashes) > _REMEMBERED:
                hashes.clear()
            sizes, bitmaps = [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                shingles = shingle_set(text.lower().split(), hashes, width)
                places = (_mix(shingles) >> np.uint64(7)).astype(np.int64) % bits
                odd = (np.bincount(places, minlength=bits) & 1).astype(np.uint8)
                sizes.append(len(shingles))
                bitmaps.append(np.packbits(odd, bitorder="little").view(np.int64))
            arrays = [pa.array(sizes, pa.int64()), pa.array(bitmaps, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("text"), *arrays], ["node", "text", "size", "parity"]
            )

    return texts.select("node", "text").mapInArrow(marked, "node BINARY, text STRING, size BIGINT, parity ARRAY<BIGINT>")


def _may_link(percent: int) -> Column:
    """Whether the parity bitmaps of the sets of `a_` and `b_` leave a link possible.

    Linked sets of together s members differ in at most
    s * (100 - percent) / (100 + percent); d differences leave d bits set at
    most, and about bits / 2 * (1 - (1 - 2 / bits)^d).
    """
    bits = 64.0 * PARITY_WORDS
    differing = F.floor((F.col("a_size") + F.col("b_size")) * F.lit(100 - percent) / F.lit(100 + percent))
    odd = (F.lit(1.0) - F.pow(F.lit(1 - 2 / bits), differing)) / 2
    most = odd * bits + F.sqrt(odd * (F.lit(1.0) - odd) * bits) * PARITY_SLACK
    return _flipped("a_parity", "b_parity", PARITY_WORDS) <= F.least(differing.cast("double"), most)


def _open_members(buckets: DataFrame, linked: DataFrame, distinct: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with the largest one of the bucket."""
    members = buckets.select("band", "i", "n", "node").join(linked, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    sizes = members.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("band").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"), F.count(F.lit(1)).alias("kinds")
    )
    return members.join(largest.where(F.col("kinds") > 1).drop("kinds"), "band").join(distinct, "node")


def _side(members: DataFrame, prefix: str) -> DataFrame:
    names = ["node", "component", "sketch", "bands", "size", "parity"]
    return members.select("band", "i", "n", "largest", *[F.col(name).alias(prefix + name) for name in names])


def _is_first_shared_band() -> Column:
    """Whether a pair that meets in several buckets meets here first, so that it is told once."""
    same = F.zip_with("a_bands", "b_bands", lambda a, b: a == b)
    return F.array_position(same, F.lit(True)) == F.col("i") + 1


def _nearest_pairs(members: DataFrame, limit: int, percent: int, sketch_words: int) -> DataFrame:
    """Pairs of different components that look like links, a few for each node.

    Each member is held against about LOOKED_AT members of its bucket, dealt by
    hash: this merges what has many links, and the work stays in proportion to
    the bucket. Links that it doesn't see are left to `_remaining_pairs`.
    """
    a = _side(members, "a_").drop("n")
    b = _side(members, "b_").where(F.pmod(F.xxhash64("b_node", "band"), "n") < LOOKED_AT).drop("i", "n", "largest")
    flips = _flipped("a_sketch", "b_sketch", sketch_words)
    pairs = a.join(b, "band").where(
        (F.col("a_component") != F.col("b_component")) & (flips <= limit) & _is_first_shared_band() & _may_link(percent)
    )
    pairs = pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"), flips.alias("flips"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy("flips", "b"))
    nearest = pairs.withColumn("rank", rank).where(F.col("rank") <= NEAREST)
    return nearest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _remaining_pairs(members: DataFrame, limit: int, percent: int, sketch_words: int) -> DataFrame:
    """All pairs of different components whose sketches and bitmaps don't rule a link out.

    By now most members of a large bucket are in one component; only the
    others are compared, with all members: the work is (others x bucket), and
    only what the bitmaps of whole sets leave possible becomes a pair.
    """
    others = _side(members.where(F.col("component") != F.col("largest")), "a_").drop("n")
    b = _side(members, "b_").drop("i", "n", "largest")
    pairs = others.join(b, "band").where(
        (F.col("a_component") != F.col("b_component"))
        & ((F.col("b_component") == F.col("largest")) | (F.col("a_node") < F.col("b_node")))
        & (_flipped("a_sketch", "b_sketch", sketch_words) <= limit)
        & _is_first_shared_band()
        & _may_link(percent)
    )
    # the largest component differs by bucket, so a pair may come from either side
    ends = F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")
    return pairs.select(*ends).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = sets.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    # only pairs and texts travel; a text in many pairs is a skewed side, split at run time
    both = pairs.join(right, "b").join(left, "a")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last = _WordHashes(), (None, None)
        for batch in slices(batches, "b_text"):
            if len(hashes) > _REMEMBERED:
                hashes.clear()
            keep = []
            a_texts = batch.column("a_text").cast(pa.binary()).to_pylist()
            for a_text, b_text in zip(a_texts, batch.column("b_text").cast(pa.binary()).to_pylist(), strict=True):
                if last[0] != a_text:
                    last = a_text, shingle_set(a_text.lower().split(), hashes, width)
                other = shingle_set(b_text.lower().split(), hashes, width)
                shared = len(np.intersect1d(last[1], other, assume_unique=True))
                keep.append(100 * shared >= percent * (len(last[1]) + len(other) - shared))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    renamed = both.select(F.col("a").alias("u"), F.col("b").alias("v"), "a_text", "b_text")
    return renamed.mapInArrow(confirm, "u BINARY, v BINARY")


def link_near_duplicates(
    documents: DataFrame,
    percent: int = 85,
    bands: int = BANDS,
    rows: int = ROWS,
    sketch_words: int = SKETCH_WORDS,
    width: int = WIDTH,
) -> tuple[DataFrame, DataFrame]:
    """The signature of every row, and (node, component) of every distinct text that isn't its component's first.

    Nodes are digests of word sequences, so exact copies count once. Texts
    that share a band are candidates. First each bucket compares all members
    with its pivot, the member that shares most buckets (among edited copies
    of one text, that text). Then, in buckets that still hold several
    components, each text is compared with the nearest of some members.
    At last all pairs there that lie in different components and may be links
    are compared. A pair may be a link if neither the sketches of the samples
    nor bitmaps of the whole sets rule it out; the latter are made once for
    each text with a candidate. So no link between components is missed, and
    in a large group of copies most pairs need no comparison.
    """
    signed = stage(signatures(documents, bands, rows, sketch_words, width), "signatures")
    samples, bits = bands * rows, 64 * sketch_words
    limit = flip_bound(percent / 100, samples, bits)
    distinct = signed.where("n_shingles > 0").groupBy(F.col("digest").alias("node")).agg(
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    distinct = stage(distinct, "distinct")
    banded = distinct.select("node", F.posexplode("bands").alias("i", "key")).select(
        "node", "i", F.xxhash64("i", "key").alias("band")
    )
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = stage(banded.join(shared, "band"), "buckets")
    popular = buckets.groupBy("node").agg(F.sum("n").alias("popularity"))
    ranked = buckets.join(popular, "node")
    pivots = ranked.groupBy("band").agg(F.max_by("node", F.struct("popularity", "node")).alias("pivot"))
    star = buckets.join(pivots, "band").where(F.col("node") != F.col("pivot"))
    star = star.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    sketches = distinct.select("node", "sketch")
    near = (
        star.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("a_sketch")), "a")
        .join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("b_sketch")), "b")
        .where(_flipped("a_sketch", "b_sketch", sketch_words) <= limit)
        .select("a", "b")
    )
    # the texts of all candidates, one for each digest, leave the documents once
    one = signed.groupBy(F.col("digest").alias("node")).agg(F.min(F.struct("doc_id", "text_hash")).alias("row"))
    wanted = buckets.select("node").distinct().join(one, "node").select(
        "node", F.col("row.doc_id").alias("wanted_id"), F.col("row.text_hash").alias("text_hash")
    )
    wanted = stage(wanted, "wanted")
    bitmaps = _key_bitmaps(wanted, "text_hash")
    some = documents.join(F.broadcast(bitmaps), _may_occur(documents["text"], bitmaps), "left_semi")
    texts = _rows(some).join(wanted, "text_hash").where(F.col("doc_id").eqNullSafe(F.col("wanted_id")))
    sets = stage(with_parity(texts.select("node", "text").dropDuplicates(["node"]), width), "candidates")
    parities = sets.select("node", "size", "parity")

    linked = connected_components(_confirmed(near, sets, percent, width))
    tight = flip_bound(percent / 100, samples, bits, slack=0)
    for candidates, most in ((_nearest_pairs, tight), (_remaining_pairs, limit)):
        members = stage(_open_members(buckets, linked, distinct.join(parities, "node")), "open")
        links = stage(_confirmed(candidates(members, most, percent, sketch_words), sets, percent, width), "links")
        if not links.isEmpty():
            known = linked.select(F.col("node").alias("u"), F.col("component").alias("v"))
            linked = connected_components(known.unionByName(links))
    return signed, linked


def near_duplicates(documents: DataFrame, percent: int = 85, **settings: int) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept of every row.

    Two documents are linked if their sets of distinct five-word shingles
    have 100 * intersection >= percent * union; a text of one to four words is
    one shingle, and a null or empty text, or one without words, is linked
    with nothing: it is a component of its own. Rows with a null id take part
    in links; a component of such rows only has a null id, and its rows are
    not kept apart: each has kept true. Repeated rows have one component and
    are both kept if they hold its id. An empty table gives no rows; further
    columns are ignored.
    """
    signed, linked = link_near_duplicates(documents, percent, **settings)
    classes = signed.where("n_shingles > 0").groupBy(F.col("digest").alias("node")).agg(F.min("doc_id").alias("first"))
    named = classes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = named.join(smallest, "component").select(F.col("node").alias("digest"), "component_id")
    some = signed.where("n_shingles > 0").join(of_class, "digest").select("doc_id", "n_shingles", "component_id")
    none = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.unionByName(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(documents: DataFrame, percent: int = 80, **settings: int) -> DataFrame:
    """The documents, all their columns, without those that are near duplicates of a kept one.

    Of each component the row of smallest id stays, null ids last, then by the
    hash of the text; of repeated rows one stays. Documents without words are
    in no component and stay, repeated or not.
    """
    signed, linked = link_near_duplicates(documents, percent, **settings)
    key = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_hash")
    with_words = signed.where("n_shingles > 0").select("digest", key.alias("key"))
    classes = with_words.groupBy(F.col("digest").alias("node")).agg(F.min("key").alias("key"))
    named = classes.join(linked, "node", "left")
    first = named.groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("key").alias("key"))
    rows = with_words.groupBy("key").agg((F.count(F.lit(1)) > 1).alias("_repeated"))
    dropped = rows.join(first.select("key", F.lit(True).alias("_first")), "key", "left")
    marks = dropped.where(F.col("_first").isNull() | F.col("_repeated")).select(
        F.col("key.doc_id").alias("_id"), F.col("key.text_hash").alias("_hash"), "_first"
    )
    same = F.xxhash64(documents["text"]).eqNullSafe(F.col("_hash")) & documents["doc_id"].eqNullSafe(F.col("_id"))
    marks = stage(marks, "marks")
    # most documents have no mark: they stay where they are, only the others meet the marks
    bitmaps = _key_bitmaps(marks, "_hash")
    touched = _may_occur(documents["text"], bitmaps)
    sure = documents.join(F.broadcast(bitmaps), touched, "left_anti")
    marked = documents.join(F.broadcast(bitmaps), touched, "left_semi")
    kept = sure.unionByName(marked.join(marks, same, "left_anti"))
    # a repeated row that stays: any one of its copies
    again = marked.join(marks.where(F.col("_first").isNotNull()), same)
    number = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy("_id"))
    single = again.withColumn("_number", number).where(F.col("_number") == 1)
    return kept.unionByName(single.select(*[single[f"`{name}`"] for name in documents.columns]))
