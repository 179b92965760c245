"""Near-duplicate documents by circulant MinHash, banding and exact verification.

A document is its set of 5-word shingles. Documents with equal sets are one class from the start. One permutation spreads the
shingle hashes; the other, shifted by k places, gives coordinate k of the signature as the least image. Bands of
coordinates make buckets. Members of a bucket are compared with one pivot at a time, whole sets against whole sets,
until what is linked has merged. What is left in a bucket between different components is compared in blocks of members:
a task holds two blocks, counts all their intersections and returns the links, so pairs never become rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm.common import staged
from paylake.llm.components import components
from paylake.llm.wordhash import Runs, WordHashes, mix
from paylake.operators.skew import lookup

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: At similarity 0.75 two documents share no band with probability (1 - 0.75^4)^32 = 5e-6.
BANDS, ROWS = 32, 4
#: Signature bits (one a coordinate) in which linked documents may differ; more at similarity 0.75: about 1e-7.
BITS_APART = 36
#: Members of a bucket in a block, on average.
BLOCK = 1_500
#: Shingles of a block, on average: two blocks are in one task.
BLOCK_SHINGLES = 2_000_000
#: A key in at least this share of the rows, and in this many, is spread over several tasks.
HEAVY_SHARE, HEAVY_PAIRS = 1_000, 5_000
#: Shingles whose signatures are worked out together.
CHUNK = 16_384
_SHIFT = np.uint64(0x9FB21C651E98DF25)


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct shingle hashes; of a text with fewer words, that of the whole sequence; of none, nothing."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(Runs(hashes.of(words)).windows(min(SHINGLE, len(words))))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row per set, none of them empty: BANDS * ROWS coordinates."""
    out = np.empty((len(sets), BANDS * ROWS), np.uint64)
    at = 0
    while at < len(sets):
        end, size = at + 1, len(sets[at])
        while end < len(sets) and size + len(sets[end]) <= CHUNK:
            size += len(sets[end])
            end += 1
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[at:end]])])[:-1]
        spread = mix(np.concatenate(sets[at:end]) + _SHIFT)     # the first permutation
        image, high = np.empty_like(spread), np.empty_like(spread)
        for k in range(BANDS * ROWS):
            np.add(spread, np.uint64(k), out=image)              # a circular shift by k ...
            np.multiply(image, np.uint64(0xD6E8FEB86659FD93), out=image)  # ... then the second permutation
            np.right_shift(image, np.uint64(32), out=high)
            np.bitwise_xor(image, high, out=image)
            np.multiply(image, np.uint64(0xA0761D6478BD642F), out=image)
            np.right_shift(image, np.uint64(29), out=high)
            np.bitwise_xor(image, high, out=image)
            np.minimum.reduceat(image, starts, out=out[at:end, k])
        at = end
    return out


def _signed(source):
    """(doc_id, text, text_key) batches to doc_id, text_key, n_shingles, set_key, bands and two longs of signature bits."""
    hashes = WordHashes()
    weights = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _SHIFT) | np.uint64(1)
    for batch in source:
        sets = [shingles(t.as_py(), hashes) for t in batch.column(1)]
        full = [i for i, s in enumerate(sets) if len(s)]
        keys: list = [None] * len(sets)
        for i in full:
            keys[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
        found = signatures([sets[i] for i in full])
        bands = mix((mix(found) * weights).reshape(len(full), BANDS, ROWS).sum(2, dtype=np.uint64)
                    + np.arange(BANDS, dtype=np.uint64))
        bits = np.packbits((found >> np.uint64(40) & np.uint64(1)).astype(np.uint8), axis=1).copy().view(np.int64)
        rows = np.full(len(sets), -1)
        rows[full] = np.arange(len(full))
        take = pa.array([None if r < 0 else int(r) for r in rows], pa.int64())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1, dtype=np.int32) * BANDS),
                                         pa.array(bands.view(np.int64).ravel()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), lists.take(take),
             pa.array(bits[:, 0].copy()).take(take), pa.array(bits[:, 1].copy()).take(take)],
            names=["doc_id", "text_key", "n_shingles", "set_key", "bands", "bits_a", "bits_b"])


def _verified(source):
    """Pairs with both texts to those that are linked on their whole sets."""
    hashes, last, held = WordHashes(), None, None
    for batch in source:
        keep = []
        for i, (b, text_a, text_b) in enumerate(zip(batch.column("b"), batch.column("text_a"), batch.column("text_b"))):
            if b.as_py() != last:   # pairs come sorted by b
                last, held = b.as_py(), shingles(text_b.as_py(), hashes)
            other = shingles(text_a.as_py(), hashes)
            both = len(np.intersect1d(other, held, assume_unique=True))
            if 100 * both >= PERCENT * (len(other) + len(held) - both):
                keep.append(i)
        yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))


def _links_between(sets: list[np.ndarray], components: list, blocks: list[int]) -> list[tuple[int, int]]:
    """The linked pairs of different components, and of different blocks if there are two: places in the lists.

    Intersections are counted through the shingles that two or more of the sets share.
    """
    sizes = np.array([len(s) for s in sets])
    _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, shared = np.repeat(np.arange(len(sets)), sizes), uses[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    holders, begins = owner[order], np.searchsorted(column[order], np.arange(len(uses) + 1))
    rows = np.searchsorted(owner, np.arange(len(sets) + 1))
    _, kind = np.unique(np.array(components), return_inverse=True)
    block, two = np.array(blocks), len(set(blocks)) > 1
    found = []
    for i in range(len(sets)):
        columns = column[rows[i]:rows[i + 1]]
        first, many = begins[columns], begins[columns + 1] - begins[columns]
        steps = np.repeat(first - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum()) \
            if len(columns) else np.empty(0, np.int64)
        both = np.bincount(holders[steps], minlength=len(sets))
        linked = 100 * both >= PERCENT * (sizes + sizes[i] - both)
        linked[:i + 1] = False
        linked &= kind != kind[i]
        if two:
            linked &= block != block[i]
        found += [(i, int(j)) for j in np.flatnonzero(linked)]
    return found


def _compared(source):
    """Rows sorted by bucket and pair of blocks to the links inside each."""
    hashes, now, group = WordHashes(), None, []

    def links() -> list[tuple]:
        pairs = []
        if group:
            ids, components, blocks, texts = zip(*group)
            sets = [shingles(t, hashes) for t in texts]
            pairs = [tuple(sorted((ids[i], ids[j]))) for i, j in _links_between(sets, components, blocks)]
        return pairs

    for batch in source:
        found = []
        columns = [batch.column(c).to_pylist() for c in ("bucket", "low", "high", "node", "component", "block", "text")]
        for bucket, low, high, *member in zip(*columns):
            if (bucket, low, high) != now:
                found += links()
                now, group = (bucket, low, high), []
            group.append(member)
        kind = batch.schema.field("node").type
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], kind) for i in range(2)], names=["a", "b"])
    if group:
        found = links()
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], kind) for i in range(2)], names=["a", "b"])


class _Search:
    """Buckets, texts and links of one run. Nodes are classes, named by the hash of their set."""

    def __init__(self, classes: DataFrame, docs: DataFrame):
        """classes: node, n, bands, bits, and the id and text_key of a row that has the set, `rows` times. docs: id, text_key, text."""
        banded = classes.select("node", "n", F.explode("bands").alias("bucket"))
        shared = banded.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")) \
            .filter("low < high").select(F.col("bucket").alias("k"))
        self.members = staged(banded.join(shared, F.col("bucket") == F.col("k")).select("bucket", "node", "n"), "near-members")
        nodes = self.members.select(F.col("node").alias("i")).distinct()
        self.marks = staged(classes.drop("bands").join(nodes, F.col("node") == F.col("i")).drop("i"), "near-marks")
        # One text per class. Only where its very row is repeated is there more than one to choose from.
        wanted = self.marks.select("node", "rows", F.col("id").alias("i"), F.col("text_key").alias("k"))
        found = wanted.join(docs, (F.col("id") == F.col("i")) & (F.col("text_key") == F.col("k"))).select("node", "rows", "text")
        self.texts = staged(found.filter("rows = 1").select("node", "text"), "near-texts")
        repeated = wanted.filter("rows > 1").join(docs, (F.col("id") == F.col("i")) & (F.col("text_key") == F.col("k")))
        if not wanted.filter("rows > 1").isEmpty():
            self.texts = self.texts.union(staged(repeated.groupBy("node").agg(F.min("text").alias("text")), "near-texts"))
        self.tried: DataFrame | None = None
        self.links: DataFrame | None = None

    def verify(self, pairs: DataFrame) -> None:
        """Adds the linked ones of pairs (a < b) that were not compared before."""
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        # Sizes and signature bits that rule a link out spare the comparison of whole sets.
        mark = lambda side: self.marks.select(*[F.col(c).alias(f"{side}_{c}") for c in ("node", "n", "bits_a", "bits_b")])
        apart = (F.bit_count(F.col("l_bits_a").bitwiseXOR(F.col("r_bits_a")))
                 + F.bit_count(F.col("l_bits_b").bitwiseXOR(F.col("r_bits_b"))))
        sized = 100 * F.least("l_n", "r_n") >= PERCENT * F.greatest("l_n", "r_n")
        likely = staged(pairs.join(mark("l"), F.col("a") == F.col("l_node")).join(mark("r"), F.col("b") == F.col("r_node"))
                        .filter(sized & (apart <= BITS_APART)).select("a", "b"), "near-pairs")
        self.tried = likely if self.tried is None else self.tried.union(likely)
        heavy = max(HEAVY_PAIRS, likely.count() // HEAVY_SHARE)   # a pivot in very many pairs is spread over tasks
        texts = likely
        for side, other in (("a", "b"), ("b", "a")):
            table = self.texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}"))
            texts = lookup(texts, table, side, salt_on=[other], heavy_rows=heavy)
        schema = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
        found = staged(texts.sortWithinPartitions("b").select("a", "b", "text_a", "text_b").mapInArrow(_verified, schema), "near-links")
        self.links = found if self.links is None else self.links.union(found)

    def labelled(self) -> DataFrame:
        """bucket, node, n and component of members of buckets that hold more than one component."""
        found = components(self.links).select(F.col("node").alias("i"), "component")
        rows = self.members.join(found, F.col("node") == F.col("i"), "left").select(
            "bucket", "node", "n", F.coalesce("component", "node").alias("component"))
        rows = staged(rows, "near-labels")
        mixed = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")) \
            .filter("low < high").select(F.col("bucket").alias("k"))
        return staged(rows.join(mixed, F.col("bucket") == F.col("k")).drop("k"), "near-mixed")

    def against_pivots(self, rows: DataFrame, seed: list[str]) -> DataFrame:
        """Each member with its bucket's pivot, the one whose node hashes lowest, unless they are in one component."""
        pivots = rows.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("node", *seed), "node", "component")).alias("p"))
        pivots = pivots.select(F.col("bucket").alias("k"), F.col("p.node").alias("y"), F.col("p.component").alias("c"))
        return rows.join(pivots, F.col("bucket") == F.col("k")).filter("component <> c") \
            .select(F.col("node").alias("x"), "y")

    def compare_blocks(self, rows: DataFrame) -> None:
        """Adds the links between different components of the members (bucket, node, n, component) of each bucket."""
        blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
        sizes = rows.groupBy("bucket").agg(blocks.alias("blocks")).withColumnRenamed("bucket", "k")
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        dealt = (rows.join(sizes, F.col("bucket") == F.col("k"))
                 .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn("other", other)
                 .select("bucket", "node", "component", "block", F.least("block", "other").alias("low"),
                         F.greatest("block", "other").alias("high")))
        texts = dealt.join(self.texts, "node")
        partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        group = ["bucket", "low", "high"]
        schema = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])
        found = texts.repartition(partitions, *group).sortWithinPartitions(*group).mapInArrow(_compared, schema).distinct()
        self.links = self.links.union(staged(found, "near-links"))

    def run(self) -> DataFrame:
        alone = self.members.withColumn("component", F.col("node"))
        self.verify(self.against_pivots(alone, []))            # the same pivots in all buckets: few pairs a member
        self.verify(self.against_pivots(self.labelled(), ["bucket"]))   # another pivot in every bucket
        self.compare_blocks(self.labelled())
        return components(self.links)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row.

    component_id is the least id that links lead to, kept whether it is the row's own. A null, empty or blank text has
    no shingles and no links. Rows that share an id are one document: what any of its texts is linked with, and all of its
    texts are linked with each other. Rows with a null id are not linked: their component_id is null and they are kept. Very
    long texts are compared whole. Other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    keyed = rows.withColumn("text_key", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("text_key", T.BinaryType()),
                           T.StructField("n_shingles", T.LongType()),
                           T.StructField("set_key", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
                           T.StructField("bits_a", T.LongType()), T.StructField("bits_b", T.LongType())])
    signed = staged(keyed.select("id", "text", "text_key").mapInArrow(_signed, schema), "near-signatures")
    linkable = signed.filter("doc_id IS NOT NULL AND set_key IS NOT NULL")
    # A class: the rows with one set. Its signature and its representative's id and text, the least, come from one aggregate.
    copies = linkable.groupBy("set_key", "doc_id", "text_key").agg(F.count("*").alias("rows"), F.first("n_shingles").alias("n"),
                                                                  F.first("bits_a").alias("bits_a"), F.first("bits_b").alias("bits_b"))
    copies = staged(copies, "near-copies")
    least = copies.groupBy(F.col("set_key").alias("node")).agg(
        F.min(F.struct(F.col("doc_id").alias("id"), "text_key", "rows")).alias("f"), F.first("n").alias("n"),
        F.first("bits_a").alias("bits_a"), F.first("bits_b").alias("bits_b")).select("node", "n", "bits_a", "bits_b", "f.*")
    least = staged(least, "near-classes")
    bands = linkable.select("set_key", "doc_id", "text_key", "bands")
    mine = [F.col("set_key") == F.col("node"), F.col("doc_id") == F.col("id"), bands["text_key"] == least["text_key"]]
    banded = bands.join(least, mine).drop(bands["text_key"]).select(*least.columns, "bands")
    banded = banded.filter("rows = 1").unionByName(
        banded.filter("rows > 1").groupBy(*least.columns).agg(F.first("bands").alias("bands")))
    search = _Search(staged(banded, "near-banded"), keyed)
    # An id given to several texts links their classes.
    several = copies.groupBy("doc_id").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")) \
        .filter("low < high").select(F.col("doc_id").alias("i"), "low")
    same_id = copies.select("doc_id", "set_key").distinct().join(several, F.col("doc_id") == F.col("i")).filter("set_key <> low")
    search.links = staged(same_id.select(F.col("set_key").alias("a"), F.col("low").alias("b")).distinct(), "near-links")
    found = search.run().select(F.col("node").alias("i"), "component")
    placed = least.select("node", "id").join(found, F.col("node") == F.col("i"), "left") \
        .select("node", "id", F.coalesce("component", "node").alias("component"))
    placed = staged(placed, "near-placed")
    names = placed.groupBy("component").agg(F.min("id").alias("name"))
    class_of = staged(placed.join(names, "component").select(F.col("node").alias("k"), "name"), "near-names")
    heavy = max(HEAVY_PAIRS, signed.count() // HEAVY_SHARE)
    whole = lookup(signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("k")),
                   class_of, "k", salt_on=["doc_id"], heavy_rows=heavy)
    component = F.coalesce("name", "doc_id")
    return whole.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
