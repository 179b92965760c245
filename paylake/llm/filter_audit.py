"""Interaction of filters, by counting paths through the lattice of their subsets.

A state is the set of filters already applied, an edge the next filter. Documents are reduced to counts per set of filters
they fail; from these every edge gets what it removes. An order is a path from the empty set to the full one: counting
forward how many paths reach a state, and backward how many leave it, tells in how many orders an edge lies, so an edge's
removals, weighted by that, add up to Shapley values, and the steps of any order are read off its edges.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import permutations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm.common import staged
from paylake.operators.skew import lookup

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = frozenset("#$%&*|")
#: A text or id that holds at least this share of all rows, and this many, is spread over several tasks.
HEAVY_SHARE, HEAVY_ROWS = 1_000, 1_000


@dataclass(frozen=True)
class Edge:
    """Filter number `step_filter` applied in the state `before` (a bit per filter), and the orders that do so."""
    before: int
    step_filter: int
    orders: int


def lattice(filters: int) -> list[Edge]:
    """All edges, with the number of orders through each: paths that reach its state times paths that leave the next."""
    states, full = sorted(range(1 << filters), key=int.bit_count), (1 << filters) - 1
    reaching, leaving = {0: 1}, {full: 1}
    for state in states[1:]:
        reaching[state] = sum(reaching[state ^ 1 << f] for f in range(filters) if state >> f & 1)
    for state in states[-2::-1]:
        leaving[state] = sum(leaving[state | 1 << f] for f in range(filters) if not state >> f & 1)
    return [Edge(state, f, reaching[state] * leaving[state | 1 << f])
            for state in states for f in range(filters) if not state >> f & 1]


def _measured(source):
    """(doc_id, part, text) batches to doc_id, part, fails (a bit for each of A to D) and the text's 128-bit hash."""
    for batch in source:
        fails, keys = [], []
        for value in batch.column(2):
            text = value.as_py() or ""
            data = text.encode("utf-8", "replace")
            words = data.split()   # at exactly the six characters that separate words
            many = len(words)
            capitals = len(data) - len(data.translate(None, _CAPITALS))
            fails.append((many < MIN_WORDS) | (100 * len(set(words)) < DISTINCT_PERCENT * many) << 1
                         | (100 * capitals > CAPITAL_PERCENT * len(text)) << 2
                         | (not _MARKS.isdisjoint(text)) << 3)
            keys.append(xxhash.xxh3_128_digest(data))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fails, pa.int32()),
                                          pa.array(keys, pa.binary())], names=["doc_id", "part", "fails", "key"])


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """doc_id, part, fails, n: distinct documents with the filters they fail, a bit each from A, and how many rows they are.

    Null texts count as empty, null parts as the empty text. E fails where a row of a smaller id has the same text (128-bit
    hash) anywhere; a null id is neither smaller nor larger than another.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.col(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("part", T.StringType(), False),
                           T.StructField("fails", T.IntegerType(), False), T.StructField("key", T.BinaryType(), False)])
    alike = staged(rows.mapInArrow(_measured, schema).groupBy("doc_id", "part", "fails", "key")
                   .agg(F.count("*").alias("n")), "audit-rows")
    repeated = alike.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")) \
        .filter("copies > 1 AND first IS NOT NULL")
    heavy = max(HEAVY_ROWS, alike.count() // HEAVY_SHARE)
    known = lookup(alike, staged(repeated, "audit-texts"), "key", salt_on=["doc_id"], weight="copies", heavy_rows=heavy)
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    fails = F.col("fails").bitwiseOR(F.when(later, 1 << FILTERS.index("E")).otherwise(0))
    return known.select("doc_id", "part", "key", fails.alias("fails"), "n")


def audit(failed: DataFrame, labels: DataFrame, filters: str = FILTERS, doc_id: str = "doc_id", good: str = "quality",
          toxic: str = "toxic", orders: Sequence[str] | None = None) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley: a row per
    part, order and step, zeros included.

    failed: rows of failures(), or of the same columns for other filters. An id labelled more than once counts as labelled
    if any of its rows says so; null labels do not count. Labels of unknown documents are not used. An empty table
    has no parts and gives no rows. Other columns are not read.
    """
    heavy = max(HEAVY_ROWS, failed.count() // HEAVY_SHARE)
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(good).alias("good"), F.col(toxic).alias("toxic")) \
        .filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
            F.coalesce(F.max((F.col("good") == 1).cast("int")), F.lit(0)).alias("good"),
            F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"))
    rows = lookup(failed, known, "doc_id", salt_on=["key"], heavy_rows=heavy)
    # Counts per part and set of failed filters: all that the lattice needs.
    of = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)) * F.col("n"))
    counted = staged(rows.groupBy("part", "fails").agg(F.sum("n").alias("n"), of("good").alias("good"), of("toxic").alias("toxic")),
                     "audit-counts")
    spark = failed.sparkSession
    edges = lattice(len(filters))
    listed = F.array(*[F.struct(F.lit(e.before).alias("before"), F.lit(e.step_filter).alias("f"), F.lit(e.orders).cast("long").alias("orders"))
                       for e in edges])
    on = counted.withColumn("e", F.explode(listed)).select("*", "e.*").drop("e")
    own = F.expr("shiftleft(1, f)")
    fails_it = F.col("fails").bitwiseAND(own) != 0
    there = F.col("fails").bitwiseAND(F.col("before")) == 0
    alone = F.col("fails") == own
    total = lambda c, when: F.sum(F.when(when, F.col(c)).otherwise(0)).cast("long")
    steps = staged(on.groupBy("part", "before", "f", "orders").agg(
        total("n", there & ~fails_it).alias("kept"), total("n", there & fails_it).alias("removed"),
        total("n", ~there & fails_it).alias("redundant"), total("n", alone).alias("unique_fails"),
        total("good", there & fails_it).alias("good_lost"), total("toxic", there & fails_it).alias("toxic_lost")), "audit-edges")
    shapley = steps.groupBy("part", "f").agg(F.sum(F.col("orders") * F.col("removed")).cast("long").alias("shapley"))
    read = []
    for order in orders or ["".join(p) for p in permutations(filters)]:
        before = 0
        for step, name in enumerate(order, 1):
            read.append((before, filters.index(name), order, step))
            before |= 1 << filters.index(name)
    path = spark.createDataFrame(read, "before int, f int, filter_order string, step int")
    return steps.join(shapley, ["part", "f"]).join(path, ["before", "f"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
