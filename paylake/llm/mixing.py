"""Mixing sources to target weights.

Every document gets a hash-random key. Within each source the documents are sorted by ranges of that key; word counts
are summed by range, the sums of the ranges are added up, and only the range in which a source's budget ends is sorted
row by row to find the exact cut. Sources with a budget above their size repeat whole epochs first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paylake.llm.common import n_words, prefix_sums, staged

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Documents in a key range, on average; a range is what one task sorts.
RANGE_ROWS = 50_000
KEY_BITS = 60


def _key(doc_id: Column) -> Column:
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def _measured(docs: DataFrame, doc_id: str, text: str, source: str) -> list[Column]:
    return [F.col(doc_id).alias("__id"), F.col(source).cast("string").alias("__source"),
            n_words(F.col(text)).alias("__size"), _key(F.col(doc_id)).alias("__key")]


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source_size and target of each __source from its __total.

    Sources by code point, null last, weigh `weights` in turn and share the words of all sources. A target above
    max_epochs times its source's size stops there and the excess is shared again by weight. The end of that sharing is
    one level: target = least(level * weight, max_epochs * size). In the order of size / weight the capped sources come
    first, so the level follows from running sums.
    """
    ranked = prefix_sums(sizes.withColumn("__one", F.lit(1).cast("long")), ["__source"], {"__rank": "__one"}, "mix-ranks")
    turn = (F.col("__rank") % len(weights)).cast("int")
    weighed = ranked.select(
        "__source", "__total", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn + 1).alias("__weight"),
    ).withColumn("__most", F.col("__total") * max_epochs) \
     .withColumn("__ratio", F.col("__most").cast("double") / F.col("__weight"))
    summed = prefix_sums(weighed, ["__ratio", "__source"], {"__most_before": "__most", "__weight_before": "__weight"},
                         "mix-levels")
    whole = summed.agg(F.sum("__total").alias("words"), F.sum("__weight").alias("weights")).first()
    level = ((F.lit(whole.words).cast("double") - F.col("__most_before").cast("double"))
             / (F.lit(whole.weights) - F.col("__weight_before")))
    first = (summed.withColumn("__level", level).filter("__level <= __ratio")
             .agg(F.min(F.struct("__ratio", F.col("__source").isNull(), "__source", "__level")).alias("first")).first().first)
    found = F.lit(first["__level"] if first else None).cast("double")
    return summed.select(
        "__source", F.col("__total").alias("source_size"),
        F.coalesce(F.least(found * F.col("__weight"), F.col("__most").cast("double")), F.lit(0.0)).alias("target"))


def _cuts(docs: DataFrame, doc_id: str, text: str, source: str, weights, max_epochs: int):
    """The measured documents, and for each source its target, epochs and the row at which its last epoch ends."""
    measured = staged(docs.select(*_measured(docs, doc_id, text, source)), "mix-sizes")
    bits = max(0, math.ceil(math.log2(max(1, measured.count() / RANGE_ROWS))))
    ranged = measured.withColumn("__range", F.shiftright("__key", KEY_BITS - bits))
    by_range = staged(ranged.groupBy("__source", "__range").agg(F.sum("__size").alias("__words")), "mix-ranges")
    sizes = by_range.groupBy("__source").agg(F.sum("__words").alias("__total"))
    budget = F.floor("target")
    goals = staged(targets(sizes, weights, max_epochs)
                   .withColumn("__epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size")))
                               .otherwise(0).cast("long"))
                   .withColumn("__rest", (budget - F.col("__epochs") * F.col("source_size")).cast("long")), "mix-targets")

    ends = F.sum("__words").over(Window.partitionBy("__source").orderBy("__range"))
    # The range in which the rest of the budget ends: its first words are within it, its last are not.
    last = (by_range.withColumn("__end", ends).withColumn("__start", F.col("__end") - F.col("__words"))
            .join(goals.select(F.col("__source").alias("__s"), "__rest"), F.col("__source").eqNullSafe(F.col("__s")))
            .filter("__rest > 0 AND __start < __rest AND __rest <= __end")
            .select("__s", F.col("__range").alias("__r"), "__start", "__rest"))
    alike = ["__source", "__range", "__key", "__id", "__size"]
    inside = Window.partitionBy("__source", "__range").orderBy("__key", "__id", "__size")
    row = (ranged.join(last, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__range") == F.col("__r")))
           .groupBy(*alike, "__start", "__rest").agg(F.count("*").alias("__alike"))
           .withColumn("__end", F.col("__start") + F.sum(F.col("__alike") * F.col("__size")).over(inside))
           .withColumn("__before", F.col("__end") - F.col("__alike") * F.col("__size"))
           .filter("__before < __rest AND __rest <= __end")
           .select(F.col("__source").alias("__s"), F.struct("__key", "__id", "__size").alias("__cut"),
                   F.floor((F.col("__rest") - F.col("__before")) / F.col("__alike")).cast("long").alias("__part")))
    cuts = (goals.join(row, F.col("__source").eqNullSafe(F.col("__s")), "left")
            .select(F.col("__source").alias("__of"), "source_size", "target", "__epochs", "__cut", "__part"))
    return measured, staged(cuts, "mix-cuts")


def _last_epoch() -> Column:
    """Words that the last, partial epoch takes of a document."""
    here = F.struct("__key", "__id", "__size")
    return (F.when(F.col("__cut").isNull(), 0).when(here < F.col("__cut"), F.col("__size"))
            .when(here == F.col("__cut"), F.col("__part")).otherwise(0).cast("long"))


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, epochs.

    taken is epochs * size plus what the last epoch takes; over a source it adds up to floor(target), less at most one
    word for each row equal to the one at the cut. A null or empty text has size 0 and takes nothing; a null source is a
    source of its own; rows with a null id share one key and are ordered by size. Rows alike in id and size take the same.
    An empty table gives an empty result. Other columns of docs are not read.
    """
    measured, cuts = _cuts(docs, doc_id, text, source, weights, max_epochs)
    joined = measured.join(cuts, F.col("__source").eqNullSafe(F.col("__of")))
    return joined.select(
        F.col("__id").alias("doc_id"), F.col("__size").alias("size"), "source_size", "target",
        (F.col("__epochs") * F.col("__size") + _last_epoch()).alias("taken"), F.col("__epochs").alias("epochs"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixed documents, with the columns of docs: each as often as the mix takes it.

    The document at a source's cut is the only one that can come shortened: its last copy ends after the word at which
    the budget is reached. Edge cases are those of plan(); documents without a word are not taken.
    """
    _, cuts = _cuts(docs, doc_id, text, source, weights, max_epochs)
    row = F.struct(*[F.col(c) for c in docs.columns])
    keyed = docs.select(row.alias("__row"), *_measured(docs, doc_id, text, source))
    joined = keyed.join(cuts, F.col("__source").eqNullSafe(F.col("__of"))).withColumn("__last", _last_epoch())
    copies = F.col("__epochs") + F.when(F.col("__last") > 0, 1).otherwise(0)
    repeated = (joined.filter(F.col("__size") > 0).withColumn("__copies", copies.cast("int")).filter("__copies > 0")
                .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))))
    short = (F.col("__copy") > F.col("__epochs")) & (F.col("__last") < F.col("__size"))
    # A piece is a word with the white space before it, so the first pieces joined are the text up to a word's end.
    pieces = F.regexp_extract_all(F.col(f"__row.`{text}`"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.when(short, F.array_join(F.slice(pieces, 1, F.greatest(F.col("__last"), F.lit(1)).cast("int")), "")) \
        .otherwise(F.col(f"__row.`{text}`"))
    return repeated.select(*[(cut if c == text else F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])
