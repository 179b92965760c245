"""Benchmark decontamination by winnowing.

Every run of GRAM words has a hash; of each window of consecutive hashes the least is kept (the rightmost of equal ones).
Two texts that share a run of WINDOW words share the hash kept in it, whatever surrounds it, so joining what is kept of
documents and of items misses no shared window. A hit is then extended word by word, at most to the window's length on either
side: any further words are in a window that has a kept hash of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paylake.llm.common import staged
from paylake.operators.skew import lookup

#: What separates words: ASCII characters that are, once in small letters, no letter or digit.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, GRAM = 10, 6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A text that holds at least this share of all rows, and this many, is spread over several tasks.
HEAVY_SHARE, HEAVY_ROWS = 1_000, 1_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once a row wherever the optimizer moves the expression."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    """The words of a text, A to Z in small letters. A text with as many bytes as characters is ASCII."""
    whole = F.coalesce(text, F.lit(""))
    small = F.when(F.octet_length(whole) == F.length(whole), F.lower(whole)).otherwise(F.translate(whole, _UPPER, _LOWER))
    return F.array_remove(F.split(small, BETWEEN), "")


def _places(count: Column) -> Column:
    none = F.array().cast("array<int>")
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(none)


def _grams(hashes: Column, gram: int) -> Column:
    """The hash of every run of `gram` words, from the hashes of the words."""
    return F.transform(_places(F.size(hashes) - (gram - 1)),
                       lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(gram)]))


def _kept(grams: Column, width: int) -> Column:
    """The places of the least hash, the rightmost of equal ones, in every `width` consecutive hashes."""
    def place(i: Column) -> Column:
        def rightmost(least: Column) -> Column:
            at = i
            for k in range(1, width):
                at = F.when(F.get(grams, i + k) == least, i + k).otherwise(at)
            return at
        return _let(F.least(*[F.get(grams, i + k) for k in range(width)]), rightmost)
    if width == 1:
        return _places(F.size(grams))
    return F.array_distinct(F.transform(_places(F.size(grams) - (width - 1)), place))


def fingerprints(words: Column, gram: int, width: int, window: int = WINDOW) -> Column:
    """Of each hash kept: hash, its place at, and near, the words from window - gram before its run to as many after
    it; null beyond the ends."""
    def near(at: Column) -> Column:
        return F.array(*[F.get(words, at + k) for k in range(gram - window, window)])

    def kept(grams: Column) -> Column:
        return F.transform(_kept(grams, width), lambda at: F.struct(
            F.get(grams, at).alias("hash"), at.alias("at"), near(at).alias("near")))
    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: _let(_grams(hashes, gram), kept))


def _least_hashes(words: Column, classes: list[tuple[int, int, int, int]]) -> Column:
    """The distinct hashes that fingerprints() keeps for these classes, without their places."""
    def least(width: int) -> Callable[[Column], Column]:
        def of(grams: Column) -> Column:
            return F.transform(_places(F.size(grams) - (width - 1)),
                               lambda i: F.least(*[F.get(grams, i + k) for k in range(width)]))
        return of if width > 1 else lambda grams: grams

    def of_all(hashes: Column) -> Column:
        return F.concat(*[F.array_distinct(_let(_grams(hashes, gram), least(width))) for gram, width, _, _ in classes])
    return _let(F.transform(words, lambda w: F.xxhash64(w)), of_all)


def _classes(lengths: list[int], window: int, gram: int) -> list[tuple[int, int, int, int]]:
    """(gram, width, least and largest number of words) for the items: one class of those with a whole gram, and one
    for each smaller number of words, in which every run is kept."""
    whole = [n for n in lengths if n >= gram]
    found = [(gram, min(min(whole), window) - gram + 1, gram, 1 << 30)] if whole else []
    return found + [(n, 1, n, n) for n in lengths if n < gram]


def _class_hits(texts: DataFrame, items: DataFrame, window: int, gram: int, width: int) -> DataFrame:
    """key, begin, end and items (ids) of the runs of a text that are covered by windows of items."""
    made = items.select("item", "n", F.explode(fingerprints(F.col("words"), gram, width, window)).alias("f")) \
        .groupBy("f.hash", F.col("f.near").alias("there"), F.least("n", F.lit(window)).alias("whole")) \
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    kept = texts.select("key", F.explode(fingerprints(F.col("words"), gram, width, window)).alias("f")) \
        .select("key", "f.hash", "f.at", "f.near")
    # An item's fingerprints are a table of known size once written: broadcast while small, shuffled by hash beyond that.
    both = kept.join(staged(made, "leak-fingerprints"), "hash")
    side = window - gram

    def same(k: int) -> Column:
        return F.coalesce(F.col("near")[k] == F.col("there")[k], F.lit(False))

    def reach(steps: list[int]) -> Column:
        """How many of the places, in this order, agree before the first that does not."""
        count = F.lit(0)
        for k in reversed(steps):
            count = F.when(same(k), count + 1).otherwise(F.lit(0))
        return count
    run = F.lit(True)
    for k in range(side, side + gram):
        run = run & same(k)
    before, after = reach(list(range(side - 1, -1, -1))), reach(list(range(side + gram, window + side)))
    spans = both.filter(run).select("key", "items", "whole", (F.col("at") - before).alias("begin"),
                                    (F.col("at") + gram + after).alias("end"))
    return spans.filter(F.col("end") - F.col("begin") >= F.col("whole")).select("key", "begin", "end", "items")


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _spans(docs: DataFrame, measured: DataFrame, items: DataFrame, classes: list[tuple[int, int, int, int]], window: int) -> DataFrame:
    """key, begin, end and items: word ranges of texts that windows of items cover, with the ids of the items.

    First the kept hashes alone are joined: texts without a common one, nearly all, are not looked at again. The words of
    the others are then compared around each kept hash. Ranges may overlap; equal texts give theirs once.
    """
    wanted = staged(items.select(F.explode(_least_hashes(F.col("words"), classes)).alias("hash")).distinct(), "leak-hashes")
    candidates = staged(measured.select("key", F.explode("hashes").alias("hash")).join(wanted, "hash", "left_semi")
                        .select("key").distinct(), "leak-candidates")
    texts = docs.withColumn("key", _text_key(F.col("text"))).join(candidates, "key", "left_semi") \
        .select("key", _words(F.col("text")).alias("words"))
    found = [_class_hits(texts, items.filter(F.col("n").between(low, high)), window, size, width)
             for size, width, low, high in classes]
    return reduce(DataFrame.unionByName, found).distinct()


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items and contaminated of each row of docs.

    n_hit counts the words inside any occurrence of a window of an item, items lists the ids (as text, sorted) of items
    with occurring windows. Null, empty and wordless texts have no words and no hits; items without words are not
    looked for. Rows that share an id are judged each by its text; an item id given twice is one item with the windows of
    both, a null one is the empty text. Very long texts are taken whole. Without items nothing is hit. Other columns are not read.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), _words(F.col(item_text)).alias("words"))
    wordy = staged(named.withColumn("n", F.size("words")).filter("n > 0"), "leak-items")
    lengths = [r.n for r in wordy.select(F.least("n", F.lit(window)).alias("n")).distinct().collect()]  # at most `window`
    classes = _classes(lengths, window, gram)
    words = docs.select("doc_id", _text_key(F.col("text")).alias("key"), _words(F.col("text")).alias("words"))
    rows = words.select("doc_id", "key", F.size("words").cast("long").alias("n_words"),
                        *([_least_hashes(F.col("words"), classes).alias("hashes")] if classes else []))
    if not classes:
        return rows.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
                           F.array().cast("array<string>").alias("items"), F.lit(False).alias("contaminated"))
    rows = staged(rows, "leak-documents")
    spans = staged(_spans(docs, rows, wordy, classes, window), "leak-spans")
    before = Window.partitionBy("key").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("begin", F.coalesce(F.max("end").over(before), F.lit(0))))
    hit = (spans.groupBy("key", "begin").agg(F.max("end").alias("end")).select("key", fresh.alias("fresh"))
           .groupBy("key").agg(F.sum("fresh").cast("long").alias("n_hit")))
    named = (spans.select("key", F.explode("items").alias("item")).distinct()
             .groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("items")))
    judged = staged(hit.join(named, "key"), "leak-texts")
    heavy = max(HEAVY_ROWS, rows.count() // HEAVY_SHARE)
    found = lookup(rows.drop("hashes"), judged, "key", salt_on=["doc_id"], heavy_rows=heavy)
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    hits = F.coalesce("n_hit", F.lit(0).cast("long"))
    return found.select("doc_id", "n_words", hits.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
                        items_of.alias("items"), (hits > 0).alias("contaminated"))
