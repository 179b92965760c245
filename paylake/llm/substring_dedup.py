"""Removing passages that occur more than once in a corpus, by suffix automata.

A window is `length` consecutive words. Equal windows contain equal minimal 8-word grams, so the windows of a document
are cut into runs that share their minimal gram, and runs are compared by gram. Where all runs with a gram are the same
words, they are repeated as a whole. Where they differ, their words form a reference shard: the shard's suffix
automaton is built in the task that holds it, the runs are streamed through it, and the matching statistics give the
maximal repeated spans. Grams with very many different runs are split by window instead.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.llm.common import staged
from paylake.llm.suffix_automaton import SuffixAutomaton
from paylake.llm.wordhash import Runs, WordHashes, other_windows, sliding_min

LENGTH, GRAM = 35, 8
#: Different runs of one gram, and bytes of their words, up to which they form a shard (some 100 MB of automaton in a task); beyond
#: either, each window is counted by itself.
SHARD_RUNS, SHARD_BYTES = 4_000, 4_000_000
#: A run's place is its first word, shifted, and its number of windows.
SIZE_BITS = 20
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_of(words: list[bytes], hashes: WordHashes, length: int = LENGTH):
    """gram, context hash, first window and number of windows of each run of a document; and a flag for runs in which
    a window occurs twice."""
    n = len(words) - length + 1
    sums = Runs(hashes.of(words))
    least = sliding_min(sums.windows(GRAM), length - GRAM + 1)
    edge = np.flatnonzero(least[1:] != least[:-1]) + 1
    first = np.concatenate([[0], edge]).astype(np.int64)
    size = np.diff(np.append(first, n))
    if size.max() >= 1 << SIZE_BITS:  # the place holds no more: cut such runs
        most = (1 << SIZE_BITS) - 1
        first = np.concatenate([np.arange(a, a + s, most) for a, s in zip(first, size)])
        size = np.diff(np.append(first, n))
    context = sums.hash(first, first + size + length - 1)
    windows = sums.windows(length)
    in_order = np.sort(windows)
    twice = np.zeros(len(first), bool)
    if (in_order[1:] == in_order[:-1]).any():
        run = np.repeat(np.arange(len(first)), size)
        order = np.lexsort((windows, run))
        same = (windows[order][1:] == windows[order][:-1]) & (run[order][1:] == run[order][:-1])
        twice[run[order][1:][same]] = True
    return least[first], context, first, size, twice


def _runs(length: int):
    def batches(source):
        hashes = WordHashes()
        for batch in source:
            found: list[list[np.ndarray]] = [[], [], [], []]
            for key, text in zip(batch.column(0).to_numpy(), batch.column(1)):
                words = (text.as_py() or "").encode("utf-8", "replace").split()
                if len(words) < length:
                    continue
                gram, context, first, size, twice = runs_of(words, hashes, length)
                place = (first << SIZE_BITS) | size
                if twice.any():  # an empty run beside it, so that its gram is not taken for one that occurs once
                    gram, context = np.append(gram, gram[twice]), np.append(context, context[twice] + np.uint64(1))
                    place = np.append(place, place[twice] >> SIZE_BITS << SIZE_BITS)
                for column, values in zip(found, (gram.view(np.int64), context.view(np.int64),
                                                  np.full(len(gram), key, np.int64), place)):
                    column.append(values)
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found],
                                                 names=["gram", "context", "key", "place"])
    return batches


def _contexts(length: int):
    """Rows of docs with their list of runs, to one row per run with its words."""
    def batches(source):
        for batch in source:
            out: list[list] = [[], [], [], [], []]
            for key, text, runs in zip(batch.column("key").to_pylist(), batch.column("__text"), batch.column("runs")):
                words = text.as_py().encode("utf-8", "replace").split()
                for run in runs.as_py():
                    first, size = run["place"] >> SIZE_BITS, run["place"] & ((1 << SIZE_BITS) - 1)
                    if size:
                        for column, value in zip(out, (run["gram"], run["n"], key, first,
                                                       b" ".join(words[first:first + size + length - 1]))):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.binary())],
                                             names=["gram", "n", "key", "first", "words"])
    return batches


def _shards(length: int):
    """Runs sorted by gram to the repeated spans of those that occur once as a whole."""
    def spans(group: list[tuple]) -> list[tuple[int, int, int]]:
        sequences = [words.split() for _, _, _, words in group]
        automaton = SuffixAutomaton(sequences, [n for n, _, _, _ in group])
        return [(key, first + a, first + b) for (n, key, first, _), words in zip(group, sequences) if n == 1
                for a, b in automaton.repeated_spans(words, length)]

    def batches(source):
        gram, group = None, []
        for batch in source:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("gram", "n", "key", "first", "words")]
            for g, *run in zip(*columns):
                if g != gram:
                    found += spans(group)
                    gram, group = g, []
                group.append(run)
            yield _ranges(found)
        yield _ranges(spans(group))
    return batches


def _ranges(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(3)],
                                      names=["key", "begin", "end"])


def _windows(length: int):
    """Runs to one row per window, under two hashes."""
    def batches(source):
        hashes = WordHashes()
        for batch in source:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            columns = [batch.column(c).to_pylist() for c in ("n", "key", "first", "words")]
            for n, key, first, words in zip(*columns):
                own = hashes.of(words.split())
                one, two = Runs(own).windows(length), other_windows(own, length)
                for column, values in zip(out, (one.view(np.int64), two.view(np.int64), np.full(len(one), n),
                                                np.full(len(one), key), first + np.arange(len(one)))):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out],
                                                 names=["one", "two", "n", "key", "begin"])
    return batches


def _keyed(docs: DataFrame, doc_id: str, text: str, kept: list[str]) -> DataFrame:
    """key, __text and the other kept columns in row. The key is one of id and text: rows alike in both have the same
    words, so one key serves them."""
    others = [F.col(f"`{c}`") for c in kept if c != text]
    row = F.struct(*others) if others else F.struct(F.lit(1).alias("one"))
    return docs.select(F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("key"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"), row.alias("row"))


RANGE = "key long, begin long, end long"


def repeated_ranges(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """key, begin, end: ranges of words covered by windows that occur more than once."""
    runs = keyed.select("key", "__text").mapInArrow(_runs(length), "gram long, context long, key long, place long")
    # A gram's runs are the same words if their context hashes are; (gram, context) is a hash of 128 bits.
    grams = (runs.groupBy("gram").agg(F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high"))
             .filter("n > 1").select(F.col("gram").alias("g"), (F.col("low") != F.col("high")).alias("mixed")))
    shared = staged(runs.join(grams, F.col("gram") == F.col("g")).select("gram", "context", "key", "place", "mixed"),
                    "dedup-runs")
    first = F.shiftright("place", SIZE_BITS)
    size = F.col("place").bitwiseAND(F.lit((1 << SIZE_BITS) - 1))
    whole = [F.col("key"), first.alias("begin"), (first + size + (length - 1)).alias("end")]

    mixed = shared.filter("mixed")
    contexts = (mixed.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("run")))
    several = contexts.filter("n > 1").select(F.col("gram").alias("g"), F.col("context").alias("c"))
    copies = mixed.join(several, (F.col("gram") == F.col("g")) & (F.col("context") == F.col("c")))
    # One run of each kind, found by document, gets its words from the text.
    wanted = (contexts.select(F.col("run.key").alias("k"), F.struct("gram", F.least("n", F.lit(2)).alias("n"),
                                                                    F.col("run.place").alias("place")).alias("run"))
              .groupBy("k").agg(F.collect_list("run").alias("runs")))
    distinct_rows = keyed.select("key", "__text")
    spelled = staged(distinct_rows.join(wanted, F.col("key") == F.col("k")).select("key", "__text", "runs")
                     .mapInArrow(_contexts(length), "gram long, n long, key long, first long, words binary")
                     .dropDuplicates(["key", "first", "gram"]), "dedup-contexts")
    counts = spelled.groupBy("gram").agg(F.count("*").alias("runs"), F.sum(F.length("words")).alias("bytes")).select(
        F.col("gram").alias("g"), ((F.col("runs") <= SHARD_RUNS) & (F.col("bytes") <= SHARD_BYTES)).alias("shard"))
    sized = spelled.join(counts, F.col("gram") == F.col("g")).drop("g")
    partitions = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    from_shards = (sized.filter("shard").repartition(partitions, "gram").sortWithinPartitions("gram")
                   .select("gram", "n", "key", "first", "words").mapInArrow(_shards(length), RANGE))
    windows = staged(sized.filter("NOT shard").select("n", "key", "first", "words")
                     .mapInArrow(_windows(length), "one long, two long, n long, key long, begin long"), "dedup-windows")
    often = windows.groupBy("one", "two").agg(F.sum("n").alias("uses")).filter("uses > 1") \
        .select(F.col("one").alias("o"), F.col("two").alias("t"))
    from_windows = (windows.filter("n = 1").join(often, (F.col("one") == F.col("o")) & (F.col("two") == F.col("t")))
                    .select("key", "begin", (F.col("begin") + length).alias("end")))
    return (shared.filter("NOT mixed").select(*whole).union(copies.filter(size > 0).select(*whole))
            .union(from_shards).union(from_windows))


def cut(text: str, ranges: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the words of the ranges, its words and the words removed. The white space before a kept word that
    follows a removed one goes with the removed one, unless it is the first kept word's."""
    places = [m.span() for m in _WORD.finditer(text)]
    gone = np.zeros(len(places) + 1, np.int64)
    for begin, end in ranges:
        gone[begin] += 1
        gone[min(end, len(places))] -= 1
    removed = np.cumsum(gone[:-1]) > 0
    n = int(removed.sum())
    if not n:
        return text, len(places), 0
    out, at = [], 0
    for i in np.flatnonzero(np.diff(np.concatenate([[0], removed.view(np.int8), [0]]))).reshape(-1, 2).tolist():
        begin, end = i
        out.append(text[at:places[begin][0]])
        at = places[end][0] if end < len(places) else len(text)
    out.append(text[at:])
    kept = "".join(out)
    return kept if n < len(places) else "", len(places), n


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """The rows of docs, the text without repeated passages, and the columns n_words and n_removed.

    Every word goes that a window covers whose words also start elsewhere, in the same document or another; windows
    are judged on the input, so all copies go. The rest of the text stays as it is. A null text has no words and comes
    back empty; a text of fewer than `length` words is never changed; repeated rows are copies of each other. Rows are
    told apart by a 64-bit hash of id and text. A very long text is taken whole, an empty table gives an empty result. Columns of docs named n_words or n_removed are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    keyed = _keyed(docs, doc_id, text, kept)
    ranges = staged(repeated_ranges(keyed, length), "dedup-ranges")
    by_key = ranges.groupBy("key").agg(F.collect_list(F.struct("begin", "end")).alias("ranges")).withColumnRenamed("key", "k")
    joined = keyed.join(by_key, F.col("key") == F.col("k"), "left").select("__text", "row", "ranges")
    schema = T.StructType([T.StructField("row", joined.schema["row"].dataType, False), T.StructField("text", T.StringType()),
                           T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])

    def batches(source):
        for batch in source:
            out: list[list] = [[], [], []]
            for value, found in zip(batch.column("__text"), batch.column("ranges")):
                old = value.as_py()
                if found.is_valid:
                    result = cut(old, [(r["begin"], r["end"]) for r in found.as_py()])
                else:
                    result = old, len(old.encode("utf-8", "replace").split()), 0
                for column, x in zip(out, result):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.int64())], names=["row", "text", "n_words", "n_removed"])

    cleaned = joined.mapInArrow(batches, schema)
    return cleaned.select(*[(F.col("text") if c == text else F.col(f"row.`{c}`")).alias(c) for c in kept],
                          "n_words", "n_removed")
