"""Quality rules as a short-circuit cascade.

Base measures are computed for every text. Further rules are ordered by what they reject on a sample for what they cost
there, and a text leaves the cascade at the first rule it fails, so later rules are not evaluated for it. The order
decides the time, never the verdict: a text is kept if it passes all of them.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import WORD, staged, words

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Texts (on average) on which costs and selectivities are estimated, and how often each rule is timed there.
SAMPLE_ROWS = 2_000
TIMED = 2
#: A window's place in its text takes the lower bits of a long, its hash the rest.
PLACE_BITS = 24


@dataclass(frozen=True)
class Rule:
    """passes() makes a condition of the columns __text, __words and the base measures; it is never null."""
    name: str
    passes: Callable[[], Column]


def _share(part: Column, whole: str, most: float) -> Column:
    return part <= F.col(whole) * F.lit(most)


RULES = (
    Rule("symbols", lambda: _share(F.col("n_symbols"), "n_words", 0.5)),
    Rule("word_length", lambda: F.col("word_chars").between(2 * F.col("n_words"), 12 * F.col("n_words"))),
    Rule("repeated_lines", lambda: _share(F.col("n_dup_lines"), "n_words", 0.05)),
    Rule("exclamations", lambda: _share(F.regexp_count(F.col("__text"), F.lit("!")), "n_words", 0.25)),
    Rule("capitals", lambda: _share(F.regexp_count(F.col("__text"), F.lit(r"\p{Lu}")), "word_chars", 0.4)),
    Rule("letters", lambda: F.size(F.filter("__words", lambda w: w.rlike(r"\p{L}"))) >= F.col("n_words") * F.lit(0.6)),
    Rule("distinct_words", lambda: F.size(F.array_distinct("__words")) >= F.col("n_words") * F.lit(0.02)),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once a row wherever the optimizer moves the expression."""
    return F.transform(F.array(value), body)[0]


def _same_words(w: Column, a: Column, b: Column) -> Column:
    """Whether the windows at two places hold the same three words."""
    same = F.lit(True)
    for k in range(3):
        same = same & (F.get(w, a + k) == F.get(w, b + k))
    return same


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")


def _hash(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def _places(count: Column) -> Column:
    none = F.array().cast("array<int>")
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(none)


def _by_hash(w: Column, s: Column) -> Column:
    """The places of windows that occur twice, from the sorted hashes; null if two different windows share a hash."""
    def pair(j: Column) -> tuple[Column, Column]:
        return F.get(s, j), F.get(s, j - 1)

    def equal_hash(j: Column) -> Column:
        a, b = pair(j)
        return (j > 0) & (_hash(a) == _hash(b))

    def clash(j: Column) -> Column:
        a, b = pair(j)
        return ~_same_words(w, _place(a), _place(b))

    def both(at: Column) -> Column:
        clean = ~F.exists(at, clash)
        places = F.flatten(F.transform(at, lambda j: F.array(_place(F.get(s, j)), _place(F.get(s, j - 1)))))
        return F.when(clean, places)

    return _let(F.filter(_places(F.size(s)), equal_hash), both)


def _by_words(w: Column, count: Column) -> Column:
    """The same by sorting the windows themselves. Words hold no space: what follows the last one is the place."""
    spelled = F.array_sort(F.transform(_places(count), lambda i: F.concat_ws(
        " ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2), F.lpad(i.cast("string"), 10, "0"))))
    window = lambda x: F.substring_index(x, " ", 3)
    place = lambda x: F.substring_index(x, " ", -1).cast("int")

    def twice(t: Column) -> Column:
        at = F.filter(_places(F.size(t)), lambda j: (j > 0) & (window(F.get(t, j)) == window(F.get(t, j - 1))))
        return F.flatten(F.transform(at, lambda j: F.array(place(F.get(t, j)), place(F.get(t, j - 1)))))

    return _let(spelled, twice)


def _repeat_words(w: Column) -> Column:
    """How many words are in 3-word windows that occur twice or more.

    Windows are sorted by hash, so equal ones are neighbours, and neighbours are compared word by word. Where two
    different windows share a hash, or a text is too long for the packed place, the windows themselves are sorted.
    """
    count = F.greatest(F.size(w) - 2, F.lit(0))
    packed = F.sort_array(F.transform(_places(count), lambda i: F.shiftleft(
        F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), PLACE_BITS).bitwiseOR(i.cast("long"))))
    hashed = F.when(count < 1 << PLACE_BITS, _let(packed, lambda s: _by_hash(w, s)))
    starts = F.coalesce(hashed, _by_words(w, count))
    return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))))


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, __text, __words, the base measures and base_failed of each text."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    base = base.withColumn("__words", words(F.col("__text")))
    # A line of white space only is not counted.
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(WORD))
    base = base.select(
        "doc_id", "__text", "__words", F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count(F.col("__text"), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("__words")).cast("long").alias("n_repeat_words"))
    return base.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text",
                sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by share rejected per second on a sample, best first; a rule that rejects nothing comes last."""
    count = docs.count()
    sample = docs.select(doc_id, text).sample(min(1.0, sample_rows / max(1, count)), seed=7)
    sample = staged(measure(sample, doc_id, text), "rules-sample").filter(~F.col("base_failed"))

    def timed(condition: Column) -> tuple[float, int]:
        job, took, rejected = sample.agg(F.count_if(~condition).alias("n")), [], 0
        for _ in range(TIMED):
            began = time.perf_counter()
            rejected = job.first().n
            took.append(time.perf_counter() - began)
        return min(took), rejected

    idle, _ = timed(F.length("__text") >= 0)
    worth = {}
    for rule in rules:
        seconds, rejected = timed(rule.passes())
        worth[rule.name] = rejected / max(seconds - idle, 1e-3)
    return sorted(rules, key=lambda r: -worth[r.name])


def assess(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_rule, kept per row.

    failed_rule is the rule at which a text left the cascade; which of several failing rules that is depends on the
    order, kept does not. A null text counts as empty: no words, base_failed, not kept. Repeated rows are assessed each;
    a null id stays null; other columns are not read; an empty table gives an empty result.
    """
    verdict = F.when(F.col("base_failed"), F.lit(None).cast("string"))
    for rule in order_rules(docs, rules, doc_id, text):
        verdict = verdict.when(~rule.passes(), F.lit(rule.name))
    return measure(docs, doc_id, text).withColumn("failed_rule", verdict.otherwise(F.lit(None).cast("string"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed_rule",
        (~F.col("base_failed") & F.col("failed_rule").isNull()).alias("kept"))
