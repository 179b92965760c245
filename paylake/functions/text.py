"""Question text as columns: normalisation, intent tag, dimension and metric. Row-local, no shuffle."""

from __future__ import annotations

import unicodedata
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from paylake import fixed_values as fv
from paylake.functions.scalars import rows, when_any


def _accent_table() -> tuple[str, str]:
    """Every character whose compatibility decomposition is one base character, and that character."""
    marked, base = [], []
    for code in chain(range(0x00A1, 0xD800), range(0xF900, 0xFFFE)):
        letters = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(letters) == 1 and letters != chr(code) and ord(letters) < 0x10000:
            marked.append(chr(code))
            base.append(letters)
    return "".join(marked), "".join(base)


_MARKED, _BASE = _accent_table()


def normalize(text: str | Column) -> Column:
    """Lower case without accents or outer blanks; null reads as empty."""
    c = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    bare = F.translate(F.regexp_replace(c, r"\p{Mn}+", ""), _MARKED, _BASE)
    return F.trim(F.lower(bare))


def tokens(normalized: Column) -> Column:
    return F.regexp_extract_all(normalized, F.lit(r"([a-z0-9_]+)"), F.lit(1))


def is_data_question(normalized: Column, toks: Column) -> Column:
    return when_any(normalized, fv.DATA_QUESTION_WORDS) | F.array_contains(toks, fv.DATA_QUESTION_TOKEN)


def intent(normalized: Column, toks: Column) -> Column:
    """First matching business rule; summary questions and the rest have none."""
    chosen = F.when(when_any(normalized, fv.SUMMARY_WORDS), F.lit(None).cast("string"))
    for name, any_of, and_any_of, whole_words in fv.INTENT_RULES:
        hit = when_any(normalized, any_of)
        if and_any_of:
            hit = hit & when_any(normalized, and_any_of)
        for word in whole_words:
            hit = hit | F.array_contains(toks, word)
        if name == "city":
            by_failure = when_any(normalized, fv.CITY_FAILURE_WORDS)
            chosen = chosen.when(hit & by_failure, "city_by_failure")
        chosen = chosen.when(hit, name)
    return chosen


def _keys_in_order(words: dict[str, tuple[str, ...]], toks: Column) -> Column:
    """Keys of the known tokens, by first appearance. A hash intersection leaves the few known ones."""
    spelled = [(w, key) for key, spellings in words.items() for w in spellings]
    known = F.array_intersect(toks, F.array(*(F.lit(w) for w, _ in spelled)))
    table = F.create_map(*(F.lit(x) for pair in spelled for x in pair))
    return F.transform(known, lambda t: F.element_at(table, t))


def _metric(normalized: Column, found: Column, has_dimension: Column) -> Column:
    """Phrases first, then the first specific token, then the generic user count."""
    specific = F.filter(found, lambda k: k != fv.GENERIC_METRIC)
    phrases = None
    for phrase, key in fv.METRIC_PHRASES:
        test = normalized.contains(phrase)
        phrases = F.when(test, key) if phrases is None else phrases.when(test, key)
    default = F.when(has_dimension, fv.GENERIC_METRIC)
    return F.coalesce(phrases, F.get(specific, 0), F.get(found, 0), default)


def tag_questions(questions: DataFrame, text: str = "text") -> DataFrame:
    """Add every tag: data question, intent, dimension of the first token that names one, metric.

    Normalised text, tokens and metric words are columns of their own, so each is computed once.
    """
    q, toks, found = F.col("_q"), F.col("_tokens"), F.col("_metrics")
    prepared = (
        questions.withColumn("_q", normalize(text)).withColumn("_tokens", tokens(q))
        .withColumns({
            "dimension": F.get(_keys_in_order(fv.DIMENSION_WORDS, toks), 0),
            "_metrics": _keys_in_order(fv.METRIC_WORDS, toks),
        })
    )
    return prepared.withColumns({
        "is_data_question": is_data_question(q, toks),
        "intent": intent(q, toks),
        "metric": _metric(q, found, F.col("dimension").isNotNull()),
    }).drop("_q", "_tokens", "_metrics")


def intent_counts(questions: DataFrame, text: str = "text") -> DataFrame:
    q = questions.select(normalize(text).alias("_q")).withColumn("_tokens", tokens(F.col("_q")))
    return q.groupBy(intent(F.col("_q"), F.col("_tokens")).alias("intent")).agg(rows().alias("n"))
