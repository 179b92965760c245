"""Oracle SQL for question tagging."""

from paylake import fixed_values as fv
from paylake.sources.questions import EXAMPLES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _any(words) -> str:
    return "(" + " OR ".join(f"contains(q, {_text(w)})" for w in words) + ")"


def _values(words: dict[str, tuple[str, ...]]) -> str:
    return ", ".join(f"({_text(w)}, {_text(key)})" for key, ws in words.items() for w in ws)


def _questions() -> str:
    rows = ", ".join(f"({i}, {_text(t)})" for i, t in enumerate(EXAMPLES))
    return f"""
    asked AS (
      SELECT 'conversation' AS origin, conv_id, turn, text FROM conversations
      UNION ALL SELECT 'example', -1, i, t FROM (VALUES {rows}) e(i, t)
    ),
    normal AS (
      SELECT *, TRIM(LOWER(strip_accents(text))) AS q,
             regexp_extract_all(TRIM(LOWER(strip_accents(text))), '[a-z0-9_]+') AS toks FROM asked
    ),
    words AS (
      SELECT origin, conv_id, turn, UNNEST(toks) AS tok, UNNEST(range(len(toks))) AS pos FROM normal
    ),
    dims AS (
      SELECT origin, conv_id, turn, arg_min(key, pos) AS dimension
      FROM words JOIN (VALUES {_values(fv.DIMENSION_WORDS)}) v(word, key) ON tok = word GROUP BY ALL
    ),
    mets AS (
      SELECT origin, conv_id, turn, arg_min(key, pos) FILTER (WHERE key <> 'usuarios') AS specific, MIN(key) AS anyone
      FROM words JOIN (VALUES {_values(fv.METRIC_WORDS)}) v(word, key) ON tok = word GROUP BY ALL
    )"""


def _intent() -> str:
    cases = [f"WHEN {_any(fv.SUMMARY_WORDS)} THEN NULL"]
    for name, any_of, and_any_of, whole in fv.INTENT_RULES:
        test = _any(any_of) + (f" AND {_any(and_any_of)}" if and_any_of else "")
        for word in whole:
            test = f"({test} OR list_contains(toks, {_text(word)}))"
        if name == "city":
            cases.append(f"WHEN {test} AND {_any(fv.CITY_FAILURE_WORDS)} THEN 'city_by_failure'")
        cases.append(f"WHEN {test} THEN {_text(name)}")
    return "CASE " + " ".join(cases) + " END"


def text_oracle() -> dict[str, str]:
    phrases = " ".join(f"WHEN contains(q, {_text(p)}) THEN {_text(m)}" for p, m in fv.METRIC_PHRASES)
    metric = f"""COALESCE(CASE {phrases} END, specific, CASE WHEN anyone IS NOT NULL THEN 'usuarios' END,
        CASE WHEN dimension IS NOT NULL THEN 'usuarios' END)"""
    return {
        "text_is_data_question": f"""WITH {_questions()} SELECT origin, conv_id, turn,
            {_any(fv.DATA_QUESTION_WORDS)} OR list_contains(toks, 'dia') AS is_data_question FROM normal""",
        "text_intent_counts": f"WITH {_questions()} SELECT {_intent()} AS intent, COUNT(*) AS n FROM normal GROUP BY 1",
        "text_dim_metric": f"""WITH {_questions()} SELECT origin, conv_id, turn, dimension, {metric} AS metric
            FROM normal LEFT JOIN dims USING (origin, conv_id, turn) LEFT JOIN mets USING (origin, conv_id, turn)""",
    }
