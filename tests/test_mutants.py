"""Five wrong versions of our own operators; the named tests must notice each of them."""

import inspect

import pytest

from paylake.operators import bronze, gold, guard, silver
from tests import test_bronze, test_gold, test_guard, test_silver

MUTANTS = [
    ("guard off", guard, "check", "if found:", "if False:",
     lambda spark: test_guard.test_blocked("SELECT 1 FROM (DROP TABLE gold_user_360)")),
    ("cap inverted", guard, "capped", "df.limit(max_rows)", "df.offset(max_rows)",
     lambda spark: _capped(spark)),
    ("missing id not flagged", bronze, "flag_duplicates",
     '        .when(F.col("_id").isNull(), fv.MISSING_EVENT_ID)\n', "",
     lambda spark: test_bronze.test_flags_follow_history_and_batch_order(spark)),
    ("last duplicate kept", silver, "deduplicate", 'F.min("_order")', 'F.max("_order")',
     lambda spark: test_silver.test_canonical_row_is_the_first_unflagged(spark)),
    ("failures not in the denominator", gold, "failure_and_recency", "done + failed", "done",
     lambda spark: test_gold.test_two_successes_and_a_failure(spark)),
]


def _capped(spark):
    df = spark.createDataFrame([("u1", 5.0)] * 150, "user_id string, total double")
    assert guard.run(spark, "SELECT total FROM gold_user_360", {"gold_user_360": df})[0].count() == 100


@pytest.mark.parametrize("name,module,function,old,new,check", MUTANTS, ids=[m[0] for m in MUTANTS])
def test_mutant_is_noticed(spark, monkeypatch, name, module, function, old, new, check):
    source = inspect.getsource(getattr(module, function))
    assert source.count(old) == 1
    scope = dict(vars(module))
    exec("from __future__ import annotations\n" + source.replace(old, new), scope)
    check(spark)
    monkeypatch.setattr(module, function, scope[function])
    with pytest.raises((AssertionError, pytest.fail.Exception)):
        check(spark)
