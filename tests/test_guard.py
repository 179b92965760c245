import pytest

from paylake.operators import guard


@pytest.mark.parametrize("sql", [
    "DROP TABLE gold_user_360", "SELECT * FROM gold_user_360; DELETE FROM gold_user_360",
    "SELECT * FROM gold_user_360 -- note", "SELECT * FROM gold_user_360 /* note */", "SHOW TABLES",
    "select 1; select 2", "create table x as select 1", "CACHE TABLE t AS SELECT 1", "FROM t SELECT 1", "", "SELECTED",
])
def test_blocked(sql):
    with pytest.raises(guard.UnsafeSQL):
        guard.check(sql)


def test_words_inside_names_are_allowed():
    assert guard.check("SELECT updated_at, created FROM t ;").endswith("t ")
    assert guard.check("(with x as (select 1) select replace(a, 'b', 'c') from x)")


def test_warehouse_reads(spark):
    from paylake.sources import catalog

    assert catalog.query(spark, "WITH x AS (SELECT 1 AS a, 'n' AS user_name) SELECT * FROM x").columns == ["a"]
    assert catalog.command(spark, "SHOW TABLES").columns
    for sql in ("SHOW TABLES", "MERGE INTO t USING s ON 1=1", "SELECT replace('a', 'b', 'c')"):
        with pytest.raises(guard.UnsafeSQL):
            catalog.query(spark, sql)


@pytest.fixture
def tables(spark):
    df = spark.createDataFrame([("u1", "Ana", "a@b.c", 30, 5.0)] * 150,
                               "user_id string, user_name string, user_email string, user_age int, total double")
    return {"gold_user_360": df}


def test_rows_are_capped_and_named_pii_is_reported_and_dropped(spark, tables):
    result, pii = guard.run(spark, "SELECT user_email, total FROM gold_user_360", tables)
    assert pii == ["user_email"] and result.columns == ["total"] and result.count() == 100


@pytest.mark.parametrize("limit,expected", [(500, 100), (5, 5)])
def test_a_limit_in_the_text_can_only_lower_the_cap(spark, tables, limit, expected):
    assert guard.run(spark, f"SELECT total FROM gold_user_360 LIMIT {limit}", tables)[0].count() == expected


def test_an_alias_does_not_carry_pii_out(spark, tables):
    result, _ = guard.run(spark, "SELECT DISTINCT user_email AS x, concat('-', user_name) AS y FROM gold_user_360", tables)
    assert [tuple(r) for r in result.collect()] == [(None, None)]


@pytest.mark.parametrize("sql", [
    "SELECT TRANSFORM(total) USING 'id -un' AS (x string) FROM gold_user_360",
    "SELECT java_method('java.lang.System', 'getProperty', 'user.name')", "SELECT `reflect`('java.lang.System', 'nanoTime')",
    "SELECT user_email AS e FROM parquet.`/tmp/x`", "SELECT user_email AS e FROM default.other", "SELECT * FROM other",
    "SELECT (SELECT max(user_email) FROM other) AS e FROM gold_user_360", "SELECT * FROM gold_user_360 WHERE EXISTS (SELECT 1 FROM other)",
])
def test_only_the_given_tables_are_read_and_nothing_is_run(spark, tables, sql):
    with pytest.raises(guard.UnsafeSQL):
        guard.run(spark, sql, tables)


def test_definitions_and_subqueries_are_allowed(spark, tables):
    sql = "WITH x AS (SELECT total FROM gold_user_360) SELECT (SELECT max(total) FROM x) AS m, count(*) AS n FROM x"
    assert [tuple(r) for r in guard.run(spark, sql, tables)[0].collect()] == [(5.0, 150)]


def test_the_callers_view_stays_and_a_cut_is_told(spark, tables):
    spark.range(3).createOrReplaceTempView("gold_user_360")
    assert guard.is_cut(spark, "SELECT total FROM gold_user_360", tables)
    assert not guard.is_cut(spark, "SELECT total FROM gold_user_360 LIMIT 7", tables)
    assert spark.table("gold_user_360").count() == 3
    spark.catalog.dropTempView("gold_user_360")


def test_the_catalog_masks_personal_columns_under_any_name(spark):
    from paylake.sources import catalog

    catalog.publish_table(spark.sql("SELECT 'a@b.c' AS user_email, 1 AS n"), "guarded_people")
    try:
        rows = catalog.query(spark, "SELECT user_email AS e, n FROM guarded_people").collect()
        assert [tuple(r) for r in rows] == [(None, 1)]
        for sql in ("WITH guarded_people AS (SELECT 1 AS n) SELECT * FROM spark_catalog.default.guarded_people",
                    "SELECT * FROM default.guarded_people"):
            with pytest.raises(guard.UnsafeSQL):
                catalog.query(spark, sql)
    finally:
        spark.sql("DROP TABLE guarded_people")


HIDDEN = [
    "SELECT user_email AS e FROM IDENTIFIER('secret')", "SELECT user_email AS e FROM IDENTIFIER('sec'||'ret')",
    "SELECT user_email AS e FROM IDENTIFIER('parquet.`/tmp/x`')",
    "SELECT IDENTIFIER('ref'||'lect')('java.lang.System','getProperty','user.name')", "SELECT IDENTIFIER('user_'||'email') FROM gold_user_360",
    "SELECT * FROM range(5)", "SELECT * FROM explode(array(1))", "SELECT system.builtin.upper('a')", "SELECT shout('a')",
    "FROM secret SELECT user_email", "SELECT (SELECT max(user_email) FROM IDENTIFIER('secret')) AS e", "TABLE secret",
]


@pytest.fixture
def secret(spark):
    spark.createDataFrame([("a@b.c",)], "user_email string").createOrReplaceTempView("secret")
    spark.udf.register("shout", lambda x: x)
    yield
    spark.catalog.dropTempView("secret")
    spark.sql("DROP TEMPORARY FUNCTION shout")


@pytest.mark.parametrize("sql", HIDDEN)
def test_names_made_at_run_time_and_foreign_functions_are_refused(spark, tables, secret, sql):
    from paylake.sources import catalog

    for ask in (lambda: guard.run(spark, sql, tables), lambda: catalog.query(spark, sql), lambda: catalog.command(spark, sql),
                lambda: catalog.command(spark, f"EXPLAIN {sql}"), lambda: catalog.command(spark, f"DESCRIBE {sql}")):
        with pytest.raises(guard.UnsafeSQL):
            ask()


@pytest.mark.parametrize("sql", [
    "SHOW FUNCTIONS", "SHOW TABLES IN default", "DESCRIBE secret", "DESCRIBE EXTENDED secret", "DESC FUNCTION upper", "SHOW VIEWS",
    "EXPLAIN SELECT * FROM secret", "EXPLAIN SELECT * FROM parquet.`/tmp/x`", "SHOW CREATE TABLE secret", "DESCRIBE parquet.`/tmp/x`"])
def test_commands_answer_for_stored_tables_only(spark, secret, sql):
    from paylake.sources import catalog

    with pytest.raises(guard.UnsafeSQL):
        catalog.command(spark, sql)


def test_commands_on_a_stored_table(spark, secret):
    from paylake.sources import catalog

    catalog.publish_table(spark.sql("SELECT 'a@b.c' AS user_email, 1 AS n"), "told_people")
    try:
        names = [r.tableName for r in catalog.command(spark, "show tables").collect()]
        assert "told_people" in names and "secret" not in names
        described = [tuple(r) for r in catalog.command(spark, "DESCRIBE TABLE told_people").collect()]
        assert described == [("user_email", "string"), ("n", "int")]
        assert "told_people" in catalog.command(spark, "EXPLAIN SELECT n FROM told_people").first().plan
        answer = catalog.ask(spark, "SELECT n, user_email AS e FROM told_people", max_rows=1)
        assert answer.personal == ["user_email"] and not answer.cut and [tuple(r) for r in answer.rows.collect()] == [(1, None)]
        spark.range(1).createOrReplaceTempView("told_people")        # a view of that name hides nothing and shows nothing
        assert catalog.query(spark, "SELECT n FROM told_people").first().n == 1
    finally:
        spark.catalog.dropTempView("told_people")
        spark.sql("DROP TABLE told_people")


@pytest.mark.parametrize("sql,expected", [
    ("SELECT user_id, upper(user_email) AS x, total * 2 AS y FROM gold_user_360", {"user_id": {"user_id"}, "x": {"user_email"}, "y": {"total"}}),
    ("SELECT * FROM gold_user_360", {c: {c} for c in ("user_id", "total")} | {c: {c} for c in ("user_name", "user_email", "user_age")}),
    ("SELECT total AS a FROM gold_user_360 UNION ALL SELECT user_age FROM gold_user_360", {"a": {"total", "user_age"}}),
    ("WITH x AS (SELECT user_name AS n, total FROM gold_user_360), y AS (SELECT concat(n, '!') AS m FROM x) SELECT m AS q, 1 AS one FROM y",
     {"q": {"user_name"}, "one": set()}),
    ("SELECT user_id, (SELECT max(user_age) FROM gold_user_360) AS m FROM gold_user_360", {"user_id": {"user_id"}, "m": {"user_age"}}),
    ("SELECT a.total, b.user_name AS w FROM gold_user_360 a JOIN gold_user_360 b USING (user_id)", {"total": {"total"}, "w": {"user_name"}}),
    ("SELECT user_id, max(user_email) OVER (PARTITION BY user_id ORDER BY total) AS e FROM gold_user_360",
     {"user_id": {"user_id"}, "e": {"user_email", "user_id", "total"}}),
    ("SELECT count(*) AS n, any_value(user_age) AS v FROM gold_user_360 GROUP BY user_id HAVING count(*) > 1 ORDER BY n LIMIT 3",
     {"n": set(), "v": {"user_age"}}),
    ("SELECT c FROM gold_user_360 LATERAL VIEW explode(array(user_name, user_id)) t AS c", {"c": {"user_name", "user_id"}}),
    ("SELECT c.x FROM VALUES (1), (2) AS c(x) WHERE c.x IN (SELECT total FROM gold_user_360)", {"x": set()}),
    ("SELECT user_segment FROM (SELECT user_name AS user_segment FROM gold_user_360 EXCEPT SELECT user_id FROM gold_user_360)",
     {"user_segment": {"user_name", "user_id"}}),
])
def test_every_output_is_traced_to_its_columns(spark, tables, sql, expected):
    text = guard.check(sql)
    guard.check_relations(spark, text, tables)
    with guard._masked_views(spark, tables):
        found = guard.Resolved(spark.sql(text), tables).columns()
    assert found == expected
    personal = set().union(*expected.values()) & {"user_name", "user_email", "user_age"}
    assert set(guard.run(spark, sql, tables).personal) >= personal


def test_an_answer_tells_that_it_was_cut(spark, tables):
    answer = guard.run(spark, "SELECT total FROM gold_user_360", tables)
    rows, personal = answer
    assert answer.cut and rows.count() == 100 and personal == []
    assert not guard.run(spark, "SELECT sum(total) AS t FROM gold_user_360", tables).cut
    shown = guard.for_chart(spark.range(51).orderBy("id"))
    assert shown.cut and shown.rows.count() == 50 and not guard.for_chart(spark.range(50)).cut
