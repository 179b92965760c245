"""Read-only SQL over Gold: checked text, masked personal data, capped rows."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from paylake import fixed_values as fv

# Functions that call code of the class path.
UNSAFE_WORDS = ("reflect", "java_method", "try_reflect")
# What a query may consist of before Spark resolves it. IDENTIFIER, table functions, files and programs are not in it.
_PARSED = frozenset("""UnresolvedRelation UnresolvedAttribute UnresolvedAlias UnresolvedStar UnresolvedFunction UnresolvedHaving
    UnresolvedOrdinal UnresolvedWith UnresolvedSubqueryColumnAliases UnresolvedInlineTable UnresolvedExtractValue
    UnresolvedNamedLambdaVariable UnresolvedGenerator NamedRelation GroupByAll""".split())
_STEPS = frozenset("""Project Filter Aggregate Sort GlobalLimit LocalLimit Offset Distinct Deduplicate Join Union Intersect Except
    SubqueryAlias OneRowRelation LocalRelation Window WithWindowDefinition Pivot Unpivot Expand Generate LateralJoin
    PipeOperator WithCTE CTERelationDef CTERelationRef View""".split())
# Expressions that run foreign code.
_FOREIGN = frozenset("""CallMethodViaReflection TryReflect ScalaUDF PythonUDF PythonUDAF PythonUDTF ScalaUDAF ScalaAggregator
    HiveSimpleUDF HiveGenericUDF HiveUDAFFunction HiveGenericUDTF PythonFuncExpression""".split())
_LEAVES = frozenset("OneRowRelation LocalRelation CTERelationRef".split())
_SUBQUERIES = frozenset("ScalarSubquery Exists ListQuery LateralSubquery".split())
_EXPRESSIONS = "org.apache.spark.sql.catalyst.expressions."


class UnsafeSQL(ValueError):
    """The text is not a single read-only query."""


def check(
    sql: str, forbidden: tuple[str, ...] = fv.FORBIDDEN_SQL_WORDS, starts: tuple[str, ...] = fv.QUERY_STARTS
) -> str:
    """The text without a trailing semicolon, or UnsafeSQL: no comment, no forbidden word, one query."""
    found = re.search(r"\b(" + "|".join(forbidden) + r")\b|--|/\*", sql, re.IGNORECASE)
    if found:
        raise UnsafeSQL(f"forbidden in a query: {found.group(0)}")
    text = sql.strip().rstrip(";")
    if ";" in text:
        raise UnsafeSQL("only one statement is allowed")
    if not re.match(r"\(*\s*(" + "|".join(starts) + r")\b", text, re.IGNORECASE):
        raise UnsafeSQL(f"a query starts with one of {', '.join(starts)}")
    return text


def _nodes(tree) -> Iterator[dict]:
    """Every plan node and expression of a plan as Spark writes it in JSON, subqueries included."""
    if isinstance(tree, dict):
        if "class" in tree:
            yield tree
        tree = list(tree.values())
    if isinstance(tree, list):
        for part in tree:
            yield from _nodes(part)


def _parts(text: str) -> tuple[str, ...]:
    return tuple(p.strip().lower() for p in text.strip("[]").split(","))


def _allowed_class(name: str, unresolved: frozenset[str]) -> bool:
    short = name.rsplit(".", 1)[-1].rstrip("$")
    if name.startswith(_EXPRESSIONS):
        return short not in _FOREIGN
    return short in _STEPS or short in unresolved


def _parsed(spark: SparkSession, text: str) -> list[dict]:
    """The nodes of a query by Spark's own parser, all of them of kinds that a query may have."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Py4JJavaError as error:
        raise UnsafeSQL("not a query that Spark can read") from error
    nodes = list(_nodes(json.loads(plan.toJSON())))
    for node in nodes:
        if not _allowed_class(node["class"], _PARSED):
            raise UnsafeSQL(f"not allowed in a query: {node['class'].rsplit('.', 1)[-1]}")
    return nodes


def _system_functions(spark: SparkSession) -> set[str]:
    return {row[0].lower() for row in spark.sql("SHOW SYSTEM FUNCTIONS").collect()}


def check_relations(spark: SparkSession, text: str, allowed: Iterable[str]) -> None:
    """A query reads the allowed names and what it defines itself, and calls Spark's own functions: no files, no other tables,
    no programs, no names made at run time."""
    if re.search(r"\b(" + "|".join(UNSAFE_WORDS) + r")\b", text, re.IGNORECASE):
        raise UnsafeSQL("a query calls no code by name")
    nodes, known = _parsed(spark, text), {a.lower() for a in allowed}
    kinds = lambda name: [n for n in nodes if n["class"].endswith("." + name)]
    calls = {_parts(n["nameParts"]) for n in kinds("UnresolvedFunction") if isinstance(n["nameParts"], str)}
    foreign = {".".join(c) for c in calls if len(c) > 1} | ({c[0] for c in calls} - _system_functions(spark) if calls else set())
    if foreign:
        raise UnsafeSQL(f"not a function of a query: {', '.join(sorted(foreign))}")
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    defined = {n.strip().lower() for m in re.findall(r"(?:CTE|UnresolvedWith) \[([^\]]*)\]", plan) for n in m.split(",")}
    named = {_parts(n["multipartIdentifier"]) for n in kinds("UnresolvedRelation")}
    for parts in named:
        if len(parts) > 1 or parts[0] not in known | defined:
            raise UnsafeSQL(f"not a table of this query: {'.'.join(parts)}")
    for name in defined - known:  # a definition holds only in its own part of the text
        if (name,) in named and spark.catalog.tableExists(name):
            raise UnsafeSQL(f"a definition hides a table: {name}")


def _seq(found) -> list:
    return [found.apply(i) for i in range(found.size())]


def _kind(node) -> str:
    return node.getClass().getName()


class Resolved:
    """A query as Spark resolved it: only allowed steps over the given views, and where each column comes from."""

    def __init__(self, df: DataFrame, views: Iterable[str]):
        self.views = {v.lower() for v in views}
        self.after: dict[int, set[int]] = {}      # column id: the columns it is made of
        self.source: dict[int, str] = {}          # column id: the view's column it is
        self.defined: dict[int, list[int]] = {}   # WITH definition: its columns
        plan = df._jdf.queryExecution().analyzed()
        self._step(plan)
        self.outputs = [(a.name(), a.exprId().id()) for a in _seq(plan.output())]

    def _step(self, node) -> list[int]:
        """The ids of a node's columns."""
        kind = _kind(node)
        short = kind.rsplit(".", 1)[-1].rstrip("$")
        out = [(a.exprId().id(), a.name()) for a in _seq(node.output())] if short != "WithCTE" else []
        ids = [i for i, _ in out]
        if short == "View":
            name = node.desc().identifier().table().lower()
            if name not in self.views:
                raise UnsafeSQL(f"not a table of this query: {name}")
            self.source |= {i: column.lower() for i, column in out}
            return ids
        children = _seq(node.children())
        if short not in _STEPS or (not children and short not in _LEAVES):
            raise UnsafeSQL(f"not allowed in a query: {short}")
        below = [self._step(child) for child in children]
        if short == "WithCTE":
            return below[-1]
        if short == "CTERelationDef":
            self.defined[node.id()] = below[0]
        sets = below if short in ("Union", "Intersect", "Except") else []
        if short == "CTERelationRef":
            sets = [self.defined.get(node.cteId(), [])]
        for columns in sets:
            for mine, other in zip(ids, columns):
                if mine != other:
                    self.after.setdefault(mine, set()).add(other)
        used: set[int] = set()
        for expression in _seq(node.expressions()):
            used |= self._made(expression)
        known = set().union(*below) | self.after.keys() | self.source.keys()
        for i in ids:   # columns that a step makes without naming an expression for each
            if i not in known:
                self.after[i] = used if short == "Generate" else used | set().union(*below)
        return ids

    def _made(self, expression) -> set[int]:
        """Ids of the columns an expression uses; notes what named expressions are made of."""
        kind = _kind(expression)
        short = kind.rsplit(".", 1)[-1].rstrip("$")
        if not kind.startswith(_EXPRESSIONS) or short in _FOREIGN:
            raise UnsafeSQL(f"not allowed in a query: {short}")
        if short == "AttributeReference":
            return {expression.exprId().id()}
        used: set[int] = set(self._step(expression.plan())) if short in _SUBQUERIES else set()
        if short == "OuterReference":
            used |= self._made(expression.e())
        for child in _seq(expression.children()):
            used |= self._made(child)
        if short == "Alias":
            self.after.setdefault(expression.exprId().id(), set()).update(used)
            return {expression.exprId().id()}
        return used

    def columns(self) -> dict[str, set[str]]:
        """For each output column the columns of the given tables it is made of."""
        out = {}
        for name, start in self.outputs:
            seen, todo = set(), [start]
            while todo:
                i = todo.pop()
                if i not in seen:
                    seen.add(i)
                    todo += self.after.get(i, ())
            out.setdefault(name, set()).update(self.source[i] for i in seen if i in self.source)
        return out


@contextmanager
def _masked_views(spark: SparkSession, tables: dict[str, DataFrame]) -> Iterator[None]:
    """The tables under their names with personal columns masked; the session's own views come back afterwards."""
    own = {name: spark.table(name) for name in tables if any(
        t.isTemporary and t.name.lower() == name.lower() for t in spark.catalog.listTables())}
    masked = {name: mask_pii(df) for name, df in tables.items()}
    try:
        for name, df in masked.items():
            df.createOrReplaceTempView(name)
        yield
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        for name, df in own.items():
            df.createOrReplaceTempView(name)


def pii_mentioned(sql: str, pii: tuple[str, ...] = fv.PII_COLUMNS) -> list[str]:
    """Personal columns named in the text."""
    return [c for c in pii if re.search(rf"\b{c}\b", sql, re.IGNORECASE)]


def drop_pii(df: DataFrame, pii: tuple[str, ...] = fv.PII_COLUMNS) -> DataFrame:
    return df.drop(*(c for c in df.columns if c.lower() in pii))


def mask_pii(df: DataFrame, pii: tuple[str, ...] = fv.PII_COLUMNS) -> DataFrame:
    """Personal columns keep name and type but hold nulls, so an alias cannot carry them out."""
    return df.withColumns({
        f.name: F.lit(None).cast(f.dataType) for f in df.schema.fields if f.name.lower() in pii
    })


@dataclass
class Answer:
    """Rows of a query, the personal columns it names or uses, and whether rows were left out.

    ``rows, personal = answer`` works as well.
    """

    rows: DataFrame
    personal: list[str]
    whole: DataFrame
    max_rows: int

    @property
    def cut(self) -> bool:
        return self.whole.limit(self.max_rows + 1).count() > self.max_rows

    def __iter__(self):
        return iter((self.rows, self.personal))

    def __getitem__(self, i: int):
        return (self.rows, self.personal)[i]


def capped(df: DataFrame, max_rows: int, personal: Iterable[str] = ()) -> Answer:
    return Answer(df.limit(max_rows), list(personal), df, max_rows)


def for_chart(df: DataFrame, max_rows: int = fv.CHART_ROW_CAP) -> Answer:
    """The rows of a dataset that a chart shows, in the dataset's order, and whether there are more."""
    return capped(df, max_rows)


def resolved(
    spark: SparkSession, sql: str, tables: dict[str, DataFrame], forbidden: tuple[str, ...] = fv.FORBIDDEN_SQL_WORDS
) -> tuple[DataFrame, list[str]]:
    """All rows of a checked query over masked tables, and the personal columns it names or its columns are made of. Spark
    resolves a query at once, so the views need not stay."""
    text = check(sql, forbidden)
    check_relations(spark, text, tables)
    with _masked_views(spark, tables):
        df = spark.sql(text)
        used = set().union(*Resolved(df, tables).columns().values())
        named = set(pii_mentioned(sql))
        return drop_pii(df), [c for c in fv.PII_COLUMNS if c in used | named]


def answer(
    spark: SparkSession, sql: str, tables: dict[str, DataFrame], forbidden: tuple[str, ...] = fv.FORBIDDEN_SQL_WORDS
) -> DataFrame:
    return resolved(spark, sql, tables, forbidden)[0]


def run(spark: SparkSession, sql: str, tables: dict[str, DataFrame], max_rows: int = fv.SQL_ROW_CAP) -> Answer:
    """Result without personal columns and at most ``max_rows`` rows, with the personal columns it uses; the answer says
    whether it was cut."""
    df, personal = resolved(spark, sql, tables)
    return capped(df, max_rows, personal)


def is_cut(spark: SparkSession, sql: str, tables: dict[str, DataFrame], max_rows: int = fv.SQL_ROW_CAP) -> bool:
    """Whether ``run`` leaves rows of the answer out."""
    return run(spark, sql, tables, max_rows).cut
