"""SQL that can only read, and only what it is given."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

# Functions that run code of their own choice in the JVM.
_FOREIGN = {"reflect", "java_method", "try_reflect"}


# What a parsed query consists of; every command, insert and definition is something else.
_READING = {
    "Aggregate",
    "Distinct",
    "Except",
    "Filter",
    "Generate",
    "GlobalLimit",
    "Intersect",
    "Join",
    "LateralJoin",
    "LocalLimit",
    "LocalRelation",
    "Offset",
    "OneRowRelation",
    "OneRowRelation$",
    "Pivot",
    "Project",
    "ResolvedInlineTable",
    "Sort",
    "SubqueryAlias",
    "Union",
    "UnresolvedHaving",
    "UnresolvedInlineTable",
    "UnresolvedRelation",
    "UnresolvedSubqueryColumnAliases",
    "UnresolvedWith",
    "Unpivot",
    "WithWindowDefinition",
}


class RefusedStatement(ValueError):
    """The statement is no query, or reads what it was not given."""


def _nodes(plan):
    """A parsed plan's nodes, with those of subqueries and of named ones."""
    yield plan
    for group in (plan.children(), plan.innerChildren(), plan.subqueries()):
        for k in range(group.size()):
            if _is_plan(group.apply(k)):
                yield from _nodes(group.apply(k))


def _is_plan(node) -> bool:
    return node.getClass().getName().startswith(
        ("org.apache.spark.sql.catalyst.plans.logical.", "org.apache.spark.sql.catalyst.analysis.")
    )


def check(spark: SparkSession, text: str, given: set[str]) -> None:
    """Raises unless `text` is one query over the relations in `given` and names of its own."""
    parser = spark._jsparkSession.sessionState().sqlParser()
    nodes = list(_nodes(parser.parsePlan(text)))
    own = set()
    for node in nodes:
        kind = node.getClass().getSimpleName()
        if kind == "UnresolvedWith":
            named = node.cteRelations()
            own |= {named.apply(k).productElement(0).lower() for k in range(named.size())}
    for node in nodes:
        kind = node.getClass().getSimpleName()
        if kind not in _READING:
            raise RefusedStatement(f"{kind} is not part of a query")
        if kind == "UnresolvedRelation":
            name = node.tableName()
            if name.strip("`").lower() not in given | own:
                raise RefusedStatement(f"{name} is neither a mart nor a staging view")
        for function in _FOREIGN:
            if f"'{function}(" in node.toString():
                raise RefusedStatement(f"{function} may do more than read")


def _quoted(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool | int | float):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def read_only(
    spark: SparkSession,
    sql: str,
    frames: Mapping[str, Callable[[], DataFrame]],
    values: Mapping[str, object],
) -> DataFrame:
    """The result of a query in which {name} stands for a frame or for a value.

    The statement is parsed before anything runs, and refused unless it is a query over the named frames.
    Frames are views of names nobody else knows while the query is analysed, and gone afterwards.
    """
    used = {name for _, name, _, _ in Formatter().parse(sql) if name}
    unknown = used - set(frames) - set(values)
    if unknown:
        raise RefusedStatement(f"unknown name {sorted(unknown)[0]}")
    views = {name: f"vitrine_{name}_{uuid.uuid4().hex}" for name in used if name in frames}
    text = sql.format(**views, **{n: _quoted(v) for n, v in values.items() if n in used and n not in views})
    check(spark, text, set(views.values()))
    try:
        for name, view in views.items():
            frames[name]().createOrReplaceTempView(view)
        return spark.sql(text)
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)
