"""The gate in front of free SQL: one read-only statement over allowed tables and columns, bounded in size and rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Bounds of a statement and of an answer.
MAX_CHARS, MAX_ROWS, MAX_OFFSET = 32_000, 100, 10_000
#: Plan nodes that a read-only statement without nested queries has.
ALLOWED_NODES = {"Project", "Filter", "Join", "Aggregate", "Sort", "Distinct", "GlobalLimit", "LocalLimit", "Offset", "SubqueryAlias", "UnresolvedRelation", "Union", "OneRowRelation", "UnresolvedHaving"}


#: Functions that a statement may call.
FUNCTIONS = set("count sum avg min max lower upper trim coalesce year month day abs round length substring concat contains startswith endswith greatest least".split())


class Refused(ValueError):
    pass


def check(spark: SparkSession, text: str, tables: dict[str, set[str]]) -> set[str]:
    """The tables that the statement reads, or ``Refused``.

    The statement is parsed, not matched: its plan may only have nodes of a flat SELECT over ``tables``
    (name -> columns), so commands, writes, table functions and nested queries are refused, whatever
    they look like as text.
    """
    if len(text) > MAX_CHARS:
        raise Refused(f"longer than {MAX_CHARS} characters")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception as e:
        raise Refused("not one statement") from e
    seen: set[str] = set()
    todo = [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName().lstrip("'")
        if name not in ALLOWED_NODES:
            raise Refused(f"{name} is not allowed")
        if name == "UnresolvedRelation":
            table = node.tableName()
            if table not in tables:
                raise Refused(f"table {table} is not allowed")
            seen.add(table)
        if name in ("GlobalLimit", "LocalLimit", "Offset"):
            expr = node.offsetExpr() if name == "Offset" else node.limitExpr()
            bound = MAX_OFFSET if name == "Offset" else MAX_ROWS
            if not re.fullmatch(r"\d+", expr.toString()) or int(expr.toString()) > bound:
                raise Refused(f"{name} above {bound}")
        text_of = node.expressions().toString()
        if re.search(r"scalar-?subquery|exists#|list#|in-?subquery", text_of, re.I):
            raise Refused("nested queries are not allowed")
        if unknown := set(re.findall(r"'(\w+)\(", text_of.lower())) - FUNCTIONS:
            raise Refused(f"functions {sorted(unknown)} are not allowed")
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return seen


def run(spark: SparkSession, text: str, tables: dict[str, set[str]], frames: dict[str, DataFrame], name: str = "gate") -> list[tuple]:
    """At most ``MAX_ROWS`` rows of a checked statement, complete or ``Refused``; it sees only the allowed columns."""
    for t in check(spark, text, tables):
        frames[t].select(*sorted(tables[t])).createOrReplaceTempView(t)
    rows = spark.sql(text).limit(MAX_ROWS + 1).collect()
    if len(rows) > MAX_ROWS:
        raise Refused(f"more than {MAX_ROWS} rows: not a complete answer")
    return [tuple(r) for r in rows]
