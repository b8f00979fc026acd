"""A guard for written queries, on the plan that Spark makes of them: nothing is decided by looking at the text.

A query may only read tables, not files by their path, and call no code by its name; a recursion needs a bound of its levels; a join needs a condition that
compares its sides, unless a side is one row; and the result needs a limit or must be an aggregate,
else it gets the default limit.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

DEFAULT_LIMIT = 300
#: Parts of parsed plans that only read.
READS = {
    "Project", "Filter", "UnresolvedHaving", "Aggregate", "Join", "LateralJoin", "AsOfJoin", "Sort", "GlobalLimit", "LocalLimit", "Offset", "Tail", "Distinct", "Deduplicate", "Union", "Intersect", "Except",
    "SubqueryAlias", "UnresolvedSubqueryColumnAliases", "UnresolvedWith", "UnresolvedRelation", "UnresolvedInlineTable", "UnresolvedTableValuedFunction", "UnresolvedTVFAliases", "OneRowRelation", "LocalRelation", "Range",
    "Generate", "Window", "WithWindowDefinition", "Pivot", "Unpivot", "Sample", "UnresolvedHint", "RepartitionByExpression", "Repartition", "UnresolvedOrdinal",
}

#: Functions that call any code; formats that a path may follow.
CALLS = {"reflect", "java_method", "try_reflect"}
FORMATS = {"parquet", "csv", "json", "orc", "text", "avro", "xml", "binaryfile"}


class Refused(ValueError):
    """Why a query isn't run."""


def _kind(plan) -> str:
    return plan.getClass().getSimpleName().rstrip("$")


def _each(items) -> Iterator:
    it = items.iterator()
    while it.hasNext():
        yield it.next()


def _tree(plan, inner: bool = True) -> Iterator:
    """The plan and all below it; with inner, also the plans of subqueries and of WITH."""
    yield plan
    for x in _each(plan.children()):
        yield from _tree(x, inner)
    if inner:
        for x in _each(plan.innerChildren()):
            if hasattr(x, "children") and "plans.logical" in x.getClass().getName():
                yield from _tree(x)
        for top in _each(plan.expressions()):
            for e in _parts(top):
                if "Subquery" in _kind(e) or _kind(e) in ("Exists", "ListQuery"):
                    yield from _tree(e.plan())


def _parts(expression) -> Iterator:
    yield expression
    for e in _each(expression.children()):
        yield from _parts(e)


def _one_row(plan) -> bool:
    """Whether the plan can give one row at most."""
    most = plan.maxRows()
    return most.isDefined() and most.get() <= 1


def checked(spark: SparkSession, sql: str, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The query's result, not run yet; raises ``Refused`` with the reason."""
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as e:
        raise Refused("the query can't be read") from e
    for node in _tree(parsed):
        kind = _kind(node)
        if kind not in READS:
            raise Refused(f"only reading statements are allowed, not {kind}")
        if kind == "UnresolvedRelation" and _names(node).split(".")[0] in FORMATS:
            raise Refused("files can't be named by their path")
        called = {e.nameParts().mkString(".").lower() for top in _each(node.expressions()) for e in _parts(top) if _kind(e) == "UnresolvedFunction"}
        if called & CALLS:
            raise Refused("a function that calls other code")
        if kind == "UnresolvedWith" and node.allowRecursion():
            for relation in _each(node.cteRelations()):
                level = relation._3()
                if not level.isDefined() and any(_kind(n) == "UnresolvedRelation" and _names(n) == relation._1().lower() for n in _tree(relation._2())):
                    raise Refused("a recursion needs MAX RECURSION LEVEL")
    out = spark.sql(sql)
    for node in _tree(out._jdf.queryExecution().optimizedPlan()):
        if _kind(node) == "Join" and node.condition().isEmpty() and not any(_one_row(side) for side in _each(node.children())):
            raise Refused("a join has no condition")
    return out if _bounded(out._jdf.queryExecution().analyzed()) else out.limit(limit)


def _names(relation) -> str:
    return ".".join(_each(relation.multipartIdentifier())).lower()


def _bounded(plan) -> bool:
    """Whether the result as a whole is limited or aggregated: what stands above may sort, filter or rename only."""
    while True:
        kind = _kind(plan)
        if kind in ("GlobalLimit", "Aggregate"):
            return True
        if kind not in ("Project", "Filter", "Sort", "SubqueryAlias", "WithCTE", "Offset"):
            return False
        plan = plan.plan() if kind == "WithCTE" else plan.children().apply(0)
