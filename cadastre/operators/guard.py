"""Ad-hoc statements: one read-only SELECT over given tables, nothing else.

What a statement may do is told by its parsed plan: every operator, relation and function in it, in subqueries and
common table expressions too, must be one that is allowed. What is not known to be harmless is refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

MOST_CHARACTERS = 20_000
#: Operators of a parsed query that only compute. Files, table functions, scripts and identifiers from expressions are none of them.
OPERATORS = frozenset(
    "Aggregate BaseGroupingSets Distinct Except Filter Generate GlobalLimit Intersect Join LateralJoin LocalLimit LocalRelation Offset OneRowRelation Pivot Project Sort SubqueryAlias Tail "
    "Union UnresolvedHaving UnresolvedInlineTable UnresolvedRelation UnresolvedSubqueryColumnAliases UnresolvedWith Unpivot UnpivotTransformer WithWindowDefinition".split()
)
#: Groups of Spark's built-in functions that compute from their arguments alone. The group ``misc_funcs`` also calls Java methods and tells about files.
GROUPS = frozenset(
    "agg_funcs array_funcs bitwise_funcs collection_funcs conditional_funcs conversion_funcs csv_funcs date_funcs generator_funcs hash_funcs json_funcs lambda_funcs map_funcs math_funcs "
    "predicate_funcs string_funcs struct_funcs url_funcs window_funcs".split()
)


def read_only(statement: str) -> str:
    """The statement without its last semicolon, or an error saying what is wrong with it at first sight."""
    plain = re.sub(r"\s*;\s*\Z", "", statement.strip())
    if not plain:
        raise ValueError("empty statement")
    if len(plain) > MOST_CHARACTERS:
        raise ValueError("statement too long")
    if not re.match(r"(select|with)\b", plain, re.IGNORECASE):
        raise ValueError("only a single SELECT (or WITH ... SELECT) statement is allowed")
    return plain


def items(seq: JavaObject) -> Iterator[JavaObject]:
    for k in range(seq.size()):
        yield seq.apply(k)


def kind(node: JavaObject) -> str:
    return node.getClass().getSimpleName()


class Walk:
    """One pass over a parsed plan that raises at the first thing that is not allowed."""

    def __init__(self, spark: SparkSession, tables: set[str]):
        self.catalyst = spark._jvm.org.apache.spark.sql.catalyst
        self.builtin, self.session = self.catalyst.analysis.FunctionRegistry.builtin(), spark._jsparkSession.sessionState().functionRegistry()
        self.tables = {t.lower() for t in tables}

    def function(self, parts: list[str]) -> None:
        name = ".".join(parts)
        found = self.builtin.lookupFunction(self.catalyst.FunctionIdentifier(name)) if len(parts) == 1 else None
        if found is None or found.isEmpty() or found.get().getGroup() not in GROUPS:
            raise ValueError(f"the function {name} is not allowed")
        own = self.session.lookupFunction(self.catalyst.FunctionIdentifier(name))
        if own.isEmpty() or own.get().getClassName() != found.get().getClassName():
            raise ValueError(f"the function {name} is not Spark's own")

    def expression(self, node: JavaObject) -> None:
        what = kind(node)
        if what == "UnresolvedFunction":
            self.function(list(items(node.nameParts())))
        elif what == "UnresolvedGenerator":
            self.function([node.name().funcName()])
        elif "UnresolvedIdentifier" in what or "Reflect" in what:
            raise ValueError(f"{what} is not allowed")
        for child in items(node.children()):
            self.expression(child)

    def plan(self, node: JavaObject, known: frozenset[str] = frozenset()) -> None:
        """``known``: names of the common table expressions around ``node``."""
        what = kind(node)
        if what not in OPERATORS:
            raise ValueError(f"only a query over the given tables is allowed, not {what}")
        if what == "UnresolvedRelation":
            parts = list(items(node.multipartIdentifier()))
            if len(parts) != 1 or parts[0].lower() not in self.tables | known:
                raise ValueError(f"there is no table {'.'.join(parts)}")
        if what == "UnresolvedWith":
            for pair in items(node.cteRelations()):
                # One expression may read those before it.
                self.plan(pair.productElement(1), known)
                known = known | {pair.productElement(0).lower()}
        else:
            for inner in items(node.innerChildren()):
                self.plan(inner, known)
            own = [*items(node.expressions()), *(items(node.windowDefinitions().values().toSeq()) if what == "WithWindowDefinition" else ())]
            for e in own:
                self.expression(e)
        for child in items(node.children()):
            self.plan(child, known)


def checked(spark: SparkSession, statement: str, tables: set[str]) -> str:
    """The statement, if it is one query whose every part is allowed."""
    plain = read_only(statement)
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(plain)
    except (ParseException, Py4JJavaError) as e:
        raise ValueError(f"not one statement: {str(e).splitlines()[0]}") from None
    Walk(spark, tables).plan(parsed)
    return plain


def run_select(spark: SparkSession, statement: str, tables: dict[str, DataFrame], limit: int = 1000) -> DataFrame:
    """Run a guarded statement over the given tables. They are views only while it is analysed; views of the same names come back."""
    plain = checked(spark, statement, set(tables))
    hidden = {n: spark.table(n) for n in tables if any(t.isTemporary and t.name == n for t in spark.catalog.listTables(pattern=n))}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(plain).limit(min(max(limit, 1), 1000))
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        for name, df in hidden.items():
            df.createOrReplaceTempView(name)
