"""Governed SELECT (A1-A5): per-table access, per-row tenant filters, text result.

Design: every accessible table is registered as a *filtered* temp view in a fresh
``spark.newSession()`` (so one access context never sees another's views), then the
user's text runs through ``spark.sql``. The tenant predicate is an ordinary Filter node
under the view, so Catalyst pushes it into the Parquet scan, it applies inside derived
tables, subqueries, CTE bodies and on every join input, and an outer join keeps its
unmatched rows. No SQL text is rewritten.

Before running, the text is parsed with Spark's own parser and rejected unless it is a
query made of listed nodes whose relations are all registered views (or CTE names in scope) and each carries an alias.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The error messages a caller sees, as the reference words them.
MSG_ONLY_SELECT = "Only queries of type 'SELECT' are allowed."
MSG_TABLE_WITHOUT_ALIAS = "The table %s must have an alias."
MSG_TABLE_NOT_ACCESSIBLE = "The table %s is not accessible by this user."

# Above this many ids an IN-list becomes a broadcast semi-join (size of the list is known).
ISIN_LIMIT = 1000

# Root nodes of a parsed plan that are plain queries.
_QUERY_ROOTS = {
    "Project", "Aggregate", "Sort", "Distinct", "Union", "Intersect", "Except", "GlobalLimit",
    "LocalLimit", "Offset", "Filter", "UnresolvedWith", "WithCTE", "Window", "Join", "SubqueryAlias",
    "UnresolvedHaving", "Deduplicate", "Generate", "Tail", "WithWindowDefinition", "Pivot",
    "UnresolvedInlineTable", "LateralJoin",
}


class GovernanceError(ValueError):
    pass


@dataclass(frozen=True)
class TenantColumns:
    """Where a table keeps its tenant: SQL expressions for client and org (None = not present)."""

    client: str | None = None
    org: str | None = None


@dataclass(frozen=True)
class AccessContext:
    clients: tuple = ()
    orgs: tuple = ()
    tables: frozenset = field(default_factory=frozenset)  # accessible table names (lower case)

    def can_read(self, name: str) -> bool:
        return name.lower() in self.tables


def _member(df: DataFrame, expr: Column, values: tuple, label: str) -> DataFrame:
    if len(values) <= ISIN_LIMIT:
        return df.filter(expr.isin(list(values)))
    spark = df.sparkSession
    ids = spark.createDataFrame([(v,) for v in values], [label])
    key = f"__{label}"
    out = df.withColumn(key, expr).join(F.broadcast(ids).withColumnRenamed(label, key), key, "left_semi")
    return out.drop(key)


def tenant_filter(df: DataFrame, spec: TenantColumns, ctx: AccessContext) -> DataFrame:
    """Client filter only if the table has a client, org filter only if it has an org."""
    if spec.client is not None:
        df = _member(df, F.expr(spec.client), tuple(ctx.clients), "client_id")
    if spec.org is not None:
        df = _member(df, F.expr(spec.org), tuple(ctx.orgs), "org_id")
    return df


def governed_session(spark: SparkSession, tables: dict, specs: dict, ctx: AccessContext) -> SparkSession:
    """New session holding one filtered temp view per accessible table; nothing else is reachable.

    Every accessible table needs an entry in ``specs``; ``TenantColumns()`` says that it has no tenant.
    ``tables`` maps a name to a loader ``session -> DataFrame`` (a view belongs to the session
    that made its DataFrame, so the loader runs in the new session).
    """
    session = spark.newSession()
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    for name, load in tables.items():
        if ctx.can_read(name):
            if name not in specs:
                raise GovernanceError(f"The table {name} has no tenant specification.")
            tenant_filter(load(session), specs[name], ctx).createOrReplaceTempView(name)
    return session


# Nodes a user's query may consist of; anything else (script transforms, commands, identifier clauses,
# table functions, inline sources of other kinds) is refused.
_QUERY_NODES = _QUERY_ROOTS | {"UnresolvedRelation", "UnresolvedSubqueryColumnAliases", "OneRowRelation", "WindowExpression", "WithWindowDefinition",
                               "UnresolvedHint", "Sample", "Expand", "Aggregate", "LocalRelation"} - {"Tail"}
# Functions that run code of their own choosing, and identifiers made from expressions.
_REFUSED_FUNCTIONS = {"reflect", "java_method", "try_reflect"}
_REFUSED_EXPRESSIONS = {"ExpressionWithUnresolvedIdentifier", "CallMethodViaReflection"}


def _items(seq):
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


def _check_expression(e) -> None:
    name = e.getClass().getSimpleName()
    if name in _REFUSED_EXPRESSIONS:
        raise GovernanceError(MSG_TABLE_NOT_ACCESSIBLE % "identifier expression")
    if name == "UnresolvedFunction":
        called = ".".join(str(x) for x in _items(e.nameParts())).lower()
        if called.rsplit(".", 1)[-1] in _REFUSED_FUNCTIONS:
            raise GovernanceError(f"The function {called} is not allowed.")
    for c in _items(e.children()):
        _check_expression(c)


def _relations(node, parent: str, scope: frozenset):
    """(name parts, aliased?, is a CTE of an enclosing WITH?) of every relation below a parsed node.

    A CTE's name holds for the later CTEs and the body of its own WITH only (for its own body too if the
    WITH is recursive)."""
    name = node.getClass().getSimpleName()
    if name in ("UnresolvedTableValuedFunction", "UnresolvedTVFAliases"):
        raise GovernanceError(MSG_TABLE_NOT_ACCESSIBLE % "table function")
    if name not in _QUERY_NODES:
        raise GovernanceError(MSG_ONLY_SELECT)
    for e in _items(node.expressions()):
        _check_expression(e)
    if name == "UnresolvedRelation":
        parts = tuple(str(x) for x in _items(node.multipartIdentifier()))
        yield parts, parent == "SubqueryAlias", len(parts) == 1 and parts[0].lower() in scope
    if name == "UnresolvedWith":
        for pair in _items(node.cteRelations()):
            cte = str(pair._1()).lower()
            yield from _relations(pair._2(), name, scope | {cte} if node.allowRecursion() else scope)
            scope = scope | {cte}
        children = _items(node.children())
    else:
        children = [*_items(node.children()), *_items(node.innerChildren())]
    for child in [*children, *_items(node.subqueries())]:
        yield from _relations(child, name, scope)


def check_select(session: SparkSession, sql: str, ctx: AccessContext) -> None:
    """A1 gates in the reference's order: a query, every table aliased, every table accessible.

    Every node and expression of the parsed text is on a list or refused, and a table must be one of this
    session's own filtered views, not merely a name on the access list."""
    state = session._jsparkSession.sessionState()
    plan = state.sqlParser().parsePlan(sql)
    if plan.getClass().getSimpleName() not in _QUERY_ROOTS:
        raise GovernanceError(MSG_ONLY_SELECT)
    rels = list(_relations(plan, "", frozenset()))
    for parts, aliased, _ in rels:
        if not aliased:
            raise GovernanceError(MSG_TABLE_WITHOUT_ALIAS % ".".join(parts))
    for parts, _, cte in rels:
        name = ".".join(parts).lower()
        if not cte and (len(parts) != 1 or not ctx.can_read(name) or not state.catalog().getTempView(name).isDefined()):
            raise GovernanceError(MSG_TABLE_NOT_ACCESSIBLE % ".".join(parts))


def run_select(session: SparkSession, sql: str, ctx: AccessContext) -> DataFrame:
    """A1: gate, then run over the filtered views. Lazy: nothing runs until an action."""
    if not sql or not sql.strip():
        raise GovernanceError("Missing parameter: Query")
    check_select(session, sql, ctx)
    return session.sql(sql)


def text_result(df: DataFrame) -> DataFrame:
    """A5: every column as nullable text, order kept. Duplicate names are made unique by position."""
    if len(set(c.lower() for c in df.columns)) == len(df.columns):
        return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    return df.toDF(*[f"__c{i}" for i in range(len(df.columns))]).select(
        [F.col(f"__c{i}").cast("string").alias(n) for i, n in enumerate(_unique(df.columns))])


def _unique(names: list) -> list:
    out, seen = [], set()
    for i, n in enumerate(names):
        m = n if n.lower() not in seen else f"{n}_{i}"
        seen.add(m.lower())
        out.append(m)
    return out


def rows_as_json(df: DataFrame) -> DataFrame:
    """A5 single-column form: each row as a JSON array of its text cells (the reference's `data`)."""
    t = text_result(df)
    return t.select(F.to_json(F.array(*[F.col(f"`{c}`") for c in t.columns])).alias("row"))
