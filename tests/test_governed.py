import pytest
from pyspark.sql import functions as F

from sparkdesk.operators.governed import (
    MSG_ONLY_SELECT,
    AccessContext,
    GovernanceError,
    TenantColumns,
    governed_session,
    run_select,
    text_result,
)
from tests.conftest import SF001

CTX = AccessContext(clients=("BUILDING",), orgs=(1, 2, 3), tables=frozenset({"customer", "orders", "nation", "events"}))
SPECS = {"customer": TenantColumns("c_mktsegment", "c_nationkey"),
         "orders": TenantColumns("o_orderpriority", "o_custkey % 25"), "nation": TenantColumns()}


@pytest.fixture(scope="module")
def session(spark):
    tables = {t: (lambda s, t=t: s.read.parquet(f"{SF001}/{t}.parquet"))
              for t in ("customer", "orders", "nation", "lineitem")}
    return governed_session(spark, tables, SPECS, CTX)


@pytest.mark.parametrize("sql,msg", [
    ("INSERT INTO customer SELECT * FROM customer c", MSG_ONLY_SELECT),
    ("DROP TABLE customer", MSG_ONLY_SELECT),
    ("SHOW TABLES", MSG_ONLY_SELECT),
    ("SELECT * FROM customer", "must have an alias"),
    ("SELECT * FROM lineitem l", "not accessible"),
    ("SELECT * FROM parquet.`/root/testdata/sf0.001/customer.parquet` p", "not accessible"),
    ("SELECT * FROM range(10) r", "not accessible"),
    ("SELECT * FROM spark_catalog.default.customer c", "not accessible"),
    ("SELECT z.a FROM (SELECT TRANSFORM(n.n_name) USING 'echo x' AS (a string) FROM nation n LIMIT 1) z", MSG_ONLY_SELECT),
    ("SELECT reflect('java.lang.System', 'getProperty', 'user.dir') AS a FROM nation n", "not allowed"),
    ("SELECT n.n_name FROM nation n WHERE java_method('java.lang.System', 'getProperty', 'user.dir') > ''", "not allowed"),
    ("SELECT * FROM IDENTIFIER('line' || 'item') l", "not accessible|Only queries"),
    ("SELECT l.* FROM lineitem l WHERE EXISTS (WITH lineitem AS (SELECT 1 AS a) SELECT x.a FROM lineitem x)", "not accessible"),
    ("WITH a AS (SELECT b1.* FROM b b1), b AS (SELECT 1 AS x) SELECT a1.* FROM a a1", "not accessible"),
    ("SELECT * FROM events e", "not accessible"),
])
def test_gates(session, sql, msg):
    with pytest.raises(GovernanceError, match=msg):
        run_select(session, sql, CTX)


def test_missing_tenant_spec_is_an_error(spark):
    with pytest.raises(GovernanceError, match="no tenant specification"):
        governed_session(spark, {"nation": lambda s: s.read.parquet(f"{SF001}/nation.parquet")}, {}, CTX)


def test_org_closure_deep_and_cyclic(spark):
    from sparkdesk.operators import rules

    chain = spark.createDataFrame([(str(k), str(k - 1) if k else None) for k in range(41)], "node string, parent string")
    got = rules.org_closure(spark, chain)
    assert got.where("ancestor = '0'").count() == 41 and got.agg(F.max("level")).first()[0] == 41
    ring = spark.createDataFrame([("a", "b"), ("b", "a")], "node string, parent string")
    assert sorted(map(tuple, rules.org_closure(spark, ring).collect())) == [("a", "a", 1), ("a", "b", 2), ("b", "a", 2), ("b", "b", 1)]


def _only_tenant(rows, seg_idx=None):
    return all(r["c_mktsegment"] == "BUILDING" and r["c_nationkey"] in (1, 2, 3) for r in rows)


def test_no_leak_through_or(session):
    rows = run_select(session, "SELECT c.* FROM customer c WHERE c.c_acctbal > 0 OR c.c_nationkey = 7", CTX).collect()
    assert rows and _only_tenant(rows)


def test_no_leak_through_subquery_cte_union(session):
    sql = """WITH x AS (SELECT o.o_custkey FROM orders o)
             SELECT c.* FROM customer c WHERE c.c_custkey IN (SELECT x1.o_custkey FROM x x1)
             UNION SELECT c2.* FROM customer c2 WHERE c2.c_acctbal < 0"""
    assert _only_tenant(run_select(session, sql, CTX).collect())
    keys = {r.o_custkey for r in run_select(session, "SELECT o.o_custkey FROM orders o", CTX).collect()}
    assert all(k % 25 in (1, 2, 3) for k in keys)


def test_outer_join_keeps_unmatched(session, spark):
    res = run_select(session, "SELECT c.c_custkey, o.o_orderkey FROM customer c LEFT JOIN orders o "
                              "ON o.o_custkey = c.c_custkey", CTX)
    n_cust = run_select(session, "SELECT c.c_custkey FROM customer c", CTX).count()
    assert res.select("c_custkey").distinct().count() == n_cust


def test_views_do_not_leak_between_sessions(session, spark):
    assert "customer" not in [t.name for t in spark.catalog.listTables()]


def test_text_result_duplicate_names(session):
    df = run_select(session, "SELECT c.c_name AS name, n.n_name AS name, c.c_acctbal FROM customer c "
                             "JOIN nation n ON c.c_nationkey = n.n_nationkey", CTX)
    t = text_result(df)
    assert t.columns == ["name", "name_1", "c_acctbal"]
    assert all(f.dataType.simpleString() == "string" for f in t.schema.fields)


def test_filter_pushed_to_scan(session):
    df = run_select(session, "SELECT c.c_name FROM customer c", CTX)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "c_mktsegment" in plan


def test_rules_with_columns_present(spark):
    from sparkdesk.operators import rules

    df = spark.createDataFrame([(1, "Y", "Y", "CO"), (2, "N", "Y", "CO"), (3, "Y", "N", "DR")],
                               "id int, isactive string, issotrx string, docstatus string")
    assert [r.id for r in rules.active_only(df).collect()] == [1, 3]
    assert [r.id for r in rules.active_only(df, include_inactive=True).collect()] == [1, 2, 3]
    assert [r.id for r in rules.sales_split(df, sales=False).collect()] == [3]
    assert [r.id for r in rules.docstatus_filter(df).collect()] == [1, 2]
    assert [r.id for r in rules.docstatus_filter(df, statuses=None).collect()] == [1, 2, 3]
    names = df.select(rules.docstatus_name(F.col("docstatus")).alias("n")).collect()
    assert [r.n for r in names] == ["Completed", "Completed", "Drafted"]


def test_org_included(spark):
    from sparkdesk.operators import rules

    tree = spark.createDataFrame([("0", None), ("R1", "0"), ("N1", "R1"), ("N2", "R1"), ("R2", "0")],
                                 "node string, parent string")
    closure = rules.org_closure(spark, tree)
    pairs = spark.createDataFrame([("N1", "0"), ("N1", "R1"), ("N1", "N1"), ("N1", "R2")], "child string, parent string")
    got = {(r.child, r.parent): r.level for r in rules.org_included(pairs, closure).collect()}
    assert got == {("N1", "0"): 3, ("N1", "R1"): 2, ("N1", "N1"): 1, ("N1", "R2"): -1}


def test_relaxed_search_stages(spark):
    from sparkdesk.operators import rules

    ent = spark.createDataFrame([(1, "White T-Shirt"), (2, "Black shirt"), (3, "White cap")], "id int, name string")
    terms = spark.createDataFrame([("a", "white t-shirt"), ("b", "Wite T-Shirt"), ("c", "zz")], "term_id string, term string")
    got = sorted((r.term_id, r.id, r.stage) for r in rules.relaxed_search(ent, "id", "name", terms).collect())
    assert got == [("a", 1, 1), ("b", 1, 2)]


def test_rows_as_json(session):
    from sparkdesk.operators.governed import rows_as_json

    df = run_select(session, "SELECT n.n_nationkey, n.n_name FROM nation n WHERE n.n_nationkey < 2", CTX)
    rows = sorted(r.row for r in rows_as_json(df).collect())
    assert rows == ['["0","NATION_0"]', '["1","NATION_1"]']
