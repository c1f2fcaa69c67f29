"""How the driver's tables stand in for the ERP tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.governed import AccessContext, TenantColumns, governed_session
from ..session import table

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

# Tenant columns of the stand-in tables: client and org as SQL expressions.
TENANTS = {
    "customer": TenantColumns(client="c_mktsegment", org="c_nationkey"),
    "supplier": TenantColumns(org="s_nationkey"),
    "orders": TenantColumns(client="o_orderpriority", org="o_custkey % 25"),
    **{name: TenantColumns() for name in ("nation", "region", "part")},  # shared by all tenants
}

# The access context used by the registered queries.
DEMO_CONTEXT = AccessContext(
    clients=("AUTOMOBILE", "BUILDING", "1-URGENT", "2-HIGH", "3-MEDIUM"),
    orgs=tuple(range(0, 13)),
    tables=frozenset({"customer", "orders", "supplier", "nation", "region", "part"}),
)

# Same context written out as SQL for the oracle side.
DEMO_CLIENTS_SQL = "('AUTOMOBILE', 'BUILDING', '1-URGENT', '2-HIGH', '3-MEDIUM')"
DEMO_ORGS_SQL = "(" + ", ".join(str(i) for i in range(0, 13)) + ")"


def demo_session(spark: SparkSession, sf_dir: str, ctx: AccessContext = DEMO_CONTEXT) -> SparkSession:
    tables = {name: (lambda s, n=name: table(s, sf_dir, n)) for name in TABLES}
    return governed_session(spark, tables, TENANTS, ctx)
