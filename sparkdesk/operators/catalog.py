"""Catalog listing (A6, A7) over dictionary DataFrames.

Dictionaries: ``tables(table_id, db_name, name, description)`` and
``columns(table_id, db_column, name, data_type, description)``. Both are metadata-sized;
joins against them are left to the planner (AQE turns them into broadcasts from the
measured size, never from a guess).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class CatalogError(ValueError):
    pass


def dictionary_from_schemas(spark: SparkSession, schemas: dict[str, StructType],
                            described: dict[str, set] | None = None) -> tuple[DataFrame, DataFrame]:
    """Build the two dictionaries from table schemas. ``described`` limits, per table, which
    columns get a dictionary entry (the rest exist only physically)."""
    trows, crows = [], []
    for i, (name, schema) in enumerate(sorted(schemas.items())):
        tid = f"T{i:03d}"
        trows.append((tid, name, name.capitalize(), f"Table {name}"))
        keep = (described or {}).get(name)
        for f in schema.fields:
            if keep is None or f.name in keep:
                crows.append((tid, f.name, f.name.replace("_", " ").title(), f.dataType.simpleString(),
                              f"Column {f.name} of {name}"))
    tables = spark.createDataFrame(trows, "table_id string, db_name string, name string, description string")
    columns = spark.createDataFrame(
        crows, "table_id string, db_column string, name string, data_type string, description string")
    return tables, columns


def accessible_table_ids(readable: DataFrame, derived: DataFrame) -> DataFrame:
    """Union distinct of readable and derived-readable ids (single column ``table_id``)."""
    return readable.select("table_id").union(derived.select("table_id")).distinct()


def list_tables(tables: DataFrame, ids: DataFrame) -> DataFrame:
    """Dictionary rows of the accessible tables as TABLENAME, NAME, DESCRIPTION."""
    return (tables.join(ids, "table_id", "left_semi")
            .select(F.col("db_name").alias("TABLENAME"), F.col("name").alias("NAME"),
                    F.col("description").alias("DESCRIPTION")))


def resolve_table(tables: DataFrame, user_text: str) -> DataFrame:
    """The first dictionary row whose db name or display name equals the text, ignoring case
    (case-insensitive equality, not a LIKE pattern)."""
    t = user_text.strip().lower()
    hit = tables.filter((F.lower("db_name") == t) | (F.lower("name") == t))
    return hit.orderBy("table_id").limit(1)


def list_columns(spark: SparkSession, tables: DataFrame, columns: DataFrame, user_text: str,
                 physical: StructType | None = None, physical_by_table: dict | None = None) -> DataFrame:
    """Physical columns left-joined to dictionary columns case-insensitively.

    ``physical`` is the real schema of the resolved table (or looked up in ``physical_by_table``
    by db name). A physical column without a dictionary entry is kept with nulls.
    """
    t = resolve_table(tables, user_text)
    row = t.select("table_id", "db_name").first()  # one metadata row, bounded by the limit above
    if row is None:
        raise CatalogError(f"Table {user_text} not found")
    schema = physical if physical is not None else physical_by_table[row["db_name"]]
    phys = spark.createDataFrame([(i, f.name) for i, f in enumerate(schema.fields)],
                                 "position int, column_name string")
    dict_cols = columns.filter(F.col("table_id") == row["table_id"])
    joined = phys.join(dict_cols, F.lower(phys["column_name"]) == F.lower(dict_cols["db_column"]), "left")
    return joined.select(F.col("column_name").alias("COLUMNNAME"), F.col("name").alias("NAME"),
                         F.col("data_type").alias("DBTYPE"), F.col("description").alias("DESCRIPTION"))
