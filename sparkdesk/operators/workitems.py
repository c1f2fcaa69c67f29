"""Work items and task tables.

An item is one row as a compact JSON object, or a group of rows as one JSON array of whole rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default task type and status ids.
TASK_TYPE_DEFAULT = "A83E397389DB42559B2D7719A442168F"
TASK_STATUS_DEFAULT = "D0FCC72902F84486A890B70C1EB10C9C"

_JSON = {"ignoreNullFields": "false"}


class ItemError(ValueError):
    pass


def normalise_group_keys(value) -> list | None:
    """List or comma text → trimmed non-blank names; none/empty → None; other types → error."""
    if value is None:
        return None
    if isinstance(value, str):
        parts = value.split(",")
    elif isinstance(value, (list, tuple)):
        parts = list(value)
    else:
        raise ItemError(f"groupby must be a list or a comma-separated text, got {type(value).__name__}")
    keys = [str(p).strip() for p in parts if p is not None and str(p).strip()]
    return keys or None


def check_group_keys(df: DataFrame, keys: list) -> None:
    """Unknown key → error naming the available headers."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ItemError(f"Group-by column(s) {missing} not found. Available headers: {df.columns}")


def row_items(df: DataFrame, ordinal: str | None = None) -> DataFrame:
    """One item per row: header → cell as a compact JSON object (nulls kept as null)."""
    cols = [c for c in df.columns if c != ordinal]
    item = F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]), _JSON).alias("item")
    return df.select(*([ordinal] if ordinal else []), item)


def group_items(df: DataFrame, keys: list, ordinal: str, fill_text: bool = True) -> DataFrame:
    """Rows grouped by ``keys`` → one JSON array of whole rows per group (key columns included),
    in ``ordinal`` order. Output: keys..., n_rows, first_row, item.

    ``fill_text`` casts every cell to text with null → '' (null keys then form the '' group). One item
    holds its whole group: that is the operator's output, as long as the group itself.
    """
    check_group_keys(df, keys)
    cols = [c for c in df.columns if c != ordinal]
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if fill_text else F.col(f"`{c}`")
             for c in cols]
    staged = df.select(F.col(ordinal).alias("__ord"), *cells)
    row = F.struct(F.col("__ord").alias("o"), F.struct(*[F.col(f"`{c}`") for c in cols]).alias("r"))
    grouped = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.min("__ord").alias("first_row"),
                                        F.array_sort(F.collect_list(row)).alias("rows"))
    return grouped.select(*keys, "n_rows", "first_row", F.to_json(F.transform("rows", lambda x: x["r"]), _JSON).alias("item"))


def task_table(items: DataFrame, question: str, agent_id: str, task_type: str | None = None,
               status: str | None = None, group_id: str | None = None, conversation_id: str | None = None,
               item_col: str = "item", ordinal: str | None = None) -> DataFrame:
    """C11: one task per item; question ':' item; empty type/status → default ids; empty group →
    conversation id, else one new id for the whole batch (made once, on the driver)."""
    import uuid

    ttype = task_type or TASK_TYPE_DEFAULT
    tstatus = status or TASK_STATUS_DEFAULT
    group = group_id or conversation_id or uuid.uuid4().hex.upper()
    return items.select(
        *([F.col(ordinal).alias("item_no")] if ordinal else []),
        F.lit(ttype).alias("taskType"), F.lit(tstatus).alias("status"),
        F.concat_ws(":", F.lit(question), F.col(item_col)).alias("question"),
        F.lit(agent_id).alias("agent"), F.lit(group).alias("group_id"))


def write_tasks(tasks: DataFrame, path: str, batch_id: str) -> None:
    """Idempotent bulk sink. Partitioned by group and batch (one file or run); re-running a batch
    replaces only its own partition (dynamic overwrite), other batches of the group stay. Never a
    content hash: equal rows stay separate tasks."""
    (tasks.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("group_id", "batch_id").parquet(path))


def get_or_create(names: DataFrame, dimension: DataFrame, new_id: Column | None = None,
                  name_col: str = "name") -> DataFrame:
    """Look each distinct name up in ``dimension(id, name)`` (first hit = lowest id); names
    with no row get a new id (from a hash of the name, so names that differ only in case stay apart). Output: name, id, created."""
    wanted = names.select(F.col(name_col).alias("name")).distinct()
    first_hit = dimension.groupBy("name").agg(F.min("id").alias("id"))
    found = wanted.join(first_hit, "name", "left")
    made = new_id if new_id is not None else F.concat(F.lit("NEW-"), F.upper(F.md5(F.col("name").cast("binary"))))
    return found.select("name", F.coalesce(F.col("id"), made).alias("id"), F.col("id").isNull().alias("created"))


def with_created(dimension: DataFrame, looked_up: DataFrame) -> DataFrame:
    """C12, the insert: the dimension(id, name) with the rows that ``get_or_create`` made."""
    made = looked_up.where("created and name is not null").select("id", "name")
    return dimension.select("id", "name").unionByName(made)


def page_of_list(df: DataFrame, name_col: str, name: str, start: int, end: int, key: str) -> DataFrame:
    """C14: rows with name == ``name`` ordered by ``key``, rows [start, end)."""
    return df.filter(F.col(name_col) == name).orderBy(key).offset(start).limit(max(end - start, 0))
