import json

import pytest
from pyspark.sql import functions as F

from sparkdesk.operators import workitems
from sparkdesk.sources.tabular import build_xlsx, parse_xlsx, read_text_csv, read_workbooks, sheet_range


def test_text_csv_quotes_and_newlines(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('col1,col2,col3\n1,"say ""hi""",\n2,"two\nlines",x\n', encoding="utf-8")
    rows = read_text_csv(spark, str(p)).collect()
    assert rows[0].col2 == 'say "hi"' and rows[0].col3 == ''
    assert rows[1].col2 == "two\nlines"
    assert all(f.dataType.simpleString() == "string" for f in read_text_csv(spark, str(p)).schema.fields)


def test_row_items(spark, tmp_path):
    p = tmp_path / "b.csv"
    p.write_text("col1,col2\n1,foo\n2,bar\n")
    items = [json.loads(r.item) for r in workitems.row_items(read_text_csv(spark, str(p))).collect()]
    assert items == [{"col1": "1", "col2": "foo"}, {"col1": "2", "col2": "bar"}]


def test_group_items(spark):
    df = spark.createDataFrame([(0, "A", "1"), (1, "A", "2"), (2, "B", "3"), (3, None, "4")],
                               "row_no long, cat string, val string")
    rows = {r.cat: r for r in workitems.group_items(df, ["cat"], "row_no").collect()}
    assert json.loads(rows["A"].item) == [{"cat": "A", "val": "1"}, {"cat": "A", "val": "2"}]
    assert json.loads(rows["B"].item) == [{"cat": "B", "val": "3"}]
    assert rows[""].n_rows == 1  # null key forms its own group, cells as ''


def test_one_item_per_group(spark):
    df = spark.range(0, 2500).select(F.col("id").alias("row_no"), F.lit("K").alias("k"))
    rows = workitems.group_items(df, ["k"], "row_no").collect()
    assert len(rows) == 1 and rows[0].n_rows == 2500 and len(json.loads(rows[0].item)) == 2500


def test_batches_of_a_group_stay(spark, tmp_path):
    path = str(tmp_path / "tasks")
    for name, n in (("one.csv", 2), ("two.csv", 1), ("one.csv", 2)):
        items = spark.createDataFrame([(f"x{k}",) for k in range(n)], "item string")
        workitems.write_tasks(workitems.task_table(items, "Q", "AG", conversation_id="C1"), path, name)
    assert spark.read.parquet(path).count() == 3


def test_wide_header_comes_back_whole(spark, tmp_path):
    from sparkdesk.sources.blobs import read_first_line

    head = ",".join([f"column_é_{k}" for k in range(6000)] + ['"two\nlines"'])
    (tmp_path / "w.csv").write_text(head + "\r\n1,2\n", encoding="utf-8")
    assert read_first_line(str(tmp_path / "w.csv")) == head


def test_messages_of_long_conversations(spark):
    from sparkdesk.operators.messages import assemble_messages

    turns = spark.createDataFrame([(1, k, "system" if k == 1500 else "user", str(k)) for k in range(2000)],
                                  "conv_id long, turn long, role string, text string")
    rows = assemble_messages(turns).collect()
    got = json.loads(rows[0].messages)
    assert len(rows) == 1 and len(got) == 2000 and got[0] == {"role": "system", "content": "1500"}


def test_group_key_normalisation():
    assert workitems.normalise_group_keys(["a", " b "]) == ["a", "b"]
    assert workitems.normalise_group_keys("col1, col2") == ["col1", "col2"]
    assert workitems.normalise_group_keys(None) is None and workitems.normalise_group_keys([]) is None
    with pytest.raises(workitems.ItemError):
        workitems.normalise_group_keys(123)


def test_unknown_group_key(spark):
    df = spark.createDataFrame([(0, "A")], "row_no long, cat string")
    with pytest.raises(workitems.ItemError, match="Available headers"):
        workitems.group_items(df, ["nope"], "row_no")


def test_task_defaults(spark):
    items = spark.createDataFrame([("x",)], "item string")
    t = workitems.task_table(items, "Q", "AG", task_type="", status="", group_id="", conversation_id="C1").first()
    assert (t.taskType, t.status, t.question, t.group_id) == (
        workitems.TASK_TYPE_DEFAULT, workitems.TASK_STATUS_DEFAULT, "Q:x", "C1")


def test_get_or_create(spark):
    names = spark.createDataFrame([("a",), ("b",), ("a",), ("B",)], "name string")
    dim = spark.createDataFrame([("2", "a"), ("1", "a")], "id string, name string")
    got = {r.name: (r.id, r.created) for r in workitems.get_or_create(names, dim).collect()}
    assert got["a"] == ("1", False) and got["b"][1] and got["B"][1] and got["b"][0] != got["B"][0]
    after = workitems.with_created(dim, workitems.get_or_create(names, dim))
    assert after.count() == 4
    again = workitems.get_or_create(names, after).collect()
    assert {r.name: r.id for r in again} == {k: v[0] for k, v in got.items()} and not any(r.created for r in again)


def test_workbook_three_sheets(spark, tmp_path):
    data = build_xlsx([("Sheet1", [["A", "B"], ["1", "2"]]), ("Sheet2", [["X", "Y"], ["3", ""]]),
                       ("Sheet3", [["P", "Q"], ["5", "6"]])])
    assert [s for s, _ in parse_xlsx(data)] == ["Sheet1", "Sheet2", "Sheet3"]
    (tmp_path / "w.xlsx").write_bytes(data)
    rows = read_workbooks(spark, str(tmp_path)).collect()
    assert len(rows) == 6
    rng = sheet_range(read_workbooks(spark, str(tmp_path)), "A2:A9").collect()
    assert sorted(r.line for r in rng) == ["1", "3", "5"]


def test_typed_csv_extension(spark, tmp_path):
    from sparkdesk.sources.tabular import TabularError, check_extension, read_typed_csv

    p = tmp_path / "t.csv"
    p.write_text("product,price\nLaptop,999.99\nMouse,29.99\n")
    df = read_typed_csv(spark, str(p))
    assert dict(df.dtypes)["price"] == "double"
    with pytest.raises(TabularError):
        check_extension("x.CSV")


def test_headers_table(spark, tmp_path):
    from sparkdesk.sources.files import directory_manifest
    from sparkdesk.sources.tabular import headers_table

    (tmp_path / "a.csv").write_text('id,"na,me"\n1,x\n')
    (tmp_path / "b.csv").write_text("p,q,r\n")
    got = sorted((r.path.rsplit("/", 1)[-1], r.position, r.column)
                 for r in headers_table(spark, directory_manifest(spark, str(tmp_path))).collect())
    assert got == [("a.csv", 0, "id"), ("a.csv", 1, "na,me"), ("b.csv", 0, "p"), ("b.csv", 1, "q"), ("b.csv", 2, "r")]
