import bz2
import gzip
import zipfile

import pytest
from pyspark.sql import functions as F

from sparkdesk.functions.text import safe_name, url_file_name
from sparkdesk.operators import files as fileops
from sparkdesk.sources import files as filesrc


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as zf:
        zf.writestr("a.txt", "A")
        zf.writestr("b.txt", "B")
        zf.writestr("__MACOSX/._a.txt", "meta")
    (tmp_path / "c.txt.gz").write_bytes(gzip.compress(b"C"))
    (tmp_path / "d.txt.bz2").write_bytes(bz2.compress(b"D"))
    (tmp_path / "e.xyz").write_bytes(b"E")
    rows = filesrc.read_archives(spark, str(tmp_path)).collect()
    assert sorted((r.member, bytes(r.content)) for r in rows) == [
        ("a.txt", b"A"), ("b.txt", b"B"), ("c.txt", b"C"), ("d.txt", b"D")]
    odd = spark.read.format("binaryFile").load(str(tmp_path / "e.xyz"))
    assert filesrc.expand_archives(odd).first().status == "unsupported archive format"


def test_manifest(spark, tmp_path):
    (tmp_path / "file1.txt").write_text("1")
    (tmp_path / "file2.TXT").write_text("2")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deep.txt").write_text("3")
    (tmp_path / "skip").mkdir()
    (tmp_path / "skip" / "x.txt").write_text("4")
    flat = filesrc.directory_manifest(spark, str(tmp_path)).collect()
    assert sorted(r.name for r in flat) == ["file1.txt", "file2.TXT"]
    rec = filesrc.directory_manifest(spark, str(tmp_path), recursive=True, extensions=".txt", ignore=["skip"])
    assert sorted(r.rel_path for r in rec.collect()) == ["file1.txt", "file2.TXT", "sub/deep.txt"]
    with pytest.raises(filesrc.FileSetError):
        filesrc.directory_manifest(spark, str(tmp_path / "missing")).collect()


def test_base64(spark):
    df = spark.createDataFrame([("SGVsbG8gV29ybGQ=",), ("SGVsbG8gV29ybGQ",), ("not base64!!",)], "b string")
    got = [r.v for r in df.select(fileops.from_base64("b").cast("string").alias("v")).collect()]
    assert got == ["Hello World", "Hello World", None]


def test_sniff(spark):
    df = spark.createDataFrame([(b"\xff\xd8\xff\xe0xx",), (b"\x89PNG\r\n\x1a\n",), (b"%PDF-1.7",),
                                (b"RIFF\x00\x00\x00\x00WEBPVP8",), (b"hello",)], "content binary")
    got = [(r.m, r.a) for r in df.select(fileops.sniff_mime("content").alias("m"),
                                         F.coalesce(fileops.sniff_mime("content").isin(*fileops.ACCEPTED_MIME),
                                                    F.lit(False)).alias("a")).collect()]
    assert got == [("image/jpeg", True), ("image/png", True), ("application/pdf", True), ("image/webp", True),
                   (None, False)]


def test_names(spark):
    df = spark.createDataFrame([("https://x.org/a/report",), ("http://x.org/",), ("http://x.org/f.csv?x=1",)],
                               "u string")
    got = [r.n for r in df.select(url_file_name("u", F.lit(True)).alias("n")).collect()]
    assert got == ["report.txt", "downloaded_file.txt", "f.csv"]
    n = spark.createDataFrame([("Año 2024: ventas/Q1",)], "t string").select(safe_name("t").alias("s")).first().s
    assert n == "Año_2024__ventas_Q1"


def test_whole_text_and_sinks(spark, tmp_path):
    from sparkdesk.sources.export import ExportError, export_csv, write_header_only, write_table

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("line1\nline2\n")
    rows = filesrc.whole_text(spark, str(tmp_path / "in")).collect()
    assert len(rows) == 1 and rows[0].text == "line1\nline2\n"
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    write_table(df, str(tmp_path / "t"))
    write_table(df, str(tmp_path / "t"), override=False)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    write_table(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    write_header_only(df, str(tmp_path / "h"))
    parts = [p for p in (tmp_path / "h").iterdir() if p.name.startswith("part-")]
    assert parts and parts[0].read_text().strip() == "id,v"
    res = export_csv(spark.createDataFrame([("John Doe", None)], "name string, email string"),
                     str(tmp_path / "e"), include_headers=False)
    assert res.rows == 1
    with pytest.raises(ExportError, match="No data returned"):
        export_csv(df.limit(0), str(tmp_path / "empty"))
    kept = str(tmp_path / "kept")
    export_csv(df, kept)
    before = spark.read.csv(kept).count()
    with pytest.raises(ExportError):
        export_csv(df.limit(0), kept)
    assert spark.read.csv(kept).count() == before > 0


def test_names_with_an_underscore_are_listed(spark, tmp_path):
    for name in ("__init__.py", "_sub/deep_.txt", "a b/%20.txt", ".hidden/x.txt", "a b/.x", "plain.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(name)
    (tmp_path / "_sub" / "_old.gz").write_bytes(gzip.compress(b"old"))
    rows = filesrc.directory_manifest(spark, str(tmp_path), recursive=True, with_content=True).collect()
    assert sorted(r.rel_path for r in rows) == ["__init__.py", "_sub/_old.gz", "_sub/deep_.txt", "a b/%20.txt", "plain.txt"]
    assert all(bytes(r.content) == (tmp_path / r.rel_path).read_bytes() and r.length == len(r.content) for r in rows)
    assert all(r.modificationTime is not None and r.path == f"file:{tmp_path}/{r.rel_path}" for r in rows)
    assert [r.name for r in filesrc.directory_manifest(spark, "file://" + str(tmp_path), extensions=".py").collect()] == ["__init__.py"]
    assert [(r.member, bytes(r.content)) for r in filesrc.read_archives(spark, str(tmp_path)).collect()] == [("_old", b"old")]


def test_text_pieces_cut_between_characters(spark, tmp_path):
    text = "aé漢😀\n" * 500
    (tmp_path / "a.txt").write_bytes(text.encode())
    (tmp_path / "empty.txt").write_bytes(b"")
    (tmp_path / "bad.txt").write_bytes(b"x\x80\x80\x80\x80\x80\x80y" * 20)
    (tmp_path / "b.bin").write_bytes(b"no")
    for size in (1, 3, 7, 1000, 1 << 20):
        pieces = filesrc.text_pieces(spark, str(tmp_path), piece_bytes=size, extensions=".txt")
        got = {r["path"].rsplit("/", 1)[1]: r["text"] for r in filesrc.joined_text(pieces).collect()}
        assert got["a.txt"] == text and got["empty.txt"] == "" and set(got) == {"a.txt", "empty.txt", "bad.txt"}
        assert got["bad.txt"].count("x") == got["bad.txt"].count("y") == 20
    spread = filesrc.text_pieces(spark, str(tmp_path), piece_bytes=100, extensions=".txt").where("path like '%a.txt'")
    assert spread.count() > 50 and spread.select(F.spark_partition_id()).distinct().count() > 1


def test_text_pieces_of_one_task_stay_small(spark, tmp_path):
    """A file of 24 MB is never whole in one row: no piece is over its bound."""
    (tmp_path / "big.txt").write_bytes("0123456789abcde\n".encode() * 1_500_000)
    pieces = filesrc.text_pieces(spark, str(tmp_path), piece_bytes=1 << 20)
    worst, total = pieces.agg(F.max(F.length("text")), F.sum(F.length("text"))).first()
    assert worst <= 1 << 20 and total == 24_000_000


def test_members_come_in_bounded_frames(monkeypatch):
    import gzip

    monkeypatch.setattr(filesrc, "PART_BYTES", 5_000)
    archives = [(f"/a/f{i}.txt.gz", gzip.compress(bytes([i]) * 2_000)) for i in range(20)] + [("/a/x.rar", b"")]
    frames = list(filesrc._member_frames(iter(archives)))
    assert len(frames) >= 7 and max(len(f) for f in frames) <= 3
    rows = [r for f in frames for r in f.itertuples(index=False)]
    assert [r.archive for r in rows] == [p for p, _ in archives]
    assert [r.content for r in rows[:20]] == [bytes([i]) * 2_000 for i in range(20)] and rows[20].status == "unsupported archive format"


def test_staged_contents_never_pass_as_rows(spark, monkeypatch, tmp_path):
    """The task that makes a file puts it: contents are no rows that a writer gets by the ten thousand."""
    from sparkdesk.plans import staging
    from sparkdesk.sources import blobs

    docs = [(i, f"text {i}" if i % 3 else None, "web") for i in range(120)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))

    def no_rows(*a, **k):
        raise AssertionError("contents passed as rows")

    monkeypatch.setattr(blobs, "write_blobs", no_rows)
    monkeypatch.setattr(staging, "write_blobs", no_rows)
    members = filesrc.read_archives(spark, staging.document_files(spark, str(tmp_path))).collect()
    got = sorted((r.archive.rsplit("/", 1)[1], r.member, bytes(r.content).decode()) for r in members)
    want = [(f"doc_{i}.txt.gz", f"doc_{i}.txt", t or "") for i, t, _ in docs if i % 6 == 1]
    want += [(f"doc_{i}.txt.bz2", f"doc_{i}.txt", t or "") for i, t, _ in docs if i % 6 == 2]
    want += [(f"archive_{i // 50}.zip", f"docs/doc_{i}.txt", t or "") for i, t, _ in docs]
    assert got == sorted(want)


def test_items_of_folders_are_listed_and_read_in_tasks(spark, tmp_path, monkeypatch):
    """The items are those of Spark's own file index, which held every file of the folders on the driver."""
    from sparkdesk.plans.file_queries import dispatch_items
    from sparkdesk.sources.tabular import build_xlsx

    top = tmp_path / "top"
    for folder in ("a b", "_hidden", "_k=1", ".dot", "a b/deep"):
        (top / folder).mkdir(parents=True)
        (top / folder / "x.csv").write_text('k,"na\nme"\r\n1,"é, ""q"""\r\n\r\n2\r\n', newline="")
    with zipfile.ZipFile(top / "a b" / "z.zip", "w") as zf:
        for name in ("in/", "in/a.txt", "__MACOSX/._a", "b.txt"):
            zf.writestr(name, "x")
    (top / "w.xlsx").write_bytes(build_xlsx([("s", [["h", "i"], ["1", ""], ["", "2"]]), ("other", [["h"], ["9"]])]))
    for name in ("_part.csv", ".x.csv", "UP.CSV", "note.txt", "late.csv._COPYING_"):
        (top / name).write_text("a\n1\n")
    (top / "empty.csv").write_text("")
    (top / "empty.zip").write_text("")
    (top / "long.csv").write_text("a,b\n" + "".join(f"{i},{'é' * 50}\n" for i in range(3000)))
    monkeypatch.setattr(filesrc, "PART_BYTES", 20_000)
    own = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{csv,xlsx,zip}").load(str(top))
    want = sorted(tuple(r) for r in filesrc.dispatch_items(own).collect())
    got = filesrc.read_items(spark, [str(top), str(top / "a b")], (".csv", ".xlsx", ".zip"))
    again = [r for r in want if "/a b/" in r[0]]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want + again) and len(want) > 3000

    spark.createDataFrame([(i, f"s{i % 2}", f"text {i}") for i in range(60)], "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, f"c{i}", "SEG") for i in range(7)], "c_custkey long, c_name string, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    items = dispatch_items(spark, str(tmp_path))
    assert "binaryFile" not in items._jdf.queryExecution().executedPlan().toString()
    assert {r.kind: r["count"] for r in items.groupBy("kind").count().collect()} == {"csv": 7, "excel": 7, "zip": 60}
