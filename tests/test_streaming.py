from pyspark.sql import functions as F

from sparkdesk.operators import memory
from sparkdesk.streaming import streams
from tests.test_audit import ACCEPTED, REJECTED
from tests.test_memory import LOG, SCHEMA


def test_audit_stream(spark, tmp_path):
    src = tmp_path / "q"
    spark.createDataFrame([(q,) for q in ACCEPTED + REJECTED], "query string").write.parquet(str(src))
    stream = spark.readStream.schema("query string").parquet(str(src))
    q = (streams.audit_stream(stream).writeStream.format("memory").queryName("audit_out")
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = {r.query: r.allowed for r in spark.sql("SELECT * FROM audit_out").collect()}
    assert sum(got.values()) == len(ACCEPTED)


def test_memory_fold_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "log"
    for i, chunk in enumerate([LOG[:3], LOG[3:6], LOG[6:]]):
        spark.createDataFrame(chunk, SCHEMA).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(src))
    root = str(tmp_path / "snap")
    q = (stream.writeStream.foreachBatch(streams.memory_fold_batch(root))
         .option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start())
    q.awaitTermination()
    live = sorted((r.memory_id, r.user_id, r.content) for r in streams.live_memories(spark, root).collect())
    batch = memory.fold_state(memory.fold_status(spark.createDataFrame(LOG, SCHEMA)))
    assert live == sorted((r.memory_id, r.user_id, r.content) for r in batch.collect())


def test_governed_and_items_streams(spark, tmp_path):
    from sparkdesk.operators.governed import AccessContext, TenantColumns

    src = tmp_path / "c"
    spark.read.parquet("/root/testdata/sf0.001/customer.parquet").write.parquet(str(src))
    schema = spark.read.parquet(str(src)).schema
    stream = spark.readStream.schema(schema).parquet(str(src))
    ctx = AccessContext(clients=("BUILDING",), orgs=(1, 2, 3), tables=frozenset({"customer"}))
    gov = streams.governed_stream(stream, TenantColumns("c_mktsegment", "c_nationkey"), ctx)
    q = (streams.items_stream(gov).writeStream.format("memory").queryName("items_out")
         .option("checkpointLocation", str(tmp_path / "ck3")).start())
    q.processAllAvailable()
    q.stop()
    import json

    items = [json.loads(r.item) for r in spark.sql("SELECT * FROM items_out").collect()]
    assert items and all(i["c_mktsegment"] == "BUILDING" and i["c_nationkey"] in (1, 2, 3) for i in items)
    want = spark.read.parquet(str(src)).filter("c_mktsegment = 'BUILDING' AND c_nationkey IN (1, 2, 3)").count()
    assert len(items) == want


def test_replayed_epoch_gives_the_same_state(spark, tmp_path):
    root, status = str(tmp_path / "snap"), str(tmp_path / "status")
    fold = streams.memory_fold_batch(root, status)
    fold(spark.createDataFrame(LOG[:4], SCHEMA), 0)
    for _ in range(2):
        fold(spark.createDataFrame(LOG[4:], SCHEMA), 1)
    live = sorted((r.memory_id, r.user_id, r.content) for r in streams.live_memories(spark, root).collect())
    assert live == [("m2", "u1", "x")] and spark.read.parquet(status).count() == len(LOG)


def _random_log(n):
    import random

    rnd = random.Random(5)
    ids = [None, "", "hot", "hot", "hot", *[f"m{i}" for i in range(12)]]
    return [(i, rnd.choice(["add", "add", "update", "update", "delete", "search", "bad", None]), rnd.choice(["a1", "a2", None]),
             rnd.choice(["u1", "u1", "u2"]), rnd.choice(ids), rnd.choice(["text", "text", "x", None, " "])) for i in range(n)]


def test_memory_status_stream_equals_batch_also_after_a_restart(spark, tmp_path):
    schema = "seq long, op string, assistant_id string, user_id string, memory_id string, content string"
    rows = _random_log(600)
    src, out, ck = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
        q = (streams.memory_status_stream(stream).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None

    def put(chunk):  # shuffled inside its micro-batch
        spark.createDataFrame(chunk[::-1], schema).coalesce(1).write.mode("append").parquet(str(src))

    put(rows[:200])
    run()
    run()  # nothing new: nothing twice
    put(rows[200:350])
    put([])
    run()
    put(rows[350:])
    run()
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("seq", "op", "memory_id", "error", "status").fillna("-").collect())
    batch = memory.fold_status(spark.createDataFrame(rows, schema))
    assert got == sorted(tuple(r) for r in batch.select("seq", "op", "memory_id", "error", "status").fillna("-").collect())
    assert {r[4] for r in got} == {"invalid", "added", "duplicate", "updated", "deleted", "not found", "search"}
    live = memory.fold_state(spark.read.parquet(out))
    assert sorted(map(str, live.collect())) == sorted(map(str, memory.fold_state(batch).collect()))
