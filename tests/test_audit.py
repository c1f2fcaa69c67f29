
from sparkdesk.operators.audit import audit_queries

ACCEPTED = ["SELECT * FROM users", "select id, name from customers where active = true",
            "  SELECT COUNT(*) FROM orders  ", "SELECT DISTINCT category FROM products"]
REJECTED = ["DROP TABLE users", "DELETE FROM users WHERE id = 1", "INSERT INTO users VALUES (1, 'x')",
            "UPDATE users SET name = 'x'", "TRUNCATE TABLE users", "ALTER TABLE users ADD c int",
            "CREATE TABLE t (id int)", "EXEC sp_who", "SELECT * FROM users; DROP TABLE users"]
NOT_SELECT = ["SHOW TABLES", "DESCRIBE users", "EXPLAIN SELECT * FROM users"]


def test_guard_truth_table(spark):
    rows = ACCEPTED + REJECTED + NOT_SELECT
    df = spark.createDataFrame([(q,) for q in rows], "query string")
    got = {r.query: r.allowed for r in audit_queries(df).collect()}
    assert all(got[q] for q in ACCEPTED)
    assert not any(got[q] for q in REJECTED + NOT_SELECT)


def test_whole_word_verdict(spark):
    df = spark.createDataFrame([("SELECT created_at, last_updated FROM t",)], "query string")
    r = audit_queries(df).first()
    assert r.allowed is False and r.keyword == "create"
    assert r.allowed_whole_word is True and r.word_keyword is None
