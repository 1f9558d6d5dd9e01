from pyspark.sql import functions as F

from usagetally.operators import relational_update_result, relational_insert_rows
from usagetally.schemas import ENRICHED_FACT_COLUMNS, RELATIONAL_FACT_SCHEMA


def merged(spark, pid, user, total, is_insert):
    vals = {c: "x" for c in ENRICHED_FACT_COLUMNS}
    vals.update(pId=pid, user_id=user, total_duration=total, last_long="2",
                first_open_datetime="a", last_close_datetime="b")
    df = spark.createDataFrame([tuple(vals[c] for c in ENRICHED_FACT_COLUMNS)],
                               ", ".join(f"{c} string" for c in ENRICHED_FACT_COLUMNS))
    return df.withColumn("is_insert", F.lit(is_insert))


def stored(spark, rows):
    out = []
    for pid, account, total in rows:
        r = {f.name: "s" for f in RELATIONAL_FACT_SCHEMA.fields}
        r.update(id=pid, yun_account_id=account, total_long=total, last_long=1.0)
        out.append(tuple(r[f.name] for f in RELATIONAL_FACT_SCHEMA.fields))
    return spark.createDataFrame(out, RELATIONAL_FACT_SCHEMA)


def test_update_keeps_known_account(spark):
    m = merged(spark, "p1", "u1", "5", 0).unionByName(merged(spark, "p2", "u1", "5", 0))
    t = stored(spark, [("p1", "N/A", 10.0), ("p2", "u9", 10.0), ("p3", "u3", 1.0)])
    got = {r.id: (r.yun_account_id, r.total_long) for r in relational_update_result(t, m, "add").collect()}
    assert got == {"p1": ("u1", 15.0), "p2": ("u9", 15.0), "p3": ("u3", 1.0)}
    got = {r.id: r.total_long for r in relational_update_result(t, m, "set").collect()}
    assert got == {"p1": 5.0, "p2": 5.0, "p3": 1.0}


def test_insert_ignores_stored_ids(spark):
    m = merged(spark, "p1", "u1", "5", 1).unionByName(merged(spark, "p4", "u1", "5", 1))
    t = stored(spark, [("p1", "N/A", 10.0)])
    assert [r.id for r in relational_insert_rows(m, t).collect()] == ["p4"]


def test_jdbc_read_predicates_cover_every_key(spark):
    """The parallel relational read splits by key prefix without losing rows:
    applying the predicates to a DataFrame partitions it exactly."""
    from usagetally.sources.jdbc import key_prefix_predicates
    preds = key_prefix_predicates("id", 2)
    assert len(preds) == 257
    df = spark.createDataFrame([("00ab",), ("ff01",), ("a9",), ("ZZZ",), (None,), ("0",), ("f",), ("fg",), ("9:",)], "id string")
    parts = [df.where(p).count() for p in preds]
    assert sum(parts) == df.count()                 # disjoint and complete
    assert parts[-1] == 6                           # NULL, non-hex and too-short keys
    assert parts[int("00", 16)] == 1 and parts[int("ff", 16)] == 1 and parts[int("a9", 16)] == 1


def test_changed_rows_are_only_the_updated_ids(spark):
    from usagetally.operators import relational_changed_rows
    m = merged(spark, "p1", "u1", "5", 0).unionByName(merged(spark, "p4", "u1", "5", 1))
    t = stored(spark, [("p1", "N/A", 10.0), ("p2", "u9", 10.0)])
    got = [(r.id, r.yun_account_id, r.total_long) for r in relational_changed_rows(t, m, "add").collect()]
    assert got == [("p1", "u1", 15.0)]


def test_update_statement_applies_the_staged_changes(spark):
    """The set-based update gives the rows of the keyed update, also when it runs twice (in this process's own memory)."""
    import duckdb

    from usagetally.schemas import RELATIONAL_FACT_MAP
    from usagetally.sources.jdbc import update_statement
    m = merged(spark, "p1", "u1", "5", 0).unionByName(merged(spark, "p4", "u1", "5", 1))
    t = stored(spark, [("p1", "N/A", 10.0), ("p2", "u9", 10.0)])
    from usagetally.operators import relational_changed_rows
    want, changes = relational_update_result(t, m, "add").toPandas(), relational_changed_rows(t, m, "add").toPandas()
    columns = [d for d, _ in RELATIONAL_FACT_MAP if d != "id"]
    con = duckdb.connect()
    before = t.toPandas()                    # noqa: F841 (read by name below)
    con.execute("create table facts as select * from before")
    con.execute("create table facts_changes as select * from changes")
    for _ in range(2):
        con.execute(update_statement("facts", "facts_changes", columns))
        got = con.execute("select * from facts order by id").fetchdf()
        assert got.equals(want.sort_values("id").reset_index(drop=True)[list(got.columns)])
    assert update_statement("a", "b", ["x"], dialect="join") == "UPDATE a t JOIN b s ON t.id = s.id SET t.x = s.x"
    assert len(changes) == 1
