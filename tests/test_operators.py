from datetime import date

import pytest
from pyspark.sql import functions as F

from rollkeeper.operators import changes as ch
from rollkeeper.operators import dated, keys, lookup, pick, positions, snapshot, spread
from rollkeeper.operators.gate import first_filled_slot
from rollkeeper.operators.people import xref_changes
from rollkeeper.session import written

DAY = date(2024, 1, 10)
AA = "aa_no int, id int, aa string, beg_date date, end_date date, line1 string, zip string, phone string, line2 string, line3 string, city string, st string, ctry string"


def contacts(spark, rows):
    """(aa_no, id, kind, begin, end, value)."""
    full = [(n, i, a, b, e, v, v, v, "", "", "", "", "") for n, i, a, b, e, v in rows]
    return spark.createDataFrame(full, AA)


def seen(changes):
    """(action, old number, begin, end, first line or phone)."""
    rows = changes.select("action", "before.aa_no", "after.beg_date", "after.end_date", "after.line1", "after.phone").collect()
    return sorted([tuple(r) for r in rows], key=repr)


D = date


@pytest.mark.parametrize(
    "state, wanted",
    [
        ([], [("insert", None, DAY, None, "", "new")]),
        ([(1, 1, "CELL", D(2024, 1, 3), D(2024, 1, 5), "old")], [("insert", None, D(2024, 1, 4), None, "", "new")]),
        ([(1, 1, "CELL", D(2024, 1, 3), None, "new")], [("none", 1, D(2024, 1, 3), None, "new", "new")]),
        (
            [(2, 1, "CELL", D(2024, 1, 3), None, "old"), (3, 1, "CELL", D(2024, 1, 11), None, "x")],
            [
                ("end_date", 2, D(2024, 1, 3), D(2024, 1, 11), "old", "old"),
                ("insert", None, D(2024, 1, 12), None, "", "new"),
            ],
        ),
    ],
)
def test_phone(spark, state, wanted):
    given = spark.createDataFrame([(1, "CELL", "new")], "id int, aa string, phone string")
    assert seen(dated.set_phone(given, contacts(spark, state), F.lit(DAY))) == sorted(wanted, key=repr)


@pytest.mark.parametrize(
    "newest, rule, begins",
    [
        (D(2024, 1, 3), "email", DAY),
        (D(2024, 1, 10), "email", D(2024, 1, 11)),
        (D(2024, 1, 20), "email", D(2024, 1, 21)),
        (D(2024, 1, 3), "max_plus_one", D(2024, 1, 4)),
    ],
)
def test_email_days(spark, newest, rule, begins):
    state = contacts(spark, [(1, 1, "EML2", newest, None, "old")])
    given = spark.createDataFrame([(1, "EML2", "new")], "id int, aa string, email string")
    result = seen(dated.set_email(given, state, F.lit(DAY), rule=rule))
    assert result == [("end_date", 1, newest, DAY, "old", "old"), ("insert", None, begins, None, "new", "")]


def address(spark, line1, zip_code):
    values = (1, line1, "", "", "", "", zip_code, "USA", "262-555-0100")
    return spark.createDataFrame([values], "id int, line1 string, line2 string, line3 string, city string, st string, zip string, ctry string, phone string")


def test_archive_address_three_cases(spark):
    none = seen(dated.archive_address(address(spark, "a", "1"), contacts(spark, []), F.lit(DAY)))
    assert none == [("insert", None, DAY, None, "a", "262-555-0100")]
    closed = contacts(spark, [(1, 1, "PREV", D(2024, 1, 1), D(2024, 1, 2), "a")])
    assert [r[0] for r in seen(dated.archive_address(address(spark, "b", "1"), closed, F.lit(DAY)))] == ["insert"]
    same = contacts(spark, [(4, 1, "PERM", D(2024, 1, 1), None, "a"), (5, 1, "PREV", D(2024, 1, 1), None, "b")])
    assert seen(dated.archive_address(address(spark, "a", "a"), same, F.lit(DAY))) == [
        ("update", 4, D(2024, 1, 1), None, "a", "262-555-0100")
    ]
    ahead = contacts(spark, [(4, 1, "PERM", D(2024, 1, 1), None, "x"), (5, 1, "PREV", D(2024, 1, 15), None, "y")])
    changes = dated.archive_address(address(spark, "a", "a"), ahead, F.lit(DAY))
    assert seen(changes) == [
        ("end_date", 4, D(2024, 1, 1), D(2024, 1, 15), "x", "x"),
        ("insert", None, D(2024, 1, 16), None, "a", "262-555-0100"),
    ]
    kinds = {r["action"]: r["k"] for r in changes.select("action", F.col("after.aa").alias("k")).collect()}
    assert kinds == {"end_date": "PREV", "insert": "PREV"}


def test_one_open_row_after_a_run(spark):
    state = contacts(spark, [(1, 1, "CELL", D(2024, 1, 3), None, "old"), (2, 2, "CELL", D(2024, 1, 3), D(2024, 1, 4), "old")])
    given = spark.createDataFrame([(i, "CELL", "new") for i in (1, 2, 3)], "id int, aa string, phone string")
    numbered = ch.number_inserts(dated.set_phone(given, state, F.lit(DAY)), state, "aa_no", ["id", "aa", "beg_date"])
    after = ch.apply_changes(state, numbered, ["aa_no"])
    opened = {r["id"]: (r["aa_no"], r["phone"]) for r in after.filter("end_date IS NULL").collect()}
    assert opened == {1: (3, "new"), 2: (4, "new"), 3: (5, "new")}
    assert after.count() == 5


def test_update_may_set_null(spark):
    state = spark.createDataFrame([(1, DAY), (2, DAY)], "k int, end_date date")
    given = spark.createDataFrame([(1,)], "key int")
    changes = ch.upsert(given, state, {"key": "k"}, {"end_date": F.lit(None)})
    after = ch.apply_changes(state, changes, ["k"])
    assert sorted(map(tuple, after.collect())) == [(1, None), (2, DAY)]


def test_snapshot_with_itself_is_empty(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "a int, b string")
    assert snapshot.snapshot_diff(df, df).count() == 0
    assert snapshot.snapshot_diff(df, df.limit(0)).count() == 2
    blank = df.fillna({"b": ""})
    assert snapshot.snapshot_diff(blank, df).count() == 1
    assert snapshot.snapshot_diff(blank, df, blank_is_null=True).count() == 0


def test_latest_modes(spark):
    """A stale row that shares another person's newest stamp is kept by stamp only."""
    rows = [(1, "a", D(2024, 1, 1)), (1, "a", D(2024, 1, 2)), (2, "b", D(2024, 1, 1)), (None, "c", D(2024, 1, 1))]
    df = spark.createDataFrame(rows, "id int, name string, stamp date")
    by_stamp = snapshot.latest_snapshot(df, ["id", "name"], "stamp", "stamp_in")
    assert by_stamp.count() == 4
    by_key = snapshot.latest_snapshot(df, ["id", "name"], "stamp", "per_key")
    assert sorted(map(tuple, by_key.collect()), key=repr) == sorted(rows[1:], key=repr)


def test_verify_null_rules(spark):
    schema = "n string, t string, d date"
    stored = spark.createDataFrame([("007", "x", None), ("8", None, DAY)], schema)
    given = spark.createDataFrame([("7", "x", None), ("8", "", DAY), ("8", None, DAY), ("7", "x", DAY)], schema)
    left = snapshot.not_in_latest(given, stored, ["n", "t", "d"], dates=["d"], numbers=["n"])
    wanted = [("8", "", DAY), ("8", None, DAY), ("7", "x", DAY)]
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(wanted, key=repr)


def hot_batch(spark, n=3000):
    """A third of the rows under one key."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    return spark.range(0, n, numPartitions=4).select(key.alias("key"), F.col("id").alias("row"), F.lit(DAY).alias("day"))


def test_hot_key_joins_whole(spark):
    df = hot_batch(spark)
    right = df.groupBy("key").agg(F.max("row").alias("top"))
    joined = spread.spread_join(df, right, ["key"], "inner")
    wanted = df.join(right, "key")
    assert joined.count() == 3000
    assert joined.select(*wanted.columns).exceptAll(wanted).count() == 0
    for how, kept in (("left_semi", 3000), ("left_anti", 0), ("left", 3000)):
        assert spread.spread_join(df, right, ["key"], how).count() == kept
    assert lookup.lookup(df, "key", right, "key", "top", "found", -1).filter("found < 0").count() == 0


SMALL_TASKS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.shuffle.partitions": "16",
}


def test_two_thousand_hot_keys_are_all_split(spark):
    """However many hot keys there are, the partitions they lie in are cut into tasks of the
    stated size; no task takes a whole one."""
    before = {k: spark.conf.get(k, None) for k in SMALL_TASKS}
    # the hot keys are those that hashing sends to 4 of the 16 partitions
    part = F.expr("pmod(hash(coalesce(key, 0L), isnull(key)), 16)")
    keys_ = spark.range(8000).select(F.col("id").alias("key")).withColumn("copies", F.when(part < 4, 40).otherwise(1))
    df = written(keys_.select("key", F.explode(F.sequence(F.lit(1), "copies")).alias("row")))
    right = spark.range(8000).select(F.col("id").alias("key"), F.lit(1).alias("one"))
    assert df.groupBy("key").count().filter("count = 40").count() > 1900
    try:
        for k, v in SMALL_TASKS.items():
            spark.conf.set(k, v)
        joined = spread.spread_join(df, right, ["key"], "left").withColumn("task", F.spark_partition_id())
        rows = joined.groupBy("task").count().collect()
        whole = df.count()
        assert sum(r["count"] for r in rows) == whole
        assert len(rows) > 16 and max(r["count"] for r in rows) < whole / 7
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_one_per_key(spark):
    rows = [(1, D(2024, 1, 1), "a"), (1, D(2024, 1, 2), "b"), (1, D(2024, 1, 2), "b"), (2, D(2024, 1, 1), "c"), (None, DAY, "n"), (None, D(2024, 1, 1), "m")]
    df = spark.createDataFrame(rows, "id int, day date, v string")
    won, lost = pick.one_per_key(df, ["id"], "day")
    assert sorted(map(tuple, won.collect()), key=repr) == sorted([rows[1], rows[3], rows[4]], key=repr)
    assert sorted(map(tuple, lost.collect()), key=repr) == sorted([rows[0], rows[5]], key=repr)


def test_one_per_key_loses_no_row_of_a_hot_key(spark):
    df = hot_batch(spark)
    won, lost = pick.one_per_key(df, ["key"], "day")
    assert won.count() + lost.count() == 3000


def test_one_per_key_hashes_only_rows_that_share_the_latest_day(spark, monkeypatch):
    rows = [(1, D(2024, 1, 1), "a"), (1, D(2024, 1, 2), "b"), (1, None, "x"), (2, D(2024, 1, 1), "c"), (None, DAY, "n"), (None, D(2024, 1, 1), "m")]
    df = spark.createDataFrame(rows, "id int, day date, v string")
    monkeypatch.setattr(pick, "fingerprint", lambda *c: F.raise_error(F.lit("hashed")).cast("binary"))
    won, lost = pick.one_per_key(df, ["id"], "day")
    assert sorted(r.v for r in won.collect()) == ["b", "c", "n"] and sorted(r.v for r in lost.collect()) == ["a", "m", "x"]
    monkeypatch.undo()
    undated = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (1, None, "b"), (2, None, "c")], "id int, day date, v string")
    won, lost = pick.one_per_key(undated, ["id"], "day")
    assert won.count() == 2 and {r.v for r in won.unionByName(lost).collect()} == {"a", "b", "c"}


def test_keys_follow_the_natural_order(spark):
    df = spark.range(5000).select(F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("name"))
    numbered = keys.assign_keys(df.repartition(7), ["name"], "no", 100, ranges=8)
    rows = [(r["name"], r["no"]) for r in numbered.orderBy("name").collect()]
    assert [n for _, n in rows] == list(range(101, 5101))


def test_keys_with_nulls_and_few_rows(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", None)], "x string, y int")
    numbered = keys.assign_keys(df, ["x", "y"], "no", 0)
    assert {(r["x"], r["no"]) for r in numbered.collect()} == {(None, 1), ("a", 2), ("b", 3)}


def test_held_by_other_takes_the_smallest_other(spark):
    held = spark.createDataFrame([("v", 1), ("v", 2), ("v", 3), ("w", 5)], "held string, owner int")
    asks = spark.createDataFrame([("v", 1), ("v", 2), ("v", 9), ("w", 5), ("x", 1), (None, 1)], "value string, me int")
    found = lookup.held_by_other(asks, "value", "me", held, "held", "owner", "other")
    got = {(r["value"], r["me"]): r["other"] for r in found.collect()}
    assert got == {("v", 1): 2, ("v", 2): 1, ("v", 9): 1, ("w", 5): 0, ("x", 1): 0, (None, 1): 0}


def test_supervisor(spark):
    people = spark.createDataFrame([("0000007",), ("x",), ("0",)], "adp_id string")
    asks = spark.createDataFrame([("0000007",), ("8",), ("",), ("0",), (None,)], "n string")
    found = lookup.known_supervisor(asks, "n", people, "adp_id", "s")
    assert {r["n"]: r["s"] for r in found.collect()} == {"0000007": 7, "8": 0, "": 0, "0": 0, None: 0}


def test_xref_reject_order(spark):
    xref = spark.createDataFrame(
        [("1", 1, "F1", "", 1, "1", "A1"), ("2", 2, "F2", "", 2, "2", "A2")],
        "old_id string, old_id_num int, adp_id string, ssn string, cx_id int, cx_id_char string, adp_associate_id string",
    )
    batch = spark.createDataFrame(
        [(3, "F3", "A3"), (1, "F1", "A1"), (1, "F9", "A2"), (1, "F2", "A1"), (1, "F2", "A2"), (4, "F1", "A4")],
        "id int, file_number string, employee_assoc_id string",
    ).withColumn("ssn", F.lit("s"))
    got = [(r["after"]["cx_id"], r["after"]["adp_id"], r["after"]["adp_associate_id"], r["action"], r["reason"]) for r in xref_changes(batch, xref).collect()]
    assert sorted(got) == sorted([
        (3, "F3", "A3", "insert", None),
        (1, "F1", "A1", "update", None),
        (1, "F9", "A2", "reject", "associate_id_held"),
        (1, "F2", "A1", "reject", "file_number_held"),
        (1, "F2", "A2", "reject", "associate_id_held"),
        (4, "F1", "A4", "reject", "file_number_held"),
    ])


def test_code_table(spark):
    table = spark.createDataFrame(
        [("a", "same", DAY, None), ("b", "old", DAY, None), ("c", "gone", DAY, DAY)],
        "hrclass string, txt string, active_date date, inactive_date date",
    )
    rows = [("a", "same", DAY), ("b", "new", DAY), ("c", "again", DAY), ("d", "one", D(2024, 1, 1)), ("d", "two", DAY), (" ", "x", DAY)]
    batch = spark.createDataFrame(rows, "job_class_code string, job_class_descr string, pos_effective_date date")
    got = positions.job_class_changes(batch, table, F.lit(DAY)).select("action", "after.hrclass", "after.txt").collect()
    assert sorted(map(tuple, got)) == [
        ("insert", "c", "again"),
        ("insert", "d", "two"),
        ("none", "a", "same"),
        ("reject", "d", "one"),
        ("update", "b", "new"),
    ]


def test_first_filled_slot(spark):
    rows = [("x", "y", "z"), ("", "y", "z"), (None, "", "z"), ("", "", None)]
    df = spark.createDataFrame(rows, "s2 string, s3 string, s4 string")
    picked = first_filled_slot(df, [("s2", 3, {}), ("s3", 4, {}), ("s4", 5, {})], "key", "rank")
    assert sorted(map(tuple, picked.collect())) == [("x", 3), ("y", 4), ("z", 5)]


def test_ended_job_boundaries(spark):
    """Ended yesterday and today are over, tomorrow is not; rank 2 leaves rank 1 alone."""
    jobs = spark.createDataFrame(
        [(1, 1, 10, 1, D(2024, 1, 9)), (2, 2, 10, 1, DAY), (3, 3, 10, 1, D(2024, 1, 11)), (4, 4, 10, 1, None), (5, 5, 10, 1, None)],
        "job_no int, id int, tpos_no int, title_rank int, end_date date",
    )
    places = spark.createDataFrame([(10, "a"), (11, "b")], "tpos_no int, pcn_aggr string")
    wanted = spark.createDataFrame([(1, 1, "b"), (2, 1, "b"), (3, 1, "b"), (4, 2, "b"), (5, 1, "a")], "id int, title_rank int, pcn_aggr string")
    ended = positions.ended_jobs(wanted, jobs, places, F.lit(DAY))
    assert [(r["before"]["job_no"], r["after"]["end_date"]) for r in ended.collect()] == [(3, DAY)]
