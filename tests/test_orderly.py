"""Kept fingerprints, days that count, scripts and their replay, overlays, code checks."""

import io
from contextlib import redirect_stdout
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_sources import empty_history, frame, person

from rollkeeper.contract import PEOPLE, STAMP, STAMP_DAY
from rollkeeper.operators import changes as ch
from rollkeeper.operators import judge, script, snapshot
from rollkeeper.plans import ingest as plan
from rollkeeper.plans.ingest import run_ingest
from rollkeeper.sources import tables
from rollkeeper.sources.history import append_history
from rollkeeper.sources.kept import keep_fingerprints, kept_fingerprints
from rollkeeper.sources.tables import TwoWriters, publish, read_table, write_table


def rows(df):
    return sorted(map(repr, (r.asDict(recursive=True) for r in df.collect())))


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    size = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, size)


def test_kept_side_is_not_shuffled(spark, tmp_path, no_broadcast):
    old = spark.createDataFrame([(k, str(k), None if k % 5 else "x") for k in range(300)], "a int, b string, c string")
    new = spark.createDataFrame([(k, str(k - k % 3), None if k % 5 else "x") for k in range(400)] * 2, "a int, b string, c string")
    keep_fingerprints(old, str(tmp_path), "b1", old.columns)
    found = snapshot.snapshot_diff_kept(new, kept_fingerprints(spark, str(tmp_path)))
    text = plan_of(found)  # before it runs, so that it shows one plan
    assert rows(found) == rows(snapshot.snapshot_diff(new, old))
    # one shuffle, and it is of the new side
    assert text.count("\nArguments: hashpartitioning(_fp") == 1 and "Bucketed: true" in text
    assert not spark.catalog.listTables()


def test_kept_fingerprints_of_another_state_are_not_used(spark, tmp_path):
    base = str(tmp_path)
    assert kept_fingerprints(spark, base) is None
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    write_table(df, base, "latest", "b1")
    keep_fingerprints(df, base, "b1", df.columns)
    assert kept_fingerprints(spark, base, "latest") is None  # not in one commit
    assert kept_fingerprints(spark, base).count() == 1


def test_runs_with_and_without_kept_fingerprints(spark, tmp_path):
    """Three nights; the kept run finds the same rows, and one that broke off is caught up with."""
    nights = [
        [person(carth_id="1"), person(carth_id="2", last_name="b")],
        [person(carth_id="1", last_name="new"), person(carth_id="2", last_name="b"), person(carth_id="3")],
        [person(carth_id="1"), person(carth_id="2", last_name="b"), person(carth_id="3", ssn="9")],
    ]
    found = {}
    for keep in (False, True):
        base, path = str(tmp_path / f"base{keep}"), str(tmp_path / f"history{keep}")
        history = empty_history(spark)
        for k, night in enumerate(nights):
            done = run_ingest(frame(spark, night), history, path, datetime(2024, 1, k + 1), state_base=base, keep=keep, mode="per_key")
            found[keep, k] = rows(done.new_rows)
            history = read_table(spark, base, "latest")
    assert all(found[True, k] == found[False, k] for k in range(3))
    assert [len(found[True, k]) for k in range(3)] == [2, 2, 2]


def test_only_days_that_count_are_read(spark, tmp_path):
    """One person's newest row is of the first day that counts; the day between holds nobody's."""
    path = str(tmp_path / "history")
    for day, ids in ((1, [1, 2, 3]), (2, [2, 3]), (3, [2, 3]), (4, [3])):
        df = spark.createDataFrame([(i, f"{i}-{day}") for i in ids], "id int, v string")
        append_history(df.withColumn(STAMP, F.lit(datetime(2024, 1, day))), path)
    stored = spark.read.parquet(path).filter("id > 1")
    for mode in ("stamp_in", "per_key"):
        pruned = snapshot.latest_snapshot(stored, ["id"], STAMP, mode, STAMP_DAY)
        whole = snapshot.latest_snapshot(stored.drop(STAMP_DAY), ["id"], STAMP, mode)
        assert rows(pruned.select(whole.columns)) == rows(whole)
        text = plan_of(pruned)
        assert "dynamicpruning" in text and "2024-01-03" in text  # days found at run time, and none before the first
    none = snapshot.latest_snapshot(stored.filter("id > 9"), ["id"], STAMP, "stamp_in", STAMP_DAY)
    assert none.count() == 0


def test_ingest_reads_a_history_by_day(spark, tmp_path):
    path = str(tmp_path / "history")
    first = plan.ingest(frame(spark, [person(carth_id="1"), person(carth_id="2")]), empty_history(spark), datetime(2024, 1, 1))
    append_history(first.new_rows, path)
    stored = spark.read.parquet(path)
    again = plan.ingest(frame(spark, [person(carth_id="1", ssn="7"), person(carth_id="2")]), stored, datetime(2024, 1, 2))
    assert [r["carthage_id"] for r in again.new_rows.collect()] == [1]
    assert set(again.new_rows.columns) == {*PEOPLE.history_names, STAMP}


STATE = "id int, name string, day date"


def _batch(spark, state, wanted):
    given = spark.createDataFrame(wanted, "k int, v string")
    return ch.upsert(given, state, {"k": "id"}, {"name": F.col("v")}, {"id": F.col("k"), "name": F.col("v")}, when_differs=["name"])


def test_replay_over_batches_and_on_the_wrong_state(spark):
    state = spark.createDataFrame([(1, "a", None), (2, 'b "x"', None), (3, "c", None)], STATE)
    first = _batch(spark, state, [(1, "a"), (2, "B\n"), (4, "d")])
    one = script.change_script({"t": first}, {"t": ["id"]}, "b1", ["t"])
    assert [(r.seq, r.action, r.key) for r in one.orderBy("seq").collect()] == [(1, "update", "2"), (2, "insert", "4")]
    after = ch.apply_changes(state, first, ["id"])
    assert rows(script.replay(state, one, "t", ["id"])) == rows(after)
    second = _batch(spark, after, [(4, "D"), (1, "A")])
    two = script.change_script({"t": second}, {"t": ["id"]}, "b2", ["t"])
    both = one.unionByName(two)
    assert rows(script.replay(state, both, "t", ["id"])) == rows(ch.apply_changes(after, second, ["id"]))
    assert script.unfit(state, both, "t", ["id"]).count() == 0
    assert rows(script.replay(state, both, "other", ["id"])) == rows(state)
    # replayed again: 2 is changed already, 4 is there
    assert sorted(r.seq for r in script.unfit(after, one, "t", ["id"]).collect()) == [1, 2]


def test_script_order_is_by_step_then_end_update_insert(spark):
    state = spark.createDataFrame([(k, str(k), None) for k in range(6)], STATE)
    schema = ch.row_type(state)
    ended = state.filter("id < 2").select(F.struct("*").alias("before"))
    ends = ch.emit(ended, F.array(ch.change(ch.END, schema, ch.row_after(schema, {"day": F.lit(datetime(2024, 1, 1).date())}, "before"), True)))
    mixed = _batch(spark, state, [(3, "x"), (9, "y"), (8, "z"), (4, "4")]).unionByName(ends)
    out = script.change_script({"jobs": mixed, "codes": _batch(spark, state, [(7, "n")])}, {"jobs": ["id"], "codes": ["id"]}, "b", ["codes", "places", "jobs"])
    got = [(r.target, r.action, r.key) for r in out.orderBy("seq").collect()]
    assert got == [("codes", "insert", "7"), ("jobs", "end_date", "0"), ("jobs", "end_date", "1"), ("jobs", "update", "3"), ("jobs", "insert", "8"), ("jobs", "insert", "9")]
    assert [r.seq for r in out.orderBy("seq").collect()] == list(range(1, 7))


def test_overlay_is_the_next_state_of_what_was_asked(spark):
    state = spark.createDataFrame([(k, f"n{k % 4}", None) for k in range(20)], STATE)
    changes = _batch(spark, state, [(1, "n0"), (4, "other"), (30, "n0"), (31, "n9"), (5, "n1")])
    after = ch.apply_changes(state, changes, ["id"])
    for column, asked in (("name", ["n0", "n9"]), ("id", [1, 4, 6, 30, 77])):
        wanted = spark.createDataFrame([(a,) for a in asked], f"x {'string' if column == 'name' else 'int'}")
        got = ch.overlay(state, changes, ["id"], column, wanted)
        assert rows(got) == rows(after.filter(F.col(column).isin(asked)))


def test_two_writers_are_found(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    df = spark.createDataFrame([(1,)], "a int")
    write_table(df, base, "t", "b1")
    known = tables._manifest(spark, base)
    taken = spark.createDataFrame([(2, "other", "t", -1, "x", True)], tables.MANIFEST)
    real, calls = tables._manifest, []

    def before_the_other(s, b):
        calls.append(1)
        if len(calls) == 1:
            out = spark.createDataFrame(known.collect(), tables.MANIFEST)
            taken.write.mode("append").parquet(f"{base}/{tables.PUBLISHED}")
            return out
        return real(s, b)

    monkeypatch.setattr(tables, "_manifest", before_the_other)
    with pytest.raises(TwoWriters):
        publish(spark, base, "b2", {"t": {-1: "y"}})


def test_code_checks(spark):
    tables_ = {
        "t": spark.createDataFrame([("a", "A"), ("b", "B"), ("b", "A2"), (None, "N")], "c string, d string"),
        "n": spark.createDataFrame([(1,), (2,)], "c int"),
    }
    df = spark.createDataFrame([(1, "a", "1"), (2, "b", "3"), (3, "z", None), (4, None, "2"), (5, "a", "1")], "id int, x string, y string")
    checks = [judge.Check("t", "x", "c", "d"), judge.Check("n", "x", "c"), judge.Check("n", "y", "c")]
    judged = judge.code_judgements(df, tables_, checks)
    assert {(r.table, r.code, r.known, r.text) for r in judged.collect()} == {
        ("t", "a", True, "A"), ("t", "b", True, "A2"), ("t", "z", False, None), ("t", None, False, None),
        ("n", "a", False, None), ("n", "b", False, None), ("n", "z", False, None), ("n", None, False, None),
        ("n", "1", True, None), ("n", "2", True, None), ("n", "3", False, None),
    }
    marked = judge.with_judgements(df, judged, checks)
    assert plan_of(marked).count("Join (") + plan_of(marked).count("Join LeftOuter (") <= 2 * 2  # one join a column
    said = marked.select("id", *[judge.is_known(c).alias(f"k{i}") for i, c in enumerate(checks)], judge.text_for(checks[0]).alias("t"))
    assert [tuple(r) for r in said.orderBy("id").collect()] == [
        (1, True, False, True, "A"), (2, True, False, False, "A2"), (3, False, False, False, ""), (4, False, False, True, ""), (5, True, False, True, "A"),
    ]
    warned = judge.judged_warnings(df, tables_, {"w1": checks[0], "w2": checks[2]}, ["id"])
    assert {tuple(r) for r in warned.collect()} == {(3, "w1", "z"), (4, "w1", None), (2, "w2", "3"), (3, "w2", None)}


def test_a_replay_broadcasts_nothing(spark):
    """Rows of JSON text are far larger than their files: none of them goes through the driver."""
    state = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    rows = [("b1", 1, "t", "update", "1", '{"id":1,"x":"a"}', '{"id":1,"x":"c"}'), ("b1", 2, "t", "insert", "3", None, '{"id":3,"x":"d"}')]
    one = spark.createDataFrame(rows, "batch_id string, seq bigint, target string, action string, key string, before string, after string")
    changes = one.select("action", F.from_json("before", state.schema).alias("before"), F.from_json("after", state.schema).alias("after"))
    after = [(1, "c"), (2, "b"), (3, "d")]
    found = script.replay(state, one, "t", ["id"]), ch.apply_changes(state, changes, ["id"], merged=True), script.unfit(state, one, "t", ["id"])
    assert sorted(map(tuple, found[0].collect())) == sorted(map(tuple, found[1].collect())) == after and found[2].count() == 0
    for df in found:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
