"""Work that must not grow with the number of columns or of uses."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rollkeeper.contract import STAMP
from rollkeeper.operators import chains, pick, places, snapshot, spread
from rollkeeper.operators.snapshot import snapshot_diff
from rollkeeper.plans import ingest as ingest_plan
from rollkeeper.queries import whole, world
from rollkeeper.sources.history import append_history

FOLDER = Path("/root/testdata/sf0.001")


def test_repeats_are_folded_as_one_value(spark):
    names = [f"c{k}" for k in range(90)]
    rows = [tuple(f"{r}" for _ in names) for r in (1, 1, 2, 3)]
    schema = ", ".join(f"{c} string" for c in names)
    new, old = spark.createDataFrame(rows, schema), spark.createDataFrame(rows[3:], schema)
    out = snapshot_diff(new, old)
    assert out.columns == names
    assert sorted(tuple(r) for r in out.collect()) == [rows[0], rows[2]]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("first(") <= 4  # not one for each column


@pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")
def test_derived_targets_are_stored_and_the_batch_is_spread(spark):
    targets = world.targets(spark, str(FOLDER))
    for name in ("pos_table", "job_rec"):
        plan = targets[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
    assert "Repartition" in world.batch(spark, str(FOLDER))._jdf.queryExecution().optimizedPlan().toString()


def test_chains_are_not_broadcast(spark, monkeypatch):
    """Chains take many rounds; none of their tables goes through the driver."""
    plans = []
    real = chains.written

    def planned(df, name="step"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(chains, "written", planned)
    steps = spark.createDataFrame([(str(k), str(k + 1)) for k in range(9)] + [("x", "y"), ("y", "x")], "a string, b string")
    lost = chains.doomed(steps, spark.createDataFrame([("5",)], "n string"))
    assert {r.n for r in lost.collect()} == {"0", "1", "2", "3", "4", "5", "x", "y"}
    assert not any("Broadcast" in p for p in plans)


def test_a_day_of_history_is_not_written_by_every_task(spark, tmp_path):
    rows = spark.range(400).repartition(8).selectExpr("id", f"timestamp'2024-01-01' + make_interval(0, 0, 0, int(id % 5)) AS {STAMP}")
    append_history(rows, str(tmp_path / "history"))
    assert len(list((tmp_path / "history").glob("*/*.parquet"))) <= 5
    assert spark.read.parquet(str(tmp_path / "history")).count() == 400


@pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")
def test_a_sync_stores_wide_rows_once(spark, monkeypatch):
    """Only keys of rows are dealt out and stored between the steps; repeats and rejects come out whole."""
    widths = {}
    for module in (ingest_plan, snapshot, spread, places):
        real = module.written

        def noted(df, name="step", real=real):
            widths.setdefault(name, []).append(len(df.columns))
            return real(df, name)

        monkeypatch.setattr(module, "written", noted)
    feed = whole.feed(spark, str(FOLDER)).drop("o_orderdate")
    run = ingest_plan.ingest(feed.unionAll(feed), whole.stored(spark, str(FOLDER)), whole.MOMENT)
    assert [name for name, found in widths.items() if max(found) > 20] == ["cleaned-feed"]
    once = ingest_plan.ingest(feed, whole.stored(spark, str(FOLDER)), whole.MOMENT)
    assert run.new_rows.count() == once.new_rows.count() > 0
    assert run.skipped.count() == once.skipped.count() > 0
    unreadable = once.rejects.filter("reject_reason like 'bad_value:%'").count()
    assert run.rejects.count() == once.rejects.count() + unreadable and unreadable > 0


def test_rows_are_picked_by_their_places(spark):
    rows = places.placed(spark.range(0, 70_000, 1, 3).withColumn("x", F.col("id") * 2), "rows")
    some = rows.filter("id % 7 = 3 or id in (0, 32767, 32768, 69999)")
    found = places.at_places(rows, some)
    assert found.columns == rows.columns
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in some.collect())
    assert places.at_places(rows, some.limit(0)).count() == 0


def test_one_row_per_key_of_placed_rows_stores_no_wide_rows(spark, monkeypatch):
    """Winners and losers are the same as without places: ties, repeats, null days and null keys too."""
    names = [f"c{k}" for k in range(30)]
    values = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "x"), ("b", None, "x"), (None, 3, "x"), (None, 1, "x"), ("c", 4, "x"), ("c", 4, "x")]
    df = spark.createDataFrame([(k, d, *[v] * 30) for k, d, v in values], "k string, d int, " + ", ".join(f"{c} string" for c in names))
    plain = [sorted(map(repr, part.collect())) for part in pick.one_per_key(df, ["k"], "d")]
    widths = {}

    def noted(df, name="step", real=pick.written):
        widths[name] = len(df.columns)
        return real(df, name)

    monkeypatch.setattr(pick, "written", noted)
    parts = pick.one_per_key(places.placed(df, "rows"), ["k"], "d")
    assert [part.columns for part in parts] == [df.columns] * 2
    assert [sorted(map(repr, part.collect())) for part in parts] == plain
    assert widths["marked"] == 3
