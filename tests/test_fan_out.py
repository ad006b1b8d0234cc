from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rollkeeper.plans.fan_out import KEYS, fan_out, run_fan_out
from rollkeeper.queries import world
from rollkeeper.sources.tables import append_log, read_table, table_folders

FOLDER = "/root/testdata/sf0.001"
DAY = date(2024, 1, 28)

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("state"))
    targets = world.targets(spark, FOLDER)
    batch = world.batch(spark, FOLDER)
    log = run_fan_out(batch, targets, DAY, "b1", base, second_jobs=world.second_jobs(spark, FOLDER))
    return base, targets, batch, log


def state(spark, ran, table):
    return read_table(spark, ran[0], table)


def test_every_target_has_a_next_state(spark, ran):
    for table in KEYS:
        if table != "second_job":
            assert state(spark, ran, table).columns == ran[1][table].columns


@pytest.mark.parametrize("table", ["id_rec", "aa_rec", "profile_rec", "cvid_rec", "pos_table", "job_rec", "hremp_rec"])
def test_keys_stay_unique(spark, ran, table):
    df = state(spark, ran, table)
    assert df.select(*KEYS[table]).distinct().count() == df.count()
    assert df.filter(F.col(KEYS[table][0]).isNull()).count() == 0


def test_counts_add_up(spark, ran):
    counts = {(r["target"], r["action"]): r["n"] for r in ran[3].groupBy("target", "action").agg(F.count("*").alias("n")).collect()}
    for table in ("aa_rec", "profile_rec", "cvid_rec", "pos_table", "hremp_rec"):
        grown = state(spark, ran, table).count() - ran[1][table].count()
        assert grown == counts.get((table, "insert"), 0)
    jobs = state(spark, ran, "job_rec").count() - ran[1]["job_rec"].count()
    assert jobs == counts.get(("job_rec", "insert"), 0) + counts.get(("second_job", "insert"), 0)
    assert state(spark, ran, "id_rec").count() == ran[1]["id_rec"].count()


def test_positions_are_unique_and_known_to_jobs(spark, ran):
    positions = state(spark, ran, "pos_table")
    assert positions.select("pcn_aggr").distinct().count() == positions.count()
    jobs = state(spark, ran, "job_rec")
    assert jobs.join(positions, "tpos_no", "left_anti").count() == 0


def test_log_is_written_and_hides_personal_data(spark, ran):
    log = spark.read.parquet(f"{ran[0]}/change_log")
    assert log.count() == ran[3].count()
    row = log.filter("target = 'id_rec'").first()
    shown = row["after"]
    assert " Street" not in shown


def test_a_batch_that_runs_again_replaces_its_log(spark, tmp_path):
    row = spark.createDataFrame([("b1", 1), ("b1", 2)], "batch_id string, n int")
    append_log(row, str(tmp_path), "log")
    append_log(row.withColumn("batch_id", F.lit("b2")), str(tmp_path), "log")
    append_log(row.limit(1), str(tmp_path), "log")
    counts = spark.read.parquet(f"{tmp_path}/log").groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in counts} == {"b1": 1, "b2": 2}


def test_second_run_changes_no_code_and_no_position(spark, ran):
    targets = {**ran[1], **{t: state(spark, ran, t) for t in KEYS if t != "second_job"}}
    again = fan_out(ran[2], targets, DAY)
    for table in ("cc_work_cat_table", "hrclass_table", "hrdiv_table", "hrdept_table", "pos_table"):
        actions = {r["action"] for r in again.changes[table].select("action").distinct().collect()}
        assert actions <= {"none", "reject"}, table


def test_dry_run_writes_no_target(spark, ran, tmp_path):
    run_fan_out(ran[2], ran[1], DAY, "b1", str(tmp_path), apply=False)
    assert list(tmp_path.iterdir()) == []


def test_a_finished_batch_runs_again_on_its_own_state(spark, ran):
    """The same batch once more, on the published tables: what did not change stays the same files."""
    base = ran[0]
    before = {t: table_folders(spark, base, t) for t in KEYS if t != "second_job"}
    rows = {t: state(spark, ran, t).count() for t in before}
    again = run_fan_out(ran[2], ran[1], DAY, "b1", base, from_base=True)
    after = {t: table_folders(spark, base, t) for t in before}
    for table in ("cc_work_cat_table", "hrclass_table", "hrdiv_table", "hrdept_table", "pos_table"):
        assert before[table] == after[table], table
    kept = ("id_rec", "pos_table", "hremp_rec", "cvid_rec")  # second jobs are not given again, so jobs do change
    assert {t: state(spark, ran, t).count() for t in kept} == {t: rows[t] for t in kept}
    assert again.filter(F.col("target").isin(*kept) & (F.col("action") == "insert")).count() == 0


def test_a_small_batch_leaves_other_buckets_alone(spark, ran):
    base = ran[0]
    before = table_folders(spark, base, "id_rec")
    one = ran[2].filter("carth_id <> ''").orderBy("carth_id").limit(1)
    run_fan_out(one, ran[1], DAY, "b2", base, from_base=True)
    after = table_folders(spark, base, "id_rec")
    assert len(before) > 10 and sum(before[n] != after[n] for n in before) <= 1


def test_rejects_of_both_plans_have_one_shape(spark, ran):
    rejects = spark.read.parquet(f"{ran[0]}/rejects")
    assert set(rejects.columns) == {"batch_id", "stage", "reason", "row"}
    assert rejects.count() > 0 and rejects.filter("row LIKE '%Customer%'").count() == 0
