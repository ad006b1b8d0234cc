"""Runs that store what they find: target tables by batch, rejects, logs, files, history."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeeper.contract import CORRUPT, PEOPLE, STAMP
from rollkeeper.operators import gate
from rollkeeper.operators.changes import apply_changes
from rollkeeper.operators.script import change_script, replay, unfit
from rollkeeper.plans.fan_out import KEYS, STEP_TABLES, STEPS, fan_out, run_fan_out
from rollkeeper.plans.ingest import clean
from rollkeeper.queries import target_sql as sqls
from rollkeeper.queries import whole, world
from rollkeeper.queries.changing import _on_world
from rollkeeper.queries.inputs import EVENT_DAY, flat, sql, table
from rollkeeper.queries.jobs import SLOTS_CTE, _slots
from rollkeeper.session import shared_folder, written
from rollkeeper.sources.feed import write_csv, write_difference
from rollkeeper.sources.history import append_history, read_history
from rollkeeper.sources.quoted import read_quoted
from rollkeeper.sources.tables import read_table, reject_rows, write_attempt, write_table


def _base(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def table_rerun(spark, d):
    """Orders per customer, kept as a table. Batch b10 comes after b9 and runs twice, the
    second time on what it made itself; an attempt that was not published counts for nothing."""
    base = _base(spark, "tables")
    orders = table(spark, d, "orders").select("o_custkey", F.lit(1).alias("n"))

    def added(state, rows):
        return state.unionByName(rows).groupBy("o_custkey").agg(F.sum("n").alias("n"))

    write_table(added(orders.limit(0), orders), base, "per_customer", "b9")
    urgent = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select("o_custkey", F.lit(1).alias("n"))
    write_table(added(read_table(spark, base, "per_customer"), urgent), base, "per_customer", "b10")
    write_table(added(read_table(spark, base, "per_customer"), urgent.limit(0)), base, "per_customer", "b10")
    write_attempt(orders, base, "per_customer", "b11")
    now, before = read_table(spark, base, "per_customer"), read_table(spark, base, "per_customer", "b9")
    return now.join(before.withColumnRenamed("n", "n_before"), "o_custkey")


RERUN_SQL = """
SELECT o_custkey, CAST(count(*) + count(*) FILTER (o_orderpriority = '1-URGENT') AS BIGINT) AS n,
  count(*) AS n_before FROM orders GROUP BY o_custkey
"""

KEY = "not a secret"


def reject_log(spark, d):
    """The rejects of a fan-out in their stored form; names are keyed hashes."""
    rejects = fan_out(world.batch(spark, d), world.targets(spark, d), EVENT_DAY).rejects
    return reject_rows(rejects, "2024-01-28", "fan_out", gate.REASON, ["payroll_name"], KEY)


REJECT_LOG_SQL = f"""
SELECT '2024-01-28' AS batch_id, 'fan_out' AS stage, reject_reason AS reason,
  '{{' || CASE WHEN id IS NULL THEN '' ELSE '"id":' || id || ',' END || '"payroll_name":"'
  || sha256('{KEY}:' || sha256('{KEY}:' || payroll_name)) || '","file_number":"' || file_number || '"}}' AS row
FROM ({whole.FAN_REJECTS_SQL})
"""


def fan_out_second(spark, d):
    """What a fan-out does to second jobs, found in the slots of their rows: persons must be
    known and no students, and jobs are looked up as the same batch leaves them."""
    result = fan_out(world.batch(spark, d), world.targets(spark, d), EVENT_DAY, second_jobs=_slots(spark, d))
    return flat(result.changes["second_job"], "job_no", sqls.JOB_OUT)


def fan_out_second_rejects(spark, d):
    """Second jobs of persons that are not known are rejects."""
    result = fan_out(world.batch(spark, d), world.targets(spark, d), EVENT_DAY, second_jobs=_slots(spark, d))
    return result.rejects.filter("payroll_name IS NULL").select("id", gate.REASON)


GATED_CTE = f"""
{SLOTS_CTE.strip()},
gated_second AS (SELECT * FROM slots WHERE id IN (SELECT id FROM id_rec)
  AND id NOT IN (SELECT id FROM person WHERE payroll_comp_code = 'DPW'))
"""
SECOND_STEPS = ",".join(
    [
        sqls.PLACED_SQL,
        sqls.JOBS_CTES,
        sqls.JOBS_NEXT_CTES,
        GATED_CTE,
        sqls.second_ctes("gated_second", "job_next"),
    ]
)


def fan_out_applied(spark, d):
    """A fan-out that is applied: its stored log, counted, and the tables it has published."""
    base = _base(spark, "fan-out")
    targets = world.targets(spark, d)
    run_fan_out(world.batch(spark, d), targets, EVENT_DAY, "b1", base)
    log = spark.read.parquet(f"{base}/change_log").groupBy("target", "action").agg(F.count(F.lit(1)).alias("n"))
    grown = [
        read_table(spark, base, t).select(F.lit(t).alias("target"), F.lit("rows").alias("action"))
        for t in ("id_rec", "job_rec", "pos_table")
    ]
    rows = grown[0].unionByName(grown[1]).unionByName(grown[2])
    return log.unionByName(rows.groupBy("target", "action").agg(F.count(F.lit(1)).alias("n")))


APPLIED_SQL = f"""
SELECT target, action, count(*) AS n FROM ({whole._LOG}) GROUP BY ALL
UNION ALL SELECT 'id_rec', 'rows', count(*) FROM id_rec
UNION ALL SELECT 'job_rec', 'rows', (SELECT count(*) FROM job_rec) + count(*) FROM ({sqls.job()}) WHERE action = 'insert'
UNION ALL SELECT 'pos_table', 'rows', (SELECT count(*) FROM pos_table) + count(*) FROM ({sqls.position()})
  WHERE action = 'insert'
"""

def _scripted(spark, d):
    targets = world.targets(spark, d)
    steps = fan_out(world.batch(spark, d), targets, EVENT_DAY, second_jobs=_slots(spark, d)).numbered(targets)
    return targets, steps, written(change_script(steps, KEYS, "b1", STEPS, STEP_TABLES), "script")


def script_order(spark, d):
    """Where each table's changes stand in the script of a fan-out, second jobs included."""
    script = _scripted(spark, d)[2]
    # second jobs are changes of the same table and come last
    last = F.when((F.col("target") == "job_rec") & (F.col("seq") > F.lit(script.filter("target = 'hremp_rec'").agg(F.min("seq")).first()[0])), "second")
    return script.groupBy("target", "action", F.coalesce(last, F.lit("")).alias("part")).agg(
        F.min("seq").alias("first"), F.max("seq").alias("last"), F.count(F.lit(1)).alias("n")
    )


_ORDERED = [
    ("cc_work_cat_table", sqls.work_category()),
    ("hrclass_table", sqls.job_class()),
    ("hrdiv_table", sqls.division()),
    ("hrdept_table", sqls.department()),
    ("pos_table", sqls.position()),
    ("id_rec", sqls.person()),
    ("profile_rec", sqls.profile()),
    ("cvid_rec", sqls.xref()),
    ("aa_rec", sqls.contacts()),
    ("job_rec", sqls.job()),
    ("hremp_rec", sqls.employment()),
    ("second_job", sqls.second_job()),
]
_COUNTED = "\nUNION ALL\n".join(
    f"SELECT {place} AS place, '{step}' AS step, action, count(*) AS n FROM ({body}) GROUP BY action"
    for place, (step, body) in enumerate(_ORDERED)
)
SCRIPT_SQL = f"""
SELECT CASE step WHEN 'second_job' THEN 'job_rec' ELSE step END AS target, action,
  CASE step WHEN 'second_job' THEN 'second' ELSE '' END AS part,
  CAST(sum(n) OVER w - n + 1 AS BIGINT) AS first, CAST(sum(n) OVER w AS BIGINT) AS last, n
FROM ({_COUNTED}) WHERE action IN ('insert', 'update', 'end_date')
WINDOW w AS (ORDER BY place, CASE action WHEN 'end_date' THEN 1 WHEN 'update' THEN 2 ELSE 3 END)
"""


def replay_log(spark, d):
    """Every table rebuilt from the last state and the script alone: its rows, how many the
    script changed, in how many it is unlike the applied state, and changes that don't fit.

    The tables' figures are found one table after the other: else all their joins would run,
    and what these broadcast would lie in the driver, at once."""
    targets, steps, script = _scripted(spark, d)
    out = []
    for target in dict.fromkeys(STEP_TABLES.get(s, s) for s in STEPS):
        key, state = KEYS[target], targets[target]
        applied = apply_changes(state, steps[target], key, merged=True)
        if target == "job_rec":
            applied = apply_changes(applied, steps["second_job"], key, merged=True)
        rebuilt = written(replay(state, script, target, key), "rebuilt")
        applied = written(applied, "applied")
        differ = rebuilt.exceptAll(applied).unionByName(applied.exceptAll(rebuilt)).agg(F.count(F.lit(1)).alias("unlike"))
        changed = script.filter(F.col("target") == target).agg(F.count(F.lit(1)).alias("changed"))
        rows = rebuilt.agg(F.count(F.lit(1)).alias("rows"))
        bad = unfit(state, script, target, key).agg(F.count(F.lit(1)).alias("unfit"))
        figures = rows.crossJoin(changed).crossJoin(differ).crossJoin(bad).withColumn("target", F.lit(target))
        out.append(written(figures, "figures"))
    return reduce(DataFrame.unionByName, out)


REPLAY_SQL = f"""
SELECT target, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(changed) AS BIGINT) AS changed, CAST(0 AS BIGINT) AS unlike, CAST(0 AS BIGINT) AS unfit FROM (
  SELECT CASE step WHEN 'second_job' THEN 'job_rec' ELSE step END AS target,
    CASE action WHEN 'insert' THEN n ELSE 0 END AS rows, n AS changed FROM ({_COUNTED}) WHERE action IN ('insert', 'update', 'end_date')
  UNION ALL {" UNION ALL ".join(f"SELECT '{step}', count(*), 0 FROM {step}" for step, _ in _ORDERED if step != "second_job")})
GROUP BY target
"""


def dry_run(spark, d):
    """A fan-out that isn't applied: its log, the applied run's beside it, and whether it has written anything."""
    dry, real = _base(spark, "dry"), _base(spark, "applied")
    targets, batch = world.targets(spark, d), world.batch(spark, d)

    def counted(log, name):
        return log.groupBy("target", "action").agg(F.count(F.lit(1)).alias(name))

    found = written(counted(run_fan_out(batch, targets, EVENT_DAY, "b1", dry, apply=False), "n"), "dry")
    applied = counted(run_fan_out(batch, targets, EVENT_DAY, "b1", real), "n_applied")
    place = spark._jvm.org.apache.hadoop.fs.Path(dry)
    stored = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return found.join(applied, ["target", "action"], "full").withColumn("stored", F.lit(bool(stored)))


DRY_SQL = f"SELECT target, action, count(*) AS n, count(*) AS n_applied, false AS stored FROM ({whole._LOG}) GROUP BY target, action"

SOME = ["carth_id", "file_number", "payroll_name", "long_title", "birth_date", "home_phone"]


def difference_files(spark, d):
    """Cleaned rows written as a difference file and read back as text."""
    rows = clean(whole.feed(spark, d).drop("o_orderdate")).drop(gate.REASON)
    path = _base(spark, "difference")
    write_difference(rows, path, PEOPLE)
    back = spark.read.option("header", True).option("escape", '"').csv(path).select(*SOME)
    return back.na.fill("")


#: Small enough that one file is read by several tasks; larger for large feeds, as every task reports to the driver.
RANGE = "spark.sql.files.maxPartitionBytes"
LEAST_RANGE, MOST_RANGES = 16384, 2000


def range_bytes(spark, path: str) -> int:
    """The size of the ranges into which the files of ``path`` are cut: not more than some ``MOST_RANGES`` ranges."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stored = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    return max(LEAST_RANGE, -(-stored // MOST_RANGES))


def feed_quoted_lines(spark, d):
    """Orders as a feed whose values hold line breaks, quotes and commas; each file is cut into many ranges."""
    path = _base(spark, "quoted")
    note = F.expr(
        "concat(o_orderpriority, '\\n', repeat(concat('\"', o_orderstatus, '\", '), CAST(o_orderkey % 5 AS INT)), '\\r\\n\\n', o_orderkey)"
    )
    write_csv(table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("Key"), note.alias("Note"), "o_orderstatus"), path)
    size = spark.conf.get(RANGE)
    spark.conf.set(RANGE, str(range_bytes(spark, path)))
    try:
        back = read_quoted(spark, path, ["Key", "Note", "o_orderstatus"])
    finally:
        spark.conf.set(RANGE, size)
    return back.select("Key", "Note", "o_orderstatus", CORRUPT)


QUOTED_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS Key, o_orderpriority || chr(10) || repeat('"' || o_orderstatus || '", ', CAST(o_orderkey % 5 AS INT))
  || chr(10) || chr(10) || o_orderkey AS Note, o_orderstatus, CAST(NULL AS VARCHAR) AS _corrupt_record FROM orders
"""


def history_read(spark, d):
    """The history as it is stored and read under its contract."""
    path = _base(spark, "history")
    append_history(whole.stored(spark, d), path)
    back = read_history(spark, path, PEOPLE)
    return back.select("carthage_id", "file_no", "fullname", F.col(STAMP).cast("timestamp_ntz").alias(STAMP))


QUERIES = {
    "table_rerun": (table_rerun, RERUN_SQL),
    "reject_log": (reject_log, _on_world(REJECT_LOG_SQL)),
    "fan_out_second": (fan_out_second, _on_world(sqls.second_job(), SECOND_STEPS)),
    "fan_out_second_rejects": (
        fan_out_second_rejects,
        _on_world(
            "SELECT id, 'unknown_person_id' AS reject_reason FROM slots WHERE id NOT IN (SELECT id FROM id_rec)", SLOTS_CTE
        ),
    ),
    "script_order": (script_order, _on_world(SCRIPT_SQL, SECOND_STEPS)),
    "replay_log": (replay_log, _on_world(REPLAY_SQL, SECOND_STEPS)),
    "dry_run": (dry_run, _on_world(DRY_SQL, whole._STEPS)),
    "fan_out_applied": (fan_out_applied, _on_world(APPLIED_SQL, whole._STEPS)),
    "difference_files": (
        difference_files,
        sql(
            whole.INGEST_CTES,
            "SELECT "
            + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in SOME)
            + " FROM cleaned",
        ),
    ),
    "feed_quoted_lines": (feed_quoted_lines, QUOTED_SQL),
    "history_read": (
        history_read,
        sql(
            whole.INGEST_CTES,
            "SELECT CAST(carth_id AS INT) AS carthage_id, file_number AS file_no, payroll_name AS fullname,"
            " CAST(date_stamp AS TIMESTAMP) AS date_stamp FROM hist",
        ),
    ),
}
