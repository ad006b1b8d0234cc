"""Ids that move between persons, kept fingerprints, and a history read by the days that count."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rollkeeper.contract import STAMP, STAMP_DAY
from rollkeeper.operators import judge, people, snapshot
from rollkeeper.queries import target_sql as sqls
from rollkeeper.queries import world
from rollkeeper.queries.inputs import CUT_DAY, HISTORY_SQL, ORDER_SNAPSHOTS_SQL, flat, history, new_orders, old_orders, sql, table
from rollkeeper.session import shared_folder
from rollkeeper.sources.history import append_history
from rollkeeper.sources.kept import keep_fingerprints, kept_fingerprints

# Customers in blocks of fifty, by the place in their block: a chain of fifty, swaps, chains of two
# (some with both ids), a ring of fifty, a chain whose last number is kept, and contests.
_BLOCK, _PLACE = "(c_custkey {div} 50)", "(c_custkey % 50)"
_NUMBER = f"""CASE {_BLOCK} % 6
  WHEN 0 THEN CASE WHEN {_PLACE} < 49 THEN CAST(c_custkey + 1 AS {{text}}) ELSE concat('N', CAST(c_custkey AS {{text}})) END
  WHEN 1 THEN CAST(CASE WHEN c_custkey % 2 = 0 THEN c_custkey + 1 ELSE c_custkey - 1 END AS {{text}})
  WHEN 2 THEN CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey + 1 AS {{text}}) ELSE concat('N', CAST(c_custkey AS {{text}})) END
  WHEN 3 THEN CAST(CASE WHEN {_PLACE} < 49 THEN c_custkey + 1 ELSE c_custkey - 49 END AS {{text}})
  WHEN 4 THEN CAST(CASE WHEN {_PLACE} < 26 THEN c_custkey + 1 ELSE c_custkey END AS {{text}})
  ELSE CASE WHEN {_PLACE} % 10 = 9 THEN CAST(c_custkey - 1 AS {{text}}) ELSE concat('N', CAST(c_custkey {{div}} 3 AS {{text}})) END END"""
_ASSOCIATE = f"""CASE WHEN {_BLOCK} % 12 <> 2 THEN concat('A', CAST(c_custkey AS {{text}}))
  WHEN c_custkey % 2 = 0 THEN concat('A', CAST(c_custkey + 1 AS {{text}})) ELSE concat('B', CAST(c_custkey AS {{text}})) END"""
_ASKED = {"file_number": _NUMBER, "employee_assoc_id": _ASSOCIATE, "id": "CAST(c_custkey AS INT)", "ssn": "c_phone"}
_STORED = {
    "old_id": "CAST(c_custkey AS {text})",
    "old_id_num": "CAST(c_custkey AS INT)",
    "adp_id": "CAST(c_custkey AS {text})",
    "ssn": "''",
    "cx_id": "CAST(c_custkey AS INT)",
    "cx_id_char": "CAST(c_custkey AS {text})",
    "adp_associate_id": "concat('A', CAST(c_custkey AS {text}))",
}


def _named(columns: dict[str, str], text: str, div: str) -> list[str]:
    return [f"{e.format(text=text, div=div)} AS {n}" for n, e in columns.items()]


def _chains(spark, d):
    """The batch (some persons have no row in it) and the stored table (some persons are new)."""
    customer = table(spark, d, "customer").withColumn("c_phone", F.col("c_mktsegment"))
    batch = customer.filter("c_custkey % 97 <> 0").selectExpr(*_named(_ASKED, "STRING", "DIV"))
    stored = customer.filter("c_custkey % 89 <> 0").selectExpr(*_named(_STORED, "STRING", "DIV"))
    return batch, stored


def xref_release_chain(spark, d):
    """File numbers and associate ids that move along chains of persons, and rings of those who swap them."""
    batch, stored = _chains(spark, d)
    return flat(people.xref_in_order(batch, stored), "cx_id", list(world.XREF))


_SQL = {"text": "VARCHAR", "div": "//"}
RELEASE_CTES = f"""
buyer AS (SELECT *, c_mktsegment AS c_phone FROM customer),
asked AS (SELECT {", ".join(_named(_ASKED, **_SQL))} FROM buyer WHERE c_custkey % 97 <> 0),
cvid_rec AS (SELECT {", ".join(_named(_STORED, **_SQL))} FROM buyer WHERE c_custkey % 89 <> 0),
claim AS (SELECT id, 'a' AS kind, employee_assoc_id AS v FROM asked UNION ALL SELECT id, 'f', file_number FROM asked),
held AS (SELECT cx_id AS id, 'a' AS kind, adp_associate_id AS v FROM cvid_rec UNION ALL SELECT cx_id, 'f', adp_id FROM cvid_rec),
kept AS (SELECT held.* FROM held LEFT JOIN claim USING (id, kind) WHERE claim.v IS NULL OR claim.v = held.v),
freed AS (SELECT held.* FROM held JOIN claim USING (id, kind) WHERE claim.v <> held.v),
blocked AS (SELECT DISTINCT c.id, kind FROM claim c JOIN kept k USING (kind, v) WHERE k.id <> c.id),
waits AS (SELECT DISTINCT c.id AS a, g.id AS b, kind FROM claim c JOIN freed g USING (kind, v) WHERE g.id <> c.id),
reach AS (SELECT a, b FROM waits UNION SELECT reach.a, waits.b FROM reach JOIN waits ON reach.b = waits.a),
first_lost AS (SELECT id FROM blocked UNION SELECT a FROM reach WHERE a = b),
lost AS (SELECT id FROM first_lost UNION SELECT a FROM reach WHERE b IN (SELECT id FROM first_lost)),
able AS (SELECT *, min(id) OVER (PARTITION BY employee_assoc_id) < id AS a_beaten FROM asked WHERE id NOT IN (SELECT id FROM lost)),
beaten AS (SELECT id, 'a' AS kind FROM able WHERE a_beaten UNION ALL SELECT id, 'f' FROM (
  SELECT id, min(id) OVER (PARTITION BY file_number) < id AS f_beaten FROM able WHERE NOT a_beaten) WHERE f_beaten),
refused AS (SELECT id FROM lost UNION SELECT id FROM beaten UNION SELECT a FROM reach WHERE b IN (SELECT id FROM beaten)),
judged AS (SELECT asked.*, x.cx_id AS mine, asked.id IN (SELECT id FROM refused) AS no,
  asked.id IN (SELECT id FROM blocked WHERE kind = 'a') OR asked.id IN (SELECT id FROM beaten WHERE kind = 'a')
  OR asked.id IN (SELECT a FROM waits WHERE kind = 'a' AND b IN (SELECT id FROM refused)) AS by_a
  FROM asked LEFT JOIN cvid_rec x ON x.cx_id = asked.id)
"""
RELEASE_SQL = sqls.one(
    "CASE WHEN no THEN 'reject' WHEN mine IS NULL THEN 'insert' ELSE 'update' END",
    "CASE WHEN NOT no THEN mine END",
    "cx_id",
    {
        "old_id": "CAST(id AS VARCHAR)",
        "old_id_num": "id",
        "adp_id": "file_number",
        "ssn": "ssn",
        "cx_id": "id",
        "cx_id_char": "CAST(id AS VARCHAR)",
        "adp_associate_id": "employee_assoc_id",
    },
    "judged",
    "CASE WHEN no AND by_a THEN 'associate_id_held' WHEN no THEN 'file_number_held' END",
)

def diff_kept(spark, d):
    """The difference of two snapshots when the old one's fingerprints were kept in buckets."""
    base = f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"
    new = new_orders(spark, d)
    keep_fingerprints(old_orders(spark, d), base, "b1", new.columns)
    return snapshot.snapshot_diff_kept(new, kept_fingerprints(spark, base))


def stored_by_day(spark, d):
    """The orders as a history stored by day, stamped with the first day of their quarter."""
    path = f"{shared_folder(spark)}/by-day-{uuid.uuid4().hex}"
    rows = history(spark, d).withColumn(STAMP, F.date_trunc("quarter", "stamp")).drop("stamp")
    append_history(rows, path)
    return spark.read.parquet(path)


def latest_pruned(spark, d):
    """Urgent orders were recorded until the cut day only; the newest rows of each priority, by customer group."""
    rows = stored_by_day(spark, d).filter((F.col("name") != "1-URGENT") | (F.col(STAMP) < F.lit(CUT_DAY)))
    rows = rows.withColumn("kind", F.col("id") % 5)
    newest = snapshot.latest_snapshot(rows, ["kind", "name"], STAMP, "stamp_in", STAMP_DAY)
    return newest.select("id", "name", "row_no", "status", F.col(STAMP).cast("timestamp_ntz").alias("stamp"))


def latest_pruned_per_key(spark, d):
    newest = snapshot.latest_snapshot(stored_by_day(spark, d), ["id", "name"], STAMP, "per_key", STAMP_DAY)
    return newest.select("id", "name", "row_no", "status", F.col(STAMP).cast("timestamp_ntz").alias("stamp"))


#: Table, its key, its text, and the batch's column that holds its codes.
JUDGED = [
    ("func_table", "func", None, "home_dept_code"),
    ("hrdept_table", "hrdept", "descr", "home_dept_code"),
    ("hrdiv_table", "hrdiv", "descr", "business_unit_code"),
    ("hrpay_table", "hrpay", None, "payroll_comp_code"),
    ("ctry_table", "ctry", None, "primary_country_code"),
    ("hrclass_table", "hrclass", "txt", "job_class_code"),
]


def code_judgements(spark, d):
    """Each distinct code of a batch, judged once against its table."""
    checks = [judge.Check(t, column, key, text) for t, key, text, column in JUDGED]
    return judge.code_judgements(world.batch(spark, d), world.targets(spark, d), checks)


def code_judgement_rows(spark, d):
    """What the judgements say of each row: codes that are not known, and the department's stored text."""
    checks = [judge.Check(t, column, key, text) for t, key, text, column in JUDGED]
    rows = world.batch(spark, d).select("carth_id", "pos_effective_date", *dict.fromkeys(c for *_, c in JUDGED))
    marked = judge.with_judgements(rows, judge.code_judgements(rows, world.targets(spark, d), checks), checks)
    unknown = [F.when(~judge.is_known(c), F.lit(c.table)) for c in checks]
    return marked.select("carth_id", "pos_effective_date", F.concat_ws(",", *unknown).alias("unknown"), judge.text_for(checks[1]).alias("text"))


JUDGED_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS "table", {column} AS code, max(k.code) IS NOT NULL AS known, min(said) AS text FROM batch
  LEFT JOIN (SELECT {key} AS code, {text or "CAST(NULL AS VARCHAR)"} AS said FROM {t}) k ON k.code = {column} GROUP BY {column}"""
    for t, key, text, column in JUDGED
)
_UNKNOWN = ", ".join(f"CASE WHEN coalesce({column} NOT IN (SELECT {key} FROM {t}), true) THEN '{t}' END" for t, key, _, column in JUDGED)
JUDGED_ROWS_SQL = f"""
SELECT carth_id, pos_effective_date, concat_ws(',', {_UNKNOWN}) AS unknown,
  coalesce((SELECT min(descr) FROM hrdept_table WHERE hrdept = home_dept_code), '') AS text FROM batch
"""

QUARTER_CTES = (
    HISTORY_SQL
    + f""",
quarter AS (SELECT * REPLACE (CAST(date_trunc('quarter', stamp) AS TIMESTAMP) AS stamp) FROM hist),
kinds AS (SELECT *, id % 5 AS kind FROM quarter WHERE name <> '1-URGENT' OR stamp < DATE '{CUT_DAY}')
"""
)

QUERIES = {
    "xref_release_chain": (xref_release_chain, sql("RECURSIVE " + RELEASE_CTES.strip(), RELEASE_SQL)),
    "code_judgements": (code_judgements, sql(world.WORLD_SQL, JUDGED_SQL)),
    "code_judgement_rows": (code_judgement_rows, sql(world.WORLD_SQL, JUDGED_ROWS_SQL)),
    "diff_kept": (diff_kept, sql(ORDER_SNAPSHOTS_SQL, "SELECT * FROM new_o EXCEPT SELECT * FROM old_o")),
    "latest_pruned": (
        latest_pruned,
        sql(
            QUARTER_CTES,
            "SELECT id, name, row_no, status, stamp FROM kinds WHERE stamp IN (SELECT max(stamp) FROM kinds GROUP BY kind, name)",
        ),
    ),
    "latest_pruned_per_key": (
        latest_pruned_per_key,
        sql(
            QUARTER_CTES,
            "SELECT id, name, row_no, status, stamp FROM (SELECT *, max(stamp) OVER (PARTITION BY id, name) AS top FROM quarter) "
            "WHERE stamp = top",
        ),
    ),
}
