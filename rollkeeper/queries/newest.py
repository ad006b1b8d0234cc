"""Newest recorded state, snapshot difference, seen-before check, picks."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from rollkeeper.operators import pick, snapshot
from rollkeeper.plans.ingest import refresh_latest
from rollkeeper.queries.inputs import (
    CUT_DAY,
    HISTORY_SQL,
    ORDER_SNAPSHOTS_SQL,
    contacts,
    contacts_sql,
    fingerprint_sql,
    history,
    new_orders,
    old_orders,
    sql,
    table,
)
from rollkeeper.session import shared_folder
from rollkeeper.sources.history import append_history, stamped


def latest_stamp_in(spark, d):
    return snapshot.latest_snapshot(history(spark, d), ["id", "name"], "stamp", "stamp_in")


def latest_refreshed(spark, d):
    """The newest state kept from batch to batch equals that of the whole history."""
    rows = history(spark, d).withColumnRenamed("stamp", "date_stamp")
    before = F.to_date("date_stamp") < F.lit(CUT_DAY)
    old = snapshot.latest_snapshot(rows.filter(before), ["id", "name"], "date_stamp")
    now = refresh_latest(old, rows.filter(~before), ("id", "name"))
    return now.withColumnRenamed("date_stamp", "stamp")


def latest_per_key(spark, d):
    return snapshot.latest_snapshot(history(spark, d), ["id", "name"], "stamp", "per_key")


def latest_by_id(spark, d):
    return snapshot.latest_snapshot(history(spark, d), ["id"], "stamp", "per_key")


def latest_single(spark, d):
    rows = history(spark, d).select("id", "name", "stamp", "row_no")
    return snapshot.latest_snapshot(rows, ["id"], "stamp", "single")


def snapshot_diff(spark, d):
    return snapshot.snapshot_diff(new_orders(spark, d), old_orders(spark, d))


def snapshot_diff_except(spark, d):
    return new_orders(spark, d).subtract(old_orders(spark, d))


def diff_dedupe(spark, d):
    return snapshot.drop_repeats(new_orders(spark, d).select("o_custkey", "o_orderstatus", "o_orderpriority"))


def diff_blank_null(spark, d):
    """Null on one side meets blank on the other."""

    def rows(df, blank):
        status = F.when(F.col("o_orderstatus") == "P", blank).otherwise(F.col("o_orderstatus"))
        return df.select("o_orderkey", status.alias("status"))

    new = rows(new_orders(spark, d), F.lit(""))
    old = rows(old_orders(spark, d), F.lit(None).cast("string"))
    return snapshot.snapshot_diff(new, old, blank_is_null=True)


def _verified(status, day):
    """Candidate or stored rows: number text, text, date."""
    return [
        F.col("id"),
        F.col("name"),
        status.alias("status"),
        day.alias("day"),
    ]


def verify_not_latest(spark, d):
    hist = history(spark, d)
    latest = snapshot.latest_snapshot(hist, ["id"], "stamp", "per_key")
    day = F.when(F.col("name") != "2-HIGH", F.to_date("stamp"))
    stored_status = F.when(F.col("status") != "P", F.col("status"))
    stored = latest.select(F.col("row_no").cast("string").alias("file_no"), *_verified(stored_status, day))
    padded = F.lpad(F.col("row_no").cast("string"), 12, "0")
    changed = F.when(F.col("name") == "1-URGENT", "X").otherwise(F.col("status"))
    candidates = hist.select(padded.alias("file_no"), *_verified(changed, day))
    columns = ["file_no", "id", "name", "status", "day"]
    return snapshot.not_in_latest(candidates, stored, columns, dates=["day"], numbers=["file_no", "id"])


VERIFY_SQL = sql(
    HISTORY_SQL
    + """,
stored AS (
  SELECT row_no, id, name, CASE WHEN status <> 'P' THEN status END AS status,
    CASE WHEN name <> '2-HIGH' THEN CAST(stamp AS DATE) END AS day
  FROM hist h WHERE stamp = (SELECT max(stamp) FROM hist g WHERE g.id = h.id)),
cand AS (
  SELECT row_no, lpad(CAST(row_no AS VARCHAR), 12, '0') AS file_no, id, name,
    CASE WHEN name = '1-URGENT' THEN 'X' ELSE status END AS status,
    CASE WHEN name <> '2-HIGH' THEN CAST(stamp AS DATE) END AS day
  FROM hist)
""",
    """
SELECT file_no, id, name, status, day FROM cand c WHERE NOT EXISTS (
  SELECT 1 FROM stored s WHERE s.row_no = CAST(c.file_no AS BIGINT) AND s.id = c.id AND s.name = c.name
    AND s.status = c.status AND s.day IS NOT DISTINCT FROM c.day)
""",
)


def newest_begin(spark, d):
    return pick.newest(contacts(spark, d), ["id", "aa"], "beg_date")


def newest_open_begin(spark, d):
    rows = contacts(spark, d).filter((F.col("aa") == "PREV") & F.col("end_date").isNull())
    return pick.newest(rows, ["id", "aa", "line1"], "beg_date")


def pick_one(spark, d):
    rows = contacts(spark, d).select("aa_no", "id", "aa", "line1", "beg_date")
    return pick.pick_one(rows, ["id", "aa"], F.col("aa_no"))


def _batch(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("status")
    )


def batch_winners(spark, d):
    return pick.one_per_key(_batch(spark, d), ["id"], "day")[0]


def batch_conflicts(spark, d):
    return pick.one_per_key(_batch(spark, d), ["id"], "day")[1]


def batch_conflicts_hot(spark, d):
    """A status that holds a third of the orders as the key."""
    rows = table(spark, d, "orders").select(
        F.col("o_orderstatus").alias("id"), F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("row_no")
    )
    return pick.one_per_key(rows, ["id"], "day")[1]


def batch_sql(wanted: str) -> str:
    return f"""
WITH b AS (
  SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS status,
    {fingerprint_sql("o_custkey", "CAST(o_orderdate AS DATE)", "o_orderstatus")} AS fp FROM orders),
best AS (SELECT *, first_value(fp) OVER (PARTITION BY id ORDER BY day DESC, fp DESC) AS win FROM b)
{wanted}
"""


HOT_SQL = f"""
WITH b AS (
  SELECT o_orderstatus AS id, CAST(o_orderdate AS DATE) AS day, o_orderkey AS row_no,
    {fingerprint_sql("o_orderstatus", "CAST(o_orderdate AS DATE)", "o_orderkey")} AS fp FROM orders),
best AS (SELECT *, first_value(fp) OVER (PARTITION BY id ORDER BY day DESC, fp DESC) AS win FROM b)
SELECT id, day, row_no FROM best WHERE fp <> win
"""

MOMENT = datetime(2001, 9, 1, 1, 0, 0, 123456)


def append_history_query(spark, d):
    """The history after the difference of two snapshots was added to it."""
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    day = F.date_trunc("year", "o_orderdate").cast("timestamp").alias("date_stamp")
    old = old_orders(spark, d).join(table(spark, d, "orders").select("o_orderkey", day), "o_orderkey")
    path = f"{shared_folder(spark)}/history-{uuid.uuid4().hex}"
    append_history(old.select(*names, "date_stamp"), path)
    seen = spark.read.parquet(path)
    fresh = snapshot.snapshot_diff(new_orders(spark, d), seen.select(*names))
    append_history(stamped(fresh, MOMENT), path)
    after = spark.read.parquet(path)
    return after.select(*names, F.col("date_stamp").cast("timestamp_ntz").alias("date_stamp"))


APPEND_SQL = sql(
    ORDER_SNAPSHOTS_SQL,
    """
SELECT old_o.*, CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS date_stamp FROM old_o JOIN orders USING (o_orderkey)
UNION ALL
SELECT *, TIMESTAMP '2001-09-01 01:00:00.12345' FROM (SELECT * FROM new_o EXCEPT SELECT * FROM old_o)
""",
)

QUERIES = {
    "latest_stamp_in": (
        latest_stamp_in,
        sql(
            HISTORY_SQL,
            "SELECT * FROM hist WHERE stamp IN (SELECT s FROM (SELECT max(stamp) AS s FROM hist GROUP BY id, name))",
        ),
    ),
    "latest_refreshed": (
        latest_refreshed,
        sql(
            HISTORY_SQL,
            "SELECT * FROM hist WHERE stamp IN (SELECT s FROM (SELECT max(stamp) AS s FROM hist GROUP BY id, name))",
        ),
    ),
    "latest_per_key": (
        latest_per_key,
        sql(
            HISTORY_SQL,
            "SELECT hist.* FROM hist JOIN (SELECT id, name, max(stamp) AS stamp FROM hist GROUP BY id, name) "
            "USING (id, name, stamp)",
        ),
    ),
    "latest_by_id": (
        latest_by_id,
        sql(HISTORY_SQL, "SELECT * FROM hist h WHERE stamp = (SELECT max(stamp) FROM hist g WHERE g.id = h.id)"),
    ),
    "latest_single": (
        latest_single,
        sql(
            HISTORY_SQL,
            "SELECT id, name, stamp, row_no FROM (SELECT *, row_number() OVER (PARTITION BY id "
            "ORDER BY stamp DESC, name, row_no) AS rn FROM hist) WHERE rn = 1",
        ),
    ),
    "snapshot_diff": (snapshot_diff, sql(ORDER_SNAPSHOTS_SQL, "SELECT * FROM new_o EXCEPT SELECT * FROM old_o")),
    "snapshot_diff_except": (
        snapshot_diff_except,
        sql(ORDER_SNAPSHOTS_SQL, "SELECT * FROM new_o EXCEPT SELECT * FROM old_o"),
    ),
    "diff_dedupe": (diff_dedupe, "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders"),
    "diff_blank_null": (
        diff_blank_null,
        sql(
            ORDER_SNAPSHOTS_SQL,
            "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS status FROM "
            "(SELECT o_orderkey, o_orderstatus FROM new_o EXCEPT SELECT o_orderkey, o_orderstatus FROM old_o)",
        ),
    ),
    "verify_not_latest": (verify_not_latest, VERIFY_SQL),
    "newest_begin": (
        newest_begin,
        sql(contacts_sql(), "SELECT id, aa, max(beg_date) AS beg_date FROM contact GROUP BY id, aa"),
    ),
    "newest_open_begin": (
        newest_open_begin,
        sql(
            contacts_sql(),
            "SELECT id, aa, line1, max(beg_date) AS beg_date FROM contact WHERE aa = 'PREV' AND end_date IS NULL "
            "GROUP BY id, aa, line1",
        ),
    ),
    "pick_one": (
        pick_one,
        sql(
            contacts_sql(),
            "SELECT aa_no, id, aa, line1, beg_date FROM (SELECT *, row_number() OVER (PARTITION BY id, aa "
            "ORDER BY aa_no) AS rn FROM contact) WHERE rn = 1",
        ),
    ),
    "batch_winners": (batch_winners, batch_sql("SELECT DISTINCT id, day, status FROM best WHERE fp = win")),
    "batch_conflicts": (batch_conflicts, batch_sql("SELECT id, day, status FROM best WHERE fp <> win")),
    "batch_conflicts_hot": (batch_conflicts_hot, HOT_SQL),
    "append_history": (append_history_query, APPEND_SQL),
}
