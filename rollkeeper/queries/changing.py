"""Changes of contacts, persons and code tables, and the states they lead to."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from rollkeeper.operators import changes as ch
from rollkeeper.operators import dated, people, positions
from rollkeeper.operators.gate import accepted, blank_rule, judged, route
from rollkeeper.operators.pick import one_per_key
from rollkeeper.plans.fan_out import contact_changes, fan_out, gated
from rollkeeper.queries import target_sql as sqls
from rollkeeper.queries import world
from rollkeeper.queries.inputs import (
    CODES_SQL,
    EVENT_DAY,
    ORDER_SNAPSHOTS_SQL,
    codes,
    contacts,
    contacts_sql,
    flat,
    incoming,
    incoming_sql,
    new_orders,
    old_orders,
    sql,
    table,
)

CONTACT = sqls.CONTACT
STUDENT = "DPW"
SEQUENCE_DAY = date(2024, 1, 12)


def today():
    return F.lit(EVENT_DAY)


def _flat_contacts(changes):
    return flat(changes, "aa_no", CONTACT)


def phone_type2(spark, d):
    given = incoming(spark, d).withColumnRenamed("value", "phone")
    return _flat_contacts(dated.set_phone(given, contacts(spark, d), today()))


def _email(spark, d, rule):
    given = incoming(spark, d).withColumnRenamed("value", "email")
    return _flat_contacts(dated.set_email(given, contacts(spark, d), today(), rule=rule))


def email_type2(spark, d):
    return _email(spark, d, "email")


def email_type2_plus_one(spark, d):
    return _email(spark, d, "max_plus_one")


def _sequence(spark, d, rule):
    """Every contact from the cut day on, one after the other, against those before."""
    rows = contacts(spark, d)
    before = F.col("beg_date") < F.lit(SEQUENCE_DAY)
    given = rows.filter(~before).select("id", "aa", F.col("beg_date").alias("day"), F.col("line1").alias("value"))
    return _flat_contacts(dated.dated_sequence(given, rows.filter(before), "value", "line1", "day", today(), rule))


def dated_sequence(spark, d):
    return _sequence(spark, d, "effective")


def dated_sequence_email(spark, d):
    return _sequence(spark, d, "email")


def dated_sequence_hot(spark, d):
    """All contacts of one kind as those of one person: a single key with very many rows."""
    rows = contacts(spark, d).filter(F.col("aa") == "EML2").withColumn("id", F.lit(1).cast("bigint"))
    before = F.col("beg_date") < F.lit(SEQUENCE_DAY)
    given = rows.filter(~before).select("id", "aa", F.col("beg_date").alias("day"), F.col("line1").alias("value"))
    return _flat_contacts(dated.dated_sequence(given, rows.filter(before), "value", "line1", "day", today(), "effective"))


def sequence_sql(rule: str, source: str = "contact") -> str:
    cut = f"DATE '{SEQUENCE_DAY}'"
    given = f"(SELECT id, aa, beg_date AS day, line1 AS value FROM {source} WHERE beg_date >= {cut})"
    return sqls.sequenced(given, f"(SELECT * FROM {source} WHERE beg_date < {cut})", "line1", rule)


DATED_CTES = contacts_sql() + "," + incoming_sql()


def _replaced(spark, d):
    """Per person the address of the newest event; customers without events too."""
    newest = contacts(spark, d).groupBy("id").agg(F.max_by("line1", F.struct("beg_date", "aa_no")).alias("value"))
    people_ = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    value = F.coalesce("value", F.lit("none"))
    return people_.join(newest, "id", "left").select(
        "id",
        value.alias("line1"),
        F.lit("").alias("line2"),
        F.lit("R").alias("line3"),
        F.lit("").alias("city"),
        F.lit("").alias("st"),
        F.lpad(value, 5, "0").alias("zip"),
        F.lit("CAN").alias("ctry"),
        F.lit("262-555-0100").alias("phone"),
    )


REPLACED_SQL = """
replaced AS (
  SELECT c_custkey AS id, coalesce(v, 'none') AS line1, 'R' AS line3, lpad(coalesce(v, 'none'), 5, '0') AS zip,
    'CAN' AS ctry, '262-555-0100' AS phone
  FROM customer LEFT JOIN (SELECT id, arg_max(line1, (beg_date, aa_no)) AS v FROM contact GROUP BY id) ON id = c_custkey)
"""


def archive_address(spark, d):
    return _flat_contacts(dated.archive_address(_replaced(spark, d), contacts(spark, d), today()))


def _known(spark, d):
    targets = world.targets(spark, d)
    return targets, gated(world.batch(spark, d), targets["id_rec"])[0]


def _person(spark, d):
    targets, known = _known(spark, d)
    person, _ = one_per_key(world.persons(known), ["id"], "pos_effective_date")
    return targets, person


def _staff(spark, d):
    targets, person = _person(spark, d)
    return targets, route(person, "payroll_comp_code", STUDENT)[1]


def _matched(spark, d):
    targets, staff = _staff(spark, d)
    return targets, staff, people.match_people(
        staff, targets["id_rec"], targets["title_table"], targets["ctry_table"]
    )


def _titled(spark, d):
    targets, known = _known(spark, d)
    staff = route(known, "payroll_comp_code", STUDENT)[1]
    return targets, accepted(judged(staff, [blank_rule("no_title", "job_title_code")]))


ID_COLUMNS = list(world.ID_REC)


def _person_part(*parts):
    def query(spark, d):
        targets, _, matched = _matched(spark, d)
        return flat(people.person_changes(matched, targets["id_rec"], parts), "id", ID_COLUMNS)

    return query


def contact_fan(spark, d):
    targets, staff, matched = _matched(spark, d)
    return _flat_contacts(contact_changes(staff, matched, targets["aa_rec"], today()))


def contact_fan_sequence(spark, d):
    """The contacts of a fan-out that takes every row of a person, in the order of their effective days."""
    result = fan_out(world.batch(spark, d), world.targets(spark, d), EVENT_DAY, in_sequence=True)
    return _flat_contacts(result.changes["aa_rec"])


def directory_upsert(spark, d):
    """Customers against directory rows made of events."""
    state = contacts(spark, d, world.KEPT_KIND)
    value = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").cast("string").alias("fullname"),
        F.lit("L").alias("location"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_nationkey").cast("string")).alias("phone"),
        F.lit("").alias("ext"),
    )
    return _flat_contacts(dated.set_directory(value, state, today()))


DIRECTORY_SQL = f"""
SELECT CASE WHEN o IS NULL THEN 'insert' WHEN same THEN 'none' ELSE 'update' END AS action,
  CAST(NULL AS VARCHAR) AS reason, o.aa_no AS old_aa_no, c_custkey AS id, 'SCHL' AS aa,
  CASE WHEN o IS NULL THEN {world.TODAY} ELSE o.beg_date END AS beg_date, o.end_date AS end_date,
  CAST(c_nationkey AS VARCHAR) AS line1, 'L' AS line3, coalesce(o.zip, '') AS zip, coalesce(o.ctry, '') AS ctry,
  given AS phone, 'HR' AS ofc_add_by
FROM (
  SELECT *, o.line1 = CAST(c_nationkey AS VARCHAR) AND o.phone = given AS same FROM (
    SELECT *, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS given FROM customer)
  LEFT JOIN (SELECT id AS oid, arg_min(k, aa_no) AS o FROM contact k WHERE aa = 'SCHL' GROUP BY id) ON oid = c_custkey)
"""


def profile_upsert(spark, d):
    targets, staff = _staff(spark, d)
    return flat(people.profile_changes(staff, targets["profile_rec"], today()), "id", list(world.PROFILE))


def xref_upsert(spark, d):
    targets, person = _person(spark, d)
    return flat(people.xref_changes(person, targets["cvid_rec"]), "cx_id", list(world.XREF))


def work_category_upsert(spark, d):
    targets, rows = _titled(spark, d)
    changes = positions.work_category_changes(rows, targets["cc_work_cat_table"], today())
    return flat(changes, "work_cat_code", ["work_cat_code", "work_cat_descr", "active_date"])


def job_class_upsert(spark, d):
    targets, rows = _titled(spark, d)
    return flat(positions.job_class_changes(rows, targets["hrclass_table"], today()), "hrclass", ["hrclass", "txt", "active_date"])


def division_upsert(spark, d):
    targets, rows = _titled(spark, d)
    return flat(positions.division_changes(rows, targets["hrdiv_table"], today()), "hrdiv", ["hrdiv", "descr", "beg_date"])


def dept_upsert(spark, d):
    targets, rows = _titled(spark, d)
    changes = positions.department_changes(rows, targets["hrdept_table"], today())
    return flat(changes, "hrdept", ["hrdept", "descr", "hrdiv", "beg_date"])


def code_table_upsert(spark, d):
    """Nations against the code table that lacks and rewords some."""
    nation = table(spark, d, "nation").select(
        F.col("n_nationkey").alias("c"), F.col("n_name").alias("t"), F.lit(date(2000, 1, 1)).alias("day")
    )
    state = codes(spark, d)
    changes = positions.code_table_changes(nation, state, "c", "code", {"descr": "t"}, "day", {"inactive_date": F.lit(None)})
    return flat(changes, "code", ["code", "descr", "inactive_date"])


CODE_UPSERT_SQL = """
SELECT CASE WHEN code IS NULL THEN 'insert' WHEN descr <> n_name THEN 'update' ELSE 'none' END AS action,
  CAST(NULL AS VARCHAR) AS reason, code AS old_code, n_nationkey AS code, n_name AS descr, inactive_date
FROM nation LEFT JOIN codes ON code = n_nationkey
"""


def apply_changes(spark, d):
    """The contacts after the emails of a run, new rows numbered."""
    state = contacts(spark, d)
    given = incoming(spark, d).withColumnRenamed("value", "email")
    changes = dated.set_email(given, state, today())
    numbered = ch.number_inserts(changes, state, "aa_no", ["id", "aa", "beg_date"])
    return ch.apply_changes(state, numbered, ["aa_no"]).select("aa_no", *CONTACT)


APPLY_SQL = f"""
SELECT aa_no, id, aa, beg_date, end_date, line1, line3, zip, ctry, phone, ofc_add_by FROM contact
WHERE aa_no NOT IN (SELECT old_aa_no FROM changed WHERE action = 'end_date')
UNION ALL
SELECT old_aa_no, {', '.join(CONTACT)} FROM changed WHERE action = 'end_date'
UNION ALL
SELECT (SELECT max(aa_no) FROM contact) + row_number() OVER (ORDER BY id, aa, beg_date), {', '.join(CONTACT)}
FROM changed WHERE action = 'insert'
"""


def run_counts(spark, d):
    """Orders against their older snapshot: what an upsert would do, counted."""
    state = old_orders(spark, d)
    given = new_orders(spark, d).select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("new"))
    changes = ch.upsert(
        given,
        state,
        {"key": "o_orderkey"},
        updates={"o_orderstatus": F.col("new")},
        inserts={"o_orderkey": F.col("key"), "o_orderstatus": F.col("new")},
        when_differs=["o_orderstatus"],
    )
    return ch.run_counts(ch.change_log(changes, "b1", "orders", ["o_orderkey"]))


COUNTS_SQL = """
SELECT 'orders' AS target, CASE WHEN o.o_orderkey IS NULL THEN 'insert'
  WHEN o.o_orderstatus <> n.o_orderstatus THEN 'update' ELSE 'none' END AS action, count(*) AS n
FROM new_o n LEFT JOIN old_o o USING (o_orderkey) GROUP BY ALL
"""


def change_log(spark, d):
    """The log of the phone changes, the value as a keyed hash."""
    given = incoming(spark, d).withColumnRenamed("value", "phone")
    changes = dated.set_phone(given, contacts(spark, d), today())
    log = ch.change_log(changes, "2024-01-28", "aa_rec", ["aa_no"], hide=["phone"], hide_key="k")
    phone = F.get_json_object("after", "$.phone")
    begin = F.get_json_object("after", "$.beg_date")
    return log.select("batch_id", "target", "action", "key", phone.alias("phone_hash"), begin.alias("begins"))


LOG_SQL = """
SELECT '2024-01-28' AS batch_id, 'aa_rec' AS target, action, coalesce(CAST(old_aa_no AS VARCHAR), '') AS key,
  sha256('k:' || sha256('k:' || phone)) AS phone_hash, CAST(beg_date AS VARCHAR) AS begins FROM changed
"""


def _on_world(body: str, more: str = "") -> str:
    return sql(world.WORLD_SQL + ("," + more if more else ""), body)


CROWDED_CTE = """
crowded AS (SELECT * REPLACE (CAST(id // 3 AS VARCHAR) AS file_number,
  'B' || CAST(id // 2 AS VARCHAR) AS employee_assoc_id) FROM person)
"""


def xref_batch_conflicts(spark, d):
    """Persons that ask for the same free ids in one batch: one gets them, the others are rejects."""
    targets, person = _person(spark, d)
    crowded = person.withColumn("file_number", F.expr("CAST(id DIV 3 AS STRING)")).withColumn(
        "employee_assoc_id", F.concat(F.lit("B"), F.expr("CAST(id DIV 2 AS STRING)"))
    )
    return flat(people.xref_changes(crowded, targets["cvid_rec"]), "cx_id", list(world.XREF))


QUERIES = {
    "phone_type2": (phone_type2, sql(DATED_CTES, sqls.dated("incoming", "contact", "phone", "phone"))),
    "email_type2": (email_type2, sql(DATED_CTES, sqls.dated("incoming", "contact", "line1", "email"))),
    "email_type2_plus_one": (
        email_type2_plus_one,
        sql(DATED_CTES, sqls.dated("incoming", "contact", "line1", "max_plus_one")),
    ),
    "dated_sequence": (dated_sequence, sql(contacts_sql(), sequence_sql("effective"))),
    "dated_sequence_email": (dated_sequence_email, sql(contacts_sql(), sequence_sql("email"))),
    "contact_fan_sequence": (contact_fan_sequence, _on_world(sqls.contacts(in_sequence=True))),
    "dated_sequence_hot": (
        dated_sequence_hot,
        sql(
            contacts_sql() + ", one AS (SELECT * REPLACE (CAST(1 AS BIGINT) AS id) FROM contact WHERE aa = 'EML2')",
            sequence_sql("effective", "one"),
        ),
    ),
    "archive_address": (archive_address, sql(contacts_sql() + "," + REPLACED_SQL, sqls.archive("replaced", "contact"))),
    "directory_upsert": (directory_upsert, sql(contacts_sql(world.KEPT_KIND), DIRECTORY_SQL)),
    "contact_fan": (contact_fan, _on_world(sqls.contacts())),
    "person_update": (_person_part("basics"), _on_world(sqls.person(("basics",)))),
    "title_update": (_person_part("title"), _on_world(sqls.person(("title",)))),
    "address_update": (_person_part("address"), _on_world(sqls.person(("address",)))),
    "person_all": (_person_part("basics", "title", "address"), _on_world(sqls.person())),
    "profile_upsert": (profile_upsert, _on_world(sqls.profile())),
    "xref_upsert": (xref_upsert, _on_world(sqls.xref())),
    "xref_batch_conflicts": (xref_batch_conflicts, _on_world(sqls.xref("crowded"), CROWDED_CTE)),
    "work_category_upsert": (work_category_upsert, _on_world(sqls.work_category())),
    "job_class_upsert": (job_class_upsert, _on_world(sqls.job_class())),
    "division_upsert": (division_upsert, _on_world(sqls.division())),
    "dept_upsert": (dept_upsert, _on_world(sqls.department())),
    "code_table_upsert": (code_table_upsert, sql(CODES_SQL, CODE_UPSERT_SQL)),
    "apply_changes": (
        apply_changes,
        sql(DATED_CTES + f", changed AS ({sqls.dated('incoming', 'contact', 'line1', 'email')})", APPLY_SQL),
    ),
    "run_counts": (run_counts, sql(ORDER_SNAPSHOTS_SQL, COUNTS_SQL)),
    "change_log": (
        change_log,
        sql(DATED_CTES + f", changed AS ({sqls.dated('incoming', 'contact', 'phone', 'phone')})", LOG_SQL),
    ),
}
