"""Fan-out: one batch of new or changed rows to the changes of every target table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeeper.functions import codes, text
from rollkeeper.operators import dated, gate, people, positions
from rollkeeper.operators.changes import END, INSERT, UPDATE, apply_changes, change_log, number_inserts, overlay, run_counts
from rollkeeper.operators.judge import Check, judged_warnings
from rollkeeper.operators.lookup import exists_in, missing_in
from rollkeeper.operators.pick import CONFLICT, one_per_key
from rollkeeper.operators.places import placed as with_places
from rollkeeper.operators.script import change_script
from rollkeeper.operators.spread import narrowed
from rollkeeper.session import steps_of_a_run, written
from rollkeeper.sources.tables import (
    append_log,
    bucket_of,
    hidden,
    publish,
    read_table,
    reject_rows,
    store_rejects,
    write_attempt,
)

NO_ID = "no_person_id"
UNKNOWN_ID = "unknown_person_id"
NO_TITLE = "no_job_title_code"

# Key of each target, and the generated key with the natural key
# that orders it.
KEYS = {
    "id_rec": ["id"],
    "aa_rec": ["aa_no"],
    "profile_rec": ["id"],
    "cvid_rec": ["cx_id"],
    "cc_work_cat_table": ["work_cat_code"],
    "hrclass_table": ["hrclass", "inactive_date"],
    "hrdiv_table": ["hrdiv"],
    "hrdept_table": ["hrdept"],
    "pos_table": ["tpos_no"],
    "job_rec": ["job_no"],
    "hremp_rec": ["id"],
    "second_job": ["job_no"],
}
GENERATED = {
    "aa_rec": ("aa_no", ["id", "aa", "beg_date"]),
    "job_rec": ("job_no", ["id", "tpos_no"]),
    "second_job": ("job_no", ["id", "tpos_no"]),
}
#: The order in which a script carries changes out, and the table of a step with a name of its own.
STEPS = [
    "cc_work_cat_table", "hrclass_table", "hrdiv_table", "hrdept_table", "pos_table",
    "id_rec", "profile_rec", "cvid_rec", "aa_rec", "job_rec", "hremp_rec", "second_job",
]
STEP_TABLES = {"second_job": "job_rec"}
BY_PERSON = ["id_rec", "aa_rec", "profile_rec", "job_rec", "hremp_rec"]
PERSONAL = [
    "ss_no", "ssn", "line1", "line2", "line3", "addr_line1", "addr_line2", "addr_line3", "phone", "zip",
    "payroll_name", "fullname", "lastname", "firstname", "middlename", "ss_first", "ss_middle", "ss_last", "birth_date",
]

# Columns that describe the person, not one of the person's positions.
PERSON_COLUMNS = [
    "id",
    "file_number",
    "payroll_name",
    "last_name",
    "first_name",
    "middle_name",
    "salutation",
    "primary_address1",
    "primary_address2",
    "primary_address3",
    "primary_city",
    "primary_state_code",
    "primary_zip",
    "primary_country_code",
    "home_phone",
    "mobile_phone",
    "personal_email",
    "wc_work_email",
    "ssn",
    "gender",
    "race",
    "ethnicity",
    "birth_date",
    "employee_assoc_id",
    "location_code",
    "room_number",
]


@dataclass(frozen=True)
class FanOut:
    """Changes per target. ``second_job`` holds further changes to ``job_rec``, made
    on the state that ``job_rec`` has after its own."""

    changes: dict[str, DataFrame]
    rejects: DataFrame
    warnings: DataFrame

    def log(self, batch_id: str, hide: list[str] | None = None, hide_key: str | None = None) -> DataFrame:
        """The change log of all targets."""
        logs = [
            change_log(changes, batch_id, target, KEYS[target], hide, hide_key)
            for target, changes in self.changes.items()
        ]
        return reduce(DataFrame.unionByName, logs)

    def numbered(self, targets: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The changes, stored, with a number for every new row of a generated key."""
        steps = {}
        for target, changes in self.changes.items():
            if target == "job_rec" and "second_job" in self.changes:
                steps[target] = changes  # numbered before the second jobs were worked out
            elif target in GENERATED:
                key, natural = GENERATED[target]
                table = STEP_TABLES.get(target, target)
                steps[target] = number_inserts(changes, targets[table], key, natural, steps.get(table))
            else:
                steps[target] = written(changes, f"changes-{target}")
        return steps

    def counts(self, batch_id: str) -> DataFrame:
        return run_counts(self.log(batch_id))


def gated(batch: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of known persons with ``id`` as a number, and the rejects."""
    numbered = batch.withColumn("id", F.col("carth_id").try_cast("int"))
    marked = gate.judged(numbered, [(NO_ID, F.col("id").isNull())])
    with_id = gate.accepted(marked)
    unknown = missing_in(with_id, "id", known, "id").withColumn(gate.REASON, F.lit(UNKNOWN_ID))
    return exists_in(with_id, "id", known, "id"), gate.rejected(marked).unionByName(unknown)


def contact_changes(
    person: DataFrame, matched: DataFrame, contacts: DataFrame, as_of, email_rule: str = "email", rows: DataFrame | None = None
) -> DataFrame:
    """Replaced addresses, both emails, mobile phone and directory row.

    ``rows``: all rows of the persons; their emails and phones are then taken one after the
    other, by effective day, and not those of the one row of ``person`` only.
    """
    each, day = (person, []) if rows is None else (rows, ["pos_effective_date"])
    archived = dated.archive_address(people.replaced_addresses(matched), contacts, as_of)
    emails = each.select(
        "id",
        *day,
        F.explode(
            F.array(
                F.struct(F.lit(dated.PRIVATE_EMAIL).alias("aa"), F.col("personal_email").alias("email")),
                F.struct(F.lit(dated.WORK_EMAIL).alias("aa"), F.col("wc_work_email").alias("email")),
            )
        ).alias("_e"),
    ).select("id", *day, "_e.*")
    emails = gate.filled(emails, "email")
    phones = gate.filled(each, "mobile_phone").select(
        "id", *day, F.lit(dated.CELL).alias("aa"), text.phone(F.col("mobile_phone")).alias("phone")
    )
    if rows is None:
        mailed = dated.set_email(emails, contacts, as_of, rule=email_rule)
        phoned = dated.set_phone(phones, contacts, as_of)
    else:
        mailed = dated.dated_sequence(emails, contacts, "email", "line1", *day, as_of, email_rule)
        phoned = dated.dated_sequence(phones, contacts, "phone", "phone", *day, as_of, "phone")
    directory = person.select(
        "id",
        F.col("payroll_name").alias("fullname"),
        text.location(codes.building(F.col("location_code")), F.col("room_number")).alias("location"),
        F.lit("").alias("phone"),
        F.lit("").alias("ext"),
    )
    listed = dated.set_directory(directory, contacts, as_of)
    return reduce(DataFrame.unionByName, [archived, mailed, phoned, listed])


def fan_out(
    batch: DataFrame,
    targets: dict[str, DataFrame],
    as_of: date,
    second_jobs: DataFrame | None = None,
    email_rule: str = "email",
    in_sequence: bool = False,
) -> FanOut:
    """Changes of every target for a batch of cleaned rows (short names).

    ``targets`` holds the current target and code tables by name. Students get
    their id cross-reference only. ``second_jobs`` is the separate input of
    further positions, one per row or in three slots; persons that are not known are
    rejects there too, and students get none. With ``in_sequence`` the emails and phones of
    all rows of a person count, by effective day. Nothing is written to the targets here.
    """
    today = F.lit(as_of)
    known, rejects = gated(batch, targets["id_rec"])
    known = with_places(known, "fan-out-batch")

    persons = known.groupBy(*PERSON_COLUMNS, "payroll_comp_code").agg(
        F.max("pos_effective_date").alias("pos_effective_date")
    )
    person, other = one_per_key(written(persons, "fan-out-persons"), ["id"], "pos_effective_date")
    person = written(person, "fan-out-person")
    conflicts = other.select("id", "payroll_name", "file_number", F.lit(CONFLICT).alias(gate.REASON))
    _, staff = gate.route(person, "payroll_comp_code", codes.STUDENT_PAY_CODE)
    _, staff_rows = gate.route(known, "payroll_comp_code", codes.STUDENT_PAY_CODE)

    asked = person.select("id")
    near = {t: narrowed(targets[t], "id", asked) for t in BY_PERSON}
    matched = people.match_people(staff, near["id_rec"], targets["title_table"], targets["ctry_table"])
    changes = {
        "id_rec": people.person_changes(matched, near["id_rec"]),
        "aa_rec": contact_changes(staff, matched, near["aa_rec"], today, email_rule, staff_rows if in_sequence else None),
        "profile_rec": people.profile_changes(staff, near["profile_rec"], today),
        "cvid_rec": people.xref_changes(person, targets["cvid_rec"]),
    }

    titled = gate.judged(staff_rows, [gate.blank_rule(NO_TITLE, "job_title_code")])
    jobs = gate.accepted(titled)
    changes |= {
        "cc_work_cat_table": positions.work_category_changes(jobs, targets["cc_work_cat_table"], today),
        "hrclass_table": positions.job_class_changes(jobs, targets["hrclass_table"], today),
        "hrdiv_table": positions.division_changes(jobs, targets["hrdiv_table"], today),
        "hrdept_table": positions.department_changes(jobs, targets["hrdept_table"], today),
    }
    # Keys and numbers of positions come from small stored tables, so the wide rows are read
    # with them where they are used, and not stored anew.
    keyed = positions.with_position_key(jobs, targets["func_table"])
    placed = number_inserts(
        positions.position_changes(keyed, targets["pos_table"], today),
        targets["pos_table"],
        "tpos_no",
        ["pcn_aggr"],
    )
    next_positions = apply_changes(targets["pos_table"], placed, KEYS["pos_table"])
    numbered = positions.with_position_number(keyed, next_positions)
    job_changes = positions.job_changes(
        numbered, near["job_rec"], next_positions, targets["cvid_rec"], today
    )
    changes |= {
        "pos_table": placed,
        "job_rec": job_changes,
        "hremp_rec": positions.employment_changes(numbered, near["hremp_rec"]),
    }
    second_rejects, second_warnings = [], None
    if second_jobs is not None:
        key, natural = GENERATED["job_rec"]
        changes["job_rec"] = number_inserts(changes["job_rec"], targets["job_rec"], key, natural)
        if "pcn_aggr" not in second_jobs.columns:
            second_jobs = positions.second_job_slots(second_jobs)
        strangers = missing_in(second_jobs, "id", targets["id_rec"], "id")
        reason = F.when(F.col("id").isNull(), NO_ID).otherwise(UNKNOWN_ID)
        second_rejects.append(
            strangers.select(
                "id", F.lit(None).cast("string").alias("payroll_name"), F.lit(None).cast("string").alias("file_number"), reason.alias(gate.REASON)
            )
        )
        students, _ = gate.route(person, "payroll_comp_code", codes.STUDENT_PAY_CODE)
        wanted = missing_in(exists_in(second_jobs, "id", targets["id_rec"], "id"), "id", students, "id")
        wanted = written(wanted, "second-jobs-gated")
        # of the jobs as the batch leaves them, those of its persons and, for titles, of its positions
        after = [targets["job_rec"], changes["job_rec"], [key]]
        theirs = overlay(*after, "id", written(wanted.select("id").distinct(), "second-persons"))
        places = next_positions.join(wanted.select("pcn_aggr").distinct(), "pcn_aggr", "left_semi").select("tpos_no")
        titled_jobs = overlay(*after, "tpos_no", written(places, "second-positions"))
        changes["second_job"] = positions.second_job_changes(
            wanted, theirs, next_positions, targets["func_table"], today, titled_jobs
        )
        second_warnings = positions.second_job_warnings(wanted, targets, ["id"])
    checks = {
        "unknown_function_code": Check("func_table", "_dept", "func"),
        "unknown_pay_code": Check("hrpay_table", "payroll_comp_code", "hrpay"),
    }
    untitled = gate.rejected(titled)
    all_rejects = [
        df.select("id", "payroll_name", "file_number", gate.REASON) for df in (rejects, untitled, conflicts)
    ]
    warnings = judged_warnings(keyed, targets, checks, ["id", "payroll_name"])
    if second_warnings is not None:
        warnings = warnings.unionByName(second_warnings, allowMissingColumns=True)
    return FanOut(
        changes=changes,
        rejects=reduce(DataFrame.unionByName, [*all_rejects, *second_rejects]),
        warnings=warnings,
    )


def run_fan_out(
    batch: DataFrame,
    targets: dict[str, DataFrame],
    as_of: date,
    batch_id: str,
    base: str,
    apply: bool = True,
    hide_key: str | None = None,
    from_base: bool = False,
    keep_script: bool = False,
    **options,
) -> DataFrame:
    """Fan out, write log and next states unless it is a dry run; returns the log.

    All tables are written first and published in one commit. Personal data is logged
    as a hash with ``hide_key``, without one not at all. With ``from_base`` the target
    tables are those that ``base`` holds, not ``targets``, which then need only have the
    code tables that no run changes; only buckets that the changes touch are rewritten.
    With ``keep_script`` the changes are also stored in order and in the clear, for a replay.
    """
    spark = batch.sparkSession
    if from_base:
        targets = targets | {t: read_table(spark, base, t) for t in KEYS if t != "second_job"}
    if apply:
        with steps_of_a_run(spark):
            _run_fan_out(batch, targets, as_of, batch_id, base, True, hide_key, from_base, keep_script, **options)
        return spark.read.parquet(f"{base}/change_log").filter(F.col("batch_id") == batch_id)
    return _run_fan_out(batch, targets, as_of, batch_id, base, False, hide_key, from_base, False, **options)


def touched_buckets(changes: DataFrame, key: list[str]) -> list[int]:
    """Buckets of the state that hold a changed or a new row; at most as many as there are buckets."""
    row = F.coalesce("before", "after")
    moved = changes.filter(F.col("action").isin(INSERT, UPDATE, END)).select(bucket_of([row[k] for k in key]).alias("n"))
    return [r.n for r in moved.distinct().collect()]


def _run_fan_out(batch, targets, as_of, batch_id, base, apply, hide_key, from_base, keep_script, **options) -> DataFrame:
    spark = batch.sparkSession
    result = fan_out(batch, targets, as_of, **options)
    steps = result.numbered(targets)
    log = FanOut(steps, result.rejects, result.warnings).log(batch_id, PERSONAL, hide_key)
    if apply:
        folders = {}
        for target, changes in steps.items():
            if target == "job_rec" and "second_job" in steps:
                continue
            table = STEP_TABLES.get(target, target)
            state, key = targets[table], KEYS[target]
            parts = [steps["job_rec"], changes] if target == "second_job" else [changes]
            if from_base:
                moved = {n for c in parts for n in touched_buckets(c, key)}
                if not moved:
                    continue
                state = read_table(spark, base, table, None, sorted(moved))
            for part in parts:
                state = apply_changes(state, part, key)
            folders[table] = write_attempt(state, base, table, batch_id, key)
        append_log(log, base, "change_log")
        if keep_script:
            append_log(change_script(steps, KEYS, batch_id, STEPS, STEP_TABLES), base, "change_script")
        store_rejects(reject_rows(result.rejects, batch_id, "fan_out", gate.REASON, PERSONAL, hide_key), base)
        warnings = result.warnings.withColumn("payroll_name", hidden(F.col("payroll_name"), hide_key))
        append_log(warnings.withColumn("batch_id", F.lit(batch_id)), base, "warnings")
        publish(spark, base, batch_id, folders, whole=not from_base)
    return log
