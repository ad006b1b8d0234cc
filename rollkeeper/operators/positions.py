"""Code tables, positions, jobs and employment: changes from a batch of cleaned rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeeper.functions import codes, text
from rollkeeper.operators.changes import END, change, emit, rejects_of, row_after, row_type, upsert
from rollkeeper.operators.gate import first_filled_slot, is_active
from rollkeeper.operators.judge import Check, judged_warnings
from rollkeeper.operators.lookup import known_supervisor, lookup, text_of_position
from rollkeeper.operators.pick import CONFLICT, one_per_key, pick_one
from rollkeeper.operators.spread import balanced_join
from rollkeeper.session import written

# What a new or changed position and job carries.
POSITION_OFFICE = "OFC"
TENURE_ON_UPDATE = "TENURE"
NEW_JOB = {
    "bjob_no": 0,
    "egp_type": "R",
    "comp_beg_date": None,
    "comp_end_date": None,
    "active_ctrct": "N",
    "ctrct_stat": "N/A",
    "excl_srvc_hrs": "N",
    "excl_web_time": "N",
}


def code_table_changes(
    batch: DataFrame,
    table: DataFrame,
    code: str,
    key: str,
    texts: dict[str, str],
    latest_by: str,
    on_insert: dict[str, Column],
    on_update: dict[str, Column] | None = None,
    among: Column | None = None,
) -> DataFrame:
    """Keep a code table in step with the codes and texts of a batch.

    ``texts`` maps table columns to batch columns. Equal pairs of code and texts
    are folded first; of several texts for one code the latest wins and the others
    are rejects.
    """
    pairs = batch.groupBy(code, *texts.values()).agg(F.max(latest_by).alias(latest_by))
    won, lost = one_per_key(pairs, [code], latest_by)
    values = {column: F.col(c) for column, c in texts.items()}
    changes = upsert(
        won,
        table,
        {code: key},
        updates={**values, **(on_update or {})},
        inserts={key: F.col(code), **values, **on_insert},
        when_differs=list(texts),
        among=among,
    )
    losers = rejects_of(lost, row_type(table), {key: F.col(code), **values}, CONFLICT)
    return changes.unionByName(losers)


def work_category_changes(batch: DataFrame, table: DataFrame, as_of: Column) -> DataFrame:
    texts = {"work_cat_descr": "worker_cat_descr"}
    return code_table_changes(
        batch, table, "worker_cat_code", "work_cat_code", texts, "pos_effective_date", {"active_date": as_of}
    )


def job_class_changes(batch: DataFrame, table: DataFrame, as_of: Column) -> DataFrame:
    """Only active codes count as known; a blank class is no class."""
    with_class = batch.filter(~text.is_blank(F.col("job_class_code")))
    return code_table_changes(
        with_class,
        table,
        "job_class_code",
        "hrclass",
        {"txt": "job_class_descr"},
        "pos_effective_date",
        {"active_date": as_of},
        among=F.col("inactive_date").isNull(),
    )


def division_changes(batch: DataFrame, table: DataFrame, as_of: Column) -> DataFrame:
    cut = batch.withColumn("_unit", text.cut(F.col("business_unit_code"), 4))
    texts = {"descr": "business_unit_descr"}
    begin = {"beg_date": as_of}
    return code_table_changes(cut, table, "_unit", "hrdiv", texts, "pos_effective_date", begin, begin)


def department_changes(batch: DataFrame, table: DataFrame, as_of: Column) -> DataFrame:
    """Another text or another division updates the department."""
    cut = batch.withColumn("_unit", text.cut(F.col("business_unit_code"), 4)).withColumn(
        "_dept", text.cut(F.col("home_dept_code"), 3)
    )
    texts = {"descr": "home_dept_descr", "hrdiv": "_unit"}
    begin = {"beg_date": as_of}
    return code_table_changes(cut, table, "_dept", "hrdept", texts, "pos_effective_date", begin, begin)


def with_position_key(batch: DataFrame, functions: DataFrame) -> DataFrame:
    """Adds the position key, its parts and the validated function code."""
    keyed = (
        batch.withColumn("_unit", text.cut(F.col("business_unit_code"), 4))
        .withColumn("_dept", text.cut(F.col("home_dept_code"), 3))
        .withColumn(
            "pcn_aggr",
            text.position_key(
                F.col("payroll_comp_code"),
                F.col("business_unit_code"),
                F.col("home_dept_code"),
                F.col("job_title_code"),
            ),
        )
    )
    return lookup(keyed, "_dept", functions, "func", "func", "_func", "")


def position_changes(keyed: DataFrame, positions: DataFrame, as_of: Column) -> DataFrame:
    """Positions by composite key; new ones still lack their number."""
    parts = ["payroll_comp_code", "_unit", "_func", "job_title_code", "job_title_descr"]
    pairs = keyed.groupBy("pcn_aggr", *parts).agg(F.max("pos_effective_date").alias("pos_effective_date"))
    won, lost = one_per_key(pairs, ["pcn_aggr"], "pos_effective_date")
    values = {
        "pcn_aggr": F.col("pcn_aggr"),
        "pcn_01": F.col("payroll_comp_code"),
        "pcn_02": F.col("_unit"),
        "pcn_03": F.col("_func"),
        "pcn_04": F.col("job_title_code"),
        "descr": F.col("job_title_descr"),
        "ofc": F.lit(POSITION_OFFICE),
        "func_area": F.col("_func"),
        "supervisor_no": F.lit(None),
        "fte": F.lit(0),
        "max_jobs": F.lit(0),
        "hrpay": F.col("payroll_comp_code"),
        "active_date": as_of,
    }
    changes = upsert(
        won,
        positions,
        {"pcn_aggr": "pcn_aggr"},
        updates={**values, "tenure_track": F.lit(TENURE_ON_UPDATE), "inactive_date": F.lit(None)},
        inserts={**values, "tenure_track": F.lit(""), "prev_pos": F.lit("")},
        when_differs=["descr", "func_area", "hrpay"],
        pick="tpos_no",
    )
    return changes.unionByName(rejects_of(lost, row_type(positions), values, CONFLICT))


def current_jobs(jobs: DataFrame, positions: DataFrame, as_of: Column) -> DataFrame:
    """Active jobs with the key of their position, one per person and rank."""
    held = jobs.filter(is_active(as_of)).withColumn("_job", F.struct(*jobs.columns))
    keys = positions.select(F.col("tpos_no"), F.col("pcn_aggr").alias("_held_key"))
    joined = held.select("tpos_no", "id", "title_rank", "job_no", "_job").join(keys, "tpos_no")
    order = F.struct("job_no", "_held_key")
    picked = joined.groupBy("id", "title_rank").agg(F.min_by(F.struct("_job", "_held_key"), order).alias("_p"))
    return picked.select("id", "title_rank", F.col("_p._job").alias("before"), F.col("_p._held_key"))


def ended_jobs(wanted: DataFrame, jobs: DataFrame, positions: DataFrame, as_of: Column) -> DataFrame:
    """End the active job of a person's rank when it is for another position.

    ``wanted`` has ``id``, ``title_rank`` and ``pcn_aggr``, one row per id and rank.
    """
    current = current_jobs(jobs, positions, as_of)
    joined = wanted.select("id", "title_rank", "pcn_aggr").join(current, ["id", "title_rank"])
    replaced = joined.filter(F.col("_held_key") != F.col("pcn_aggr"))
    schema = row_type(jobs)
    ended = change(END, schema, row_after(schema, {"end_date": as_of}, "before"), True)
    return emit(replaced, F.array(ended))


def upserted_jobs(
    wanted: DataFrame, jobs: DataFrame, as_of: Column, updates: dict[str, Column], inserts: dict[str, Column]
) -> DataFrame:
    """Job of a person in a position: update the active one or insert."""
    fixed = {c: F.lit(v) for c, v in NEW_JOB.items()}
    return upsert(
        wanted,
        jobs,
        {"tpos_no": "tpos_no", "id": "id"},
        updates=updates,
        inserts={**fixed, "tpos_no": F.col("tpos_no"), **inserts},
        pick="job_no",
        among=is_active(as_of),
    )


def without_updated(ended: DataFrame, upserted: DataFrame) -> DataFrame:
    """Ends of jobs that the same batch goes on with are dropped."""
    going_on = upserted.filter(F.col("before").isNotNull()).select(F.col("before.job_no").alias("_on"))
    return ended.join(going_on, F.col("before.job_no") == F.col("_on"), "left_anti")


def with_position_number(keyed: DataFrame, positions: DataFrame) -> DataFrame:
    """Inner join to the position number by key."""
    numbers = positions.groupBy("pcn_aggr").agg(F.min("tpos_no").alias("tpos_no"))
    return balanced_join(keyed, "pcn_aggr", numbers, "pcn_aggr", "inner")


def one_rank_per_position(won: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two ranks of one person in one position are one job: the smaller rank names it,
    a null rank last. ``won`` has one row per person and rank."""
    by_rank = F.struct(F.col("title_rank").isNull(), F.col("title_rank"))
    lead = written(pick_one(won, ["id", "tpos_no"], by_rank), "jobs")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("id", "tpos_no", "title_rank")]
    names = lead.select(*[F.col(c).alias(f"_{c}") for c in ("id", "tpos_no", "title_rank")])
    return lead, won.join(names, reduce(lambda a, b: a & b, same), "left_anti")


def second_job_slots(rows: DataFrame) -> DataFrame:
    """Second jobs from rows with three slots: the first filled one counts, the rank tells which.

    ``rows`` has ``id``, ``worker_cat_code``, ``job_title_descr``, ``job_function_code``
    and, numbered 2 to 4, ``home_cost_number``, ``position_eff_date``, ``position_end_date``.
    """
    slots = [
        (f"home_cost_number{n}", n + 1, {f"position_eff_date{n}": "position_start", f"position_end_date{n}": "position_end"})
        for n in (2, 3, 4)
    ]
    return first_filled_slot(rows, slots, "pcn_aggr", "title_rank")


def second_job_warnings(rows: DataFrame, targets: dict[str, DataFrame], keep: list[str]) -> DataFrame:
    """Codes of second jobs that the code tables lack; the jobs go on with them."""
    parts = rows.withColumn("_parts", text.split_position_key(F.col("pcn_aggr"))).filter(F.col("_parts").isNotNull())
    coded = parts.select(*rows.columns, *[F.col(f"_parts.{p}").alias(f"_{p}") for p in ("pay", "unit", "dept")])
    checks = {
        "unknown_pay_code": Check("hrpay_table", "_pay", "hrpay"),
        "unknown_function_code": Check("func_table", "_dept", "func"),
        "unknown_division": Check("hrdiv_table", "_unit", "hrdiv"),
        "unknown_department": Check("hrdept_table", "_dept", "hrdept"),
    }
    return judged_warnings(coded, targets, checks, keep)


def job_changes(
    numbered: DataFrame, jobs: DataFrame, positions: DataFrame, xref: DataFrame, as_of: Column
) -> DataFrame:
    """Jobs of a batch: one row per person and rank; others are rejects.

    ``numbered`` is the keyed batch with ``tpos_no``.
    """
    ranked = numbered.withColumn("title_rank", codes.primary_rank(F.col("primary_position")))
    ranked = ranked.withColumn("_number", text.supervisor_number(F.col("supervisor_id")))
    ranked = known_supervisor(ranked, "_number", xref, "adp_id", "_supervisor")
    won, lost = one_per_key(ranked, ["id", "title_rank"], "pos_effective_date")
    lead, twice = one_rank_per_position(won)
    updates = {
        "descr": F.col("job_title_descr"),
        "id": F.col("id"),
        "hrpay": F.col("payroll_comp_code"),
        "supervisor_no": F.col("_supervisor"),
        "hrstat": F.lit(""),
        "hrdiv": F.col("_unit"),
        "hrdept": F.col("_func"),
        "beg_date": F.col("pos_effective_date"),
        "end_date": F.col("termination_date"),
        "job_title": F.col("job_title_descr"),
        "worker_ctgry": F.col("worker_cat_code"),
        "hrclass": F.col("job_class_code"),
    }
    inserts = {**updates, "title_rank": F.col("title_rank")}
    upserted = upserted_jobs(lead, jobs, as_of, updates, inserts)
    ended = without_updated(ended_jobs(lead, jobs, positions, as_of), upserted)
    losers = rejects_of(lost.unionByName(twice), row_type(jobs), {**inserts, "tpos_no": F.col("tpos_no")}, CONFLICT)
    return upserted.unionByName(ended).unionByName(losers)


def employment_changes(numbered: DataFrame, employment: DataFrame) -> DataFrame:
    """Home position, names and tenure flags, one row per person."""
    won, lost = one_per_key(numbered, ["id"], "pos_effective_date")
    values = {
        "home_tpos_no": F.col("tpos_no"),
        "ss_first": F.col("first_name"),
        "ss_middle": F.col("middle_name"),
        "ss_last": F.col("last_name"),
        "ss_suffix": F.lit(""),
        "tenure": F.lit(""),
        "tenure_date": F.lit(None),
        "is_tenured": codes.is_tenured(F.col("worker_cat_code")),
        "is_tenure_track": codes.is_tenure_track(F.col("worker_cat_code")),
    }
    changes = upsert(won, employment, {"id": "id"}, values, {"id": F.col("id"), **values})
    losers = rejects_of(lost, row_type(employment), {"id": F.col("id"), **values}, CONFLICT)
    return changes.unionByName(losers)


def second_job_changes(
    rows: DataFrame, jobs: DataFrame, positions: DataFrame, functions: DataFrame, as_of: Column, titled: DataFrame | None = None
) -> DataFrame:
    """Second jobs, given by position key and rank.

    ``rows`` has ``id``, ``pcn_aggr``, ``title_rank``, ``worker_cat_code``,
    ``job_title_descr``, ``job_function_code``, ``position_start``, ``position_end``.
    A key with fewer than four parts or of no known position is a reject. ``jobs`` may be
    those of the persons concerned only, if ``titled`` has those of the positions.
    """
    schema = row_type(jobs)
    parts = rows.withColumn("_parts", text.split_position_key(F.col("pcn_aggr")))
    candidate = {"id": F.col("id"), "title_rank": F.col("title_rank"), "job_title": F.col("job_title_descr")}
    malformed = rejects_of(parts.filter(F.col("_parts").isNull()), schema, candidate, "bad_position_key")
    whole = parts.filter(F.col("_parts").isNotNull()).select(
        *rows.columns,
        F.col("_parts.pay").alias("_pay"),
        F.col("_parts.unit").alias("_unit"),
        F.col("_parts.dept").alias("_dept"),
    )
    known = positions.select("pcn_aggr")
    unknown = rejects_of(whole.join(known, "pcn_aggr", "left_anti"), schema, candidate, "unknown_position")
    numbered = with_position_number(whole, positions)
    numbered = lookup(numbered, "_dept", functions, "func", "func", "_func", "")
    numbered = text_of_position(numbered, "tpos_no", jobs if titled is None else titled, "tpos_no", "job_title", "_descr")
    numbered = written(numbered, "second-jobs")
    won, lost = one_per_key(numbered, ["id", "title_rank"], "position_start")
    lead, twice = one_rank_per_position(won)
    updates = {
        "descr": F.col("_descr"),
        "id": F.col("id"),
        "hrpay": F.col("_pay"),
        "supervisor_no": F.lit(0),
        "hrstat": F.col("job_function_code"),
        "hrdiv": F.col("_unit"),
        "hrdept": F.col("_func"),
        "beg_date": as_of,
        "end_date": F.col("position_end"),
        "job_title": F.col("job_title_descr"),
        "title_rank": F.col("title_rank"),
        "worker_ctgry": F.col("worker_cat_code"),
    }
    upserted = upserted_jobs(lead, jobs, as_of, updates, updates)
    ended = without_updated(ended_jobs(lead, jobs, positions, as_of), upserted)
    losers = rejects_of(lost.unionByName(twice), schema, {**updates, "tpos_no": F.col("tpos_no")}, CONFLICT)
    return upserted.unionByName(ended).unionByName(malformed).unionByName(unknown).unionByName(losers)
