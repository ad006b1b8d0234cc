"""Comparison SQL for the changes of each target, over the names of ``world``.

Every piece is a SELECT with the columns ``action``, ``reason``, ``old_<key>`` and
the new values.
"""

from __future__ import annotations

from rollkeeper.queries.inputs import fingerprint_sql, phone_sql
from rollkeeper.queries.world import BATCH, TODAY

CONTACT = ["id", "aa", "beg_date", "end_date", "line1", "line3", "zip", "ctry", "phone", "ofc_add_by"]


def one(action: str, old: str, key: str, values: dict[str, str], source: str, reason: str = "NULL") -> str:
    """One SELECT; ``action`` and ``reason`` are SQL."""
    columns = ", ".join(f"{v} AS {n}" for n, v in values.items())
    return f"SELECT {action} AS action, CAST({reason} AS VARCHAR) AS reason, {old} AS old_{key}, {columns} FROM {source}"


def union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def _contact_same(alias: str) -> dict[str, str]:
    return {c: f"{alias}.{c}" for c in CONTACT}


def contact_new(**values: str) -> dict[str, str]:
    base = {c: "''" for c in CONTACT} | {"end_date": "CAST(NULL AS DATE)", "ofc_add_by": "'HR'"}
    return base | values


def dated(incoming: str, state: str, into: str, rule: str, today: str = TODAY) -> str:
    """Mobile phone and email: new value of a person and kind."""
    after = f"coalesce(b + 1, {today})"
    begins = f"greatest({today}, {after})" if rule == "email" else after
    ends = "b" if rule == "phone" else today
    source = f"""(
  SELECT i.id, i.aa, i.value, n.b, o FROM {incoming} i
  LEFT JOIN (SELECT id, aa, max(beg_date) AS b FROM {state} GROUP BY id, aa) n ON n.id = i.id AND n.aa = i.aa
  LEFT JOIN (SELECT id, aa, arg_min(s, aa_no) AS o FROM {state} s WHERE end_date IS NULL GROUP BY id, aa) p
    ON p.id = i.id AND p.aa = i.aa)"""
    new = contact_new(id="id", aa="aa", beg_date=begins)
    new[into] = "value"
    ended = _contact_same("o") | {"end_date": ends}
    return union(
        one("'insert'", "NULL", "aa_no", new, f"{source} WHERE o IS NULL OR o.{into} <> value"),
        one("'end_date'", "o.aa_no", "aa_no", ended, f"{source} WHERE o.{into} <> value"),
        one("'none'", "o.aa_no", "aa_no", _contact_same("o"), f"{source} WHERE o.{into} = value"),
    )


def sequenced(given: str, state: str, into: str, rule: str, today: str = TODAY) -> str:
    """All values of a person and kind, taken in the order of ``day``; ``given`` has id, aa, day, value."""
    after = f"coalesce(newest + 1, {today})"
    first = f"greatest({today}, {after})" if rule == "email" else after
    latest = "max(day - DATE '1970-01-01' - step) OVER (PARTITION BY id, aa ORDER BY step)"
    begins = f"{first} + CAST(step - 1 AS INT)"
    if rule == "effective":
        begins = f"DATE '1970-01-01' + CAST(step + greatest(newest - DATE '1970-01-01', {latest}) AS INT)"
    closes = {"phone": "newest", "email": today, "effective": "begins - 1"}[rule]
    closed = {"phone": "begins", "email": f"greatest({today}, begins)", "effective": "following - 1"}[rule]
    new = contact_new(id="id", aa="aa", beg_date="begins", end_date=f"CASE WHEN following IS NOT NULL THEN CAST({closed} AS DATE) END")
    new[into] = "value"
    again = {c: "NULL" for c in CONTACT} | {"id": "id", "aa": "aa", into: "value"}
    parts = union(
        one("'insert'", "NULL", "aa_no", new, "closed"),
        one("'end_date'", "o.aa_no", "aa_no", _contact_same("o") | {"end_date": f"CAST({closes} AS DATE)"}, "closed WHERE step = 1 AND o IS NOT NULL"),
        one("'none'", "o.aa_no", "aa_no", _contact_same("o"), "steps WHERE same AND step = 0"),
        one("'none'", "NULL", "aa_no", again, "steps WHERE same AND step > 0"),
    )
    return f"""SELECT * FROM (
WITH found AS (SELECT id, aa, max(beg_date) AS newest, arg_min(k, aa_no) FILTER (WHERE end_date IS NULL) AS o FROM {state} k GROUP BY id, aa),
ordered AS (SELECT g.*, newest, o, row_number() OVER w AS rn, lag(value) OVER w AS prev FROM (SELECT DISTINCT * FROM {given}) g
  LEFT JOIN found USING (id, aa) WINDOW w AS (PARTITION BY id, aa ORDER BY day, value)),
marked AS (SELECT *, coalesce(CASE WHEN rn = 1 THEN o.{into} ELSE prev END = value, false) AS same FROM ordered),
steps AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY id, aa ORDER BY day, value) AS step FROM marked),
begun AS (SELECT *, CAST({begins} AS DATE) AS begins FROM steps WHERE NOT same),
closed AS (SELECT *, lead(begins) OVER (PARTITION BY id, aa ORDER BY step) AS following FROM begun)
{parts})"""


def archive(old: str, state: str, today: str = TODAY) -> str:
    source = f"""(
  SELECT a.*, o, m FROM {old} a LEFT JOIN (
    SELECT id AS oid, arg_min(s, aa_no) AS o, max(CASE WHEN aa = 'PREV' THEN beg_date END) AS m FROM {state} s
    WHERE end_date IS NULL AND aa IN ('PERM', 'PREV', 'SCND') GROUP BY id) ON oid = a.id)"""
    last = f"greatest({today}, m)"
    address = {c: c for c in ("line1", "line3", "zip", "ctry", "phone")}
    same = "o.line1 IS NOT DISTINCT FROM line1 AND o.zip IS NOT DISTINCT FROM zip"

    def inserted(day: str) -> dict[str, str]:
        return contact_new(id="id", aa="'PREV'", beg_date=day, **address)

    return union(
        one("'insert'", "NULL", "aa_no", inserted(today), f"{source} WHERE o IS NULL"),
        one("'update'", "o.aa_no", "aa_no", _contact_same("o") | address, f"{source} WHERE o IS NOT NULL AND {same}"),
        one(
            "'end_date'",
            "o.aa_no",
            "aa_no",
            _contact_same("o") | {"end_date": last, "aa": "'PREV'"},
            f"{source} WHERE o IS NOT NULL AND NOT ({same})",
        ),
        one("'insert'", "NULL", "aa_no", inserted(f"{last} + 1"), f"{source} WHERE o IS NOT NULL AND NOT ({same})"),
    )


def directory(rows: str, state: str, today: str = TODAY) -> str:
    source = f"""(
  SELECT d.*, o FROM {rows} d LEFT JOIN (
    SELECT id AS oid, arg_min(s, aa_no) AS o FROM {state} s WHERE aa = 'SCHL' GROUP BY id) ON oid = d.id)"""
    new = contact_new(id="id", aa="'SCHL'", beg_date=today, line1="fullname", line3="location")
    same = "o.line1 = fullname AND o.line3 = location AND o.phone = '' AND o.phone_ext = ''"
    values = _contact_same("o") | {"line1": "fullname", "line3": "location", "phone": "''"}
    return union(
        one("'insert'", "NULL", "aa_no", new, f"{source} WHERE o IS NULL"),
        one("'none'", "o.aa_no", "aa_no", _contact_same("o"), f"{source} WHERE o IS NOT NULL AND {same}"),
        one("'update'", "o.aa_no", "aa_no", values, f"{source} WHERE o IS NOT NULL AND NOT ({same})"),
    )


_MOVED = (
    "(trim(primary_country_code) <> '' AND (r.addr_line1, r.addr_line2, r.addr_line3, r.city, r.st, r.zip, r.ctry)"
    " IS DISTINCT FROM (primary_address1, primary_address2, primary_address3, primary_city, primary_state_code,"
    " primary_zip, primary_country_code))"
)
_MATCHED = """staff s JOIN id_rec r ON r.id = s.id
  LEFT JOIN title_table t ON t.title = upper(replace(salutation, '.', ''))
  LEFT JOIN ctry_table c ON c.ctry = primary_country_code"""


def _when_moved(new: str, old: str) -> str:
    return f"CASE WHEN {_MOVED} THEN {new} ELSE r.{old} END"


def person(parts: tuple[str, ...] = ("basics", "title", "address")) -> str:
    values = {
        c: f"r.{c}"
        for c in (
            "id fullname lastname firstname middlename title ss_no decsd upd_date ofc_add_by addr_line1 addr_line2"
            " addr_line3 city st zip ctry aa phone"
        ).split()
    }
    touched = []
    if "basics" in parts:
        values |= {
            "fullname": "payroll_name",
            "lastname": "last_name",
            "firstname": "first_name",
            "middlename": "middle_name",
            "ss_no": "ssn",
            "decsd": "'N'",
            "upd_date": "pos_effective_date",
            "ofc_add_by": "'HR'",
        }
        touched.append("true")
    if "title" in parts:
        values["title"] = "coalesce(t.title, r.title)"
        touched.append("t.title IS NOT NULL")
    if "address" in parts:
        values |= {
            "addr_line1": _when_moved("primary_address1", "addr_line1"),
            "addr_line2": _when_moved("primary_address2", "addr_line2"),
            "addr_line3": _when_moved("primary_address3", "addr_line3"),
            "city": _when_moved("primary_city", "city"),
            "st": _when_moved("primary_state_code", "st"),
            "zip": _when_moved("primary_zip", "zip"),
            "ctry": _when_moved("coalesce(c.ctry, '')", "ctry"),
            "aa": _when_moved("'PERM'", "aa"),
            "phone": _when_moved(phone_sql("home_phone"), "phone"),
        }
        touched.append(_MOVED)
    return one("'update'", "r.id", "id", values, f"{_MATCHED} WHERE {' OR '.join(touched)}")


REPLACED = (
    "(SELECT r.id, r.addr_line1 AS line1, r.addr_line3 AS line3, r.zip, r.ctry, "
    + phone_sql("home_phone")
    + f" AS phone FROM {_MATCHED} WHERE {_MOVED} AND r.addr_line1 IS NOT NULL)"
)
EMAILS = (
    "(SELECT id, 'EML2' AS aa, personal_email AS value FROM staff WHERE personal_email <> '' UNION ALL"
    " SELECT id, 'EML3', wc_work_email FROM staff WHERE wc_work_email <> '')"
)
PHONES = f"(SELECT id, 'CELL' AS aa, {phone_sql('mobile_phone')} AS value FROM staff WHERE mobile_phone <> '')"
BUILDING = (
    "CASE location_code WHEN '1' THEN 'LH' WHEN '2' THEN 'CC' WHEN '3' THEN 'DSC' WHEN '4' THEN 'HL' WHEN '5' THEN"
    " 'JAC' WHEN '6' THEN 'TWC' WHEN '7' THEN 'TC' WHEN '11' THEN 'MADR' WHEN '15' THEN 'SC' WHEN '16' THEN 'TA' END"
)
LISTED = f"(SELECT id, payroll_name AS fullname, concat_ws(' ', {BUILDING}, room_number) AS location FROM staff)"


_KNOWN_STAFF = "(SELECT * FROM known WHERE payroll_comp_code <> 'DPW')"
EACH_EMAIL = f"""(
  SELECT id, 'EML2' AS aa, pos_effective_date AS day, personal_email AS value FROM {_KNOWN_STAFF} WHERE personal_email <> ''
  UNION ALL SELECT id, 'EML3', pos_effective_date, wc_work_email FROM {_KNOWN_STAFF} WHERE wc_work_email <> '')"""
EACH_PHONE = f"""(
  SELECT id, 'CELL' AS aa, pos_effective_date AS day, {phone_sql("mobile_phone")} AS value FROM {_KNOWN_STAFF} WHERE mobile_phone <> '')"""


def contacts(in_sequence: bool = False) -> str:
    if in_sequence:
        return union(
            archive(REPLACED, "aa_rec"),
            sequenced(EACH_EMAIL, "aa_rec", "line1", "email"),
            sequenced(EACH_PHONE, "aa_rec", "phone", "phone"),
            directory(LISTED, "aa_rec"),
        )
    return union(
        archive(REPLACED, "aa_rec"),
        dated(EMAILS, "aa_rec", "line1", "email"),
        dated(PHONES, "aa_rec", "phone", "phone"),
        directory(LISTED, "aa_rec"),
    )


def profile() -> str:
    # Nobody's birthday falls on the day of the run or later in the year.
    age = (
        f"CAST(year({TODAY}) - year(s.birth_date) - CASE WHEN strftime(s.birth_date, '%m%d') >"
        f" strftime({TODAY}, '%m%d') THEN 1 ELSE 0 END AS INT)"
    )
    values = {
        "id": "s.id",
        "sex": "s.gender",
        "race": "s.race",
        "hispanic": "coalesce(s.ethnicity, 'N')",
        "birth_date": "s.birth_date",
        "age": age,
        "prof_last_upd_date": TODAY,
    }
    action = "CASE WHEN p.id IS NULL THEN 'insert' ELSE 'update' END"
    return one(action, "p.id", "id", values, "staff s LEFT JOIN profile_rec p ON p.id = s.id")


def xref(person: str = "person") -> str:
    source = f"""(
  SELECT *, coalesce(f, 0) <> 0 OR (file_number IS NOT NULL AND coalesce(f_first <> id, false)) AS f_taken FROM (
    SELECT *, min(CASE WHEN NOT a_taken AND coalesce(f, 0) = 0 THEN id END) OVER (PARTITION BY file_number) AS f_first FROM (
      SELECT *, coalesce(a, 0) <> 0 OR (employee_assoc_id IS NOT NULL AND coalesce(a_first <> id, false)) AS a_taken FROM (
        SELECT *, min(CASE WHEN coalesce(a, 0) = 0 AND coalesce(f, 0) = 0 THEN id END)
          OVER (PARTITION BY employee_assoc_id) AS a_first FROM (
          SELECT s.*, x.cx_id AS mine,
            (SELECT min(cx_id) FROM cvid_rec WHERE adp_associate_id = s.employee_assoc_id AND cx_id <> coalesce(x.cx_id, 0)) AS a,
            (SELECT min(cx_id) FROM cvid_rec WHERE adp_id = s.file_number AND cx_id <> coalesce(x.cx_id, 0)) AS f
          FROM {person} s LEFT JOIN cvid_rec x ON x.cx_id = s.id)))))"""
    action = "CASE WHEN a_taken OR f_taken THEN 'reject' WHEN mine IS NULL THEN 'insert' ELSE 'update' END"
    reason = "CASE WHEN a_taken THEN 'associate_id_held' WHEN f_taken THEN 'file_number_held' END"
    values = {
        "old_id": "CAST(id AS VARCHAR)",
        "old_id_num": "id",
        "adp_id": "file_number",
        "ssn": "ssn",
        "cx_id": "id",
        "cx_id_char": "CAST(id AS VARCHAR)",
        "adp_associate_id": "employee_assoc_id",
    }
    return one(action, "CASE WHEN NOT a_taken AND NOT f_taken THEN mine END", "cx_id", values, source, reason)


def ordered_pairs(rows: str, key: str, columns: list[str]) -> str:
    """Equal pairs once, the latest of each key first."""
    listed = ", ".join([key, *columns])
    marks = fingerprint_sql(key, *columns, "pos_effective_date")
    return f"""(
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY pos_effective_date DESC, {marks} DESC) AS place FROM (
    SELECT {listed}, max(pos_effective_date) AS pos_effective_date FROM {rows} GROUP BY {listed}))"""


def code_table(
    rows: str, table: str, code: str, key: str, texts: dict[str, str], begins: str, moves: bool, among: str = "true"
) -> str:
    source = f"""{ordered_pairs(rows, code, list(texts.values()))} w
  LEFT JOIN (SELECT * FROM {table} WHERE {among}) t ON t.{key} = w.{code} AND place = 1"""
    differs = " OR ".join(f"t.{c} IS DISTINCT FROM w.{v}" for c, v in texts.items())
    action = f"CASE WHEN place > 1 THEN 'reject' WHEN t.{key} IS NULL THEN 'insert' WHEN {differs} THEN 'update' ELSE 'none' END"
    new_day = f"t.{key} IS NULL" + (f" OR {differs}" if moves else "")
    values = {
        key: f"w.{code}",
        **{c: f"w.{v}" for c, v in texts.items()},
        begins: f"CASE WHEN place > 1 THEN NULL WHEN {new_day} THEN {TODAY} ELSE t.{begins} END",
    }
    return one(action, f"t.{key}", key, values, source, "CASE WHEN place > 1 THEN 'conflict_in_batch' END")


def work_category() -> str:
    return code_table(
        "titled", "cc_work_cat_table", "worker_cat_code", "work_cat_code", {"work_cat_descr": "worker_cat_descr"},
        "active_date", False,
    )


def job_class() -> str:
    return code_table(
        "titled WHERE trim(job_class_code) <> ''", "hrclass_table", "job_class_code", "hrclass",
        {"txt": "job_class_descr"}, "active_date", False, "inactive_date IS NULL",
    )


def division() -> str:
    return code_table("titled", "hrdiv_table", "unit", "hrdiv", {"descr": "business_unit_descr"}, "beg_date", True)


def department() -> str:
    return code_table(
        "titled", "hrdept_table", "dept", "hrdept", {"descr": "home_dept_descr", "hrdiv": "unit"}, "beg_date", True
    )


_PARTS = ["payroll_comp_code", "unit", "func", "job_title_code", "job_title_descr"]
# Changes of positions, the next positions, and the rows with their number.
PLACED_SQL = f"""
keyed AS (
  SELECT titled.*, concat_ws('-', payroll_comp_code, unit, dept, job_title_code) AS pcn_aggr,
    coalesce(f.func, '') AS func
  FROM titled LEFT JOIN func_table f ON f.func = dept),
pos_pairs AS (SELECT * FROM {ordered_pairs("keyed", "pcn_aggr", _PARTS)}),
pos_new AS (
  SELECT w.pcn_aggr, CAST((SELECT max(tpos_no) FROM pos_table)
    + row_number() OVER (ORDER BY w.pcn_aggr) AS INT) AS tpos_no
  FROM pos_pairs w WHERE place = 1 AND w.pcn_aggr NOT IN (SELECT pcn_aggr FROM pos_table)),
pos_next AS (SELECT pcn_aggr, tpos_no FROM pos_table UNION ALL SELECT pcn_aggr, tpos_no FROM pos_new),
numbered AS (SELECT keyed.*, tpos_no FROM keyed JOIN pos_next USING (pcn_aggr))
"""


def position() -> str:
    source = """pos_pairs w LEFT JOIN pos_table p ON p.pcn_aggr = w.pcn_aggr AND place = 1
  LEFT JOIN pos_new n ON n.pcn_aggr = w.pcn_aggr AND place = 1"""
    differs = "(p.descr, p.func_area, p.hrpay) IS DISTINCT FROM (w.job_title_descr, w.func, w.payroll_comp_code)"
    action = f"CASE WHEN place > 1 THEN 'reject' WHEN p.tpos_no IS NULL THEN 'insert' WHEN {differs} THEN 'update' ELSE 'none' END"

    def kept(new: str, old: str) -> str:
        return f"CASE WHEN p.tpos_no IS NOT NULL AND NOT ({differs}) THEN p.{old} ELSE {new} END"

    values = {
        "tpos_no": "coalesce(p.tpos_no, n.tpos_no)",
        "pcn_aggr": "w.pcn_aggr",
        "pcn_01": kept("w.payroll_comp_code", "pcn_01"),
        "pcn_02": kept("w.unit", "pcn_02"),
        "pcn_03": kept("w.func", "pcn_03"),
        "pcn_04": kept("w.job_title_code", "pcn_04"),
        "descr": kept("w.job_title_descr", "descr"),
        "ofc": kept("'OFC'", "ofc"),
        "func_area": kept("w.func", "func_area"),
        "tenure_track": f"CASE WHEN place > 1 THEN NULL WHEN p.tpos_no IS NULL THEN '' WHEN {differs} THEN 'TENURE' ELSE p.tenure_track END",
        "fte": kept("0", "fte"),
        "hrpay": kept("w.payroll_comp_code", "hrpay"),
        "active_date": kept(TODAY, "active_date"),
        "prev_pos": "CASE WHEN place > 1 THEN NULL WHEN p.tpos_no IS NULL THEN '' ELSE p.prev_pos END",
    }
    return one(action, "p.tpos_no", "tpos_no", values, source, "CASE WHEN place > 1 THEN 'conflict_in_batch' END")


JOB_OUT = [
    "tpos_no", "descr", "bjob_no", "id", "hrpay", "supervisor_no", "hrstat", "egp_type", "hrdiv", "hrdept", "beg_date",
    "end_date", "job_title", "title_rank", "worker_ctgry", "hrclass",
]

_NUMBERED = [*BATCH, "id", "unit", "dept", "pcn_aggr", "func", "tpos_no"]


def jobs_ctes(rows: str, prefix: str, state: str, columns: list[str], latest: str) -> str:
    """One row per person and rank, one rank per person and position, and the
    active jobs they meet."""
    marks = fingerprint_sql(*columns)
    return f"""
{prefix}_all AS (
  SELECT *, first_value(fp) OVER (PARTITION BY id, title_rank ORDER BY {latest} DESC, fp DESC) AS win FROM (
    SELECT *, {marks} AS fp FROM {rows})),
{prefix}_first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, title_rank, fp) AS again FROM {prefix}_all
    WHERE fp = win) WHERE again = 1),
{prefix}_lead AS (
  SELECT *, row_number() OVER (PARTITION BY id, tpos_no ORDER BY title_rank NULLS LAST) AS lead_no
  FROM {prefix}_first),
{prefix}_won AS (SELECT * FROM {prefix}_lead WHERE lead_no = 1),
{prefix}_active AS (SELECT * FROM {state} WHERE end_date IS NULL OR end_date > {TODAY}),
{prefix}_met AS (
  SELECT w.*, j FROM {prefix}_won w LEFT JOIN (
    SELECT id AS jid, tpos_no AS jpos, arg_min(a, job_no) AS j FROM {prefix}_active a GROUP BY id, tpos_no)
    ON jid = w.id AND jpos = w.tpos_no),
{prefix}_held AS (
  SELECT a.id, title_rank, arg_min(a, job_no) AS j, arg_min(pcn_aggr, job_no) AS held_key
  FROM {prefix}_active a JOIN pos_next USING (tpos_no) GROUP BY a.id, title_rank)
"""


def _job_rows(prefix: str, values: dict[str, str], updates_rank: bool) -> str:
    kept = ["bjob_no", "egp_type"] + ([] if updates_rank else ["title_rank"])
    updated = values | {c: f"j.{c}" for c in kept}
    ended = {c: f"j.{c}" for c in JOB_OUT} | {"end_date": TODAY}
    source = (
        f"{prefix}_won w JOIN {prefix}_held h ON h.id = w.id AND h.title_rank = w.title_rank"
        f" WHERE held_key <> w.pcn_aggr AND j.job_no NOT IN"
        f" (SELECT j.job_no FROM {prefix}_met WHERE j IS NOT NULL)"
    )
    return union(
        one("'insert'", "NULL", "job_no", values, f"{prefix}_met w WHERE j IS NULL"),
        one("'update'", "j.job_no", "job_no", updated, f"{prefix}_met w WHERE j IS NOT NULL"),
        one("'end_date'", "j.job_no", "job_no", ended, source),
    )


RANKED_SQL = """
ranked_jobs AS (
  SELECT *, CASE primary_position WHEN 'Yes' THEN 1 WHEN 'No' THEN 2 END AS title_rank,
    substr(supervisor_id, 4, 7) AS number,
    coalesce((SELECT max(CAST(adp_id AS INT)) FROM cvid_rec WHERE CAST(adp_id AS INT) >= 1
      AND CAST(adp_id AS INT) = CAST(substr(supervisor_id, 4, 7) AS INT)), 0) AS supervisor
  FROM numbered)
"""
JOBS_CTES = (
    RANKED_SQL
    + ","
    + jobs_ctes("ranked_jobs", "jb", "job_rec", [*_NUMBERED, "title_rank", "number", "supervisor"], "pos_effective_date")
)


def job() -> str:
    values = {
        "tpos_no": "w.tpos_no",
        "descr": "w.job_title_descr",
        "bjob_no": "0",
        "id": "w.id",
        "hrpay": "w.payroll_comp_code",
        "supervisor_no": "w.supervisor",
        "hrstat": "''",
        "egp_type": "'R'",
        "hrdiv": "w.unit",
        "hrdept": "w.func",
        "beg_date": "w.pos_effective_date",
        "end_date": "w.termination_date",
        "job_title": "w.job_title_descr",
        "title_rank": "w.title_rank",
        "worker_ctgry": "w.worker_cat_code",
        "hrclass": "w.job_class_code",
    }
    lost = values | {"bjob_no": "NULL", "egp_type": "NULL"}
    reason = "'conflict_in_batch'"
    return union(
        _job_rows("jb", values, False),
        one("'reject'", "NULL", "job_no", lost, "jb_all w WHERE fp <> win", reason),
        one("'reject'", "NULL", "job_no", lost, "jb_lead w WHERE lead_no > 1", reason),
    )


_SECOND = [
    "id", "title_rank", "pcn_aggr", "worker_cat_code", "job_title_descr", "job_function_code", "position_start",
    "position_end", "pay", "unit", "dept", "tpos_no", "func", "old_title",
]


def second_ctes(source: str = "second_in", state: str = "job_rec") -> str:
    return f"""
second_parts AS (
  SELECT *, split_part(pcn_aggr, '-', 1) AS pay, split_part(pcn_aggr, '-', 2) AS unit,
    split_part(pcn_aggr, '-', 3) AS dept,
    length(pcn_aggr) - length(replace(pcn_aggr, '-', '')) >= 3 AS whole FROM {source}),
second_rows AS (
  SELECT s.* EXCLUDE (whole), p.tpos_no, coalesce(f.func, '') AS func,
    coalesce((SELECT min(job_title) FROM {state} j WHERE j.tpos_no = p.tpos_no), '') AS old_title
  FROM second_parts s JOIN pos_next p USING (pcn_aggr) LEFT JOIN func_table f ON f.func = dept WHERE whole),
{jobs_ctes("second_rows", "sj", state, _SECOND, "position_start").strip()}
"""


SECOND_CTES = second_ctes()

# Jobs as the batch leaves them; new ones are numbered by person and position.
JOBS_NEXT_CTES = f"""
job_log AS ({job()}),
job_next AS (
  SELECT r.job_no, {", ".join(f"CASE WHEN l.action IS NULL THEN r.{c} ELSE l.{c} END AS {c}" for c in JOB_OUT)}
  FROM job_rec r LEFT JOIN job_log l ON l.old_job_no = r.job_no AND l.action IN ('update', 'end_date')
  UNION ALL
  SELECT (SELECT max(job_no) FROM job_rec) + row_number() OVER (ORDER BY id, tpos_no), {", ".join(JOB_OUT)}
  FROM job_log WHERE action = 'insert')
"""


def second_job() -> str:
    values = {
        "tpos_no": "w.tpos_no",
        "descr": "w.old_title",
        "bjob_no": "0",
        "id": "w.id",
        "hrpay": "w.pay",
        "supervisor_no": "0",
        "hrstat": "w.job_function_code",
        "egp_type": "'R'",
        "hrdiv": "w.unit",
        "hrdept": "w.func",
        "beg_date": TODAY,
        "end_date": "w.position_end",
        "job_title": "w.job_title_descr",
        "title_rank": "w.title_rank",
        "worker_ctgry": "w.worker_cat_code",
        "hrclass": "CASE WHEN j IS NOT NULL THEN j.hrclass END",
    }
    lost = values | {"bjob_no": "NULL", "egp_type": "NULL", "hrclass": "NULL"}
    empty = {c: "NULL" for c in JOB_OUT}
    failed = empty | {"id": "id", "title_rank": "title_rank", "job_title": "job_title_descr"}
    unknown = "second_parts WHERE whole AND pcn_aggr NOT IN (SELECT pcn_aggr FROM pos_next)"
    return union(
        _job_rows("sj", values, True),
        one("'reject'", "NULL", "job_no", failed, "second_parts WHERE NOT whole", "'bad_position_key'"),
        one("'reject'", "NULL", "job_no", failed, unknown, "'unknown_position'"),
        one("'reject'", "NULL", "job_no", lost, "sj_all w WHERE fp <> win", "'conflict_in_batch'"),
        one("'reject'", "NULL", "job_no", lost, "sj_lead w WHERE lead_no > 1", "'conflict_in_batch'"),
    )


def employment() -> str:
    source = f"""(
  SELECT *, first_value(fp) OVER (PARTITION BY id ORDER BY pos_effective_date DESC, fp DESC) AS win,
    row_number() OVER (PARTITION BY id, fp) AS again FROM (SELECT *, {fingerprint_sql(*_NUMBERED)} AS fp FROM numbered)
  ) w LEFT JOIN hremp_rec e ON e.id = w.id AND fp = win WHERE fp <> win OR again = 1"""
    action = "CASE WHEN fp <> win THEN 'reject' WHEN e.id IS NULL THEN 'insert' ELSE 'update' END"
    values = {
        "id": "w.id",
        "home_tpos_no": "w.tpos_no",
        "ss_first": "w.first_name",
        "ss_middle": "w.middle_name",
        "ss_last": "w.last_name",
        "is_tenured": "CASE WHEN worker_cat_code = 'T' THEN 'Y' ELSE 'N' END",
        "is_tenure_track": "CASE WHEN worker_cat_code = 'TE' THEN 'Y' ELSE 'N' END",
    }
    return one(action, "e.id", "id", values, source, "CASE WHEN fp <> win THEN 'conflict_in_batch' END")
