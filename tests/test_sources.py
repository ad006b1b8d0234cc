from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rollkeeper.contract import PEOPLE
from rollkeeper.operators import gate
from rollkeeper.plans import ingest as plan
from rollkeeper.plans.ingest import clean, ingest, run_ingest
from rollkeeper.sources import feed as feed_files
from rollkeeper.sources.feed import read_feed, write_difference, write_feed
from rollkeeper.sources.history import append_history, batch_stamp, read_history, stamped
from rollkeeper.sources.tables import (
    bucket_of,
    publish,
    read_table,
    reject_rows,
    table_folders,
    write_attempt,
    write_table,
)


def person(**values):
    """A feed row by short name; all other columns blank."""
    base = {n: "" for n in PEOPLE.names}
    base |= {"file_number": "000001", "carth_id": "1", "payroll_name": "Doe, A", "job_title_code": "ABC"}
    return base | values


def feed_text(rows, headers=None, end="\n"):
    headers = headers or PEOPLE.headers
    order = {f.header: f.name for f in PEOPLE.fields}

    def quoted(v):
        return '"' + v.replace('"', '""') + '"'

    lines = [",".join(quoted(h) for h in headers)]
    lines += [",".join(quoted(r[order[h]]) for h in headers) for r in rows]
    return end.join(lines) + end


def write(path, text, bom=True):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())
    return str(path)


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in PEOPLE.names) for r in rows], ", ".join(f"{n} string" for n in PEOPLE.names))


def empty_history(spark):
    return spark.createDataFrame([], PEOPLE.history_schema())


def test_contract_has_91_columns():
    assert len(PEOPLE.fields) == 91
    assert len(PEOPLE.date_fields) == 13
    assert len(set(PEOPLE.names)) == len(set(PEOPLE.headers)) == len(set(PEOPLE.history_names)) == 91


def test_feed_values_survive(spark, tmp_path):
    odd = person(last_name="a \"b\", c\nd", first_name="  x ", long_title="é")
    path = write(tmp_path / "drop" / "a.csv", feed_text([odd, person(carth_id="2")]))
    rows = {r["carth_id"]: r for r in read_feed(spark, path, PEOPLE, multi_line=True).collect()}
    assert rows["1"]["last_name"] == "a \"b\", c\nd"
    assert rows["1"]["first_name"] == "  x "
    assert rows["1"]["middle_name"] == ""
    assert rows["2"][gate.REASON] is None
    assert len(rows) == 2


def test_feed_columns_are_found_by_header(spark, tmp_path):
    path = write(tmp_path / "drop" / "a.csv", feed_text([person(ssn="9")], headers=PEOPLE.headers[::-1]))
    row = read_feed(spark, path, PEOPLE).first()
    assert (row["ssn"], row["carth_id"]) == ("9", "1")


def test_missing_header_is_an_error(spark, tmp_path):
    path = write(tmp_path / "drop" / "a.csv", feed_text([person()], headers=PEOPLE.headers[1:]))
    with pytest.raises(ValueError, match="File Number"):
        read_feed(spark, path, PEOPLE)


def test_all_files_of_the_folder(spark, tmp_path):
    write(tmp_path / "drop" / "a.csv", feed_text([person()]))
    write(tmp_path / "drop" / "b.csv", feed_text([person(carth_id="2")]), bom=False)
    rows = read_feed(spark, str(tmp_path / "drop"), PEOPLE).collect()
    assert {r["carth_id"] for r in rows} == {"1", "2"}
    assert len({r["source_file"] for r in rows}) == 2


def test_uneven_rows(spark, tmp_path):
    full = feed_text([person(carth_id=str(i)) for i in range(1, 5)]).splitlines()
    full[1] += ',"more"'  # too long: kept
    full[2] = full[2].rsplit(",", 1)[0]  # last column missing: kept, blank
    full[3] = full[3].rsplit(",", 2)[0]  # two missing: rejected
    path = write(tmp_path / "drop" / "a.csv", "\n".join(full + ["", ""]))
    rows = {r["carth_id"]: r for r in read_feed(spark, path, PEOPLE).collect()}
    assert [rows[str(i)][gate.REASON] for i in range(1, 5)] == [None, None, "short_row", None]
    assert rows["2"]["long_title"] == ""
    cleaned = clean(read_feed(spark, path, PEOPLE))
    assert gate.rejected(cleaned).count() == 1


def test_feed_and_difference_files(spark, tmp_path):
    cleaned = clean(frame(spark, [person(birth_date="1/2/1990", home_phone="2625550100", last_name=" a,b ")])).drop(gate.REASON)
    write_feed(cleaned, str(tmp_path / "feed"), PEOPLE)
    write_difference(cleaned, str(tmp_path / "diff"), PEOPLE)
    feed = spark.read.option("header", True).csv(str(tmp_path / "feed"))
    diff = spark.read.option("header", True).csv(str(tmp_path / "diff"))
    assert feed.columns == PEOPLE.headers
    assert diff.columns == PEOPLE.names
    assert feed.first()["Birth Date"] == "1990-01-02"
    assert diff.first()["last_name"] == " a,b "
    assert diff.first()["home_phone"] == "262-555-0100"


def test_difference_files_are_packed_and_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed_files, "PACKED_ROWS", 300, raising=False)
    some = clean(frame(spark, [person(last_name=' a,"b" ', long_title="")])).drop(gate.REASON)
    rows = some.crossJoin(spark.range(0, 1000, 1, 1)).withColumn("file_number", F.col("id").cast("string")).drop("id")
    write_difference(rows, str(tmp_path / "diff"), PEOPLE)
    files = list((tmp_path / "diff").glob("*.csv*"))
    text = rows.count() * len(PEOPLE.names) * 3  # quotes and commas alone
    assert sum(f.stat().st_size for f in files) < text / 4 and len(files) >= 4
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "diff"))
    assert back.columns == PEOPLE.names
    assert sorted(int(r.file_number) for r in back.collect()) == list(range(1000))
    assert {(r.last_name, r.long_title or "") for r in back.collect()} == {(' a,"b" ', "")}


def test_clean_twice_is_clean_once(spark):
    rows = [person(gender="Female", room_number="12345", business_unit_code="7", home_phone="(262) 555-0100")]
    once = clean(frame(spark, rows)).drop(gate.REASON)
    again = clean(PEOPLE.to_feed(once).toDF(*PEOPLE.names)).drop(gate.REASON)
    keep = [f.name for f in PEOPLE.fields if f.cleanup not in ("date", "race_code", "hispanic_flag")]
    assert once.select(*keep).collect() == again.select(*keep).collect()


MORNING = datetime(2024, 1, 2, 1, 0, 0, 123456)


def test_ingest_gate_and_second_run(spark, tmp_path):
    rows = [
        person(),
        person(),  # the same row twice
        person(carth_id="2", file_number=""),
        person(carth_id="", file_number=""),
        person(carth_id="", job_title_code=""),
        person(carth_id="3", birth_date="13/01/2020"),
        person(carth_id="x4"),
        person(carth_id="5", last_name='O"Neil'),
    ]
    feed = frame(spark, rows)
    path = str(tmp_path / "history")
    first = run_ingest(feed, empty_history(spark), path, MORNING)
    assert {r["carthage_id"] for r in first.new_rows.collect()} == {1, 5}
    reasons = sorted(r[gate.REASON] for r in first.rejects.collect())
    assert reasons == ["bad_value:birth_date", "bad_value:carth_id", "no_file_number", "no_person_id"]
    assert first.skipped.count() == 1
    stored = read_history(spark, path, PEOPLE)
    assert stored.count() == 2
    assert stored.first()["date_stamp"] == batch_stamp(MORNING)
    second = ingest(feed, stored, datetime(2024, 1, 3))
    assert second.new_rows.count() == 0


def test_kept_newest_state_stands_in_for_the_history(spark, tmp_path):
    path, base = str(tmp_path / "history"), str(tmp_path / "state")
    one, two = person(), person(carth_id="2", payroll_name="Roe, B")
    run_ingest(frame(spark, [one, two]), empty_history(spark), path, MORNING, state_base=base, mode="per_key")
    changed = [person(last_name="New"), two]
    run_ingest(frame(spark, changed), read_table(spark, base, "latest"), path, datetime(2024, 1, 3), state_base=base, mode="per_key")
    stored, latest = read_history(spark, path, PEOPLE), read_table(spark, base, "latest")
    assert (stored.count(), latest.count()) == (3, 2)
    feed = frame(spark, [person(last_name="Newer"), two, person()])
    by_history = ingest(feed, stored, datetime(2024, 1, 4), mode="per_key").new_rows
    by_latest = ingest(feed, latest, datetime(2024, 1, 4), mode="per_key").new_rows
    assert sorted(by_history.collect()) == sorted(by_latest.collect())
    assert by_latest.count() == 2


def test_dry_run_writes_nothing(spark, tmp_path):
    path = tmp_path / "history"
    run_ingest(frame(spark, [person()]), empty_history(spark), str(path), MORNING, apply=False)
    assert not path.exists()


def test_person_with_two_positions(spark, tmp_path):
    """With the position in both keys a second run of the same feed appends nothing,
    also when the two rows were stored on different days."""
    a, b = person(position_id="A"), person(position_id="B")
    keys = {"view_keys": ("carthage_id", "fullname", "position_id"), "verify_keys": ("carthage_id", "position_id"), "mode": "per_key"}
    path = str(tmp_path / "history")
    run_ingest(frame(spark, [a]), empty_history(spark), path, MORNING, **keys)
    run_ingest(frame(spark, [a, b]), read_history(spark, path, PEOPLE), path, datetime(2024, 1, 3), **keys)
    stored = read_history(spark, path, PEOPLE)
    assert stored.count() == 2
    assert ingest(frame(spark, [a, b]), stored, datetime(2024, 1, 4), **keys).new_rows.count() == 0


def test_null_rules_of_the_two_checks(spark):
    """A stored null equals a blank in the difference, so the row is not new at all."""
    stored = PEOPLE.to_history(clean(frame(spark, [person()])).drop(gate.REASON))
    history = stamped(stored.withColumn("middlename", F.lit(None).cast("string")), MORNING)
    assert ingest(frame(spark, [person()]), history, MORNING).new_rows.count() == 0
    assert ingest(frame(spark, [person(last_name="New")]), history, MORNING).new_rows.count() == 1


def test_padding_and_leading_zero(spark):
    stored = PEOPLE.to_history(clean(frame(spark, [person(last_name="Doe")])).drop(gate.REASON))
    padded = stamped(stored.withColumn("lastname", F.rpad("lastname", 20, " ")), MORNING)
    assert ingest(frame(spark, [person(last_name="Doe")]), padded, MORNING).new_rows.count() == 0
    # A file number that only differs in leading zeros is new in the difference and known in the check.
    assert ingest(frame(spark, [person(last_name="Doe", file_number="1")]), padded, MORNING).new_rows.count() == 0


def test_outer_blanks_are_appended_once(spark, tmp_path):
    """The difference trims the stored side only, so such a row comes back as new;
    the check, which ignores trailing blanks, knows it."""
    feed = frame(spark, [person(last_name="Doe  ", first_name=" Al", legal_country_code="US ")])
    path = str(tmp_path / "history")
    run_ingest(feed, empty_history(spark), path, MORNING)
    stored = read_history(spark, path, PEOPLE)
    assert stored.first()["firstname"] == " Al"
    assert ingest(feed, stored, datetime(2024, 1, 3)).new_rows.count() == 0


def test_history_is_partitioned_by_day(spark, tmp_path):
    rows = stamped(PEOPLE.to_history(clean(frame(spark, [person()])).drop(gate.REASON)), MORNING)
    append_history(rows, str(tmp_path / "h"))
    assert [p.name for p in (tmp_path / "h").glob("stamp_day=*")] == ["stamp_day=2024-01-02"]


def test_target_table_takes_the_last_published_batch(spark, tmp_path):
    base = str(tmp_path)
    write_table(spark.range(1), base, "t", "b9")
    write_table(spark.range(2), base, "t", "b10")
    write_attempt(spark.range(3), base, "t", "b11")
    assert read_table(spark, base, "t").count() == 2
    assert read_table(spark, base, "t", "b9").count() == 1
    write_table(read_table(spark, base, "t").unionByName(spark.range(5, 6)), base, "t", "b10")  # reads what it replaces
    assert read_table(spark, base, "t").count() == 3
    with pytest.raises(FileNotFoundError):
        read_table(spark, base, "t", "b11")
    with pytest.raises(FileNotFoundError):
        read_table(spark, base, "none")


def test_buckets_are_replaced_one_by_one(spark, tmp_path):
    base, key = str(tmp_path), ["id"]
    rows = spark.range(500).withColumn("v", F.lit("old"))
    write_table(rows, base, "t", "b1", key)
    before = table_folders(spark, base, "t")
    bucket = spark.range(7, 8).select(bucket_of([F.col("id")]).alias("n")).first().n
    part = read_table(spark, base, "t", None, [bucket])
    assert 0 < part.count() < 50
    publish(spark, base, "b2", {"t": write_attempt(part.withColumn("v", F.lit("new")), base, "t", "b2", key)}, whole=False)
    after = table_folders(spark, base, "t")
    assert {n for n in before if before[n] != after[n]} == {bucket}
    now = read_table(spark, base, "t")
    assert now.count() == 500 and now.filter("v = 'new'").count() == part.count()
    assert read_table(spark, base, "t", "b1").filter("v = 'new'").count() == 0


def test_rejects_are_stored_without_names(spark, tmp_path):
    path, base = str(tmp_path / "history"), str(tmp_path / "state")
    rows = [person(), person(carth_id="", last_name="Secret"), person(carth_id="x", file_number="", last_name="Secret")]
    for key in (None, "k"):
        for moment in (MORNING, MORNING):
            run_ingest(frame(spark, rows), empty_history(spark), path, moment, state_base=base, hide_key=key)
        log = spark.read.parquet(f"{base}/rejects").collect()
        assert sorted((r["stage"], r["reason"]) for r in log) == [("ingest", "no_file_number"), ("ingest", "no_person_id")]
        assert not any("Secret" in r["row"] for r in log) and any('"file_number":"000001"' in r["row"] for r in log)
        assert all(("last_name" in r["row"]) == (key is not None) for r in log)
    run_ingest(frame(spark, rows), empty_history(spark), str(tmp_path / "other"), MORNING)
    assert spark.read.parquet(str(tmp_path / "other-log" / "rejects")).count() == 2


def test_a_run_that_broke_off_is_caught_up_with(spark, tmp_path, monkeypatch):
    path, base = str(tmp_path / "history"), str(tmp_path / "state")
    run_ingest(frame(spark, [person()]), empty_history(spark), path, MORNING, state_base=base, mode="per_key")
    feed = frame(spark, [person(last_name="New")])

    def broken(*_, **__):
        raise RuntimeError("stopped")

    monkeypatch.setattr(plan, "publish", broken)
    with pytest.raises(RuntimeError):
        run_ingest(feed, read_table(spark, base, "latest"), path, datetime(2024, 1, 3), state_base=base, mode="per_key")
    monkeypatch.undo()
    again = run_ingest(feed, read_table(spark, base, "latest"), path, datetime(2024, 1, 4), state_base=base, mode="per_key")
    assert again.new_rows.count() == 0 and read_history(spark, path, PEOPLE).count() == 2
    assert [r["lastname"] for r in read_table(spark, base, "latest").collect()] == ["New"]


def test_newest_state_of_a_padded_history(spark, tmp_path):
    stored = PEOPLE.to_history(clean(frame(spark, [person()])).drop(gate.REASON))
    padded = stamped(stored.withColumn("fullname", F.rpad("fullname", 30, " ")), MORNING)
    base = str(tmp_path / "state")
    feed = frame(spark, [person(last_name="New")])
    run_ingest(feed, padded, str(tmp_path / "h"), datetime(2024, 1, 3), state_base=base, mode="per_key")
    assert [r["lastname"] for r in read_table(spark, base, "latest").collect()] == ["New"]


def test_no_file_number_is_said_first(spark):
    run = ingest(frame(spark, [person(carth_id="x", file_number="")]), empty_history(spark), MORNING)
    assert [r[gate.REASON] for r in run.rejects.collect()] == ["no_file_number"]


def test_quoted_line_break_is_an_error_by_default(spark, tmp_path):
    for column in ("last_name", PEOPLE.names[-1], PEOPLE.names[0]):
        path = write(tmp_path / column / "a.csv", feed_text([person(**{column: "a\nb"}), person(carth_id="2")]))
        with pytest.raises(Exception, match="line break"):
            read_feed(spark, path, PEOPLE).collect()
        assert read_feed(spark, path, PEOPLE, multi_line=True).count() == 2


def test_files_with_columns_in_another_order(spark, tmp_path):
    write(tmp_path / "drop" / "a.csv", feed_text([person(ssn="1")]))
    write(tmp_path / "drop" / "b.csv", feed_text([person(carth_id="2", ssn="2")], headers=PEOPLE.headers[::-1]), bom=False)
    rows = read_feed(spark, str(tmp_path / "drop"), PEOPLE).collect()
    assert {r["carth_id"]: r["ssn"] for r in rows} == {"1": "1", "2": "2"}
    write(tmp_path / "drop" / "c.csv", feed_text([person()], headers=PEOPLE.headers[1:]))
    with pytest.raises(ValueError, match="File Number"):
        read_feed(spark, str(tmp_path / "drop"), PEOPLE)
