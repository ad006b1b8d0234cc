import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from test_sources import feed_text, person, write

from rollkeeper.contract import CORRUPT, PEOPLE
from rollkeeper.queries import runs
from rollkeeper.sources.feed import read_feed
from rollkeeper.sources.quoted import UnevenQuotes, file_lines, range_starts, read_quoted

RANGE = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_ranges(spark):
    size = spark.conf.get(RANGE)
    spark.conf.set(RANGE, "700")
    yield
    spark.conf.set(RANGE, size)


def value(r):
    pieces = ["a", "é", " ", ",", '"', '""', "\n", "\n\n", "\r\n", "'", "\\", "x" * 40]
    return "".join(r.choice(pieces) for _ in range(r.randrange(7)))


def text_of(rows, end):
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator=end).writerows(rows)
    return out.getvalue()


def plain(rows):
    """As the reader gives them: line ends inside values are LF, a blank is a blank."""
    return sorted(tuple(v.replace("\r\n", "\n") for v in r) for r in rows)


@pytest.mark.parametrize(("seed", "end"), [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_records_as_by_a_csv_reader(spark, tmp_path, small_ranges, seed, end):
    r = random.Random(seed)
    wanted = []
    for k in range(3):
        rows = [[f"{k}-{i}", value(r), value(r)] for i in range(r.choice([0, 5, 150]))]
        wanted += rows
        write(tmp_path / "drop" / f"{k}.csv", text_of([["id", "a", "b"], *rows], end), bom=k == 1)
    got = read_quoted(spark, str(tmp_path / "drop"), ["id", "a", "b"]).collect()
    assert sorted((x["id"], x["a"], x["b"]) for x in got) == plain(wanted)
    assert all(x[CORRUPT] is None for x in got)


def test_one_file_is_read_by_several_tasks(spark, tmp_path, small_ranges):
    """A value of many lines runs over whole ranges, so some begin inside it."""
    rows = [["1", "x\n" * 2000, "b"], ["2", "c", "d\ne"], ["3", "", ""]]
    path = write(tmp_path / "drop" / "a.csv", text_of([["id", "a", "b"], *rows], "\n"))
    lines = file_lines(spark, path)
    assert lines.rdd.getNumPartitions() > 3
    ranges = range_starts(lines).collect()
    assert len(ranges) > 3 and any(x["open"] for x in ranges) and not all(x["open"] for x in ranges)
    got = read_quoted(spark, path, ["id", "a", "b"]).collect()
    assert sorted((x["id"], x["a"], x["b"]) for x in got) == plain(rows)


def test_a_missing_quote_names_the_file(spark, tmp_path, small_ranges):
    write(tmp_path / "drop" / "good.csv", text_of([["id", "a"], ["1", "x"]], "\n"))
    write(tmp_path / "drop" / "bad.csv", 'id,a\n1,"x\n2,y\n')
    with pytest.raises(UnevenQuotes, match="bad.csv"):
        read_quoted(spark, str(tmp_path / "drop"), ["id", "a"])


def test_a_record_of_too_many_lines_is_an_error(spark, tmp_path, small_ranges):
    """Two stray quotes pair up, and all between them would be one value."""
    path = write(tmp_path / "drop" / "a.csv", 'id,a\n1,"x\n' + "2,y\n" * 300 + '3,"z\n')
    with pytest.raises(UnevenQuotes, match="302 lines"):
        read_quoted(spark, path, ["id", "a"], most_lines=100)


def test_uneven_rows_and_empty_lines(spark, tmp_path, small_ranges):
    path = write(tmp_path / "drop" / "a.csv", 'id,a,b\n\n1,"x\ny"\n2,"p","q","r"\n\n3,s,t\n')
    got = {x["id"]: x for x in read_quoted(spark, path, ["id", "a", "b"]).collect()}
    assert sorted(got) == ["1", "2", "3"]
    assert (got["1"]["a"], got["1"]["b"], got["1"][CORRUPT]) == ("x\ny", "", '1,"x\ny"')
    assert got["2"][CORRUPT] is not None and got["3"][CORRUPT] is None


def test_feed_with_line_breaks(spark, tmp_path, small_ranges):
    rows = [person(carth_id=str(k), last_name=f'a "b",\nc{k}', long_title="x\r\ny") for k in range(1, 20)]
    write(tmp_path / "drop" / "a.csv", feed_text(rows, end="\r\n"))
    full = feed_text([person(carth_id="50", last_name="p\nq"), person(carth_id="51")], headers=PEOPLE.headers[::-1]).rstrip("\n")
    write(tmp_path / "drop" / "b.csv", full.rsplit(",", 2)[0] + "\n", bom=False)
    got = {x["carth_id"]: x for x in read_feed(spark, str(tmp_path / "drop"), PEOPLE, quoted_lines=True).collect()}
    assert {got[str(k)]["last_name"] for k in range(1, 20)} == {f'a "b",\nc{k}' for k in range(1, 20)}
    assert got["1"]["long_title"] == "x\ny" and got["50"]["last_name"] == "p\nq"
    assert len({x["source_file"] for x in got.values()}) == 2
    assert sum(x["reject_reason"] == "short_row" for x in got.values()) == 1


def test_no_shuffle_carries_text_while_counting(spark, tmp_path):
    """Ranges are counted on narrow rows."""
    path = write(tmp_path / "drop" / "a.csv", text_of([["id", "a"], ["1", "x\ny"]], "\n"))
    assert set(range_starts(file_lines(spark, path)).columns) == {"_file", "range", "open", "first"}
    assert read_quoted(spark, path, ["id", "a"]).filter(F.col("a") == "x\ny").count() == 1


def test_ranges_grow_with_the_feed(spark, tmp_path):
    for name, size in (("small", 1000), ("large", runs.MOST_RANGES * runs.LEAST_RANGE * 3)):
        (tmp_path / name).mkdir()
        with open(tmp_path / name / "part.csv", "wb") as f:
            f.truncate(size)
    assert runs.range_bytes(spark, str(tmp_path / "small")) == runs.LEAST_RANGE
    assert runs.range_bytes(spark, str(tmp_path / "large")) == runs.LEAST_RANGE * 3
