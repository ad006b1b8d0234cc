import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollkeeper.operators import people, sequence
from rollkeeper.operators.chains import doomed
from rollkeeper.operators.dated import dated_sequence, end_and_insert

AS_OF = date(2024, 1, 28)
DAY = timedelta(days=1)
CONTACT = "aa_no int, id int, aa string, beg_date date, end_date date, line1 string, ofc_add_by string"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_folds_go_over_range_edges(spark):
    """One key holds most rows and lies in many ranges; null keys and orders are keys and orders too."""
    r = random.Random(1)
    made = [(r.choice(["hot", "hot", "hot", "a", None]), k if k % 7 else None, r.randrange(-5, 6)) for k in range(600)]
    df = spark.createDataFrame(made, "k string, o int, v int")
    placed = sequence.placed(df, ["k"], ["o", "v"], ranges=8)
    assert placed.select(sequence.RANGE).distinct().count() >= 6
    out = sequence.previous(placed, ["k"], "v", "prev", "first")
    out = sequence.running(out, ["k"], F.col("v"), "sum", "total")
    out = rows(sequence.running(out, ["k"], F.col("v"), "max", "most").orderBy(sequence.PLACE))
    for key in ("hot", "a", None):
        own = [x for x in out if x["k"] == key]
        values = [x["v"] for x in own]
        assert [(x["o"] is not None, x["o"], x["v"]) for x in own] == sorted((o is not None, o, v) for k, o, v in made if k == key)
        assert [x["prev"] for x in own] == [None, *values[:-1]]
        assert [x["first"] for x in own] == [True] + [False] * (len(own) - 1)
        assert [x["total"] for x in own] == [sum(values[: i + 1]) for i in range(len(own))]
        assert [x["most"] for x in own] == [max(values[: i + 1]) for i in range(len(own))]


def test_a_null_before_is_not_the_same_as_none_before(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None)], "k string, o int, v int")
    out = rows(sequence.previous(sequence.placed(df, ["k"], ["o"], ranges=3), ["k"], "v", "prev", "first").orderBy("o"))
    assert [(x["prev"], x["first"]) for x in out] == [(None, True), (None, False), (5, False)]


def one_by_one(state, given, rule):
    """The state after the rows came one by one, as people would write them."""
    state = [dict(r) for r in state]
    for person, kind, day, value in given:
        own = [r for r in state if r["id"] == person and r["aa"] == kind]
        newest = max((r["beg_date"] for r in own), default=None)
        open_ = min((r for r in own if r["end_date"] is None), key=lambda r: r["aa_no"] or 10**9, default=None)
        if open_ is not None and open_["line1"] == value:
            continue
        after = newest + DAY if newest else None
        begin = {
            "phone": after or AS_OF,
            "max_plus_one": after or AS_OF,
            "email": max(AS_OF, after or AS_OF),
            "effective": max(day or AS_OF, after or day or AS_OF),
        }[rule]
        if open_ is not None:
            stored = open_["aa_no"] is not None
            end = {"phone": newest, "effective": begin - DAY}.get(rule, AS_OF)
            open_["end_date"] = end if stored or rule in ("phone", "effective") else max(end, open_["beg_date"])
        state.append({"aa_no": None, "id": person, "aa": kind, "beg_date": begin, "end_date": None, "line1": value, "ofc_add_by": "HR"})
    return state


def after(state_df, changes):
    """Stored rows with their ends, and the inserted ones without a number."""
    made = rows(changes)
    ends = {c["before"]["aa_no"]: c["after"] for c in made if c["action"] == "end_date"}
    assert len(ends) == sum(c["action"] == "end_date" for c in made)
    kept = [ends.get(r["aa_no"], r) for r in rows(state_df)]
    return kept + [c["after"] for c in made if c["action"] == "insert"]


def comparable(state):
    return sorted(tuple(sorted((k, str(v)) for k, v in r.items())) for r in state)


def random_state(r, persons):
    state, number = [], 0
    for person in range(persons):
        for kind in ("CELL", "EML2"):
            day = date(2024, 1, 1) + timedelta(days=r.randrange(40))
            held = r.randrange(3)
            for k in range(held):
                number += 1
                open_ = k == held - 1 and r.random() < 0.7
                state.append((number, person, kind, day + k * 3 * DAY, None if open_ else day + (k * 3 + 1) * DAY, r.choice("abc"), "HR"))
    return state


@pytest.mark.parametrize("rule", ["phone", "email", "max_plus_one", "effective"])
def test_like_rows_that_come_one_by_one(spark, rule):
    r = random.Random(rule)
    state = random_state(r, 14)
    given = {
        (r.choice([1, 1, 1, *range(2, 18)]), r.choice(["CELL", "EML2"]), date(2024, 1, 10) + timedelta(days=r.randrange(60)) if r.random() > 0.05 else None, r.choice("abcd"))
        for _ in range(250)
    }
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("aa", T.StringType()), T.StructField("day", T.DateType()), T.StructField("v", T.StringType())])
    incoming = spark.createDataFrame([*given, *list(given)[:20]], schema)  # equal rows count once
    state_df = spark.createDataFrame(state, CONTACT)
    changes = dated_sequence(incoming, state_df, "v", "line1", "day", F.lit(AS_OF), rule, ranges=6)
    ordered = sorted(given, key=lambda g: (g[0], g[1], g[2] is not None, g[2] or AS_OF, g[3]))
    names = [c.split()[0] for c in CONTACT.split(", ")]
    wanted = one_by_one([dict(zip(names, s, strict=True)) for s in state], ordered, rule)
    assert comparable(after(state_df, changes)) == comparable(wanted)
    made = rows(changes)
    assert sum(c["action"] in ("insert", "none") for c in made) == len(given)


@pytest.mark.parametrize("rule", ["phone", "email", "max_plus_one"])
def test_one_row_a_key_is_the_old_operator(spark, rule):
    r = random.Random(3)
    state_df = spark.createDataFrame(random_state(r, 20), CONTACT)
    given = spark.createDataFrame([(k, "CELL", AS_OF, r.choice("abcd")) for k in range(24)], "id int, aa string, day date, v string")
    one = end_and_insert(given, state_df, "v", "line1", F.lit(AS_OF), rule)
    many = dated_sequence(given, state_df, "v", "line1", "day", F.lit(AS_OF), rule)
    assert sorted(map(repr, rows(one))) == sorted(map(repr, rows(many)))


def test_no_rows(spark):
    given = spark.createDataFrame([], "id int, aa string, day date, v string")
    state = spark.createDataFrame([], CONTACT)
    assert rows(dated_sequence(given, state, "v", "line1", "day", F.lit(AS_OF), "effective")) == []


def _reaches(steps, lost):
    """Nodes with a path to a lost one or into a ring, by following every path."""
    onward = {}
    for a, b in steps:
        onward.setdefault(a, set()).add(b)

    def bad(n, seen):
        return n in lost or n in seen or any(bad(m, seen | {n}) for m in onward.get(n, ()))

    return {n for n in {a for s in steps for a in s} | lost if bad(n, frozenset())}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_doomed_by_following_paths(spark, seed):
    r = random.Random(seed)
    steps = {(f"n{r.randrange(40)}", f"n{r.randrange(40)}") for _ in range(30)}
    steps |= {(f"c{k}", f"c{k + 1}") for k in range(33)}
    lost = {"n3", "n11", "c20", "alone"}
    out = doomed(spark.createDataFrame(sorted(steps), "a string, b string"), spark.createDataFrame([(n,) for n in lost], "n string"))
    assert {x["n"] for x in rows(out)} == _reaches(steps, lost)


def test_doomed_without_steps_or_lost(spark):
    none = spark.createDataFrame([], "a string, b string")
    assert rows(doomed(none, spark.createDataFrame([], "n string"))) == []
    ring = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "a"), ("a", "d")], "a string, b string")
    assert {x["n"] for x in rows(doomed(ring, spark.createDataFrame([], "n string")))} == {"a", "b", "c"}


XREF = "old_id string, old_id_num int, adp_id string, ssn string, cx_id int, cx_id_char string, adp_associate_id string"


def released(spark, stored, asked):
    """``stored``: person -> (file number, associate id); ``asked`` the same. Gives person -> action or reason."""
    state = spark.createDataFrame([(str(p), p, f, "", p, str(p), a) for p, (f, a) in stored.items()], XREF)
    batch = spark.createDataFrame([(p, f, a, "s") for p, (f, a) in asked.items()], "id int, file_number string, employee_assoc_id string, ssn string")
    return {c["after"]["cx_id"]: c["reason"] or c["action"] for c in rows(people.xref_in_order(batch, state))}


@pytest.mark.parametrize("n", [1, 2, 50])
def test_chain_of_file_numbers(spark, n):
    stored = {k: (f"f{k}", f"a{k}") for k in range(n)}
    asked = {k: (f"f{k + 1}", f"a{k}") for k in range(n)}
    assert released(spark, stored, asked) == dict.fromkeys(range(n), "update")
    stored[n] = (f"f{n}", f"a{n}")  # someone outside the batch keeps what the last one wants
    assert released(spark, stored, asked) == dict.fromkeys(range(n), "file_number_held")


def test_rings_wait_for_one_another(spark):
    stored = {k: (f"f{k}", f"a{k}") for k in range(5)}
    asked = {0: ("f1", "a0"), 1: ("f0", "a1"), 2: ("f3", "a2"), 3: ("new", "a3"), 4: ("f0", "a4")}
    assert released(spark, stored, asked) == {0: "file_number_held", 1: "file_number_held", 2: "update", 3: "update", 4: "file_number_held"}


def test_both_ids_and_contests(spark):
    stored = {1: ("f1", "a1"), 2: ("f2", "a2"), 3: ("f3", "a3"), 9: ("f9", "a9")}
    asked = {
        1: ("f1x", "a1x"),  # gives both up
        4: ("f1", "a4"),
        5: ("f5", "a1"),
        6: ("f6", "a1"),  # 5 gets it
        7: ("f1", "a7"),  # 4 gets it
        2: ("f9", "a2"),  # held by 9, which isn't in the batch, so 2 keeps f2
        8: ("f2", "a8"),
        3: (None, "a3"),  # gives its number up for none
        10: ("f3", None),
        11: ("f11", "a9"),
        12: ("f6", "a12"),  # 6 is refused, but asks first: nobody gets f6
    }
    assert released(spark, stored, asked) == {
        1: "update", 4: "insert", 5: "insert", 6: "associate_id_held", 7: "file_number_held", 2: "file_number_held",
        8: "file_number_held", 3: "update", 10: "insert", 11: "associate_id_held", 12: "insert",
    }


def test_same_ids_and_empty_tables(spark):
    assert released(spark, {1: ("f", "a")}, {1: ("f", "a")}) == {1: "update"}
    assert released(spark, {}, {1: ("f", "a")}) == {1: "insert"}
    assert released(spark, {1: ("f", "a")}, {}) == {}


def test_two_holders_of_one_number(spark):
    """A number that two persons hold is free when both give it up."""
    stored = {1: ("f", "a1"), 2: ("f", "a2")}
    assert released(spark, stored, {1: ("g", "a1"), 3: ("f", "a3")}) == {1: "update", 3: "file_number_held"}
    assert released(spark, stored, {1: ("g", "a1"), 2: ("h", "a2"), 3: ("f", "a3")}) == {1: "update", 2: "update", 3: "insert"}
