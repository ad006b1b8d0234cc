"""The change script of a batch: every change in an order in which it can be carried out, and replay.

Rows are (batch_id, seq, target, action, key, before, after), the rows before and after as
JSON text. ``seq`` runs from 1 without gaps over the whole batch: code tables, then
positions, persons and what hangs on them, jobs last; within a table first what ends, then
what is updated, then what is new. Values are in the clear, since a replay needs them: the
script is as confidential as the tables themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeeper.operators.changes import END, INSERT, UPDATE, change_log, row_type
from rollkeeper.operators.keys import assign_keys
from rollkeeper.session import written

CARRIED_OUT = [END, UPDATE, INSERT]


def change_script(changes: dict[str, DataFrame], keys: dict[str, list[str]], batch_id: str, order: list[str], tables: dict[str, str] | None = None) -> DataFrame:
    """The script of a batch. ``changes`` by step, inserts numbered; ``order``: the steps, first to last;
    ``tables``: the table of a step whose name is another."""
    parts = []
    for place, step in enumerate(s for s in order if s in changes):
        target = (tables or {}).get(step, step)
        rows = changes[step].filter(F.col("action").isin(CARRIED_OUT))
        log = change_log_in_clear(rows, batch_id, target, keys[step])
        rank = F.array_position(F.array(*map(F.lit, CARRIED_OUT)), F.col("action"))
        parts.append(log.withColumn("_step", F.lit(place)).withColumn("_rank", rank))
    rows = written(reduce(DataFrame.unionByName, parts), "script-rows")
    numbered = assign_keys(rows, ["_step", "_rank", "key"], "seq", 0)
    return numbered.select("batch_id", "seq", "target", "action", "key", "before", "after")


def change_log_in_clear(changes: DataFrame, batch_id: str, target: str, key: list[str]) -> DataFrame:
    return change_log(changes, batch_id, target, key).drop("reason")


def _parsed(script: DataFrame, state: DataFrame, target: str, key: list[str]) -> DataFrame:
    """The changes of one table as rows: the key under ``_on_<name>``, before, after, and their place."""
    schema = row_type(state)
    rows = script.filter(F.col("target") == target).select(
        F.struct("batch_id", "seq").alias("_at"),
        F.from_json("before", schema).alias("before"),
        F.from_json("after", schema).alias("after"),
    )
    return rows.select(*[F.coalesce(f"before.{k}", f"after.{k}").alias(f"_on_{k}") for k in key], "_at", "before", "after")


def _on(key: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in key])


# A script may change every row of a table, and rows of JSON text are many times larger than
# their files, by which Spark judges what to broadcast. So script and table meet in merge joins.


def replay(state: DataFrame, script: DataFrame, target: str, key: list[str]) -> DataFrame:
    """The table after the script's batches, from the one before them.

    Of several changes of a row the last one stands: by batch id, then ``seq``. Rows that
    the script doesn't name are not touched.
    """
    rows = _parsed(script, state, target, key)
    last = rows.groupBy(*[f"_on_{k}" for k in key]).agg(F.max_by("after", "_at").alias("after"))
    last = written(last, "replayed")
    kept = state.join(last.drop("after").hint("merge"), _on(key), "left_anti")
    return kept.unionByName(last.select("after.*").select(*state.columns))


def unfit(state: DataFrame, script: DataFrame, target: str, key: list[str]) -> DataFrame:
    """The script's changes that don't fit the table: the row before isn't the stored one, or
    one that is to be inserted is there already. A replay on the right state has none."""
    rows = _parsed(script, state, target, key)
    first = written(rows.groupBy(*[f"_on_{k}" for k in key]).agg(F.min_by(F.struct("_at", "before"), "_at").alias("_first")), "first-changes")
    held = state.select(F.struct(*state.columns).alias("_held"), *key)
    joined = first.join(held.hint("merge"), _on(key), "left")
    same = F.to_json("_held").eqNullSafe(F.to_json("_first.before"))
    return joined.filter(~same).select(F.col("_first._at.batch_id").alias("batch_id"), F.col("_first._at.seq").alias("seq"))
