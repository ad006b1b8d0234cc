"""Changes to a target table, and the next state they lead to.

Every change operator returns rows of ``(action, reason, before, after)``:
``before`` is the stored row (null for an insert), ``after`` the row to be.
A target row gets at most one update or end per batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollkeeper.operators.keys import assign_keys
from rollkeeper.operators.spread import narrowed
from rollkeeper.session import written
from rollkeeper.sources.tables import hidden

INSERT = "insert"
UPDATE = "update"
END = "end_date"
NONE = "none"
REJECT = "reject"


def row_type(state: DataFrame) -> T.StructType:
    """The schema of a target row, every column nullable."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in state.schema])


def row_after(schema: T.StructType, values: dict[str, Column], base: str | None = None) -> Column:
    """A row of the target: ``values`` over the stored row ``base`` or over nulls."""

    def one(f: T.StructField) -> Column:
        if f.name in values:
            c = values[f.name]
        elif base is not None:
            c = F.col(base).getField(f.name)
        else:
            c = F.lit(None)
        return c.cast(f.dataType).alias(f.name)

    return F.struct(*[one(f) for f in schema])


def change(action: str, schema: T.StructType, after: Column, stored: bool, reason: Column | None = None) -> Column:
    """One change as a struct; ``stored`` tells whether there is a row before it."""
    before = F.col("before") if stored else F.lit(None).cast(schema)
    return F.struct(
        F.lit(action).alias("action"),
        (F.lit(None) if reason is None else reason).cast("string").alias("reason"),
        before.cast(schema).alias("before"),
        after.alias("after"),
    )


def emit(df: DataFrame, changes: Column) -> DataFrame:
    """An array of changes per row to one row per change."""
    return df.select(F.explode(F.filter(changes, lambda c: c.isNotNull())).alias("_c")).select("_c.*")


def stored_row(state: DataFrame, on: list[str], pick: str | None = None, among: Column | None = None) -> DataFrame:
    """The stored row per key as ``before``, key columns renamed ``_on_<name>``.

    With ``pick`` the key may repeat and the smallest ``pick`` wins.
    """
    rows = state if among is None else state.filter(among)
    keys = [F.col(c).alias(f"_on_{c}") for c in on]
    row = F.struct(*state.columns)
    if pick is None:
        return rows.select(*keys, row.alias("before"))
    return rows.groupBy(*keys).agg(F.min_by(row, F.col(pick)).alias("before"))


def with_stored(df: DataFrame, stored: DataFrame, on: dict[str, str]) -> DataFrame:
    """Left join of a batch with its stored rows; ``on`` maps batch to state names."""
    same = [F.col(mine) == F.col(f"_on_{theirs}") for mine, theirs in on.items()]
    joined = df.join(stored, reduce(lambda a, b: a & b, same), "left")
    return joined.drop(*[f"_on_{c}" for c in on.values()])


def upsert(
    df: DataFrame,
    state: DataFrame,
    on: dict[str, str],
    updates: dict[str, Column],
    inserts: dict[str, Column] | None = None,
    when_differs: list[str] | None = None,
    pick: str | None = None,
    among: Column | None = None,
) -> DataFrame:
    """Insert unknown keys, update known ones.

    ``updates`` and ``inserts`` map target columns to expressions over the batch.
    Without ``inserts`` unknown keys are left alone. With ``when_differs`` a known
    row is updated only if one of those columns changes, else it is ``none``.
    """
    schema = row_type(state)
    joined = with_stored(df, stored_row(state, list(on.values()), pick, among), on)
    known = F.col("before").isNotNull()
    updated = change(UPDATE, schema, row_after(schema, updates, "before"), True)
    if when_differs:
        types = {f.name: f.dataType for f in schema}
        moved = [
            ~F.col("before").getField(c).eqNullSafe(updates[c].cast(types[c])) for c in when_differs
        ]
        same = change(NONE, schema, F.col("before").cast(schema), True)
        updated = F.when(reduce(lambda a, b: a | b, moved), updated).otherwise(same)
    result = F.when(known, updated)
    if inserts is not None:
        result = result.otherwise(change(INSERT, schema, row_after(schema, inserts), False))
    return emit(joined, F.array(result))


def number_inserts(
    changes: DataFrame, state: DataFrame, key: str, natural: list[str], earlier: DataFrame | None = None
) -> DataFrame:
    """Gives each insert a ``key`` above the highest in use, in the order of ``natural``.

    The changes are written once, so the numbers stay the same however often the
    result is read. ``earlier``: changes of the same table, numbered before these.
    """
    changes = written(changes, f"numbered-{key}")
    inserts = changes.filter(F.col("action") == INSERT).select("after.*")
    top = state.agg(F.max(key)).first()[0] or 0
    if earlier is not None:
        top = max(top, earlier.agg(F.max(f"after.{key}")).first()[0] or 0)
    numbered = assign_keys(inserts, natural, key, top)
    schema = row_type(state)
    rows = numbered.select(
        F.lit(INSERT).alias("action"),
        F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast(schema).alias("before"),
        F.struct(*[F.col(c) for c in state.columns]).cast(schema).alias("after"),
    )
    return changes.filter(F.col("action") != INSERT).unionByName(rows)


def apply_changes(state: DataFrame, changes: DataFrame, key: list[str], merged: bool = False) -> DataFrame:
    """The next state: updated rows replaced, inserted rows added.

    Only the changed rows take part in the join, so Spark can broadcast a small
    batch and leave the big state where it lies. ``merged``: by a merge join, for changes as
    many as the rows of the state; none of them goes through the driver then.
    """
    touched = changes.filter(F.col("action").isin(UPDATE, END)).select(
        *[F.col(f"before.{k}").alias(f"_on_{k}") for k in key], "after"
    )
    same = [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in key]
    touched = touched.hint("merge") if merged else touched
    kept = state.join(touched, reduce(lambda a, b: a & b, same), "left").select(
        *[
            F.when(F.col("after").isNotNull(), F.col(f"after.{c}")).otherwise(F.col(c)).alias(c)
            for c in state.columns
        ]
    )
    added = changes.filter(F.col("action") == INSERT).select("after.*")
    return kept.unionByName(added)


def overlay(state: DataFrame, changes: DataFrame, key: list[str], column: str, asked: DataFrame) -> DataFrame:
    """The rows of the next state whose ``column`` has a value that the stored table ``asked``
    holds: stored rows but for the touched ones, and what the changes made of these and added.

    The next state itself is neither built nor written; what is read of the stored rows and
    joined is what was asked for.
    """
    moved = changes.filter(F.col("action").isin(INSERT, UPDATE, END))
    touched = moved.filter(F.col("before").isNotNull()).select(*[F.col(f"before.{k}").alias(f"_on_{k}") for k in key])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in key])
    kept = narrowed(state, column, asked).join(touched, same, "left_anti")
    return kept.unionByName(narrowed(moved.select("after.*"), column, asked))


def rejects_of(df: DataFrame, schema: T.StructType, values: dict[str, Column], reason: str) -> DataFrame:
    """Rows that lost or failed, as changes that change nothing."""
    return emit(df, F.array(change(REJECT, schema, row_after(schema, values), False, F.lit(reason))))


def change_log(
    changes: DataFrame, batch_id: str, target: str, key: list[str], hide: list[str] | None = None, hide_key: str | None = None
) -> DataFrame:
    """Changes of one target in the common form of the log.

    Rows before and after are JSON text, so the logs of all targets can be put
    together. Columns in ``hide`` (personal data) are logged as a hash with ``hide_key``,
    without one not at all.
    """
    hide = hide or []

    def text(row: str) -> Column:
        names = changes.schema[row].dataType.names
        values = [
            (hidden(F.col(f"{row}.{n}"), hide_key) if n in hide else F.col(f"{row}.{n}")).alias(n)
            for n in names
        ]
        return F.when(F.col(row).isNotNull(), F.to_json(F.struct(*values)))

    ids = [F.coalesce(F.col(f"before.{k}"), F.col(f"after.{k}")).cast("string") for k in key]
    return changes.select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(target).alias("target"),
        "action",
        "reason",
        F.concat_ws("|", *ids).alias("key"),
        text("before").alias("before"),
        text("after").alias("after"),
    )


def run_counts(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How many changes of each kind a run made."""
    by = by or ["target", "action"]
    return log.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
