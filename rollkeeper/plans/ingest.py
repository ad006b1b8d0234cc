"""The nightly sync: clean the feed, find what is new, append it to the history."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeeper.contract import PEOPLE, STAMP, STAMP_DAY, Contract
from rollkeeper.operators import gate
from rollkeeper.operators.places import PLACE, at_places, placed
from rollkeeper.operators.snapshot import (
    FINGERPRINT,
    SEEN,
    latest_snapshot,
    not_in_latest,
    row_fingerprint,
    seen_key,
    snapshot_diff,
    snapshot_diff_kept,
)
from rollkeeper.session import written
from rollkeeper.sources.history import append_history, read_history, stamped
from rollkeeper.sources.kept import FINGERPRINTS, kept_fingerprints, write_fingerprints
from rollkeeper.sources.tables import NO_BUCKET, publish, reject_rows, store_rejects, write_attempt

NO_TITLE = gate.SKIP + "no_job_title_code"
NO_ID = "no_person_id"
BAD_ID = "bad_value:carth_id"
NO_FILE_NUMBER = "no_file_number"
#: Columns that the gates look at, and the name of the person among the keys of a feed.
GATED = ("job_title_code", "carth_id", "file_number")
PERSON = "_person"
VIEW_KEYS = ("carthage_id", "fullname")
VERIFY_KEYS = ("carthage_id",)
# What a stored reject shows in the clear.
SHOWN = ("file_number", "carth_id", "job_title_code", "payroll_comp_code", "position_id")


@dataclass(frozen=True)
class Ingest:
    """What a run found. ``new_rows`` are in history form, stamped."""

    new_rows: DataFrame
    rejects: DataFrame
    skipped: DataFrame


def clean(feed: DataFrame, contract: Contract = PEOPLE) -> DataFrame:
    """Cleaned columns, and the reason why a row cannot be cleaned.

    Each date is read once: the reason looks at the cleaned date beside its text.
    """
    kept = [gate.REASON] if gate.REASON in feed.columns else []
    texts = [F.col(f.name).alias(f"_{f.name}") for f in contract.date_fields]
    cleaned = [f.clean(F.col(f.name)).alias(f.name) for f in contract.fields]
    rules = [
        (f"bad_value:{f.name}", (F.col(f"_{f.name}") != "") & F.col(f.name).isNull())
        for f in contract.date_fields
    ]
    marked = gate.judged(feed.select(*cleaned, *texts, *kept), rules)
    return marked.select(*contract.names, gate.REASON)


def _seen(values: dict[str, Column], contract: Contract, numbers: tuple[str, ...]) -> Column:
    """The key of the seen-before check, from the values of the history columns."""
    texts = {f.history for f in contract.fields if f.type == "string"}
    return seen_key(values, texts, [f.history for f in contract.date_fields], list(numbers))


def keyed_feed(cleaned: DataFrame, contract: Contract, person: str, numbers: tuple[str, ...]) -> DataFrame:
    """What decides on the cleaned rows, stored: their places, the columns the gates look at, the
    stored person, fingerprints and keys of the seen-before check."""
    values = {f.history: f.stored(F.col(f.name)) for f in contract.fields}
    mark = row_fingerprint([F.col(n) for n in contract.names], blank_is_null=True)
    keys = [mark.alias(FINGERPRINT), _seen(values, contract, numbers).alias(SEEN)]
    return written(cleaned.select(PLACE, gate.REASON, *GATED, values[person].alias(PERSON), *keys), "feed-keys")


def keyed_state(view: DataFrame, contract: Contract, keys: list[str], numbers: tuple[str, ...], marked: bool) -> DataFrame:
    """Keys, stamps and keys of the seen-before check of history rows, stored; with ``marked`` their fingerprints too."""
    values = {f.history: F.col(f.history) for f in contract.fields}
    mark = row_fingerprint([f.short(F.col(f.history)) for f in contract.fields], blank_is_null=True)
    marks = [mark.alias(FINGERPRINT)] if marked else []
    return written(view.select(*keys, STAMP, *marks, _seen(values, contract, numbers).alias(SEEN)), "state-keys")


def ingest(
    feed: DataFrame,
    history: DataFrame,
    moment: datetime,
    contract: Contract = PEOPLE,
    view_keys: tuple[str, ...] = VIEW_KEYS,
    verify_keys: tuple[str, ...] = VERIFY_KEYS,
    mode: str = "stamp_in",
    numbers: tuple[str, ...] = ("file_no", "carthage_id"),
    kept: DataFrame | None = None,
) -> Ingest:
    """One run; nothing is appended here. The cleaned feed is written to the shared folder,
    so it is worked out once, and then what decides on its rows: fingerprints, keys, places.
    Only these are dealt out; the wide rows stay where they lie and are picked by their
    places when a result is read. The first of ``verify_keys`` is the person.

    ``feed`` has the short names, ``history`` the history columns and the stamp.
    For a person with several rows add what tells them apart (``position_id``) to
    both key lists and use ``per_key``: then a second run appends nothing. A history
    that is partitioned by its day is read by the days that count. ``kept`` are the
    fingerprints of the newest state, if they were kept: then it isn't hashed again.
    """
    person = verify_keys[0]
    cleaned = placed(clean(feed, contract), "cleaned-feed")
    keys = keyed_feed(cleaned, contract, person, numbers)
    readable, unreadable = gate.accepted(keys), gate.rejected(cleaned).drop(PLACE)

    day = STAMP_DAY if STAMP_DAY in history.columns else None
    view = latest_snapshot(contract.unpadded(history), list(view_keys), STAMP, mode, day)
    if kept is None:
        state = keyed_state(view, contract, list(verify_keys), numbers, True)
        changed = snapshot_diff(readable, state, blank_is_null=True)
    else:
        changed = snapshot_diff_kept(readable, kept, blank_is_null=True)

    rules = [
        gate.empty_rule(NO_TITLE, "job_title_code"),
        gate.empty_rule(NO_ID, "carth_id"),
        gate.empty_rule(NO_FILE_NUMBER, "file_number"),
        (BAD_ID, F.col("carth_id").try_cast("int").isNull()),
    ]
    marked = written(gate.judged(changed, rules), "changed-keys")
    candidates = gate.accepted(marked)
    if kept is not None:
        # The newest rows per person are all in the view, and only persons with a
        # changed row are asked for: most of the view is not hashed.
        asked = view.join(candidates.select(F.col(PERSON).alias(person)).distinct(), person, "left_semi")
        state = keyed_state(asked, contract, list(verify_keys), numbers, False)
    latest = latest_snapshot(state, list(verify_keys), STAMP, "per_key")
    dates = [f.history for f in contract.date_fields]
    unseen = not_in_latest(candidates, latest, contract.history_names, dates, list(numbers))
    judged = gate.judged(at_places(cleaned, gate.refused(marked)), rules)
    return Ingest(
        new_rows=stamped(contract.to_history(at_places(cleaned, unseen)), moment),
        rejects=unreadable.unionByName(gate.rejected(judged).drop(PLACE)),
        skipped=gate.skipped(judged).drop(PLACE),
    )


def refresh_latest(
    latest: DataFrame, new_rows: DataFrame, keys: tuple[str, ...] = VIEW_KEYS, mode: str = "stamp_in"
) -> DataFrame:
    """The newest recorded state after a batch, from the one before it.

    The newest row of every key is in the old state or in the batch, so the long
    history need not be read: a run may take this table in its place.
    """
    return latest_snapshot(latest.unionByName(new_rows), list(keys), STAMP, mode)


def missed(history: DataFrame, path: str, contract: Contract = PEOPLE) -> DataFrame | None:
    """The rows that were appended at ``path`` after the newest stamp of ``history``; None if nothing is stored there."""
    try:
        stored = read_history(history.sparkSession, path, contract)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    newest = history.agg(F.max(STAMP)).first()[0]
    later = stored.select(*contract.history_names, STAMP)
    return later if newest is None else later.filter(F.col(STAMP) > F.lit(newest))


def caught_up(history: DataFrame, path: str, contract: Contract = PEOPLE) -> DataFrame:
    """``history`` with the rows that were appended at ``path`` after its newest stamp."""
    later = missed(history, path, contract)
    if later is None or later.isEmpty():
        return history
    return history.select(*contract.history_names, STAMP).unionByName(later)


def run_ingest(
    feed: DataFrame,
    history: DataFrame,
    history_path: str,
    moment: datetime,
    apply: bool = True,
    state_base: str | None = None,
    hide_key: str | None = None,
    keep: bool = False,
    **options,
) -> Ingest:
    """One run and, unless it is a dry run, the new rows appended and the rejects stored.

    ``history`` is the stored history or its newest state. With ``state_base`` the
    next newest state is kept there as the table ``latest``, and the rejects as
    ``rejects``; without it they lie beside the history. The next newest state is
    written before the rows are appended and published after it; a run that broke off
    in between is caught up with by the next one.

    ``keep``: ``history`` is the table ``latest``, whose fingerprints are kept beside it and
    used by the next run (unless that has rows to catch up with).
    """
    spark, batch_id = feed.sparkSession, f"{moment:%Y%m%dT%H%M%S}"
    contract = options.get("contract", PEOPLE)
    if keep:
        if state_base is None:
            raise ValueError("fingerprints are kept beside the table latest; give state_base")
        options["kept"] = kept_fingerprints(spark, state_base, "latest")
    if apply:
        whole = caught_up(history, history_path, contract)
        if whole is not history:
            history = whole
            options.pop("kept", None)
    result = ingest(feed, history, moment, **options)
    if not apply:
        return result
    fresh, rejects = written(result.new_rows, "new-rows"), written(result.rejects, "rejects")
    hide = [c for c in rejects.columns if c not in SHOWN]
    stored = reject_rows(rejects, batch_id, "ingest", gate.REASON, hide, hide_key)
    if state_base:
        kept = {k: v for k, v in (("keys", options.get("view_keys")), ("mode", options.get("mode"))) if v}
        known = contract.unpadded(history).select(*fresh.columns)
        parts = {"latest": write_attempt(refresh_latest(known, fresh, **kept), state_base, "latest", batch_id)}
        if keep:
            now = spark.read.schema(fresh.schema).parquet(f"{state_base}/{parts['latest'][NO_BUCKET]}")
            view = contract.from_history(contract.unpadded(now))
            parts[FINGERPRINTS] = write_fingerprints(view, state_base, batch_id, contract.names, blank_is_null=True)
        store_rejects(stored, state_base)
    else:
        store_rejects(stored, history_path.rstrip("/") + "-log")
    append_history(fresh, history_path)
    if state_base:
        publish(spark, state_base, batch_id, parts)
    return Ingest(fresh, rejects, result.skipped)
