"""Slowly changing dimensions of type 2: build, merge, read and check history.

Intervals are half open, ``[valid_from, valid_to)``; an open version has a null
``valid_to`` and ``is_current`` true. Entity keys must not be null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import instant
from tidemark.operators.ordered import (
    COLD,
    RANGE,
    carry_backward,
    carry_forward,
    default_parts,
    latest_per_key,
    split_hot_keys,
    within_ranges,
)
from tidemark.schema import IS_CURRENT, SCD2_COLUMNS, VALID_FROM, VALID_TO


def _required(key: str) -> Column:
    message = F.lit(f"entity key {key!r} must not be null")
    return F.when(F.col(key).isNull(), F.raise_error(message)).otherwise(F.col(key)).alias(key)


def _with_keys(keys: Sequence[str], row: Column) -> Column:
    """``row``, or a failure if a key is null."""
    for k in keys:
        row = F.when(F.col(k).isNull(), F.raise_error(F.lit(f"entity key {k!r} must not be null"))).otherwise(row)
    return row


def _unique(names: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(names))


def scd2_initial(df: DataFrame, stamp: str) -> DataFrame:
    """Every row as an open version that starts at its ``stamp``."""
    start = df.schema[stamp].dataType
    return df.withColumns(
        {
            VALID_FROM: F.col(stamp),
            VALID_TO: F.lit(None).cast(start),
            IS_CURRENT: F.lit(True),
        }
    )


def scd2_current(df: DataFrame) -> DataFrame:
    """The open versions."""
    return df.where(F.col(IS_CURRENT))


def scd2_as_of(df: DataFrame, at) -> DataFrame:
    """The versions that were valid at the instant ``at``."""
    at = instant(at, df.schema[VALID_FROM].dataType)
    return df.where(
        (F.col(VALID_FROM) <= at) & (F.col(VALID_TO).isNull() | (at < F.col(VALID_TO)))
    )


def _pair(old: DataFrame, new: DataFrame, keys: Sequence[str], single: bool = False) -> DataFrame:
    """Old and new row per key as two structs; a struct is null if the side has no row.

    ``single`` adds ``_once``, which fails if ``new`` holds the key twice.
    """
    # Old keys stay the columns they are, so that an old side bucketed by them need not move.
    left = old.select(*keys, _with_keys(keys, F.struct(*old.columns)).alias("_old"))
    if single:
        right = _single(new.select(*keys, F.struct(*new.columns).alias("_new")), keys)
    else:
        right = new.select(*[_required(k) for k in keys], F.struct(*new.columns).alias("_new"))
    return left.join(right, list(keys), "full_outer")


def _single(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with a failing column ``_once`` if a key is null or comes twice, counted per key.

    The count shuffles by key, as a join on the keys does, which then needs no
    further exchange. The keys stay the columns they are: rows that are dealt out by them need not move.
    """
    times = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    twice = F.raise_error(F.lit("snapshot holds an entity key more than once"))
    return rows.withColumn("_once", _with_keys(keys, F.when(times > 1, twice).otherwise(F.lit(True))))


def _action(tracked: Sequence[str]) -> Column:
    old = F.struct(*[F.col("_old")[c] for c in tracked])
    new = F.struct(*[F.col("_new")[c] for c in tracked])
    return (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "close")
        .when(old.eqNullSafe(new), "same")
        .otherwise("update")
    )


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """What became of each key: ``insert``, ``update``, ``close`` or ``same``.

    Both sides hold a key at most once. Columns: the keys, ``action``, and each
    tracked column as ``old_<c>`` and ``new_<c>``. Values are compared
    null-safely; a side is absent only if it has no row.
    """
    return _pair(old, new, keys).select(
        *keys,
        _action(tracked).alias("action"),
        *[F.col("_old")[c].alias(f"old_{c}") for c in tracked],
        *[F.col("_new")[c].alias(f"new_{c}") for c in tracked],
    )


def scd2_merge(
    current: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    at,
    on_missing: str = "close",
    order: Sequence[str] | None = None,
    changes_only: bool = False,
) -> DataFrame:
    """The history table after a full snapshot taken at ``at``.

    ``same`` leaves the open row as it is, ``update`` closes it at ``at`` and
    opens a new one, ``insert`` opens one; a key that the snapshot lacks is
    closed or kept, as ``on_missing`` says. Closed history passes through
    untouched and takes no part in the join, so ``current`` is read twice: store
    the table between merges (``VersionLog`` does). A second run with the
    same snapshot changes nothing. ``changes_only`` gives the versions that the
    merge closes and opens, nothing else.

    The snapshot must hold a key at most once, else the job fails; give
    ``order`` to have the last row per key picked first. Closing a version at or
    before its start fails the job as well, and so does a null ``at``: rebuild
    such tables with ``scd2_from_history``.
    """
    if on_missing not in ("close", "keep"):
        raise ValueError("on_missing is 'close' or 'keep'")
    if at is None:
        raise ValueError("a merge needs the time of the snapshot")
    if order:
        snapshot = latest_per_key(snapshot, keys, order)
    payload = [c for c in current.columns if c not in SCD2_COLUMNS]
    start = current.schema[VALID_FROM].dataType
    at = instant(at, start)
    at = F.when(at.isNull(), F.raise_error(F.lit("a merge needs the time of the snapshot"))).otherwise(at)

    joined = _pair(scd2_current(current), snapshot.select(*payload), keys, single=True)
    old, new = F.col("_old"), F.col("_new")
    late = F.raise_error(F.lit("snapshot is not later than the version it would close"))
    close_at = F.when(old[VALID_FROM] >= at, late).otherwise(at)

    kept = F.struct(*[old[c].alias(c) for c in (*payload, *SCD2_COLUMNS)])
    closed = F.struct(
        *[old[c].alias(c) for c in payload],
        old[VALID_FROM].alias(VALID_FROM),
        close_at.alias(VALID_TO),
        F.lit(False).alias(IS_CURRENT),
    )
    opened = F.struct(
        *[new[c].alias(c) for c in payload],
        at.alias(VALID_FROM),
        F.lit(None).cast(start).alias(VALID_TO),
        F.lit(True).alias(IS_CURRENT),
    )
    none = F.slice(F.array(kept), 1, 0)
    same = none if changes_only else F.array(kept)
    versions = (
        F.when(~F.coalesce("_once", F.lit(True)), none)
        .when(F.col("_action") == "same", same)
        .when(F.col("_action") == "insert", F.array(opened))
        .when(F.col("_action") == "update", F.array(closed, opened))
        .otherwise(F.array(closed) if on_missing == "close" else same)
    )
    merged = joined.withColumn("_action", _action(tracked)).select(F.inline(versions))
    if changes_only:
        return merged
    history = current.where(~F.col(IS_CURRENT))
    return history.unionByName(merged)


def scd2_from_history(
    log: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    at: str,
    tie_break: Sequence[str] = (),
    parts: int | None = None,
    min_rows: int | None = None,
    weigh: DataFrame | None = None,
) -> DataFrame:
    """Versions rebuilt from a change log, equal neighbours collapsed.

    Of several rows of a key at one instant the last by ``tie_break`` counts
    (without one, the greatest tracked values), so no version is empty. Hot
    keys are scanned in ranges, see ``split_hot_keys``.
    """
    tie_break = list(tie_break) or list(tracked)
    rows = log.select(
        *[_required(k) for k in keys],
        *[c for c in _unique([*tracked, at, *tie_break]) if c not in keys],
    )
    rows, ranges = split_hot_keys(rows, keys, at, parts, min_rows, weigh)
    if not ranges:
        # Without hot keys one exchange can serve this step and the windows below.
        rows = rows.repartition(*keys)
    states = latest_per_key(rows, [*keys, RANGE, at], tie_break).select(
        *keys, RANGE, at, F.struct(*tracked).alias("_state")
    )

    window = within_ranges(keys, at)
    states = states.withColumn("_before", F.lag("_state").over(window))
    if ranges:
        tails = (
            states.where(F.col(RANGE) != COLD)
            .groupBy(*keys, RANGE)
            .agg(F.max_by("_state", at).alias("_carried"))
        )
        carried = carry_forward(tails, ranges, "_carried")
        states = states.join(carried, [*keys, RANGE], "left").withColumn(
            "_before", F.coalesce("_before", "_carried")
        )
    changes = states.where(~F.col("_before").eqNullSafe(F.col("_state"))).select(
        *keys, RANGE, at, "_state"
    )

    versions = changes.withColumn("_next", F.lead(at).over(window))
    if ranges:
        heads = (
            changes.where(F.col(RANGE) != COLD)
            .groupBy(*keys, RANGE)
            .agg(F.min(at).alias("_carried"))
        )
        versions = versions.join(
            carry_backward(heads, ranges, "_carried"), [*keys, RANGE], "left"
        ).withColumn("_next", F.coalesce("_next", "_carried"))
    return versions.select(
        *keys,
        *[F.col("_state")[c].alias(c) for c in tracked],
        F.col(at).alias(VALID_FROM),
        F.col("_next").alias(VALID_TO),
        F.col("_next").isNull().alias(IS_CURRENT),
    )


def scd2_splice(
    versions: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    at,
    until,
    following: DataFrame | None = None,
    on_missing: str = "close",
) -> DataFrame:
    """The versions that change when a snapshot taken at ``at`` comes late, after that of ``until`` was merged.

    The snapshot speaks for ``[at, until)``. A version that spans ``at`` and says
    otherwise is split there, and goes on from ``until`` if it did; a state that the next
    version begins with at ``until`` is joined to that; what the snapshot lacks
    is absent until then (``on_missing="close"``) or stays (``"keep"``). Any
    order of arrival gives the history of the right order.

    ``following`` holds the rows of the snapshot at ``until``, from which a
    version that goes on takes its untracked columns (else its own). With
    ``on_missing="keep"`` the next word on a key may come later than the next
    snapshot, or never: ``until`` is then the name of a column of ``following``, which
    has the next row that each key has in a later snapshot, with its time.

    Columns: those of ``versions`` and ``gone``, true for a version that another
    one has taken up; ``scd2_apply`` applies them. Keys come once in the snapshot, else the
    job fails, and so it does where a version begins at ``at``.
    """
    if on_missing not in ("close", "keep"):
        raise ValueError("on_missing is 'close' or 'keep'")
    payload = [c for c in versions.columns if c not in SCD2_COLUMNS]
    start = versions.schema[VALID_FROM].dataType
    at = instant(at, start)
    # One row per key on either side, each made where its rows are; only the snapshots move. A version goes
    # on where the following snapshot says what it says, so that one is read for the other columns alone.
    others = [c for c in payload if c not in (*keys, *tracked)]
    whole, begin, end = F.struct(*versions.columns), F.col(VALID_FROM), F.col(VALID_TO)
    spans, behind = (begin <= at) & (end.isNull() | (end > at)), begin > at
    history = versions.groupBy(*keys).agg(
        F.max_by(F.when(spans, whole), F.when(spans, begin)).alias("_old"),
        F.min_by(F.when(behind, whole), F.when(behind, begin)).alias("_next"),
    )
    said = snapshot.select(*keys, _with_keys(keys, F.struct(*payload)).alias("_new"))
    if following is not None:
        time = F.col(until).cast(start) if on_missing == "keep" else instant(until, start)
        words = following.select(*keys, F.struct(F.lit(True).alias("_said"), *others).alias("_following"), time.alias("_until"))
        said = said.unionByName(words, allowMissingColumns=True)
    else:
        said = said.withColumns({"_following": F.lit(None), "_until": F.lit(None).cast(start)})
    twice = F.raise_error(F.lit("snapshot holds an entity key more than once"))
    said = said.groupBy(*keys).agg(
        F.first("_new", ignorenulls=True).alias("_new"),
        F.first("_following", ignorenulls=True).alias("_following"),
        F.first("_until", ignorenulls=True).alias("_until"),
        F.when(F.count("_new") > 1, twice).otherwise(F.lit(True)).alias("_once"),
    )
    joined = history.join(said, list(keys), "full_outer")
    if on_missing == "close":
        joined = joined.withColumn("_until", instant(until, start))

    old, new, end = F.col("_old"), F.col("_new"), F.col("_until")
    after = F.when(F.col("_next")[VALID_FROM] == end, F.col("_next"))

    def version(source: Column, begin: Column, finish: Column, current: Column, gone: bool = False) -> Column:
        return F.struct(
            *[source[c].alias(c) for c in payload],
            begin.alias(VALID_FROM),
            finish.alias(VALID_TO),
            current.alias(IS_CURRENT),
            F.lit(gone).alias("gone"),
        )

    def states(row: Column) -> Column:
        return F.struct(*[row[c] for c in tracked])

    none = F.slice(F.array(version(old, at, at, F.lit(False))), 1, 0)
    clash = F.raise_error(F.lit("a version begins at the time of the late snapshot"))
    closed = F.when(old.isNull(), none).otherwise(
        F.array(version(old, F.when(old[VALID_FROM] >= at, clash).otherwise(old[VALID_FROM]), at, F.lit(False)))
    )
    goes_on = old.isNotNull() & end.isNotNull() & (old[VALID_TO].isNull() | (old[VALID_TO] > end))
    taken_up = after.isNotNull() & ~goes_on & states(after).eqNullSafe(states(new))
    finish = F.when(end.isNotNull(), end).otherwise(old[VALID_TO])
    opened = F.when(new.isNull(), none).when(
        taken_up,
        F.array(
            version(new, at, after[VALID_TO], after[IS_CURRENT]),
            version(after, after[VALID_FROM], after[VALID_TO], F.lit(False), gone=True),
        ),
    ).otherwise(F.array(version(new, at, finish, finish.isNull())))
    rest = old
    if following is not None:
        word = F.col("_following")
        own = [c for c in payload if c not in others]
        rest = F.struct(*[old[c].alias(c) for c in own], *[F.when(word.isNull(), old[c]).otherwise(word[c]).alias(c) for c in others])
    resumed = F.when(goes_on, F.array(version(rest, end, old[VALID_TO], old[IS_CURRENT]))).otherwise(none)
    once = F.coalesce("_once", F.lit(True))  # asked first, so that it is looked at
    same = old.isNotNull() & new.isNotNull() & states(old).eqNullSafe(states(new))
    quiet = same | ((new.isNull()) & F.lit(on_missing == "keep"))
    pieces = F.when(~once | quiet, none).otherwise(F.concat(closed, opened, resumed))
    return joined.select(F.inline(pieces))


def scd2_splice_log(
    versions: DataFrame,
    late: DataFrame,
    later: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    at: str,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The versions that change when log rows come ``late``, after the ``later`` ones were taken.

    A key's log is silent between its rows, so how long a late state lasts is
    known only from the next row of the key: ``later`` has the log that was
    taken in place of the late rows' turn. Keys of ``late`` are rebuilt from their first late row
    on, other keys are not read. ``versions`` hold keys and tracked columns. Columns as in ``scd2_splice``.
    """
    tie_break = list(tie_break) or list(tracked)
    needed = [*keys, *_unique([*tracked, at, *[c for c in tie_break if c not in keys]])]
    since = late.groupBy(*[_required(k) for k in keys]).agg(F.min(at).alias("_since"))
    own = versions.join(since, list(keys)).where(F.col(VALID_TO).isNull() | (F.col(VALID_TO) >= F.col("_since")))
    extra = [c for c in tie_break if c not in tracked and c != at]
    seeds = own.where(F.col(VALID_FROM) < F.col("_since")).select(
        *keys, *tracked, F.col(VALID_FROM).alias(at), *[F.lit(None).cast(late.schema[c].dataType).alias(c) for c in extra]
    )
    rest = later.select(*needed).join(since, list(keys)).where(F.col(at) >= F.col("_since")).drop("_since")
    log = seeds.unionByName(late.select(*needed)).unionByName(rest)
    built = scd2_from_history(log, keys, tracked, at, tie_break)
    return _version_changes(own.select(*built.columns), built, keys)


def _version_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions of ``new`` that ``old`` does not have like that, and those that are gone."""
    at = [*keys, VALID_FROM]
    left = old.select(*at, F.struct(*old.columns).alias("_old"))
    right = new.select(*at, F.struct(*old.columns).alias("_new"))
    pair = left.join(right, at, "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))
    row = F.coalesce("_new", "_old")
    return pair.select(*[row[c].alias(c) for c in old.columns], F.col("_new").isNull().alias("gone"))


def scd2_apply(versions: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``versions`` with the ``changes`` of a splice."""
    at = [*keys, VALID_FROM]
    kept = versions.join(changes.select(*at), at, "left_anti")
    return kept.select(*versions.columns).unionByName(changes.where("NOT gone").select(*versions.columns))


def scd2_extend(
    opened: DataFrame,
    log: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    at: str,
    tie_break: Sequence[str] = (),
    changes_only: bool = False,
) -> DataFrame:
    """Open versions carried on through newer log rows, in one pass.

    The same as merging the snapshots in the log one after the other with
    ``on_missing="keep"``. Returns the versions of all keys of ``opened`` and
    ``log``: those closed on the way and those open now. Log rows older than the
    open version of their key fail the job; rows seen before change nothing.
    ``changes_only`` works on the keys of ``log`` alone and leaves out versions
    that were open before and still are.
    """
    tie_break = list(tie_break) or list(tracked)
    if changes_only:
        opened = opened.join(log.select(*keys).distinct(), list(keys), "left_semi")
    starts = opened.select(*keys, F.col(VALID_FROM).alias("_start"))
    late = F.raise_error(F.lit("log row is older than the open version of its key"))
    fresh = log.join(starts, list(keys), "left").withColumn(
        at, F.when(F.col(at) < F.col("_start"), late).otherwise(F.col(at))
    )
    extra = [c for c in tie_break if c not in tracked and c != at]
    seeds = opened.select(
        *keys,
        *tracked,
        F.col(VALID_FROM).alias(at),
        *[F.lit(None).cast(log.schema[c].dataType).alias(c) for c in extra],
    )
    both = seeds.unionByName(fresh.select(*keys, *_unique([*tracked, at, *extra])))
    versions = scd2_from_history(both, keys, tracked, at, tie_break)
    if not changes_only:
        return versions
    still = F.col(IS_CURRENT) & F.col(VALID_FROM).eqNullSafe(F.col("_start"))
    return versions.join(starts, list(keys), "left").where(~still).drop("_start")


def scd2_point_in_time(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    attributes: Sequence[str],
    how: str = "left",
    parts: int | None = None,
    min_rows: int | None = None,
    weigh: DataFrame | None = None,
) -> DataFrame:
    """Each fact with the ``attributes`` of the version valid at its time.

    Facts and versions are scanned together in time order, so the work per key
    grows with facts plus versions, never with their product. Facts without a
    version get nulls, or go with ``how="inner"``.
    """
    if how not in ("left", "inner"):
        raise ValueError("how is 'left' or 'inner'")
    attributes = list(attributes)
    fact_type = F.struct(*facts.columns)
    version_type = F.struct(*_unique([VALID_FROM, VALID_TO, *attributes]))
    # Versions come first at equal times: the interval includes its start.
    left = facts.select(
        *keys, F.col(at).alias("_at"), F.lit(1).alias("_side"), fact_type.alias("_fact")
    )
    right = versions.select(
        *keys, F.col(VALID_FROM).alias("_at"), F.lit(0).alias("_side"), version_type.alias("_version")
    )
    both = left.unionByName(right, allowMissingColumns=True)
    # Facts of one instant see the same version and may be spread.
    dealt = F.when(F.col("_side") == 1, F.xxhash64("_fact"))
    rows, ranges = split_hot_keys(both, keys, "_at", parts, min_rows, weigh, dealt)
    # Facts without a key match nothing; spread them instead of sorting them together.
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    spread = F.pmod(F.xxhash64("_fact"), F.lit(parts or default_parts(facts))).cast("int")
    rows = rows.withColumn(RANGE, F.when(null_key, spread).otherwise(F.col(RANGE)))

    so_far = within_ranges(keys, "_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_found", F.last("_version", ignorenulls=True).over(so_far))
    if ranges:
        tails = (
            rows.where((F.col(RANGE) != COLD) & F.col("_version").isNotNull())
            .groupBy(*keys, RANGE)
            .agg(F.max_by("_version", "_at").alias("_carried"))
        )
        rows = rows.join(
            carry_forward(tails, ranges, "_carried"), [*keys, RANGE], "left"
        ).withColumn("_found", F.coalesce("_found", "_carried"))
    found = F.col("_found")
    valid = F.coalesce(
        found.isNotNull() & (found[VALID_TO].isNull() | (F.col("_at") < found[VALID_TO])),
        F.lit(False),
    ) & ~null_key
    matched = rows.where(F.col("_side") == 1)
    if how == "inner":
        matched = matched.where(valid)
    return matched.select(
        *[F.col("_fact")[c].alias(c) for c in facts.columns],
        *[F.when(valid, found[c]).alias(c) for c in attributes],
    )


def scd2_check(
    df: DataFrame,
    keys: Sequence[str],
    parts: int | None = None,
    min_rows: int | None = None,
    weigh: DataFrame | None = None,
) -> DataFrame:
    """Violations of the history rules, counted per key and rule; empty if sound.

    ``overlap``: a version starts before an earlier one ended. ``empty``: a
    version does not end after its start. ``flag``: ``is_current`` disagrees
    with ``valid_to``. ``open``: open versions of the key beyond the first.
    """
    rows, ranges = split_hot_keys(
        df.select(*keys, *SCD2_COLUMNS), keys, VALID_FROM, parts, min_rows, weigh
    )
    # An open version never ends: count it as ended one row after all others.
    forever = F.col(VALID_TO).isNull()
    end = F.struct(forever.alias("open"), F.col(VALID_TO).alias("at"))
    earlier = within_ranges(
        keys, VALID_FROM, F.col(VALID_TO).asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_end", end).withColumn("_reached", F.max("_end").over(earlier))
    if ranges:
        so_far = Window.partitionBy(*keys).orderBy(RANGE)
        reached = (
            rows.where(F.col(RANGE) != COLD)
            .groupBy(*keys, RANGE)
            .agg(F.max("_end").alias("_top"))
            .withColumn("_carried", F.max("_top").over(so_far))
        )
        rows = rows.join(
            carry_forward(reached, ranges, "_carried"), [*keys, RANGE], "left"
        ).withColumn("_reached", F.greatest("_reached", "_carried"))
    reached = F.col("_reached")
    overlap = reached["open"] | (reached["at"] > F.col(VALID_FROM))
    empty = F.col(VALID_TO) <= F.col(VALID_FROM)
    flag = F.col(IS_CURRENT) != forever
    counts = rows.groupBy(*keys).agg(
        F.count_if(overlap).alias("overlap"),
        F.count_if(empty).alias("empty"),
        F.count_if(flag).alias("flag"),
        F.greatest(F.count_if(F.col(IS_CURRENT)) - 1, F.lit(0)).alias("open"),
    )
    rules = ["overlap", "empty", "flag", "open"]
    return counts.unpivot(list(keys), rules, "rule", "violations").where("violations > 0")
