"""Slowly changing history (type 2): one row per version of a key, with its validity period.

A run meets the open rows of the history with the current source in one join per key; each pair
then yields the rows it leaves behind (kept, closed, opened, tombstone). Closed rows are passed
through without a shuffle. ``changes`` gives only the rows that a run changes, for histories kept
in two stores (``plans.history``).
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodica.functions.scalars import all_known, all_of, any_of, canonical_time, version_hash
from periodica.operators.joins import KEY, key_of, new_rows, rows_with, rows_without, unique_keys
from periodica.operators.schema import find, typed_null

logger = logging.getLogger(__name__)

# What a run does with a row, as ``changes`` marks it.
KIND = "_kind"
KEPT, CLOSED, OPENED, FLAGGED = "kept", "closed", "opened", "flagged"
SHORT = "_short"


@dataclass(frozen=True)
class MetaNames:
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    scd_id: str = "scd_id"
    updated_at: str = "version_updated_at"
    is_deleted: str = "is_deleted"


@dataclass(frozen=True)
class SnapshotConfig:
    """How a history is kept.

    strategy: 'timestamp' compares ``updated_at`` with the open row's start, 'check' compares
    ``check_columns`` (None for all). hard_deletes: 'ignore' keeps rows of vanished keys open,
    'invalidate' closes them, 'new_record' also adds a row flagged as deleted. open_until: value of
    valid_to in open rows instead of NULL. versions_unique: set it for a history no hard delete has
    ever closed a key in; no version can come back there, and the look-up of closed ones is spared.
    """

    keys: Sequence[str]
    strategy: str = "timestamp"
    updated_at: str | None = None
    check_columns: Sequence[str] | None = None
    hard_deletes: str = "ignore"
    open_until: str | None = None
    versions_unique: bool = False
    names: MetaNames = field(default_factory=MetaNames)

    def __post_init__(self):
        if self.strategy not in ("timestamp", "check"):
            raise ValueError(f"unknown snapshot strategy: {self.strategy}")
        if self.strategy == "timestamp" and not self.updated_at:
            raise ValueError("the timestamp strategy needs updated_at")
        if self.strategy == "check" and self.check_columns is not None and not self.check_columns:
            raise ValueError("check_columns must name a column, or be None for all")
        if self.hard_deletes not in ("ignore", "invalidate", "new_record"):
            raise ValueError(f"unknown hard_deletes mode: {self.hard_deletes}")

    @property
    def tombstones(self) -> bool:
        return self.hard_deletes == "new_record"


def _moment(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp_ntz")


def _as_text(column: Column, kind: T.DataType) -> Column:
    return canonical_time(column) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else column


def _open_value(cfg: SnapshotConfig) -> Column:
    return F.lit(cfg.open_until).cast("timestamp_ntz")


def _is_open(cfg: SnapshotConfig) -> Column:
    end = F.col(cfg.names.valid_to)
    if cfg.open_until is None:
        return end.isNull()
    return end.isNull() | (end == _open_value(cfg))


def _version_time(cfg: SnapshotConfig, now, at: str = "") -> Column:
    return _moment(F.col(at + cfg.updated_at) if cfg.updated_at else now)


def _version_id(source: DataFrame, cfg: SnapshotConfig, now, at: str = "") -> Column:
    keys = [_as_text(F.col(at + k), find(source.schema, k).dataType) for k in cfg.keys]
    return version_hash(*keys, canonical_time(_version_time(cfg, now, at)))


def initial(source: DataFrame, cfg: SnapshotConfig, now) -> DataFrame:
    """First build: every source row is the open version of its key."""
    n = cfg.names
    built = source.select(
        "*",
        _version_id(source, cfg, now).alias(n.scd_id),
        _version_time(cfg, now).alias(n.updated_at),
        _version_time(cfg, now).alias(n.valid_from),
        _open_value(cfg).alias(n.valid_to),
    )
    return built.withColumn(n.is_deleted, F.lit("False")) if cfg.tombstones else built


def _changed(cfg: SnapshotConfig, columns: Sequence[str], held: Sequence[str]) -> Column:
    """Does the source row (``_new``) differ from the open row (``_old``)?"""
    if cfg.strategy == "timestamp":
        return F.col(f"_old.{cfg.names.valid_from}") < _moment(F.col(f"_new.{cfg.updated_at}"))
    checked = list(cfg.check_columns or columns)
    known = {h.lower() for h in held}
    if any(c.lower() not in known for c in checked):
        return F.lit(True)
    return any_of(*[~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in checked])


def _aligned(history: DataFrame, source: DataFrame, cfg: SnapshotConfig) -> tuple[DataFrame, DataFrame]:
    """History with the source's new columns, and source with the history's spelling of names."""
    n = cfg.names
    matched = [find(history.schema, c) for c in source.columns]
    source = source.toDF(*[m.name if m else c for m, c in zip(matched, source.columns)])
    added = [f for f in source.schema if not find(history.schema, f.name)]
    held = history.columns
    history = history.select("*", *[typed_null(f.dataType, f.name) for f in added])
    if cfg.tombstones and n.is_deleted not in held:
        history = history.withColumn(n.is_deleted, F.lit("False"))
    return history, source


def _versioned(source: DataFrame, cfg: SnapshotConfig, now) -> DataFrame:
    versioned = source.withColumn(cfg.names.scd_id, _version_id(source, cfg, now))
    return versioned.withColumn(cfg.names.updated_at, _version_time(cfg, now))


def _versioned_new(pairs: DataFrame, source: DataFrame, cfg: SnapshotConfig, now) -> DataFrame:
    """``_versioned`` for pairs whose _new holds the source's columns, so that ids and times need not be shuffled."""
    made = {cfg.names.scd_id: _version_id(source, cfg, now, "_new."), cfg.names.updated_at: _version_time(cfg, now, "_new.")}
    cells = {c: F.col(f"_new.{c}") for c in source.columns} | made
    versioned = F.struct(*[cell.alias(name) for name, cell in cells.items()])
    return pairs.withColumn("_new", F.when(F.col("_new").isNotNull(), versioned))


def _outcome(
    layout: T.StructType, source: DataFrame, held: Sequence[str], cfg: SnapshotConfig, now, mark: bool = False
) -> Column:
    """The rows that a pair (_old, _new) leaves behind, with ``mark`` as (KIND, layout)."""
    n = cfg.names
    moment = _moment(now)
    old, new = F.col("_old"), F.col("_new")
    both = old.isNotNull() & new.isNotNull()
    # A NULL comparison (no update time) counts as unchanged.
    differs = F.coalesce(_changed(cfg, source.columns, held), F.lit(False))
    if cfg.tombstones:
        differs = differs | F.coalesce(F.col(f"_old.{n.is_deleted}") == "True", F.lit(False))

    def row(origin: str, kind: str, overrides: dict[str, Column]) -> Column:
        cells = [
            overrides.get(f.name, F.col(f"{origin}.{f.name}")).cast(f.dataType).alias(f.name) for f in layout
        ]
        return F.struct(*[F.lit(kind).alias(KIND), *cells] if mark else cells)

    start = {n.valid_from: F.col(f"_new.{n.updated_at}"), n.valid_to: _open_value(cfg), n.is_deleted: F.lit("False")}
    given = {*source.columns, n.scd_id, n.updated_at}
    absent = {f.name: F.lit(None) for f in layout if f.name not in given}
    opened = F.array(row("_new", OPENED, {**absent, **start}))
    kept = F.array(row("_old", KEPT, {}))
    superseded = F.array(row("_old", CLOSED, {n.valid_to: F.col(f"_new.{n.updated_at}")}))

    vanished = kept
    if cfg.hard_deletes != "ignore":
        vanished = F.array(row("_old", CLOSED, {n.valid_to: moment}))
    if cfg.tombstones:
        flagged = {
            n.valid_from: moment,
            n.updated_at: moment,
            n.scd_id: version_hash(F.col(f"_old.{n.scd_id}"), canonical_time(moment)),
            n.is_deleted: F.lit("True"),
        }
        vanished = F.when(F.col(f"_old.{n.is_deleted}") == "True", kept).otherwise(
            F.concat(vanished, F.array(row("_old", FLAGGED, flagged)))
        )

    is_changed = both & differs
    known = F.col(f"_old.{n.scd_id}").eqNullSafe(F.col(f"_new.{n.scd_id}"))
    if not mark:
        known = known | F.col("_new._seen")
    starting = F.when(known, F.slice(opened, 1, 0)).otherwise(opened)
    return (
        F.when(old.isNull(), starting)
        .when(new.isNull(), vanished)
        .when(is_changed, F.concat(superseded, starting))
        .otherwise(kept)
    )


def apply(history: DataFrame, source: DataFrame, cfg: SnapshotConfig, now) -> DataFrame:
    """The history after one more run. Keys are unique in the source and among open rows.

    Source columns are matched to the history's without regard to case and take its spelling.
    """
    held = list(history.columns)
    history, source = _aligned(history, source, cfg)
    closed = history.where(~_is_open(cfg))
    open_rows = history.where(_is_open(cfg))
    fresh = _mark_seen(_versioned(source, cfg, now), closed, cfg)
    pair = _pair_given if cfg.hard_deletes == "ignore" else _pair
    pairs = pair(open_rows, fresh, cfg.keys)
    outcome = _outcome(history.schema, source, held, cfg, now)
    return closed.unionByName(pairs.select(F.inline(outcome)))


def changes(open_rows: DataFrame, closed_ids: DataFrame, source: DataFrame, cfg: SnapshotConfig, now) -> DataFrame:
    """What one more run changes, for a history whose open and closed rows are kept apart.

    ``closed_ids`` has the version ids of all closed rows. The result has the history's columns and KIND: CLOSED
    for open rows that are to be replaced by these closed ones (same version id), OPENED and FLAGGED for new open
    rows. Rows that stay as they are do not occur. With ``hard_deletes`` 'ignore' open rows without a source row
    are only looked at by key, and not moved when the source is small.
    """
    n = cfg.names
    held = list(open_rows.columns)
    open_rows, source = _aligned(open_rows, source, cfg)
    layout = open_rows.schema
    if cfg.hard_deletes == "ignore":
        open_rows = rows_with(open_rows, source, cfg.keys)
    pairs = _versioned_new(_pair(open_rows, source, cfg.keys), source, cfg, now)
    marked = pairs.select(F.inline(_outcome(layout, source, held, cfg, now, mark=True)))
    marked = marked.where(F.col(KIND) != KEPT)
    if cfg.versions_unique:
        return marked
    # A version that is already there, closed, is not opened again. The closed ids are cut to those that may be the
    # source's by a short hash of the id, which moves less; the ids themselves decide.
    ids = source.select(_version_id(source, cfg, now).alias(n.scd_id))
    there = rows_with(_short(closed_ids, n.scd_id), _short(ids, n.scd_id), [SHORT]).drop(SHORT)
    return rows_without(marked, there, [n.scd_id], F.col(KIND) == OPENED)


def _short(ids: DataFrame, name: str) -> DataFrame:
    return ids.withColumn(SHORT, F.xxhash64(name))


def _mark_seen(fresh: DataFrame, closed: DataFrame, cfg: SnapshotConfig) -> DataFrame:
    """Flag source rows whose version is already in the history, closed.

    That happens when a key comes back with its old update time; the closed version stands and no
    row is added. The closed ids are cut to those of the source before they are joined to its rows.
    """
    if cfg.versions_unique:
        return fresh.withColumn("_seen", F.lit(False))
    version = [cfg.names.scd_id]
    hits = unique_keys(rows_with(closed.select(*version), fresh, version), version).withColumn("_hit", F.lit(True))
    marked = fresh.join(hits, key_of(version) == F.col(KEY), "left")
    return marked.withColumn("_seen", F.coalesce("_hit", F.lit(False))).drop(KEY, "_hit")


def _pair(open_rows: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_old, _new) per key, either side NULL when the key is missing there.

    NULL keys never match; they skip the join, where all of them would meet in one task.
    """
    old_names = [f"_old_{k}" for k in keys]
    new_names = [f"_new_{k}" for k in keys]
    old_side = open_rows.select(
        F.struct(*open_rows.columns).alias("_old"), *[F.col(k).alias(o) for k, o in zip(keys, old_names)]
    )
    new_side = fresh.select(
        F.struct(*fresh.columns).alias("_new"), *[F.col(k).alias(m) for k, m in zip(keys, new_names)]
    )
    on = all_of(*[F.col(o) == F.col(m) for o, m in zip(old_names, new_names)])
    met = old_side.where(all_known(old_names)).join(new_side.where(all_known(new_names)), on, "full_outer")
    lone_old = old_side.where(~all_known(old_names))
    lone_new = new_side.where(~all_known(new_names))
    return (
        met.select("_old", "_new")
        .unionByName(lone_old.select("_old"), allowMissingColumns=True)
        .unionByName(lone_new.select("_new"), allowMissingColumns=True)
    )


def _pair_given(open_rows: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_pair`` by a left join, for a source that may be small: then no open row is moved."""
    given = fresh.where(all_known(keys)).select(key_of(keys).alias(KEY), F.struct(*fresh.columns).alias("_new"))
    old_side = open_rows.select(key_of(keys).alias("_key"), F.struct(*open_rows.columns).alias("_old"))
    met = old_side.join(given, F.col("_key") == F.col(KEY), "left").select("_old", "_new")
    lone = new_rows(fresh, open_rows, keys).select(F.struct(*fresh.columns).alias("_new"))
    return met.unionByName(lone, allowMissingColumns=True)


def vanished_keys(history: DataFrame, source: DataFrame, cfg: SnapshotConfig) -> DataFrame:
    """Open rows whose key the source no longer has."""
    return rows_without(history.where(_is_open(cfg)), source, cfg.keys)


def time_type_warning(source: DataFrame, cfg: SnapshotConfig, now_type: T.DataType | None = None) -> str | None:
    """Warn when the update time is of another type than the run time."""
    if not cfg.updated_at:
        return None
    found = find(source.schema, cfg.updated_at).dataType
    expected = now_type or T.TimestampNTZType()
    if found == expected:
        return None
    message = f"{cfg.updated_at} is {found.simpleString()}, run time is {expected.simpleString()}"
    logger.warning(message)
    return message
