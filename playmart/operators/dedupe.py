"""One row per key: first wins, last wins, latest; and the writes built on them.

Rows are reduced with min/max over a struct (order columns, then all others). Spark combines that before
the shuffle, so a key that owns a third of the rows reaches its reducer as one row per map task, and the
result does not depend on row order: equal order values are settled by the remaining columns.
NULL order values count as lowest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.schemas import ForeignKey, Table, load_order
from playmart.shared import saved


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.select(*keys).distinct()
    reduced = df.groupBy(*keys).agg(pick(F.struct(*order, *rest)).alias("_row"))
    return reduced.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Insert-if-absent order: the lowest row of each key."""
    return _one_per_key(df, keys, order, F.min)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Upsert order: the highest row of each key."""
    return _one_per_key(df, keys, order, F.max)


def profile_summary(log: DataFrame, key: str, profile: Sequence[str], at: str) -> DataFrame:
    """Each distinct profile of a key with the last time it was seen; NULL keys drop out.

    A hash aggregate over primitives. Summaries of several periods can be put together and summarised
    again, so a later load need not read the earlier logs.
    """
    return log.where(F.col(key).isNotNull()).groupBy(key, *profile).agg(F.max(at).alias(at))


def latest_profiles(log: DataFrame, key: str, profile: Sequence[str], at: str) -> DataFrame:
    """Every distinct profile a key had at its last time; ties keep several rows.

    The self-join sees one row per distinct profile, both sides read one shuffle of the summary, and
    joining on (key, time) spreads a key with very many profiles.
    """
    seen = profile_summary(log, key, profile, at)
    last = seen.groupBy(key).agg(F.max(at).alias(at))
    return seen.join(last, [key, at]).select(key, *profile)


def latest_profile(log: DataFrame, key: str, profile: Sequence[str], at: str) -> DataFrame:
    """Exactly one row per key: the latest profile, ties settled by the profile columns."""
    seen = profile_summary(log, key, profile, at)
    return last_per_key(seen, [key], [at, *profile]).select(key, *profile)


def insert_if_absent(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """Rows to append to target: the first source row of each key target does not have.

    The source is reduced before the anti join (unless it is unique already), so both join sides have one
    row per key. A key column may not be NULL: such rows are left out.
    """
    whole = source.dropna(subset=list(keys))
    fresh = whole if unique else first_per_key(whole, keys, order)
    return fresh.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)


def upsert(
    target: DataFrame, writes: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Target after the writes: a written key replaces its row, the last write of a key wins."""
    fresh = last_per_key(writes, keys, order).select(*target.columns)
    kept = target.join(fresh.select(*keys), list(keys), "left_anti")
    return kept.unionByName(fresh).select(*target.columns)


def cascade_delete(
    child: DataFrame, deleted: DataFrame, foreign_key: Sequence[str], parent_key: Sequence[str]
) -> DataFrame:
    """Child rows that stay when parent rows are deleted; rows with a NULL reference stay."""
    gone = deleted.select(*[F.col(p).alias(c) for c, p in zip(foreign_key, parent_key, strict=True)])
    return child.join(gone.distinct(), list(foreign_key), "left_anti").select(*child.columns)


def delete_chain(
    tables: Mapping[str, DataFrame], specs: Sequence[Table], deleted: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """The rows of every table that go when some rows go, following all foreign keys down from parents to children.

    `deleted` holds rows, or just the primary keys, that go from some tables. A child row goes with a parent row
    that any of its foreign keys refers to; a NULL in a key refers to nothing. Tables are visited parents first, so each
    is joined once, with the keys of the rows that go from its parents. Foreign keys that form a ring are an error, but
    for those of a table to itself, which are followed as often as there are rows that refer on.
    """
    by_name = {t.name: t for t in specs if t.name in tables}
    ordered = load_order(list(by_name.values()))
    gone: dict[str, DataFrame] = {}
    for table in ordered:
        rows = tables[table.name]
        found = []
        if table.name in deleted:
            keys = deleted[table.name].select(*table.primary_key).distinct()
            found.append(rows.join(keys, list(table.primary_key), "left_semi"))
        for fk in table.foreign_keys:
            if fk.parent in gone and fk.parent != table.name:
                found.append(_referring(rows, gone[fk.parent], fk))
        if not found:
            continue
        # A row that several keys lead to goes once.
        going = found[0] if len(found) == 1 else reduce(DataFrame.unionByName, found).dropDuplicates(list(table.primary_key))
        for fk in table.foreign_keys:
            if fk.parent == table.name:
                going = _with_followers(rows, going, fk, table.primary_key)
        gone[table.name] = going.select(*rows.columns)
    return gone


def _referring(rows: DataFrame, parents: DataFrame, fk: ForeignKey) -> DataFrame:
    keys = parents.select(*[F.col(p).alias(c) for p, c in zip(fk.parent_columns, fk.columns, strict=True)]).distinct()
    return rows.join(keys, list(fk.columns), "left_semi").select(*rows.columns)


def _with_followers(rows: DataFrame, going: DataFrame, fk: ForeignKey, primary_key: Sequence[str]) -> DataFrame:
    going = saved(going.select(*rows.columns))
    fresh = going
    while not fresh.isEmpty():
        found = _referring(rows, fresh, fk).join(going.select(*primary_key), list(primary_key), "left_anti")
        fresh = saved(found.select(*rows.columns))
        going = going.unionByName(fresh)
    return going


def after_deletes(tables: Mapping[str, DataFrame], specs: Sequence[Table], gone: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every table without the rows that go."""
    keys = {t.name: list(t.primary_key) for t in specs}
    return {
        name: rows.join(gone[name].select(*keys[name]), keys[name], "left_anti").select(*rows.columns) if name in gone else rows
        for name, rows in tables.items()
    }
