"""Keyed upsert as a pure function of two frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.operators.latest import as_column, latest_per_key

Key = str | tuple[str, str]


def key_pairs(keys: Sequence[Key]) -> list[tuple[str, str]]:
    """Keys as `(target column, source column)` pairs."""
    return [(k, k) if isinstance(k, str) else tuple(k) for k in keys]


def reduce_updates(
    updates: DataFrame, keys: Sequence[str], latest_by: Sequence[Column | str] = (), null_safe: bool = True
) -> DataFrame:
    """At most one update per key: the latest, ties broken by all columns.

    Without null-safe matching a key with a NULL part never equals another one, so such rows are all
    kept.
    """
    if null_safe:
        return latest_per_key(updates, keys, latest_by)
    filled = _filled(keys)
    return latest_per_key(updates.filter(filled), keys, latest_by).unionByName(updates.filter(~filled))


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[Key],
    update_cols: Sequence[str] | Mapping[str, str] | None = None,
    insert_cols: Sequence[str] | Mapping[str, str] | None = None,
    *,
    latest_by: Sequence[Column | str] = (),
    null_safe: bool = True,
    reduced: bool = False,
    keep_newer: bool = False,
    filled: Sequence[str] = (),
) -> DataFrame:
    """The target after merging `updates` into it by key.

    A matching target row takes `update_cols` from its update; an update without a match is inserted
    with `insert_cols` and its key, other columns NULL. Both are target column names, or
    `{target column: update column}`. `None` means every non-key column the updates have; an empty
    `update_cols` leaves matching rows alone.

    `latest_by` are columns or expressions of columns that both frames have. With `keep_newer` a
    matching row only takes an update that is not older by them, NULL being oldest, so updates may
    arrive in any order. Ages are compared in the target's types. `filled` are target keys that no
    update has a NULL in: they are matched by plain equality, which keeps a stored bucketing.

    The target must be unique by key, as every table written by this function is; updates are
    reduced to one row per key first unless `reduced` says they already are. Then no key is hot on
    either side of the join.
    """
    if not null_safe:
        return _upsert_filled_keys(
            target, updates, keys, update_cols, insert_cols, latest_by=latest_by, reduced=reduced,
            keep_newer=keep_newer, filled=filled,
        )
    pairs = key_pairs(keys)
    source_keys = [s for _, s in pairs]
    key_of = dict(pairs)
    others = [c for c in target.columns if c not in key_of]
    to_update = _column_map(update_cols, others, updates)
    to_insert = {**_column_map(insert_cols, others, updates), **key_of}

    one_per_key = updates if reduced else reduce_updates(updates, source_keys, latest_by)
    ages = {f"__age_{i}": as_column(c) for i, c in enumerate(latest_by if keep_newer else [])}
    # aged in the target's types, so that texts or times of another kind are compared as they are stored
    typed = one_per_key.withColumns({
        f.name: F.col(f"`{f.name}`").cast(f.dataType) for f in target.schema.fields if f.name in one_per_key.columns})
    source = _prefixed((typed if ages else one_per_key).withColumns(ages))

    if not to_update:
        return target.unionByName(new_rows(target, one_per_key, keys, insert_cols, reduced=True, filled=filled))

    matched = F.col("__in_updates").isNotNull()
    if ages:
        matched &= F.struct(*[F.col(f"__u_{a}") for a in ages]) >= F.struct(*[F.col(a) for a in ages])
    marked = source.withColumn("__in_updates", F.lit(True))

    def merged(column: str) -> Column:
        if column not in to_update:
            return F.col(f"`{column}`")
        new = F.col(f"`__u_{to_update[column]}`").cast(target.schema[column].dataType)
        return F.when(matched, new).otherwise(F.col(f"`{column}`")).alias(column)

    known = target.withColumns({**ages, "__in_target": F.lit(True)})
    joined = known.join(marked, _match(pairs, filled), "full_outer")
    is_new = F.col("__in_target").isNull()
    return joined.select(
        *[
            F.when(is_new, insert).otherwise(merged(column)).alias(column)
            for column, insert in zip(target.columns, _inserted(target, to_insert))
        ]
    )


def merge_changes(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[Key],
    update_cols: Sequence[str] | Mapping[str, str] | None = None,
    insert_cols: Sequence[str] | Mapping[str, str] | None = None,
    *,
    latest_by: Sequence[Column | str] = (),
    reduced: bool = False,
    keep_newer: bool = False,
    filled: Sequence[str] = (),
) -> DataFrame:
    """What a merge by null-safe keys (`upsert`) changes: the target's keys, `op`, `before` and `after`.

    `op` is `insert`, with `before` NULL, or `update`; both sides are structs of the target's columns. An
    update that changes no value is no change. Only rows that meet an update are looked at: the join
    starts from the updates, which have one row per key.
    """
    pairs = key_pairs(keys)
    key_of = dict(pairs)
    others = [c for c in target.columns if c not in key_of]
    to_update = _column_map(update_cols, others, updates)
    to_insert = {**_column_map(insert_cols, others, updates), **key_of}
    one_per_key = updates if reduced else reduce_updates(updates, [s for _, s in pairs], latest_by)
    typed = one_per_key.withColumns({
        f.name: F.col(f"`{f.name}`").cast(f.dataType) for f in target.schema.fields if f.name in one_per_key.columns})
    ages = {f"__age_{i}": as_column(c) for i, c in enumerate(latest_by if keep_newer else [])}
    known = target.withColumns({**ages, "__in_target": F.lit(True)})
    joined = _prefixed(typed.withColumns(ages)).join(known, _match(pairs, filled), "left")
    is_new = F.col("__in_target").isNull()
    taken = ~is_new
    if ages:
        taken &= F.struct(*[F.col(f"__u_{a}") for a in ages]) >= F.struct(*[F.col(a) for a in ages])
    before = [F.col(f"`{c}`") for c in target.columns]
    inserted = _inserted(target, to_insert)
    updated = [
        F.col(f"`__u_{to_update[f.name]}`").cast(f.dataType) if f.name in to_update else F.col(f"`{f.name}`")
        for f in target.schema.fields
    ]
    differs = reduce(or_, (~old.eqNullSafe(new) for old, new in zip(before, updated)))
    after = [F.when(is_new, i).otherwise(u).alias(c) for c, i, u in zip(target.columns, inserted, updated)]
    return joined.filter(is_new | (taken & differs)).select(
        F.when(is_new, "insert").otherwise("update").alias("op"), F.when(~is_new, F.struct(*before)).alias("before"),
        F.struct(*after).alias("after"),
    ).select(*[F.col(f"after.`{t}`").alias(t) for t, _ in pairs], "op", "before", "after")


def changed_rows(changes: DataFrame) -> DataFrame:
    """The rows as they are after the changes, for a load that takes only what is new."""
    return changes.select("after.*")


def new_rows(
    target: DataFrame, updates: DataFrame, keys: Sequence[Key], insert_cols=None, *,
    latest_by: Sequence[str] = (), null_safe: bool = True, reduced: bool = False, filled: Sequence[str] = (),
) -> DataFrame:
    """The rows an upsert would insert: updates whose key the target does not have."""
    pairs = key_pairs(keys)
    one_per_key = updates if reduced else reduce_updates(updates, [s for _, s in pairs], latest_by, null_safe)
    others = [c for c in target.columns if c not in dict(pairs)]
    inserted = _inserted(target, {**_column_map(insert_cols, others, updates), **dict(pairs)})
    if null_safe:
        fresh = _prefixed(one_per_key).join(target.select(*dict(pairs)), _match(pairs, filled), "left_anti")
        return fresh.select(*inserted)
    whole = _filled([t for t, _ in pairs]), _filled([s for _, s in pairs])
    known, source = target.filter(whole[0]), one_per_key.filter(whole[1])
    return new_rows(known, source, keys, insert_cols, reduced=True, filled=filled).unionByName(
        _prefixed(one_per_key.filter(~whole[1])).select(*inserted)
    )


def _upsert_filled_keys(target, updates, keys, update_cols, insert_cols, *, latest_by, reduced, **how) -> DataFrame:
    """Upsert in which a key with a NULL part equals no other key.

    Such rows have nothing to meet, so they stay out of the join, where all of them would fall
    into one partition: the target's are kept and the updates' are inserted as they are.
    """
    pairs = key_pairs(keys)
    one_per_key = updates if reduced else reduce_updates(updates, [s for _, s in pairs], latest_by, False)
    filled = _filled([t for t, _ in pairs]), _filled([s for _, s in pairs])
    merged = upsert(
        target.filter(filled[0]), one_per_key.filter(filled[1]), keys, update_cols, insert_cols,
        latest_by=latest_by, reduced=True, **how,
    )
    added = new_rows(
        target.filter(~filled[0]), one_per_key.filter(~filled[1]), keys, insert_cols, reduced=True,
        null_safe=False,
    )
    return merged.unionByName(target.filter(~filled[0])).unionByName(added)


def _filled(columns: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"`{c}`").isNotNull() for c in columns))


def _prefixed(updates: DataFrame) -> DataFrame:
    return updates.select(*[F.col(f"`{c}`").alias(f"__u_{c}") for c in updates.columns])


def _column_map(spec, others: Sequence[str], updates: DataFrame) -> dict[str, str]:
    if spec is None:
        return {c: c for c in others if c in updates.columns}
    return dict(spec) if isinstance(spec, Mapping) else {c: c for c in spec}


def _match(pairs, filled: Sequence[str] = ()) -> Column:
    def same(t: str, s: str) -> Column:
        left, right = F.col(f"`{t}`"), F.col(f"`__u_{s}`")
        return left == right if t in filled else left.eqNullSafe(right)

    return reduce(and_, (same(t, s) for t, s in pairs))


def _inserted(target: DataFrame, to_insert: Mapping[str, str]) -> list[Column]:
    """The target's columns taken from an update, typed like the target."""
    return [
        (F.col(f"`__u_{to_insert[f.name]}`") if f.name in to_insert else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in target.schema.fields
    ]
