"""Keyed upsert of a stage into a core table.

Semantics: a core row whose key is in the stage keeps its key spelling, its
create time and every column that is not listed in ``updates``; listed columns
take the stage value, also when that is NULL. Core rows without a stage row stay
as they are. Stage rows without a core row are inserted, all of them, repeated
keys included. A NULL in the key matches nothing. A core row that several stage
rows match is an error.

Text keys are compared in :func:`~feedmill.functions.text.match_form`.

Plans. The core is left-joined to the stage for the updates, and the stage is
anti-joined to the core's distinct keys for the inserts. A stage below the
broadcast threshold is broadcast by Catalyst and the core is not shuffled. A
larger one costs a shuffle of the core and one of its distinct keys; both joins
ask for the same shuffle of the stage, as one column and by the same expressions,
so Spark does it once unless the optimizer wrote the stage's plan in two ways, and
compared keys are not shuffled beside the rows they come from. A
single full outer join would save the core's keys, but adaptive execution cannot
split a hot key in it, and it can on the left of these joins.

Hot keys. A repeated core key sits on the left of the update join and enters the
insert join once. Whether stage keys are repeated is asked at once, by a count of
their hashes. If some are, a Bloom filter of these finds the few rows of both
sides that are looked at by key: a repeated key enters that join as one marker
row, and its copies are appended. Rows with a NULL key match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.feeds import AUDIT
from feedmill.functions.text import match_form
from feedmill.functions.typing import load_stamp
from feedmill.operators.keyfilter import key_filter, might_hold

_REPEATED = "_repeated"
_SPLIT = "_split"
_ROW = "_row"
_HASH = "_hash"
_KEY = "_key"
#: Repeated stage keys that the filter of them is made for (128 kB); more let more rows be looked at by key.
REPEATS = 1 << 16


def _key_names(keys: Sequence[str]) -> list[str]:
    return [f"_key_{k}" for k in keys]


def with_match_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append the compared form of each key column."""
    text = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(
        "*",
        *[
            (match_form(F.col(k)) if k in text else F.col(k)).alias(n)
            for k, n in zip(keys, _key_names(keys))
        ],
    )


def _complete(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _splittable(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add a join key that no earlier aggregate is partitioned by.

    Adaptive execution splits a hot key only where both sides of the join have
    been shuffled for it. Without this key Spark would reuse the partitioning of
    the aggregate below one side, and the hot key would stay in one task.
    """
    return df.withColumn(_SPLIT, F.xxhash64(*names))


def split_join(left: DataFrame, right: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Join in which a hot key on the left can be split."""
    joined = _splittable(left, names).join(_splittable(right, names), [*names, _SPLIT], how)
    return joined.drop(_SPLIT)


def repeated_keys(stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Compared keys that occur more than once, with the number of copies."""
    return (
        with_match_keys(stage.select(*keys).filter(_complete(keys)), keys)
        .groupBy(*_key_names(keys))
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def _repeated_hashes(stage: DataFrame, hashed: Column) -> DataFrame:
    """Hashes of keys that occur more than once, and by chance one of two other keys; of the stage only hashes are shuffled."""
    return stage.groupBy(hashed.alias("h")).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("h")


def multi_match(core: DataFrame, stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of core rows that several stage rows would update."""
    names = _key_names(keys)
    present = with_match_keys(core.select(*keys), keys).select(*names).distinct()
    found = repeated_keys(stage, keys).join(present, names, "left_semi")
    return found.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], "copies")


def without_keys(stage: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stage rows whose key is not among ``found`` (compared keys)."""
    names = _key_names(keys)
    listed = found.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    return split_join(with_match_keys(stage, keys), listed, names, "left_anti").select(*stage.columns)


def with_keys(stage: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stage rows whose key is among ``found`` (compared keys)."""
    names = _key_names(keys)
    listed = found.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    return split_join(with_match_keys(stage, keys), listed, names, "left_semi").select(*stage.columns)


def fresh_rows(
    rows: DataFrame, columns: Sequence[str], load_ts, audit: Sequence[str] = AUDIT
) -> DataFrame:
    """Rows as an insert writes them, in the core's column order."""
    stamp = load_stamp(load_ts)
    return rows.select(*[stamp.alias(c) if c in audit else F.col(c) for c in columns])


def present_keys(core: DataFrame, stage: DataFrame, keys: Sequence[str], *also: str) -> DataFrame:
    """Compared keys, and ``also``, of the core rows whose key is in the stage: distinct.

    Of the core only these columns are read. A Bloom filter of the stage's keys
    stands before the join, so that nearly only matching rows are shuffled.
    """
    names = _key_names(keys)
    wanted = with_match_keys(stage.select(*keys).filter(_complete(keys)), keys).select(*names).distinct()
    count = wanted.count()
    hashed = F.xxhash64(*names)
    bloom = key_filter(wanted.select(hashed.alias("h")), count)
    held = with_match_keys(core.select(*keys, *also).filter(_complete(keys)), keys)
    held = held.filter(might_hold(bloom, count, hashed)).select(*names, *also).distinct()
    return held.join(wanted, names, "left_semi")


def merge_upsert(
    core: DataFrame,
    stage: DataFrame,
    *,
    keys: Sequence[str],
    updates: Sequence[str],
    load_ts,
    audit: Sequence[str] = AUDIT,
    nullable_keys: Sequence[str] | None = None,
    unique_stage: bool = False,
    insert: bool = True,
) -> DataFrame:
    """The core table after the upsert, with the core's columns.

    ``stage`` has every core column except the audit columns. ``nullable_keys``
    names the keys that may be NULL (all, when not told). ``unique_stage`` says
    that no stage key occurs twice, which saves the check for repeats. Without
    ``insert`` only the updates are done: every stage key is known to be in the core.
    """
    keys = list(keys)
    created, updated = audit
    stamp = load_stamp(load_ts)
    columns = core.columns
    data = [c for c in columns if c not in audit]
    names = _key_names(keys)
    nullable = keys if nullable_keys is None else [k for k in keys if k in set(nullable_keys)]
    text = {f.name for f in core.schema if isinstance(f.dataType, T.StringType)}

    def inserted(rows: DataFrame) -> DataFrame:
        return fresh_rows(rows, columns, load_ts, audit)

    def compared(cell) -> list[Column]:
        return [match_form(cell(k)) if k in text else cell(k) for k in keys]

    def hashed(cell) -> Column:
        """No value where a key is NULL; Catalyst infers no filter from it, which would part the two uses of the stage."""
        whole = reduce(lambda a, b: a & b, [cell(k).isNotNull() for k in keys])
        return F.when(whole, F.xxhash64(*compared(cell)))

    def same_key(cell, other) -> Column:
        return (hashed(cell) == hashed(other)) & (F.struct(*compared(cell)) == F.struct(*compared(other)))

    stage = stage.select(*[F.col(c).cast(core.schema[c].dataType).alias(c) for c in data])
    parts: list[DataFrame] = []

    if nullable:
        if insert:
            parts.append(inserted(stage.filter(~_complete(nullable))))
        stage = stage.filter(_complete(nullable))
        parts.append(core.filter(~_complete(nullable)))
        core = core.filter(_complete(nullable))

    single, checked = stage, core
    h = F.xxhash64(*compared(F.col))
    if not unique_stage and not (again := _repeated_hashes(stage.filter(_complete(keys)), h)).isEmpty():
        may = might_hold(key_filter(again, REPEATS), REPEATS, h)
        some = stage.filter(may)
        repeats = repeated_keys(some, keys).select(*names).withColumn(_REPEATED, F.lit(True))
        flagged = split_join(with_match_keys(some, keys), repeats, names, "left")
        if insert:
            parts.append(inserted(flagged.filter(F.col(_REPEATED).isNotNull())))
        single = stage.filter(~may).unionByName(flagged.filter(F.col(_REPEATED).isNull()).select(*data))
        fault = F.raise_error(
            F.concat(F.lit("several stage rows match one core row: "), F.concat_ws("|", *names))
        )
        hit = split_join(with_match_keys(core.filter(may), keys), repeats, names, "left")
        hit = hit.filter(F.when(F.coalesce(F.col(_REPEATED), F.lit(False)), fault.cast("boolean")).otherwise(True))
        checked = core.filter(~may).unionByName(hit.select(*columns))

    # One column, so that both joins take the same columns of the stage and Spark can shuffle it once for them.
    packed = single.select(F.struct(*data).alias(_ROW))

    def staged(k: str) -> Column:
        return F.col(_ROW)[k]

    if insert:
        present = core.filter(_complete(keys)).select(h.alias(_HASH), F.struct(*compared(F.col)).alias(_KEY)).distinct()
        new = packed.join(
            present, (hashed(staged) == F.col(_HASH)) & (F.struct(*compared(staged)) == F.col(_KEY)), "left_anti"
        )
        parts.append(inserted(new.select(f"{_ROW}.*")))

    changed = set(updates)
    hit = F.col(_ROW).isNotNull()

    def merged(c: str) -> Column:
        if c == updated:
            return F.when(hit, stamp).otherwise(F.col(c)).alias(c)
        if c in changed:
            return F.when(hit, staged(c)).otherwise(F.col(c)).alias(c)
        return F.col(c)

    joined = checked.join(packed, same_key(F.col, staged), "left")
    parts.append(joined.select(*[merged(c) for c in columns]))
    return reduce(DataFrame.unionByName, parts)
