"""Joins against lookup tables, whatever the size of the table or the skew of the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
SPREAD = 64
HOT_SHARE = 0.005
LEAST_SHARE = 0.0001


def unique(table: DataFrame, key: str | Sequence[str], small: bool | None = None) -> DataFrame:
    """One row per key; where a dictionary lists a key more than once, its largest other values stay.

    For a ranked word file that is the last rank. A table proven ``small`` is reduced in one task, as it
    is broadcast whole anyway.
    """
    table = table.repartition(1) if small else table
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in table.columns if c not in keys]
    if not others:
        return table.distinct()
    return table.groupBy(*keys).agg(F.max(F.struct(*others)).alias("_row")).select(*keys, "_row.*")


def is_small(table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure at most ``max_rows + 1`` rows and say whether the table may be broadcast."""
    size = table.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("size"),
    ).first()
    return size.n <= max_rows and size.size <= max_bytes


def hot_share(facts: DataFrame) -> float:
    """The share of rows from which a key counts as hot: that of one shuffle partition, within limits."""
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(LEAST_SHARE, min(HOT_SHARE, 1 / partitions))


def hot_keys(facts: DataFrame, keys: Sequence[str], share: float | None = None) -> list[int]:
    """Hashes of all keys that hold at least ``share`` of the rows; at most a few per 1 / share.

    One pass without shuffle; a key that is listed without being hot does no harm.
    """
    share = hot_share(facts) if share is None else share
    hashed = facts.select(F.xxhash64(*keys).alias("key"))
    return list(hashed.freqItems(["key"], share).first()[0] or [])


def lookup(
    facts: DataFrame,
    table: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    *,
    small: bool | None = None,
    salt: Column | None = None,
    spread: int = SPREAD,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Join facts to a lookup table.

    A table proven small (``small=True`` where the plan bounds it, else measured) is broadcast, so
    the facts are not shuffled. Beyond that both sides are shuffled by key; rows of hot keys are
    spread over ``spread`` salts, and only the hot keys of the table are copied to each of them.
    ``salt`` must be a repeatable expression over the facts; by default it hashes the whole row. ``hot`` are the
    hashes of the hot keys where they are known already: else the facts are computed once more to find them.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"lookup does not do {how} joins")
    keys = [on] if isinstance(on, str) else list(on)
    if small is None:
        small = is_small(table)
    if small:
        return facts.join(F.broadcast(table), keys, how)
    if hot is None:
        hot = [] if facts.isStreaming else hot_keys(facts, keys)
    if not hot:
        return facts.join(table, keys, how)
    chosen = salt if salt is not None else F.xxhash64(*[F.col(c) for c in _hashable(facts)])
    is_hot = F.xxhash64(*keys).isin(hot)
    salted = facts.withColumn("_salt", F.when(is_hot, F.pmod(chosen, F.lit(spread))).otherwise(0).cast("int"))
    # Hashes differ by type, so the table's keys are hashed as the facts' type.
    copied = F.xxhash64(*[F.col(k).cast(facts.schema[k].dataType) for k in keys]).isin(hot)
    everywhere = F.sequence(F.lit(0), F.lit(spread - 1))
    copies = table.withColumn("_salt", F.explode(F.when(copied, everywhere).otherwise(F.array(F.lit(0)))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def _hashable(facts: DataFrame) -> list[str]:
    return [f"`{field.name}`" for field in facts.schema.fields if field.dataType.typeName() not in ("map", "variant")]
