"""Array arithmetic on word, sentence and document vectors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(left: Column, right: Column) -> Column:
    """Inner product of two equally long arrays."""
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def arg_max(values: Column) -> Column:
    """Zero-based position of the first largest element."""
    return F.array_position(values, F.array_max(values)) - 1


def softmax(values: Column) -> Column:
    """Softmax over the elements of one array."""
    top = F.array_max(values)
    powers = F.transform(values, lambda v: F.exp(v - top))
    total = F.aggregate(powers, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(powers, lambda v: v / total)


def pad(values: Column, width: int | Column) -> Column:
    """Array cut or zero-filled to a fixed width; to keep it whole, give at least its own length."""
    wanted = F.lit(width) if isinstance(width, int) else width
    return F.slice(F.concat(values, F.array_repeat(F.lit(0), wanted)), F.lit(1), wanted)


def pseudo_random_vector(key: Column, width: int, seed: int = 0) -> Column:
    """A repeatable vector of uniform numbers in [0, 1) for a key: the first 32 bits of the MD5 of key, place and seed."""
    def number(i: Column) -> Column:
        digest = F.md5(F.concat_ws(":", key, i.cast("string"), F.lit(str(seed))).cast("binary"))
        return F.conv(F.left(digest, F.lit(8)), 16, 10).cast("double") / F.lit(float(2**32))

    return F.transform(F.sequence(F.lit(1), F.lit(width)), number)
