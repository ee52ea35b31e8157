"""Repeatable draws: the same row gets the same draw on every run and every retry."""

from pyspark.sql import Column, functions as F

_STEPS = 10_000


def draw(key: Column, seed="0") -> Column:
    """A number in 0..9999 from the key and the seed."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(seed)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % _STEPS


def chosen(key: Column, probability: float, seed="0") -> Column:
    """True for about ``probability`` of the keys."""
    return draw(key, seed) < F.lit(round(probability * _STEPS))


def pick(key: Column, choices: int, seed="pick") -> Column:
    """An even choice among 0..choices-1."""
    return (draw(key, seed) % choices).cast("int")
