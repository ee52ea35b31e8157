"""A bounded sample that is spread by hash over all rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 1 << 31


def by_hash(rows: DataFrame, sample: int, *keys: str) -> DataFrame:
    """``sample`` rows (or all, if there are fewer) with the smallest hashes of ``keys``.

    A share of the hashes that holds about four times the sample goes first, so what the tasks
    send on does not grow with the number of rows or of tasks.
    """
    hashed: Column = F.xxhash64(*keys)
    share = min(STEPS, 4 * sample * STEPS // max(1, rows.count()) + 1)
    return rows.where(F.pmod(hashed, F.lit(STEPS)) < share).orderBy(F.pmod(hashed, F.lit(STEPS)), *keys).limit(sample)
