"""Left join to a table with one row per key, where a single key may hold a third of the rows."""

from pyspark.sql import DataFrame, functions as F

from postsift.session import staged


def lookup(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Left join ``rows`` to ``facts``, which has one row per ``key``.

    The facts are narrow (the key and its values) and are written first, so the join reads a table
    and not an aggregate on its own key: the runtime then knows their size, broadcasts them if
    they are small, and otherwise splits the rows of a hot key over many tasks (adaptive skew
    join). No count or size decides the plan here.
    """
    facts = staged(facts.where(F.col(key).isNotNull()), "facts")
    values = [name for name in facts.columns if name != key]
    return rows.join(facts, key, "left").select(*rows.columns, *values)
