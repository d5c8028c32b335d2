"""The left join, in a form whose large part adaptive execution can split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """``one`` left join ``many``, as the matches and the rows of ``one`` that have none.

    A frequent key of ``many`` can be split in an inner join but not on the right of a left join.
    """
    unmatched = one.join(many.select(key).distinct(), key, "left_anti")
    return one.join(many, key).unionByName(unmatched, allowMissingColumns=True)
