"""Row shaping that keeps costly expressions from running more than once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: Sequence[Column], *lazy: Column) -> DataFrame:
    """`df.select(*columns, *lazy)`, where `columns` are evaluated exactly once per row.

    After a plain select, a filter on a parsed column moves below it and parses the text a
    second time. The rows pass a generator here, which a filter does not cross. The `lazy`
    columns stay outside of it and cost nothing where they are not read.
    """
    return df.select(F.inline(F.array(F.struct(*columns))), *lazy)


#: More than any number of partitions.
_AS_THEY_ARE = 1 << 20


def code_ended(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions; what follows is not generated into one method with `df`.

    A coalesce that merges nothing passes rows one by one. Generated code keeps all rows that come
    of one row it reads, and a method that grows too long is not compiled.
    """
    return df.coalesce(_AS_THEY_ARE)
