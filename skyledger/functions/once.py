"""Keep a costly expression from being evaluated more than once per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expand_once(df: DataFrame, record: Column, keep: Sequence[str] = ()) -> DataFrame:
    """The fields of a struct expression as columns, next to the kept ones.

    A filter on a projected field is pushed below the projection by copying the
    expression into the filter, one copy per field it mentions. For a JSON parse
    or a forest that is several full evaluations of every row. Filters are not
    pushed through a generator's output, so the expression runs once. A null
    record gives one row of nulls.
    """
    kept = [F.col(f"`{name}`") for name in keep]
    return df.select(*kept, record.alias("_record")).select(*kept, F.inline(F.array("_record")))
