"""Output shaping shared by the registered queries.

Result columns are cast to engine-neutral types (BIGINT, DOUBLE, VARCHAR,
DATE, TIMESTAMP) so the Spark result and its DuckDB twin compare exactly;
averages, ratios and percentiles are rounded to 4 places on both sides.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACS = (T.DecimalType, T.FloatType, T.DoubleType)


def neutral(df: DataFrame, round4: Iterable[str] = (), nullable_ints: Iterable[str] = ()) -> DataFrame:
    """``nullable_ints``: integer columns that hold NULLs are shown as DOUBLE
    (the pandas form both engines agree on: float64 with NaN)."""
    round4 = set(round4)
    nullable_ints = set(nullable_ints)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in nullable_ints:
            c = c.cast("double")
        elif isinstance(f.dataType, _INTS):
            c = c.cast("bigint")
        elif isinstance(f.dataType, _FRACS):
            c = c.cast("double")
            if f.name in round4:
                c = F.round(c, 4)
        cols.append(c.alias(f.name))
    return df.select(*cols)
