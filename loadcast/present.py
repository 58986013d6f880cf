"""Result presentation shared by registered queries: stable column types.

Doubles are rounded with ``round(x + 1e-9, 6)`` (the same rule is used in
the SQL oracles), integers widened to bigint, timestamps kept as
``timestamp_ntz`` (UTC wall clock).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.functions.stats import r6


def finish(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType)):
            c = r6(c)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(t, T.DecimalType):
            c = r6(c.cast("double"))
        cols.append(c.alias(f.name))
    return df.select(*cols)
