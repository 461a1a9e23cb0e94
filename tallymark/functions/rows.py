"""Small fixed tables as part of the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fixed_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """The given rows as literals: no file, no serialized Python objects."""
    fields = T.StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], fields)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
