"""Zero or more rows from each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def emit(df: DataFrame, outputs: Sequence[tuple[Column, Sequence[Column]]], *beside: Column | str) -> DataFrame:
    """``beside`` and the columns of each output whose condition holds, from one scan.

    The rows that do not hold are dropped behind the generator by a mark: a filter of the array
    before it is evaluated without generated code, and with it all that the array is made of.
    """
    rows = F.array(*[F.when(holds, F.struct(F.lit(True).alias("_holds"), *columns)) for holds, columns in outputs])
    return df.select(*beside, F.inline(rows)).where("_holds").drop("_holds")
