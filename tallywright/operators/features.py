"""Feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame


def assembler(columns: Sequence[str], output: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    """Columns side by side in one vector. ``error`` raises on null, ``keep``
    writes NaN in its place."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=handle_invalid)


def assemble(
    df: DataFrame, columns: Sequence[str], output: str = "features", handle_invalid: str = "error"
) -> DataFrame:
    return assembler(columns, output, handle_invalid).transform(df)
