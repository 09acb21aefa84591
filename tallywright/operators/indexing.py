"""Categories as numbers: indices, one-hot vectors, and the way back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.operators.lookup import attach_lookup
from tallywright.operators.ranking import numbered

UNKNOWN_LABEL = "__unknown"


def string_indexer(
    columns: Sequence[str], outputs: Sequence[str], handle_invalid: str = "error"
) -> StringIndexer:
    """One estimator, hence one pass over the rows, for all columns.

    Most frequent value first, equal counts in alphabetical order. ``error``
    raises on values not seen at fitting, ``keep`` gives them one more index.
    For nominal features: the labels of the model live on the driver. ``TableIndexer`` is for
    columns of very many values.
    """
    return StringIndexer(inputCols=list(columns), outputCols=list(outputs), handleInvalid=handle_invalid)


def index_columns(
    df: DataFrame, columns: Sequence[str], suffix: str = "_index", handle_invalid: str = "error"
) -> tuple[StringIndexerModel, DataFrame]:
    model = string_indexer(columns, [c + suffix for c in columns], handle_invalid).fit(df)
    return model, model.transform(df)


def one_hot(
    df: DataFrame, columns: Sequence[str], outputs: Sequence[str]
) -> tuple[OneHotEncoderModel, DataFrame]:
    """One-hot vectors of index columns; the last index is all zeros."""
    model = OneHotEncoder(inputCols=list(columns), outputCols=list(outputs)).fit(df)
    return model, model.transform(df)


def category_index(df: DataFrame, column: str, output: str) -> DataFrame:
    """The mapping (value, n_rows, index) of a column with any number of values.

    Same order as the string indexer, but as a table: nothing of it is held on
    the driver. Null is no value.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return numbered(counts, [F.desc("n_rows"), F.asc(column)], output)


def apply_category_index(
    df: DataFrame,
    mapping: DataFrame,
    column: str,
    output: str,
    spread: str,
    handle_invalid: str = "error",
) -> DataFrame:
    """Attach the index of each row's value as a double.

    ``keep`` gives null and unseen values the number of labels as index;
    ``error`` raises where such a row is read.
    """
    slim = mapping.select(column, "n_rows", F.col(output).cast("double").alias(output))
    joined = attach_lookup(df, slim, column, "n_rows", spread, how="left").drop("n_rows")
    if handle_invalid == "keep":
        missing = mapping.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    else:
        value = F.coalesce(F.col(column).cast("string"), F.lit("null"))
        missing = F.raise_error(F.concat(F.lit(f"{column} has no index for: "), value)).cast("double")
    return joined.withColumn(output, F.coalesce(F.col(output), missing))


def index_to_label(df: DataFrame, column: str, labels: Sequence[str], output: str) -> DataFrame:
    """Label at an index; an index outside the list is the unknown label."""
    names = F.array(*[F.lit(label) for label in labels])
    position = F.col(column).cast("int")
    inside = (position >= 0) & (position < len(labels))
    return df.withColumn(output, F.when(inside, F.get(names, position)).otherwise(F.lit(UNKNOWN_LABEL)))


class TableIndexer(Estimator):
    """A stage that indexes columns of any number of values, in the order of the string indexer.

    Its model holds a table of the values of each column in the shared folder, and no value on
    the driver; rows meet it in joins that divide values with very many rows by the
    ``spread`` column. Null and unseen values get the number of labels (``keep``) or raise
    where they are read (``error``). The indices carry no nominal attribute: a forest, which could
    not hold a bin for each of very many values, takes them as numbers.
    """

    def __init__(self, columns: Sequence[str], outputs: Sequence[str], spread: str, handle_invalid: str = "error") -> None:
        super().__init__()
        self.columns, self.outputs = list(columns), list(outputs)
        self.spread, self.handle_invalid = spread, handle_invalid

    def _fit(self, dataset: DataFrame) -> TableIndexerModel:
        tables = [category_index(dataset, c, o) for c, o in zip(self.columns, self.outputs, strict=True)]
        return TableIndexerModel(self.columns, self.outputs, self.spread, self.handle_invalid, tables)


class TableIndexerModel(Model):
    """``tables`` are (value, n_rows, index), one for each column."""

    def __init__(
        self, columns: Sequence[str], outputs: Sequence[str], spread: str, handle_invalid: str, tables: Sequence[DataFrame]
    ) -> None:
        super().__init__()
        self.columns, self.outputs = list(columns), list(outputs)
        self.spread, self.handle_invalid, self.tables = spread, handle_invalid, list(tables)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        given = dataset.columns
        for column, output, table in zip(self.columns, self.outputs, self.tables, strict=True):
            dataset = apply_category_index(dataset, table, column, output, self.spread, self.handle_invalid)
        return dataset.select(*given, *self.outputs)


def indexers(columns: Sequence[str], outputs: Sequence[str], wide: Sequence[str], spread: str, handle_invalid: str = "keep") -> list[Estimator]:
    """Stages that index the columns: those named in ``wide``, of very many values, by tables,
    the others together by a string indexer."""
    pairs = list(zip(columns, outputs, strict=True))
    few, many = ([p for p in pairs if (p[0] in wide) == side] for side in (False, True))
    stages: list[Estimator] = []
    if few:
        stages.append(string_indexer([c for c, _ in few], [o for _, o in few], handle_invalid))
    if many:
        stages.append(TableIndexer([c for c, _ in many], [o for _, o in many], spread, handle_invalid))
    return stages
