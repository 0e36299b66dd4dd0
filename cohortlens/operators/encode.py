"""Feature preparation: label and ordinal codes, imputation, scaling, vector assembly.

Everything is fitted on training rows and then expressed as native pipeline stages, so a fitted
pipeline is one projection at scoring time and is saved and loaded like any Spark ML model.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import NULL_CLASS
from ..session import materialize, shared_dir
from .ranking import number_sorted, sorted_codes
from .stats import category_counts, fills_and_scales, most_frequent

UNKNOWN_CODE = -1
# Dictionaries up to this size become part of the projection, where a lookup scans them; larger ones
# are stored and joined, and their file size decides whether Spark broadcasts them.
INLINE_VALUES = 100
PREFIX = "f_"
CODED = "code_"
DICTIONARY = "dictionary"


def split_by_type(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names in table order."""
    kept = [f for f in df.schema.fields if f.name not in exclude]
    numeric = [f.name for f in kept if isinstance(f.dataType, T.NumericType)]
    return numeric, [f.name for f in kept if f.name not in numeric]


def label_encode(df: DataFrame, column: str) -> DataFrame:
    """Replace a text column by its code in sorted class order; missing is a class of its own."""
    filled = df.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit(NULL_CLASS)))
    return ordinal_encode(filled, sorted_codes(filled, column), column, column).select(df.columns)


def ordinal_encode(
    df: DataFrame, codes: DataFrame, column: str, output: str, inline_values: int = INLINE_VALUES
) -> DataFrame:
    """Set ``output`` to the value's code in a ``sorted_codes`` dictionary, -1 if it has none.

    A small dictionary becomes a literal, so the rows stay where they are; a large one is joined.
    """
    known = inline_dictionary(codes, inline_values)
    if known is None:
        return _looked_up(df, materialize(codes), column, output)
    # array_position counts from 1 and is 0 for an unknown value, which makes that -1.
    found = F.array_position(F.array(*[F.lit(v) for v in known]).cast("array<string>"), F.col(column))
    return df.withColumn(output, F.coalesce(found + UNKNOWN_CODE, F.lit(UNKNOWN_CODE)).cast("int"))


def inline_dictionary(codes: DataFrame, limit: int) -> list[str] | None:
    """The dictionary's values in code order, None if there are more than ``limit``."""
    known = codes.orderBy("code").limit(limit + 1).collect()
    return [r["value"] for r in known] if len(known) <= limit else None


def _looked_up(df: DataFrame, codes: DataFrame, column: str, output: str) -> DataFrame:
    renamed = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    joined = df.join(renamed, F.col(column) == F.col("_value"), "left")
    return joined.withColumn(output, F.coalesce(F.col("_code"), F.lit(UNKNOWN_CODE))).drop("_value", "_code")


class _DictionaryWriter(DefaultParamsWriter):
    """Puts a copy of the dictionary into the stage's own folder, so that a saved model needs nothing else."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        stage: DictionaryEncoder = self.instance
        self.sparkSession.read.parquet(stage.getOrDefault(stage.path)).write.parquet(f"{path}/{DICTIONARY}")


class _DictionaryReader(DefaultParamsReader):
    def load(self, path: str) -> DictionaryEncoder:
        stage = super().load(path)
        return stage._set(path=f"{path}/{DICTIONARY}")


class DictionaryEncoder(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Ordinal encoding through a dictionary table, for columns with very many values."""

    path = Param(Params._dummy(), "path", "parquet table (value, code)", TypeConverters.toString)
    fill = Param(Params._dummy(), "fill", "value used for missing input", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, path=None, fill=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def write(self) -> _DictionaryWriter:
        return _DictionaryWriter(self)

    @classmethod
    def read(cls) -> _DictionaryReader:
        return _DictionaryReader(cls)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        codes = dataset.sparkSession.read.parquet(self.getOrDefault(self.path))
        source = "_filled"
        filled = dataset.withColumn(
            source, F.coalesce(F.col(self.getInputCol()).cast("string"), F.lit(self.getOrDefault(self.fill)))
        )
        return _looked_up(filled, codes, source, self.getOutputCol()).drop(source)


class LabelCoder(Estimator, HasInputCol, HasOutputCol):
    """Label encoding as a stage: classes are those of the rows it is fitted on, in sorted order, a missing
    value being the class ``NULL_CLASS``. The model is a ``DictionaryEncoder``, so a class that was not
    there gets ``UNKNOWN_CODE``."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> DictionaryEncoder:
        column = self.getInputCol()
        filled = dataset.select(F.coalesce(F.col(column).cast("string"), F.lit(NULL_CLASS)).alias(column))
        path = shared_dir(dataset.sparkSession)
        sorted_codes(filled, column).write.parquet(path)
        return DictionaryEncoder(inputCol=column, outputCol=self.getOutputCol(), path=path, fill=NULL_CLASS)


@dataclass(frozen=True)
class FittedFeatures:
    """Pipeline stages that turn raw columns into the ``features`` vector, and the vector's names."""

    stages: list
    names: list[str]


def fit_features(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], inline_values: int = INLINE_VALUES
) -> FittedFeatures:
    """Median-impute and standardise the numeric columns, mode-impute and encode the others.

    A numeric column of text is label-encoded first, by a stage of its own. Columns without a single
    value in the training rows are dropped.
    """
    coders = [
        LabelCoder(inputCol=c, outputCol=CODED + c).fit(train) for c in numeric if isinstance(train.schema[c].dataType, T.StringType)
    ]
    for coder in coders:
        train = coder.transform(train)
    source = {c: c for c in numeric} | {coder.getInputCol(): coder.getOutputCol() for coder in coders}
    summaries = fills_and_scales(train, list(source.values()))
    centres = {c: summaries[s][0] for c, s in source.items() if s in summaries}
    scales = {c: summaries[s][1:] for c, s in source.items() if s in summaries}
    counts = materialize(category_counts(train, categorical)) if categorical else None
    fills = most_frequent(counts) if categorical else {}

    projected = {
        c: f"(coalesce(cast({_name(source[c])} AS double), {_number(centres[c])}) - {_number(scales[c][0])})"
        f" / {_number(scales[c][1])}"
        for c in numeric
        if c in centres
    }
    joined = []
    for c in (c for c in categorical if c in fills):
        codes = number_sorted(counts.where(F.col("column") == c).select("value"))
        known = inline_dictionary(codes, inline_values)
        if known is not None:
            values = ", ".join(_text(v) for v in known)
            projected[c] = (
                f"cast(array_position(array({values}), coalesce(cast({_name(c)} AS string), {_text(fills[c])}))"
                f" + {UNKNOWN_CODE} AS double)"
            )
        else:
            path = shared_dir(train.sparkSession)
            codes.write.parquet(path)
            joined.append(DictionaryEncoder(inputCol=c, outputCol=PREFIX + c, path=path, fill=fills[c]))

    exprs = ", ".join(f"{e} AS {_name(PREFIX + c)}" for c, e in projected.items())
    names = [c for c in (*numeric, *categorical) if c in centres or c in fills]
    stages = [SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__")] if exprs else []
    vector = VectorAssembler(inputCols=[PREFIX + c for c in names], outputCol="features", handleInvalid="error")
    return FittedFeatures([*coders, *stages, *joined, vector], names)


def feature_names(stages: Sequence) -> list[str]:
    """Names behind the vector positions, read from the assembler of a fitted pipeline."""
    assembler = next(s for s in reversed(stages) if isinstance(s, VectorAssembler))
    return [c.removeprefix(PREFIX) for c in assembler.getInputCols()]


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _number(value: float) -> str:
    return f"cast('{value!r}' AS double)"


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
