"""Projections and schema operators: names, narrow types, column lists."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.scalars import clean_name, present, recode_code

# Inclusive ranges of the signed integer types, narrowest first.
INTEGER_RANGES = [
    ("tinyint", -(2**7), 2**7 - 1),
    ("smallint", -(2**15), 2**15 - 1),
    ("int", -(2**31), 2**31 - 1),
    ("bigint", -(2**63), 2**63 - 1),
]
FLOAT_MAX = 3.4028234663852886e38


def _quoted(name: str):
    return F.col(f"`{name}`")


def _rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    clashes = sorted({n for n in names if list(names).count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after cleaning: {clashes}")
    return df.toDF(*names)


def lower_column_names(df: DataFrame) -> DataFrame:
    return _rename_all(df, [c.lower() for c in df.columns])


def clean_column_names(df: DataFrame) -> DataFrame:
    return _rename_all(df, [clean_name(c) for c in df.columns])


def sanitize_feature_names(df: DataFrame) -> DataFrame:
    """Runs of non-word characters become ``_``; outer ``_`` are stripped, case is kept."""
    return _rename_all(df, sanitized_names(df.columns))


def sanitized_names(names: Sequence[str]) -> list[str]:
    return [re.sub(r"\W+", "_", n).strip("_") for n in names]


class FeatureNameSanitizer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """:func:`sanitize_feature_names` for ``inputCols`` as a stage of an ML pipeline.

    Columns that are no features, such as ids or what a decision needs, keep their names;
    without ``inputCols`` every column is renamed.
    """

    inputCols = Param(Params._dummy(), "inputCols", "columns to rename", TypeConverters.toListString)

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if not self.isSet(self.inputCols):
            return sanitize_feature_names(dataset)
        own = self.getOrDefault(self.inputCols)
        new = dict(zip(own, sanitized_names(own), strict=True))
        return _rename_all(dataset, [new.get(c, c) for c in dataset.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def require_numeric(df: DataFrame, features: Sequence[str]) -> list[str]:
    """Features that exist and are numeric, in the given order; the rest raise together."""
    known = set(numeric_columns(df))
    bad = [f for f in features if f not in known]
    if bad:
        raise ValueError(f"missing or non-numeric features: {bad}")
    return list(features)


def usable_numeric(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    """Split features into (numeric and present, skipped)."""
    known = set(numeric_columns(df))
    return [f for f in features if f in known], [f for f in features if f not in known]


def recode_as_category(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: recode_code(c) for c in columns})


def align_columns(df: DataFrame, columns: Sequence[str], fill: int = 0) -> DataFrame:
    """Exactly ``columns`` in that order: absent ones are ``fill``, extra ones go."""
    have = set(df.columns)
    return df.select(*[_quoted(c) if c in have else F.lit(fill).alias(c) for c in columns])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def drop_by_name_pattern(df: DataFrame, patterns: Sequence[str] = ("_xna", "-1")) -> DataFrame:
    """Drop columns whose name contains any of the substrings."""
    return df.select(*[_quoted(c) for c in df.columns if not any(p in c for p in patterns)])


def drop_constant_columns(df: DataFrame) -> DataFrame:
    """Drop columns with exactly one distinct value; all-missing columns stay."""
    return df.drop(*constant_columns(df))


def constant_columns(df: DataFrame) -> list[str]:
    # min = max needs no shuffle of values, unlike a distinct count per column
    if not df.columns:
        return []
    row = df.agg(
        *[(F.min(_quoted(c)).eqNullSafe(F.max(_quoted(c)))
           & F.min(_quoted(c)).isNotNull()).alias(f"c{i}") for i, c in enumerate(df.columns)]
    ).first()
    return [c for i, c in enumerate(df.columns) if row[f"c{i}"]]


def shape(df: DataFrame) -> DataFrame:
    """One row with the number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def validate_data(df: DataFrame, columns: Sequence[str], name: str) -> None:
    """Raise when any of the columns holds a missing value."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    bad = {c: row[c] for c in columns if row[c]}
    if bad:
        raise AssertionError(f"{name}: missing values in {bad}")


def _integer_type(low: int, high: int) -> str:
    return next(t for t, least, most in INTEGER_RANGES if least <= low and high <= most)


def narrowed_types(df: DataFrame) -> dict[str, tuple[str, str]]:
    """Column -> (type now, narrowest type that holds the column's min and max)."""
    ints = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
    floats = [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType | T.FloatType)
    ]
    now = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if not ints + floats:
        return {c: (t, t) for c, t in now.items()}
    bounds = df.agg(
        *[F.min(_quoted(c)).alias(f"min_{c}") for c in ints],
        *[F.max(_quoted(c)).alias(f"max_{c}") for c in ints],
        *[F.min(present(_quoted(c))).alias(f"min_{c}") for c in floats],
        *[F.max(present(_quoted(c))).alias(f"max_{c}") for c in floats],
    ).first()
    plan = {}
    for c, old in now.items():
        new = old
        if c in ints and bounds[f"min_{c}"] is not None:
            new = _integer_type(bounds[f"min_{c}"], bounds[f"max_{c}"])
        elif c in floats and bounds[f"min_{c}"] is not None:
            fits = -FLOAT_MAX <= bounds[f"min_{c}"] and bounds[f"max_{c}"] <= FLOAT_MAX
            new = "float" if fits else "double"
        plan[c] = (old, new)
    return plan


def narrow_types(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The narrowed table and a report ``column_name, old_type, new_type``.

    Float32 keeps about seven digits; all-missing columns keep their type.
    """
    plan = narrowed_types(df)
    report = df.sparkSession.createDataFrame(
        [(c, old, new) for c, (old, new) in plan.items()],
        "column_name string, old_type string, new_type string",
    )
    return df.select(*[_quoted(c).cast(new).alias(c) for c, (_, new) in plan.items()]), report


@dataclass
class DowncastModel:
    """Types and category sets chosen on the training table."""

    types: dict[str, str]
    categories: dict[str, DataFrame] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        """Cast to the fitted types; values or categories outside them become null."""
        have = [c for c in df.columns if c in self.types]
        out = df.select(
            *[
                _quoted(c) if c not in self.types
                else _quoted(c).try_cast(self.types[c]).alias(c)
                for c in df.columns
            ]
        )
        for c in have:
            if c in self.categories:
                known = self.categories[c].select(
                    F.col("category").alias(c), F.lit(True).alias("__known")
                )
                out = out.join(known, c, "left").withColumn(
                    c, F.when(F.col("__known"), F.col(c))
                ).drop("__known")
        return out.select(*df.columns)


def fit_downcast(train: DataFrame, target_column: str | None = None) -> DowncastModel:
    """Choose types on ``train``; strict bounds, infinities keep double."""
    fields = {f.name: f.dataType for f in train.schema.fields}
    numbers = [c for c, t in fields.items() if isinstance(t, T.NumericType)]
    bounds = train.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(_quoted(c)).alias(f"min_{c}") for c in numbers],
        *[F.max(_quoted(c)).alias(f"max_{c}") for c in numbers],
    ).first()
    if bounds["n"] == 0:
        raise ValueError("the training table is empty")
    types = {}
    for c, t in fields.items():
        if c not in numbers:
            continue
        low, high = bounds[f"min_{c}"], bounds[f"max_{c}"]
        if low is None:
            types[c] = t.simpleString()
        elif isinstance(t, T.IntegralType):
            types[c] = next(
                (k for k, least, most in INTEGER_RANGES if least < low and high < most), "bigint"
            )
        else:
            types[c] = "float" if -FLOAT_MAX < low and high < FLOAT_MAX else "double"
    categories = {}
    for c, t in fields.items():
        if isinstance(t, T.StringType):
            types[c] = "string"
            if c != target_column:
                categories[c] = (
                    train.select(_quoted(c).alias("category")).where("category is not null")
                    .distinct()
                )
    return DowncastModel(types, categories)


def downscale_dtypes(
    train: DataFrame, test: DataFrame | None = None, target_column: str | None = None
) -> tuple[DataFrame, DataFrame | None, DowncastModel]:
    model = fit_downcast(train, target_column)
    narrow_train = train.select(*[
        _quoted(c).cast(model.types.get(c, t)).alias(c) for c, t in train.dtypes
    ])
    return narrow_train, None if test is None else model.transform(test), model
