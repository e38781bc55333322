"""Imputation: category modes and exact nearest neighbours."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.scalars import present
from loanloom.operators.donors import DonorIndex
from loanloom.operators.schema import categorical_columns, numeric_columns
from loanloom.session import stage

UNKNOWN = "Unknown"


def category_modes(train: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column with missing counted as a value.

    Ties go to the smaller value, missing last; a missing mode becomes ``"Unknown"``.
    """
    if not columns:
        return {}
    cells = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns
    ])
    counts = (
        train.select(F.explode(cells).alias("c")).groupBy("c.feature", "c.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy("feature").agg(
        F.min(F.struct((-F.col("n")).alias("rank"), F.col("value").isNull().alias("gone"), "value"))
        .alias("m")
    ).select("feature", "m.value").collect()
    return {r["feature"]: UNKNOWN if r["value"] is None else r["value"] for r in best}


def impute_categorical_features(
    train: DataFrame, test: DataFrame, target: str
) -> tuple[DataFrame, DataFrame]:
    columns = [c for c in categorical_columns(train) if c != target]
    modes = category_modes(train, columns)
    return train.fillna(modes), test.fillna({c: v for c, v in modes.items() if c in test.columns})


@dataclass
class NeighbourImputer:
    """Mean of the ``k`` nearest training rows that have the feature.

    The distance is Euclidean over the features present in both rows, scaled up by the
    share of features compared; ties go to the smaller id.  Infinite values are neither
    compared nor handed on.  One :class:`loanloom.operators.donors.DonorIndex` serves every
    pattern of gaps, and the result is exact.  With ``start_radius`` rows look within that
    distance first; it changes the work and not the result.
    """

    features: Sequence[str]
    id_column: str
    k: int = 5
    start_radius: float | None = None

    def fit(self, train: DataFrame) -> NeighbourModel:
        names = list(self.features)
        means = train.agg(*[F.avg(_finite(f)).alias(f"m{i}") for i, f in enumerate(names)]).first()
        donors = _vectors(train, names, self.id_column).where(F.instr("mask", "1") > 0)
        return NeighbourModel(self, names, list(means), DonorIndex.build(donors, len(names), self.k))


def _finite(name: str) -> Column:
    value = present(name)
    return F.when(F.abs(value) < float("inf"), value)


def _vectors(df: DataFrame, features: Sequence[str], id_column: str) -> DataFrame:
    """``id, x`` (array of doubles) and ``mask`` (``1`` where a value is there)."""
    values = [_finite(f).cast("double") for f in features]
    mask = F.concat(*[F.when(v.isNotNull(), "1").otherwise("0") for v in values])
    return df.select(F.col(id_column).alias("id"), F.array(*values).alias("x"), mask.alias("mask"))


@dataclass
class NeighbourModel:
    imputer: NeighbourImputer
    features: list[str]
    means: list[float | None]
    index: DonorIndex

    def transform(self, df: DataFrame) -> DataFrame:
        """All features as double with the gaps filled, moved behind the other columns."""
        others = [c for c in df.columns if c not in self.features]
        # ids may be missing or repeated: gaps belong to numbered rows of a written table
        df = stage(df.withColumn("__row", F.monotonically_increasing_id()), "numbered")
        found = self.neighbours(df, "__row")
        wide = found.groupBy("id").pivot("feature", list(range(len(self.features)))).agg(
            F.first("value")
        ).toDF("__id", *[f"__f{i}" for i in range(len(self.features))])
        filled = [
            F.coalesce(present(f), F.col(f"__f{i}"), F.lit(self.means[i])).alias(f)
            for i, f in enumerate(self.features)
        ]
        joined = df.join(wide, F.col("__row") == F.col("__id"), "left")
        return joined.select(*others, *filled)

    def neighbours(self, df: DataFrame, id_column: str) -> DataFrame:
        """``id, feature (position), value``: the neighbour mean of every gap that has one.

        ``id_column`` holds a bigint of its own in every row.
        """
        gaps = (
            _vectors(df, self.features, id_column)
            .where(F.instr("mask", "0") > 0).where(F.instr("mask", "1") > 0)
            .withColumn("open", F.array_compact(F.transform(
                "x", lambda v, i: F.when(v.isNull(), i))))
        )
        return self.index.nearest(gaps, self.imputer.start_radius)


def impute_numerical_features(
    train: DataFrame, test: DataFrame, target: str, id_column: str = "sk_id_curr",
    exclude: Sequence[str] = ("sk_id_curr",), k: int = 5,
) -> tuple[DataFrame, DataFrame]:
    """Fill numeric gaps of both tables from the nearest training rows."""
    features = [c for c in numeric_columns(train) if c != target and c not in exclude]
    if not features or train.isEmpty():
        return train, test
    model = NeighbourImputer(features, id_column, k).fit(train)
    return model.transform(train), model.transform(test)
