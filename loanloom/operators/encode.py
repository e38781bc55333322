"""Categorical encoders: fit on train, apply to train and test."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.scalars import clean_name, flag, lookup, placeholder_to_null
from loanloom.operators.rank import prefix_sum
from loanloom.operators.schema import align_columns, clean_column_names, constant_columns
from loanloom.session import stage

MISSING_CLASS = "nan"
LITERAL_CLASSES = 100


def distinct_values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Long distinct ``feature, value`` (text); missing values are null rows."""
    cells = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value"))
        for f in features
    ])
    return df.select(F.explode(cells).alias("c")).select("c.*").distinct()


@dataclass
class LabelEncoder:
    """Position of a value among the sorted training values; unseen values give -1.

    Missing values form the class ``"nan"``.  Few classes become a literal expression;
    larger sets stay a table that is joined.
    """

    literals: dict[str, list[str]]
    tables: dict[str, DataFrame]

    @staticmethod
    def fit(train: DataFrame, features: Sequence[str]) -> LabelEncoder:
        # sorted in value ranges and written once, so that range numbers are stable
        values = distinct_values(train, features).withColumn(
            "value", F.coalesce("value", F.lit(MISSING_CLASS))).distinct()
        ranged = values.repartitionByRange("feature", "value").select(
            "feature", "value", F.spark_partition_id().alias("part"),
            F.lit(1).cast("bigint").alias("n"),
        )
        codes = prefix_sum(stage(ranged, "classes"), ["feature"], "value", ["n"]).select(
            "feature", "value", F.col("before_n").cast("int").alias("code"), "total_n")
        codes = stage(codes, "codes")
        small = codes.where(F.col("total_n") <= LITERAL_CLASSES).orderBy("feature", "code").collect()
        literals: dict[str, list[str]] = {}
        for r in small:
            literals.setdefault(r["feature"], []).append(r["value"])
        tables = {
            f: codes.where(F.col("feature") == f).select("value", "code")
            for f in features if f not in literals
        }
        return LabelEncoder(literals, tables)

    def transform(self, df: DataFrame) -> DataFrame:
        text = {f: F.coalesce(F.col(f).cast("string"), F.lit(MISSING_CLASS))
                for f in [*self.literals, *self.tables]}
        out = df.withColumns({
            f: lookup(text[f], {v: i for i, v in enumerate(classes)}, -1)
            for f, classes in self.literals.items()
        }) if self.literals else df
        for f, table in self.tables.items():
            codes = table.select(F.col("value").alias("__v"), F.col("code").alias("__code"))
            out = out.join(codes, text[f] == F.col("__v"), "left").withColumn(
                f, F.coalesce("__code", F.lit(-1))).drop("__v", "__code")
        return out.select(*df.columns)


@dataclass
class OneHotEncoder:
    """One 0/1 column per training category; unseen and missing values are all zeros."""

    categories: dict[str, list[str]]

    @staticmethod
    def fit(train: DataFrame, features: Sequence[str], most: int | None = None) -> OneHotEncoder:
        """Categories are column names, so they come to the driver; with ``most`` a feature
        that has more of them raises instead."""
        values = distinct_values(train, features).where(F.col("value").isNotNull())
        found: dict[str, list[str]] = {f: [] for f in features}
        for r in values.collect():
            found[r["feature"]].append(r["value"])
        wide = [f for f, v in found.items() if most is not None and len(v) > most]
        if wide:
            raise ValueError(f"too many categories for one column each: {wide}")
        return OneHotEncoder({f: sorted(v) for f, v in found.items()})

    def columns(self, feature: str) -> list[Column]:
        text = F.col(feature).cast("string")
        return [flag(text == v).alias(clean_name(f"{feature}_{v}"))
                for v in self.categories[feature]]

    def transform(self, df: DataFrame) -> DataFrame:
        selected: list[Column] = []
        for c in df.columns:
            selected += self.columns(c) if c in self.categories else [F.col(f"`{c}`")]
        return df.select(*selected)


@dataclass
class LeaveOneOutEncoder:
    """Mean target of the other rows of the category.

    Training rows leave themselves out; new rows get the category mean.  Categories with a
    single training row, unseen and missing values get the overall mean.
    """

    target: str
    mean: float
    tables: dict[str, DataFrame]

    @staticmethod
    def fit(train: DataFrame, features: Sequence[str], target: str) -> LeaveOneOutEncoder:
        if target not in train.columns:
            raise ValueError("target encoding needs the target column")
        mean = train.agg(F.avg(F.col(target).cast("double"))).first()[0]
        cells = F.array(*[
            F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value"))
            for f in features
        ])
        sums = stage(
            train.select(F.explode(cells).alias("c"), F.col(target).cast("double").alias("y"))
            .where("c.value is not null").groupBy("c.feature", "c.value")
            .agg(F.sum("y").alias("s"), F.count("y").alias("n")), "target_sums",
        )
        tables = {f: sums.where(F.col("feature") == f).select("value", "s", "n") for f in features}
        return LeaveOneOutEncoder(target, mean, tables)

    def transform(self, df: DataFrame, training: bool = False) -> DataFrame:
        out = df
        for f, table in self.tables.items():
            sums = table.select(F.col("value").alias("__v"), F.col("s").alias("__s"),
                                F.col("n").alias("__n"))
            s, n = F.col("__s"), F.col("__n")
            if training:
                s, n = s - F.col(self.target).cast("double"), n - 1
            code = F.when(F.col("__n") > 1, F.try_divide(s, n))
            out = out.join(sums, F.col(f).cast("string") == F.col("__v"), "left").withColumn(
                f, F.coalesce(code, F.lit(self.mean))).drop("__v", "__s", "__n")
        return out.select(*df.columns)


def ordinal_code(feature: str, order: Sequence[str]) -> Column:
    """Position in the given order as double; everything else is -1."""
    places = F.array(*[F.lit(v) for v in order])
    found = F.array_position(places, F.col(feature).cast("string"))
    return (F.coalesce(found, F.lit(0)) - 1).cast("double").alias(feature)


def ordinal_encode(df: DataFrame, orders: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.withColumns({f: ordinal_code(f, o) for f, o in orders.items()})


@dataclass
class CategoricalEncoder:
    """All encoders of a table as one fitted object."""

    binary: Sequence[str] = ()
    categorical: Sequence[str] = ()
    target_encoded: Sequence[str] = ()
    ordinal: Sequence[str] = ()
    ordinal_orders: Mapping[str, Sequence[str]] = field(default_factory=dict)
    target_column: str = ""
    placeholder: str = "xna"
    drop_patterns: Sequence[str] = ("_xna", "-1")

    def fit(self, train: DataFrame) -> CategoricalEncoderModel:
        absent = [f for f in self.ordinal if f not in self.ordinal_orders]
        if absent:
            raise ValueError(f"no order given for ordinal features {absent}")
        if self.target_encoded and self.target_column not in train.columns:
            raise ValueError("target encoding needs the target column")
        ready = self.prepare(train)
        model = CategoricalEncoderModel(
            self,
            LabelEncoder.fit(ready, self.binary) if self.binary else None,
            OneHotEncoder.fit(ready, self.categorical) if self.categorical else None,
            LeaveOneOutEncoder.fit(ready, self.target_encoded, "target")
            if self.target_encoded else None,
            [],
        )
        encoded = model.encode(ready, training=True)
        names = [c for c in encoded.columns
                 if c != "target" and not any(p in c for p in self.drop_patterns)]
        names += ["target"] if "target" in encoded.columns else []
        constant = set(constant_columns(encoded.select(*names)))
        model.columns = [c for c in names if c not in constant]
        return model

    def prepare(self, df: DataFrame) -> DataFrame:
        """Clean names, target renamed to ``target``, placeholders turned into nulls."""
        out = clean_column_names(df)
        named = clean_name(self.target_column)
        if named in out.columns and named != "target":
            out = out.withColumnRenamed(named, "target")
        groups = [*self.binary, *self.categorical, *self.target_encoded, *self.ordinal]
        text = {c for c, t in out.dtypes if t == "string"}
        return out.withColumns({
            f: placeholder_to_null(f, self.placeholder) for f in groups if f in text
        })


@dataclass
class CategoricalEncoderModel:
    encoder: CategoricalEncoder
    label: LabelEncoder | None
    one_hot: OneHotEncoder | None
    leave_one_out: LeaveOneOutEncoder | None
    columns: list[str]

    def encode(self, ready: DataFrame, training: bool) -> DataFrame:
        out = ready
        if self.leave_one_out:
            out = self.leave_one_out.transform(out, training)
        if self.label:
            out = self.label.transform(out)
        if self.encoder.ordinal:
            orders = {f: self.encoder.ordinal_orders[f] for f in self.encoder.ordinal}
            out = ordinal_encode(out, orders)
        return self.one_hot.transform(out) if self.one_hot else out

    def transform(self, df: DataFrame, training: bool = False) -> DataFrame:
        """The fitted columns; a table without target gets none, absent columns are 0."""
        out = self.encode(self.encoder.prepare(df), training)
        columns = self.columns if training else [c for c in self.columns if c != "target"]
        return align_columns(out, columns)


def encode_categorical_features(
    train: DataFrame, test: DataFrame, binary: Sequence[str], categorical: Sequence[str],
    target_encoded: Sequence[str] | None = None, ordinal: Sequence[str] | None = None,
    ordinal_orders: Mapping[str, Sequence[str]] | None = None, target_column: str = "",
) -> tuple[DataFrame, DataFrame]:
    """Both tables encoded with what the training table teaches."""
    model = CategoricalEncoder(
        binary, categorical, target_encoded or (), ordinal or (), ordinal_orders or {},
        target_column,
    ).fit(train)
    return model.transform(train, training=True), model.transform(test)
