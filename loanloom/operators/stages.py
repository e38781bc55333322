"""Fitted preparation steps as pipeline stages that can be stored and loaded.

A stage keeps its numbers, names and short lists in the metadata every Spark ML stage writes,
and its tables (donors, codes, category sums, known categories) as Parquet beside them, so a
loaded stage needs nothing of the session that fitted it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from loanloom.operators import encode
from loanloom.operators.donors import DonorIndex
from loanloom.operators.features import engineer_features
from loanloom.operators.impute import NeighbourImputer, NeighbourModel
from loanloom.operators.outliers import Fences, flag_anomalies
from loanloom.operators.quantiles import QuantileBins
from loanloom.operators.schema import DowncastModel


class StoredStage(Transformer, MLWritable, MLReadable):
    """A fitted stage: ``facts`` (JSON values) and ``tables`` are all it knows."""

    def facts(self) -> dict:
        return {}

    def tables(self) -> dict[str, DataFrame]:
        return {}

    @classmethod
    def build(cls, facts: dict, tables: dict[str, DataFrame]) -> StoredStage:
        return cls(**facts)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance: StoredStage):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        tables = self.instance.tables()
        for i, df in enumerate(tables.values()):
            df.write.mode("overwrite").parquet(f"{path}/tables/{i}")
        # metadata last: a stage whose writing failed can't be loaded
        DefaultParamsWriter.saveMetadata(
            self.instance, path, self.sparkSession,
            extraMetadata={"facts": self.instance.facts(), "tables": list(tables)})


class _Reader(MLReader):
    def __init__(self, kind: type[StoredStage]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> StoredStage:
        spark = SparkSession.getActiveSession() or self.sparkSession
        found = DefaultParamsReader.loadMetadata(path, spark, f"{self.kind.__module__}.{self.kind.__name__}")
        tables = {name: spark.read.parquet(f"{path}/tables/{i}") for i, name in enumerate(found["tables"])}
        stage = self.kind.build(found["facts"], tables)
        stage._resetUid(found["uid"])
        return stage


class KeptColumns(StoredStage):
    """The columns that a reduction kept, in order; ``first`` goes in front where a table has it."""

    def __init__(self, kept: Sequence[str], first: str | None = None):
        super().__init__()
        self.kept, self.first = list(kept), first

    def facts(self):
        return {"kept": self.kept, "first": self.first}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        lead = [self.first] if self.first in dataset.columns else []
        return dataset.select(*[f"`{c}`" for c in [*lead, *(c for c in self.kept if c != self.first)]])


class DroppedColumns(StoredStage):
    def __init__(self, names: Sequence[str]):
        super().__init__()
        self.names = list(names)

    def facts(self):
        return {"names": self.names}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.names)


class NeighbourFill(StoredStage):
    """Gaps of numbers from the nearest training rows; the donors are stored with the stage."""

    def __init__(self, model: NeighbourModel):
        super().__init__()
        self.model = model

    def facts(self):
        m, i = self.model, self.model.imputer
        return {"imputer": {"features": list(i.features), "id_column": i.id_column, "k": i.k,
                            "start_radius": i.start_radius},
                "features": m.features, "means": m.means, "cuts": m.index.cuts}

    def tables(self):
        index = self.model.index
        return {"blocks": index.blocks, **{f"level:{i}": t for i, t in enumerate(index.levels)}}

    @classmethod
    def build(cls, facts, tables):
        levels = [t for name, t in tables.items() if name.startswith("level:")]
        imputer = NeighbourImputer(**facts["imputer"])
        index = DonorIndex(len(facts["features"]), imputer.k, tables["blocks"], levels, facts["cuts"])
        return cls(NeighbourModel(imputer, facts["features"], facts["means"], index))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.model.transform(dataset)


class ModeFill(StoredStage):
    """Gaps of texts from the training table's modes."""

    def __init__(self, modes: Mapping[str, str]):
        super().__init__()
        self.modes = dict(modes)

    def facts(self):
        return {"modes": self.modes}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        known = {c: v for c, v in self.modes.items() if c in dataset.columns}
        return dataset.fillna(known) if known else dataset


class FenceFlag(StoredStage):
    """1 where a value lies outside the fitted fences, else 0; no fences flag nothing."""

    def __init__(self, features: Sequence[str], fences: Fences, output: str = "is_anomaly"):
        super().__init__()
        self.features, self.output = list(features), output
        self.fences = {f: (low, high) for f, (low, high) in fences.items()}

    def facts(self):
        return {"features": self.features, "fences": {f: list(v) for f, v in self.fences.items()}, "output": self.output}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        flagged = flag_anomalies(dataset, self.features, self.fences, self.output)
        return flagged.withColumn(self.output, flagged[self.output].cast("int"))


class AmountFeatures(StoredStage):
    """Binned and derived features with the fitted edges."""

    def __init__(self, bins: Mapping[str, QuantileBins]):
        super().__init__()
        self.bins = dict(bins)

    def facts(self):
        return {"bins": {c: [b.edges, b.labels, b.single] for c, b in self.bins.items()}}

    @classmethod
    def build(cls, facts, tables):
        return cls({c: QuantileBins(c, edges, labels, single) for c, (edges, labels, single) in facts["bins"].items()})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return engineer_features(dataset, self.bins)


class EncodedCategories(StoredStage):
    """All fitted encoders; codes and category sums that are tables are stored as tables."""

    def __init__(self, model: encode.CategoricalEncoderModel):
        super().__init__()
        self.model = model

    def facts(self):
        m, e = self.model, self.model.encoder
        return {
            "encoder": {"binary": list(e.binary), "categorical": list(e.categorical), "ordinal": list(e.ordinal),
                        "target_encoded": list(e.target_encoded), "target_column": e.target_column,
                        "ordinal_orders": {f: list(o) for f, o in e.ordinal_orders.items()},
                        "placeholder": e.placeholder, "drop_patterns": list(e.drop_patterns)},
            "literals": m.label.literals if m.label else None,
            "categories": m.one_hot.categories if m.one_hot else None,
            "target": [m.leave_one_out.target, m.leave_one_out.mean] if m.leave_one_out else None,
            "columns": m.columns}

    def tables(self):
        m = self.model
        codes = m.label.tables if m.label else {}
        sums = m.leave_one_out.tables if m.leave_one_out else {}
        return {**{f"code:{f}": t for f, t in codes.items()}, **{f"sum:{f}": t for f, t in sums.items()}}

    @classmethod
    def build(cls, facts, tables):
        of = lambda kind: {n.split(":", 1)[1]: t for n, t in tables.items() if n.startswith(kind)}
        label = None if facts["literals"] is None else encode.LabelEncoder(facts["literals"], of("code:"))
        one_hot = None if facts["categories"] is None else encode.OneHotEncoder(facts["categories"])
        left_out = None if facts["target"] is None else encode.LeaveOneOutEncoder(*facts["target"], of("sum:"))
        return cls(encode.CategoricalEncoderModel(
            encode.CategoricalEncoder(**facts["encoder"]), label, one_hot, left_out, facts["columns"]))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.model.transform(dataset)


class NarrowedTypes(StoredStage):
    """The types and category sets that :func:`loanloom.operators.schema.fit_downcast` chose."""

    def __init__(self, model: DowncastModel):
        super().__init__()
        self.model = model

    def facts(self):
        return {"types": self.model.types}

    def tables(self):
        return self.model.categories

    @classmethod
    def build(cls, facts, tables):
        return cls(DowncastModel(facts["types"], tables))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.model.transform(dataset)
