"""From raw applications to model-ready tables: the batch flow before training."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame

from loanloom.operators.encode import CategoricalEncoder
from loanloom.operators.features import fit_amount_bins
from loanloom.operators.impute import NeighbourImputer, category_modes
from loanloom.operators.outliers import iqr_fences
from loanloom.operators.quality import feature_reduction_report
from loanloom.operators.schema import categorical_columns, numeric_columns
from loanloom.operators.stages import (
    AmountFeatures,
    DroppedColumns,
    EncodedCategories,
    FenceFlag,
    KeptColumns,
    ModeFill,
    NeighbourFill,
)
from loanloom.session import stage

# Orders of the ordinal features.
ORDINAL_ORDERS = {
    "age_group": ["18-25", "26-35", "36-45", "46-55", "56-65", "65+"],
    "income_group": ["Q1", "Q2", "Q3", "Q4", "Q5"],
    "credit_amount_group": ["Q1", "Q2", "Q3", "Q4", "Q5"],
    "region_rating_client": ["3", "2", "1"],
}
ESSENTIAL = ["sk_id_curr", "amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price"]


@dataclass
class TrainingFlow:
    """Reduce, impute, flag, engineer and encode; every fit uses the training table.

    ``fences_from_each`` refits the outlier fences and the amount bins on the test table,
    as a separate run over that table would.
    """

    target: str
    id_column: str = "sk_id_curr"
    essential: Sequence[str] = tuple(ESSENTIAL)
    fenced: Sequence[str] = ("amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price")
    dropped: Sequence[str] = ("organization_type",)
    binary: Sequence[str] = ()
    categorical: Sequence[str] = ()
    target_encoded: Sequence[str] = ()
    ordinal_orders: Mapping[str, Sequence[str]] = field(default_factory=lambda: ORDINAL_ORDERS)
    reduction: Mapping[str, float] = field(default_factory=dict)
    fences_from_each: bool = False

    def fit(self, train: DataFrame, test: DataFrame) -> PipelineModel:
        """All steps as stages that can be stored; ``test`` only decides which columns are kept."""
        return self._fitted(train, test)[0]

    def _fitted(self, train: DataFrame, test: DataFrame) -> tuple[PipelineModel, DataFrame]:
        """The stages and the training table before it is encoded."""
        report = feature_reduction_report(train, test, self.target, essential=self.essential, **self.reduction)
        done: list[Transformer] = [KeptColumns([r["feature"] for r in report if r["kept"]], self.target)]
        df = done[0].transform(train)
        numbers = [c for c in numeric_columns(df) if c not in (self.target, self.id_column)]
        if numbers and not df.isEmpty():
            done.append(NeighbourFill(NeighbourImputer(numbers, self.id_column).fit(df)))
            df = done[-1].transform(df)
        words = [c for c in categorical_columns(df) if c != self.target]
        done.append(ModeFill(category_modes(df, words)))
        # nearest neighbours are expensive to repeat
        df = stage(done[-1].transform(df), "imputed")
        done += [FenceFlag(self.fenced, iqr_fences(df, self.fenced)), AmountFeatures(fit_amount_bins(df)),
                 DroppedColumns(self.dropped)]
        for step in done[-3:]:
            df = step.transform(df)
        have = set(df.columns)
        orders = {f: o for f, o in self.ordinal_orders.items() if f in have}
        encoder = CategoricalEncoder(
            [f for f in self.binary if f in have], [f for f in self.categorical if f in have],
            [f for f in self.target_encoded if f in have], list(orders), orders, self.target,
        ).fit(df)
        return PipelineModel([*done, EncodedCategories(encoder)]), df

    def run(self, train: DataFrame, test: DataFrame) -> PreparedTables:
        model, ready = self._fitted(train, test)
        *first, flag, bins, dropped, encoded = model.stages
        other = PipelineModel(first).transform(test)
        if self.fences_from_each:
            other = stage(other, "imputed")
            flag = FenceFlag(self.fenced, iqr_fences(other, self.fenced))
            bins = AmountFeatures(fit_amount_bins(other))
        other = PipelineModel([flag, bins, dropped, encoded]).transform(other)
        return PreparedTables(
            stage(encoded.model.transform(ready, training=True), "encoded"), stage(other, "encoded"), model)


@dataclass
class PreparedTables:
    train: DataFrame
    test: DataFrame
    model: PipelineModel
