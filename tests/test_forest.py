import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from loanloom.operators import forest, models
from loanloom.operators.forest import DeepForest

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 30, 3000), rng.normal(size=3000), rng.normal(size=3000), rng.random(3000) < 0.01], axis=1)
    y = (x[:, 0] + 3 * x[:, 1] + 4 * rng.normal(size=3000) > 15) | (x[:, 3] > 0)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, label double")
    return models.assembler(FEATURES).transform(df).persist()


def test_a_tree_matches_the_library(rows):
    whole = models.assembler(["a", "d"], "few").transform(rows)
    fitted = DecisionTreeClassifier(labelCol="label", featuresCol="few", maxDepth=30).fit(whole)
    got = DeepForest(1, bagged=False).importances(whole, "few", "label")
    # the library leaves out splits of which both sides predict the same class
    assert got == pytest.approx(models.importances_of(fitted), abs=1e-3)
    with pytest.raises(ValueError):
        DeepForest(1).importances(rows.limit(0), models.RAW, "label")


def test_trees_do_not_depend_on_who_grows_them(rows):
    want = DeepForest(8).importances(rows, models.RAW, "label")
    assert sum(want) == pytest.approx(1) and want[0] > want[2] and want[1] > want[2] and want[3] > 0.01
    for few in (100, 700):
        got = DeepForest(8, few=few).importances(rows.repartition(3).sortWithinPartitions("a"), models.RAW, "label")
        assert got == pytest.approx(want, abs=0.05)  # other row numbers, other draws
        assert DeepForest(8, few=few).importances(rows, models.RAW, "label") == pytest.approx(want, abs=1e-12)


def test_the_driver_holds_few_nodes_of_a_deep_forest(rows, monkeypatch):
    """Fully grown trees of these rows have hundreds of nodes each; the driver knows the upper ones."""
    seen = []
    split = DeepForest._upper
    monkeypatch.setattr(DeepForest, "_upper", lambda *a: seen.append(split(*a)) or seen[-1])
    selector = models.model_pipeline("Random Forest", FEATURES, 3000, trees=6).getStages()[2]
    selector.classifier.few = 1000
    slicer = selector.fit(rows)
    assert set(slicer.getIndices()) <= {0, 1, 2, 3}
    assert 6 < len(seen[0][0].tree) < 6 * 20


def test_feature_importances_without_the_deep_trees(rows):
    ready = rows.drop(models.RAW).withColumn("weight", F.lit(1.0)).withColumn("id", F.monotonically_increasing_id())
    pipeline = models.model_pipeline("Random Forest", FEATURES, 3000, trees=4)
    assert isinstance(pipeline.getStages()[2].classifier, DeepForest)
    got = {r["feature"]: r["importance"] for r in models.extract_feature_importances(
        pipeline.fit(ready), ready, FEATURES, "id").collect()}
    assert set(got) == set(FEATURES) and sum(got.values()) == pytest.approx(1) and got["c"] == 0


def test_the_selector_of_the_single_tree_counts_what_the_library_counts(rows):
    """Splits below which all leaves predict the same class don't count, whoever grows them."""
    whole = models.assembler(["a", "d"], "few").transform(rows)
    want = models.importances_of(DecisionTreeClassifier(labelCol="label", featuresCol="few", maxDepth=30).fit(whole))
    for few in (forest.FEW, 300, 50):
        got = DeepForest(1, bagged=False, pruned=True, few=few).importances(whole, "few", "label")
        assert got == pytest.approx(want, abs=1e-9)
    assert DeepForest(1, bagged=False).importances(whole, "few", "label") != pytest.approx(want, abs=1e-9)
    alike = rows.withColumn("label", F.lit(1.0))
    assert DeepForest(1, bagged=False, pruned=True).importances(alike, models.RAW, "label") == [0, 0, 0, 0]


def test_the_driver_holds_no_deep_tree(rows, monkeypatch):
    """A fully grown tree of these rows has hundreds of nodes; the driver knows the upper ones."""
    seen = []
    split = DeepForest._upper
    monkeypatch.setattr(DeepForest, "_upper", lambda *a: seen.append(split(*a)) or seen[-1])
    selector = models.model_pipeline("Decision Tree", FEATURES, 3000).getStages()[2]
    deep = DecisionTreeClassifier(labelCol="label", featuresCol=models.RAW, maxDepth=30).fit(rows)
    selector.classifier.few = 500
    selector.fit(rows)
    assert 1 < len(seen[0][0].tree) < 40 < deep.numNodes / 5


def test_rows_go_only_where_a_node_waits_for_them():
    rng = np.random.default_rng(5)
    bins, cls = rng.integers(0, 32, (500, 2)).astype(np.uint8), rng.integers(0, 3, 500).astype(np.uint8)
    upper = forest.Upper.roots(2)
    first = upper.add(1, 0, 9, 1.0, [0, 1])
    below = upper.add(first + 1, 1, 20, 1.0, [1, 1])
    codes, every = forest._codes(bins, cls, 3), np.arange(500)
    got = {node: set(own.tolist()) for node, own in upper.way([first, below + 1]).rows(1, codes, 3, every)}
    low = bins[:, 0] <= 9
    assert got == {first: set(every[low].tolist()), below + 1: set(every[~low & (bins[:, 1] > 20)].tolist())}
    assert upper.way([below]).trees == [1] and not list(upper.way([below]).rows(0, codes, 3, every))
    upper.prune()
    assert upper.says.tolist()[1] == -1 and upper.gains(2, 2).tolist() == [[0, 0], [1, 0]]


def test_many_classes_and_cuts():
    """Best cuts against all cuts."""
    rng = np.random.default_rng(6)
    counts = rng.integers(0, 4, (5, 40, 6)).astype(float) * (rng.random((5, 40, 6)) < 0.4)
    gain, cut = forest._best_cut(counts)
    for k in range(40):
        own = counts[:, k]
        gini = lambda c: (c.sum(axis=1) ** 2).sum() / max(c.sum(), 1)
        every = [gini(own[:, :i + 1]) + gini(own[:, i + 1:]) - gini(own) for i in range(5)]
        assert gain[k] == pytest.approx(max(*every, 0)) and (gain[k] == 0 or every[cut[k]] == pytest.approx(gain[k]))


def test_draws_are_poisson():
    n = np.concatenate([forest.drawn(42, t, np.arange(20_000)) for t in range(5)])
    assert n.mean() == pytest.approx(1, abs=0.02) and n.var() == pytest.approx(1, abs=0.03)
    assert (n == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)
    pair = np.corrcoef(forest.drawn(42, 0, np.arange(20_000)), forest.drawn(42, 1, np.arange(20_000)))[0, 1]
    assert abs(pair) < 0.03
