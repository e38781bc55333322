import math
import random

import pytest
from pyspark.sql import functions as F

from loanloom.operators import encode, impute


def brute(train, rows, features, k):
    """All-pairs neighbour imputation of lists of dicts."""
    out = {}
    means = {}
    for f in features:
        have = [r[f] for r in train if r[f] is not None]
        means[f] = sum(have) / len(have)
    for q in rows:
        for f in features:
            if q[f] is not None:
                continue
            near = []
            for d in train:
                both = [g for g in features if q[g] is not None and d[g] is not None]
                if d[f] is None or not both:
                    continue
                s = sum((q[g] - d[g]) ** 2 for g in both)
                near.append((math.sqrt(len(features) / len(both) * s), d["id"], d[f]))
            near.sort()
            best = near[:k]
            out[(q["id"], f)] = sum(b[2] for b in best) / len(best) if best else means[f]
    return out


@pytest.mark.parametrize("kind", ["spread", "copies", "sparse"])
def test_neighbours_equal_all_pairs(spark, kind):
    rng = random.Random(kind)
    features = ["a", "b", "c", "d"]
    rows = []
    for i in range(260):
        values = {f: rng.gauss(0, 10 ** j) for j, f in enumerate(features)}
        if kind == "copies" and i % 3 == 0:
            values = {"a": 1.0, "b": 2.0, "c": 3.0, "d": float(i % 2)}
        gap = 0.25 if kind != "sparse" else 0.6
        rows.append({"id": i, **{f: None if rng.random() < gap else v for f, v in values.items()}})
    df = spark.createDataFrame(
        [(r["id"], *[r[f] for f in features]) for r in rows], "id bigint, a double, b double, c double, d double")
    model = impute.NeighbourImputer(features, "id", k=5).fit(df)
    got = {r["id"]: r for r in model.transform(df).collect()}
    for (i, f), value in brute(rows, rows, features, 5).items():
        assert got[i][f] == pytest.approx(value), (i, f)
    assert all(got[r["id"]][f] == r[f] for r in rows for f in features if r[f] is not None)


def test_start_radius_does_not_matter(spark):
    df = spark.range(200).select(
        "id", (F.col("id") * 1.5 % 37).alias("a"), F.when(F.col("id") % 9 != 0, F.col("id") * 2.5 % 11).alias("b"))
    results = []
    for radius in (None, 0.01, 1000.0):
        model = impute.NeighbourImputer(["a", "b"], "id", start_radius=radius).fit(df)
        results.append(sorted(map(tuple, model.transform(df).collect())))
    assert results[0] == results[1] == results[2]


def test_impute_moves_numbers_to_the_end(frame):
    train = frame([(1, 1.0, "a", 0), (2, None, "b", 1)], "sk_id_curr int, x double, c string, target int")
    one, _ = impute.impute_numerical_features(train, train, "target")
    assert one.columns == ["sk_id_curr", "c", "target", "x"]
    none = frame([("a",)], "c string")
    assert impute.impute_numerical_features(none, none, "target")[0] is none


def test_modes(frame):
    train = frame([("a", None), ("a", None), ("b", "x"), ("b", None)], "p string, q string")
    assert impute.category_modes(train, ["p", "q"]) == {"p": "a", "q": "Unknown"}
    one, two = impute.impute_categorical_features(train, train.where("p = 'b'"), "target")
    assert one.where("q = 'Unknown'").count() == 3 and two.where("q = 'Unknown'").count() == 1


def test_label_classes(frame):
    rows = [(i, v) for i, v in enumerate(["yes", "xna", "no", "yes", "xna"])]
    train = frame(rows, "i int, f string")
    enc = encode.CategoricalEncoder(binary=["f"]).fit(train)
    got = enc.transform(train, training=True).orderBy("i").collect()
    assert [r.f for r in got] == [2, 0, 1, 2, 0]
    test = frame([(9, "other"), (10, None)], "i int, f string")
    assert [r.f for r in enc.transform(test).orderBy("i").collect()] == [-1, 0]


def test_large_label_table(spark):
    train = spark.range(500).select(F.col("id"), F.concat(F.lit("v"), F.col("id")).alias("f"))
    coder = encode.LabelEncoder.fit(train, ["f"])
    assert not coder.literals
    want = {v: i for i, v in enumerate(sorted(f"v{i}" for i in range(500)))}
    got = coder.transform(train.union(spark.createDataFrame([(999, "new")], train.schema))).collect()
    assert all(r.f == want[f"v{r.id}"] for r in got if r.id != 999)
    assert [r.f for r in got if r.id == 999] == [-1]


def test_one_hot_unseen_and_constant(frame):
    train = frame([(1, "rail", "flat"), (2, "road", "flat"), (3, "sea", "flat")], "i int, f string, c string")
    test = frame([(1, "air", "flat"), (2, "rail", "flat")], "i int, f string, c string")
    one, two = encode.encode_categorical_features(train, test, [], ["f", "c"])
    assert one.columns == ["i", "f_rail", "f_road", "f_sea"] == two.columns
    assert [tuple(r)[1:] for r in two.orderBy("i").collect()] == [(0, 0, 0), (1, 0, 0)]


def test_leave_one_out(frame):
    rows = [("north", 1), ("south", 0), ("north", 0), ("east", 1), ("south", 0), ("north", 1), ("south", 1)]
    train = frame([(i, *r) for i, r in enumerate(rows)], "i int, f string, target int")
    test = frame([(0, "east"), (1, "north"), (2, "south"), (3, None), (4, "west")], "i int, f string")
    coder = encode.LeaveOneOutEncoder.fit(train, ["f"], "target")
    mean = 4 / 7  # of all rows, for a category with no other row
    assert [r.f for r in coder.transform(train, True).orderBy("i").collect()] == pytest.approx(
        [0.5, 0.5, 1.0, mean, 0.5, 0.5, 0.0])
    assert [r.f for r in coder.transform(test).orderBy("i").collect()] == pytest.approx(
        [mean, 2 / 3, 1 / 3, mean, mean])


def test_ordinal(frame):
    df = frame(list(enumerate(["warm", "cold", "hot", None, "cold", "damp", "warm"])), "i int, f string")
    got = encode.ordinal_encode(df, {"f": ["cold", "warm", "hot"]}).orderBy("i").collect()
    assert [r.f for r in got] == [1, 0, 2, -1, 0, -1, 1]
    with pytest.raises(ValueError):
        encode.CategoricalEncoder(ordinal=["f"]).fit(df)
    with pytest.raises(ValueError):
        encode.CategoricalEncoder(target_encoded=["f"], target_column="t").fit(df)


def test_one_hot_has_no_cap_of_its_own(spark):
    train = spark.range(1500).select(F.concat(F.lit("v"), F.col("id")).alias("f"))
    assert len(encode.OneHotEncoder.fit(train, ["f"]).categories["f"]) == 1500
    with pytest.raises(ValueError):
        encode.OneHotEncoder.fit(train, ["f"], most=1000)


def test_target_is_renamed_and_last(frame):
    train = frame([(1, "a", 5), (0, "b", 6)], "Default int, f string, n int")
    one, two = encode.encode_categorical_features(train, train.drop("Default"), ["f"], [], target_column="Default")
    assert one.columns == ["f", "n", "target"] and two.columns == ["f", "n"]
