"""Models fitted together against single fits, and the checks that tell an optimum."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from reviewlens.operators import expertise, logistic


@pytest.fixture(scope="module")
def inputs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        x = [rng.gauss(5, 2), rng.gauss(0, 300), 7.0]
        label = int(min(3, max(0, x[0] / 3 + x[1] / 400 + rng.gauss(0, 1))))
        rows.append(("a" if i % 3 else "b", label if i % 3 else 2 * (label // 2), x, i % 2))
    return spark.createDataFrame(rows, "category string, label int, x array<double>, fold int").repartition(5).cache()


@pytest.fixture(scope="module")
def found(inputs):
    return logistic.fit_together(inputs, [0.1, 0.01], folds=2).collect()


@pytest.mark.parametrize("category, left_out", [("a", -1), ("a", 0), ("b", 1)])
@pytest.mark.parametrize("penalty", [0.1, 0.01])
def test_models_equal_single_fits(inputs, found, category, left_out, penalty):
    rows = inputs.where((F.col("category") == category) & (F.col("fold") != left_out)).withColumn("features", array_to_vector("x"))
    own = sorted((r for r in found if (r.category, r.left_out, r.reg_param) == (category, left_out, penalty)), key=lambda r: r["class"])
    # Labels from 0 without gaps, as single fits want them.
    place = F.create_map(*[F.lit(v) for i, r in enumerate(own) for v in (r["class"], float(i))])
    single = LogisticRegression(family="multinomial", regParam=penalty, maxIter=2000, tol=1e-13).fit(rows.withColumn("label", place[F.col("label")]))
    assert np.allclose([r.coefficients for r in own], single.coefficientMatrix.toArray(), atol=1e-6)
    intercepts = np.array([r.intercept for r in own])
    assert np.allclose(intercepts - intercepts.mean(), single.interceptVector.toArray(), atol=1e-5)


def test_only_an_optimum_is_flat(spark, inputs):
    coefficients = logistic.fit_together(inputs, [0.05])
    cells = logistic.moments(inputs, coefficients).collect()
    assert len(cells) == (4 + 2) * 4 and all(abs(c.slope) < 1e-8 for c in cells)
    moved = coefficients.withColumn("intercept", F.col("intercept") + F.when(F.col("class") == 2, 1e-4).otherwise(0.0))
    assert any(abs(c.slope) > 1e-7 for c in logistic.moments(inputs, moved).collect())
    sums = inputs.groupBy("category", "label").agg(F.sum(F.col("x")[1]).alias("s"))
    observed = {(c.category, c["class"]): c.observed for c in cells if c.input == 1}
    assert all(observed[r.category, r.label] == pytest.approx(r.s) for r in sums.collect())


def test_separable_classes_and_empty_tables(spark, inputs):
    rows = spark.createDataFrame([("a", i // 10, [float(i)], 0) for i in range(20)], inputs.schema)
    found = logistic.fit_together(rows, [0.0], rounds=25)
    right = logistic.predicted(rows, found).where("prediction = label").count()
    assert right == 20
    assert logistic.fit_together(rows.limit(0), [0.1]).count() == 0
    one = logistic.fit_together(rows.where("label = 1"), [0.1])
    assert logistic.predicted(rows, one).where("prediction = 1").count() == 20


def test_training_rows_keep_users_with_null_inputs(spark):
    values = {name: float(i) for i, name in enumerate(expertise.INPUTS)}
    rows = [dict(user_id=u, category="Shopping", elite=0.1, elite_cat=2, **values) for u in range(20)]
    for name, user in zip(expertise.INPUTS, range(0, 20, 2)):
        rows[user][name] = None
    types = "user_id long, category string, elite double, elite_cat int, " + ", ".join(f"{n} double" for n in expertise.INPUTS)
    frame = spark.createDataFrame([tuple(r[c.split()[0]] for c in types.split(", ")) for r in rows], types)
    found = expertise.training_rows(frame).collect()
    assert sorted(r.user_id for r in found) == list(range(20))
    assert all((r.features is None) == (r.user_id % 2 == 0) for r in found)


def test_leaves_and_trees_are_checked(spark):
    rng = random.Random(1)
    rows = spark.createDataFrame([(i, "c", float(i % 7) + rng.random(), [float(i % 7), rng.random()]) for i in range(200)], "user_id long, category string, elite double, x array<double>")
    train = rows.withColumn("features", array_to_vector("x"))
    leaves = expertise.leaf_checks(train, expertise.fit_tree(train)).collect()
    assert sum(r["rows"] for r in leaves) == 200 and all(abs(r.prediction - r.mean) < 1e-9 for r in leaves)
    other = expertise.leaf_checks(train.withColumn("elite", F.col("elite") + 1), expertise.fit_tree(train)).collect()
    assert all(abs(r.prediction - r.mean) > 0.9 for r in other)
    assert all(abs(r.prediction - r["mean"]) < 1e-9 for r in expertise.forest_checks(train, expertise.fit_forest(train)).collect())
