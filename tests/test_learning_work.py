"""What the logistic models compute, and how often."""

import numpy as np

from reviewlens.operators import logistic

SCHEMA = "category string, label int, x array<double>, fold int"


def some_rows(spark):
    rng = np.random.default_rng(5)
    rows = [("a", int(i % 3), [float(x) for x in rng.normal(i % 3, 1, 2)], i % 2) for i in range(90)]
    return spark.createDataFrame(rows, SCHEMA)


def test_scores_are_computed_once_a_row(spark):
    rows = some_rows(spark)
    found = logistic.probabilities(rows, logistic.fit_together(rows, [0.1]))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with(") <= 2  # the products of a score, and the result
    assert all(abs(sum(c["p"] for c in r["classes"]) - 1) < 1e-12 for r in found.collect())


def test_the_check_of_an_optimum_has_a_row_per_class(spark):
    rows = some_rows(spark)
    plan = logistic.moments(rows, logistic.fit_together(rows, [0.1]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode(one_x") == 1  # for the deviations of the inputs only


def test_curvature_is_summed_for_the_whole_step_only(spark, monkeypatch):
    """A smaller step that is better is taken, and the optimum is the same."""
    rows, taken = some_rows(spark), []
    take = logistic.Model.take

    def watched(model, found):
        taken.append([len(sums) == 0 or sums[1:].any() for sums in found])
        take(model, found)

    monkeypatch.setattr(logistic.Model, "take", watched)
    found = logistic.fit_together(rows, [0.01]).collect()
    assert any(len(t) > 1 for t in taken) and all(t[0] and not any(t[1:]) for t in taken)
    monkeypatch.setattr(logistic, "STEPS", (3.0, 1.0))
    other = logistic.fit_together(rows, [0.01]).collect()
    assert np.allclose([r.coefficients for r in found], [r.coefficients for r in other], atol=1e-6)
