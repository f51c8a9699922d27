"""Multinomial logistic models of many categories, folds and penalties, advanced together.

All models see the training rows in one scan a round: every task sums loss, gradient and curvature
of each model over its rows, Spark adds these up row by row of the curvature matrix, and a Newton
step per model is taken on the driver. What is summed and collected is fixed by classes and inputs
(231 by 231 numbers for 21 classes and 10 inputs), whatever the number of rows. Models that are at
their optimum leave; the rest go on. Cross-validation of every category then costs some ten rounds,
not one run per category, fold and penalty.

The objective is the mean negative log-likelihood plus half the penalty times the squared
coefficients of the inputs in units of their standard deviations; intercepts are free. Classes
that a model's training rows lack have no coefficients. The optimum is checked as data: see
:func:`moments`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.operators.scale import cut_lineage, width_for

#: Largest entry of the gradient, in standard deviations of the input, at which a model is done.
TOLERANCE = 1e-9
ROUNDS = 60
#: Parts of a Newton step that a round tries together; without success a later round tries smaller ones.
STEPS = (1.0, 0.25)
LEAST_STEP = 1e-6
#: Losses that differ by at most this share are equal.
ROUNDING = 1e-13
#: An input whose variance is at most this share of its squared mean is a constant, up to rounding.
CONSTANT = 1e-24
#: Rows that a task holds as doubles at a time.
BLOCK = 4096
#: Rows of the check that a task takes, since few bytes of them are much work.
ROWS = 50_000


@dataclass
class Model:
    """One model: its training rows (a category less a fold, -1 for none), penalty and state.

    ``weights`` has a row per class and a column per input, the intercept last, for inputs that are
    centred and scaled by ``mean`` and ``scale``.
    """

    category: str
    left_out: int
    penalty: float
    n: int
    classes: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    loss: float = np.inf
    gradient: np.ndarray | None = None
    direction: np.ndarray | None = None
    part: float = 1.0
    done: bool = False

    def candidates(self) -> list[np.ndarray]:
        if self.direction is None:
            return [self.weights]
        return [self.weights + self.part * step * self.direction for step in STEPS]

    def take(self, found: list[np.ndarray]) -> None:
        """Move to the best candidate that lowers the loss; ``found`` holds, per candidate, the row
        of gradient and loss, summed over the training rows, and for the first one the rows of the
        curvature. Where another one is taken, the next round measures the curvature there."""
        size = self.weights.size
        inputs = np.ones(self.weights.shape)
        inputs[:, -1] = 0.0
        measured = []
        for which, (sums, weights) in enumerate(zip(found, self.candidates())):
            loss = sums[0, size] / self.n + self.penalty / 2 * (inputs * weights**2).sum()
            gradient = sums[0, :size].reshape(weights.shape) / self.n + self.penalty * inputs * weights
            measured.append((loss, weights, gradient, None if which else sums[1:, :size] / self.n))
        best = min(measured, key=lambda m: m[0])
        # At the optimum losses differ by rounding only: the whole step goes first.
        chosen = measured[0] if measured[0][0] <= best[0] + ROUNDING * abs(best[0]) else best
        loss, weights, gradient, curvature = chosen
        slope = np.abs(gradient).max()
        if self.direction is not None and loss >= self.loss and slope >= np.abs(self.gradient).max():
            self.part *= min(STEPS) ** 2
            self.done = self.part < LEAST_STEP
            return
        self.loss, self.weights, self.gradient, self.part = loss, weights, gradient, 1.0
        self.done = bool(slope <= TOLERANCE)
        if curvature is None:
            self.direction = None
            return
        # Equal shifts of all classes change nothing: the pseudo-inverse leaves them out.
        bent = curvature + np.diag(self.penalty * inputs.ravel())
        self.direction = -(np.linalg.pinv(bent, rcond=1e-13, hermitian=True) @ gradient.ravel()).reshape(weights.shape)

    def coefficients(self) -> list[tuple]:
        """(class, intercept, coefficients) for the inputs as they are."""
        own = np.where(self.scale > 0, self.weights[:, :-1] / np.where(self.scale > 0, self.scale, 1), 0.0)
        intercepts = self.weights[:, -1] - own @ self.mean
        return [(int(c), float(b), [float(x) for x in w]) for c, b, w in zip(self.classes, intercepts, own)]


def _models(rows: DataFrame, folds: int, penalties: list[float], width: int) -> list[Model]:
    """Models with the counts, means and deviations of their training rows: two grouped sums."""
    inputs = [F.col("x")[i] for i in range(width)]
    parts = rows.groupBy("category", "fold").agg(
        F.count("*").alias("n"),
        F.array(*[F.avg(x) for x in inputs]).alias("mean"),
        F.array(*[F.var_pop(x) for x in inputs]).alias("variance"),
    )
    sums = [(r["category"], r["fold"], r["n"], np.array(r["mean"]), np.array(r["variance"])) for r in parts.collect()]
    held = rows.groupBy("category", "fold", "label").count().collect()
    models = []
    for category in sorted({s[0] for s in sums}):
        for left_out in range(-1, folds):
            own = [s for s in sums if s[0] == category and s[1] != left_out]
            n = sum(s[2] for s in own)
            if not n:
                continue
            mean = sum(s[2] * s[3] for s in own) / n
            variance = sum(s[2] * (s[4] + (s[3] - mean) ** 2) for s in own) / max(1, n - 1)
            variance[variance <= CONSTANT * mean**2] = 0.0
            classes = np.array(sorted({r["label"] for r in held if r["category"] == category and r["fold"] != left_out}))
            for penalty in penalties:
                start = np.zeros((len(classes), width + 1))
                models.append(Model(category, left_out, penalty, n, classes, mean, np.sqrt(variance), start))
    return models


def _block_sums(z: np.ndarray, hit: np.ndarray, weights: np.ndarray, curvature: bool = True) -> np.ndarray:
    """Gradient and loss in the first row and, if asked for, the curvature in the rows below, of a
    block of rows. The curvature is nearly all of the work."""
    own = np.arange(len(z))
    score = z @ weights.T
    score -= score.max(axis=1, keepdims=True)
    p = np.exp(score)
    total = p.sum(axis=1, keepdims=True)
    loss = (np.log(total[:, 0]) - score[own, hit]).sum()
    p /= total
    wide, size = z.shape[1], weights.size
    sums = np.zeros((size + 1 if curvature else 1, size + 1))
    if curvature:
        every = (p[:, :, None] * z[:, None, :]).reshape(len(z), size)
        sums[1:, :size] = -(every.T @ every)
        for c in range(len(weights)):
            part = slice(c * wide, (c + 1) * wide)
            sums[1:, :size][part, part] += z.T @ every[:, part]
    p[own, hit] -= 1
    sums[0, :size], sums[0, size] = (p.T @ z).ravel(), loss
    return sums


def _sums(rows: DataFrame, models: list[Model]) -> list[list[np.ndarray]]:
    """Per model and candidate the sums of :func:`_block_sums` over the model's training rows."""
    tried = [m.candidates() for m in models]
    shared = rows.sparkSession.sparkContext.broadcast(
        [(m.category, m.left_out, m.classes, m.mean, m.scale, weights) for m, weights in zip(models, tried)]
    )
    wide = max(m.weights.size for m in models) + 1
    names = [f"v{i}" for i in range(wide)]

    def run(stream):
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in stream:
            category = np.array(batch["category"].to_pylist(), object)
            fold, label = batch["fold"].to_numpy(), batch["label"].to_numpy()
            x = batch["x"].flatten().to_numpy().reshape(batch.num_rows, -1)
            for at, (of, left_out, classes, mean, scale, weights) in enumerate(shared.value):
                members = np.flatnonzero((category == of) & (fold != left_out))
                for first in range(0, len(members), BLOCK):
                    some = members[first : first + BLOCK]
                    z = np.ones((len(some), x.shape[1] + 1))
                    z[:, :-1] = np.where(scale > 0, (x[some] - mean) / np.where(scale > 0, scale, 1), 0.0)
                    hit = np.searchsorted(classes, label[some])
                    for which, one in enumerate(weights):
                        sums = _block_sums(z, hit, one, curvature=not which)
                        total[at, which] = total[at, which] + sums if (at, which) in total else sums
        for (at, which), sums in total.items():
            columns = [pa.array(np.full(len(sums), i, np.int32)) for i in (at, which)] + [pa.array(np.arange(len(sums), dtype=np.int32))]
            columns += [pa.array(np.ascontiguousarray(sums[:, i])) if i < sums.shape[1] else pa.array(np.zeros(len(sums))) for i in range(wide)]
            yield pa.RecordBatch.from_arrays(columns, names=["model", "candidate", "line", *names])

    schema = "model int, candidate int, line int, " + ", ".join(f"{name} double" for name in names)
    summed = rows.mapInArrow(run, schema).groupBy("model", "candidate", "line").agg(*[F.sum(name).alias(name) for name in names])
    found = [[np.zeros((m.weights.size + 1, m.weights.size + 1)) for _ in own] for m, own in zip(models, tried)]
    for row in summed.collect():
        sums = found[row["model"]][row["candidate"]]
        sums[row["line"]] = row[3 : 3 + sums.shape[1]]
    return found


def fit_together(rows: DataFrame, penalties: list[float], folds: int = 0, rounds: int = ROUNDS) -> DataFrame:
    """Coefficients (category, left_out, reg_param, class, intercept, coefficients) of one model per
    category, left-out fold (-1: none) and penalty.

    ``rows`` has category, label (whole number), ``x`` (array of inputs without nulls) and, for
    ``folds`` > 0, ``fold``. The rows are stored once; the result has a row per model and class.
    """
    fold = F.col("fold").cast("int") if folds else F.lit(0)
    kept = rows.select("category", fold.alias("fold"), F.col("label").cast("int").alias("label"), "x")
    # Few bytes are much work here: dealt evenly, so that every task has some of it.
    kept = cut_lineage(kept.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    first = kept.select("x").first()
    schema = "category string, left_out int, reg_param double, class int, intercept double, coefficients array<double>"
    if first is None:
        return rows.sparkSession.createDataFrame([], schema)
    models = _models(kept, folds, penalties, len(first["x"]))
    for _ in range(rounds):
        going = [m for m in models if not m.done]
        if not going:
            break
        for model, found in zip(going, _sums(kept, going)):
            model.take(found)
    return rows.sparkSession.createDataFrame(
        [(m.category, m.left_out, m.penalty, *row) for m in models for row in m.coefficients()], schema
    )


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often the body names it. Columns that
    build on each other are merged by the optimizer, which computes the inner ones again at each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def probabilities(rows: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Adds to every row, for each model of its category, left_out, reg_param and ``classes``: an array
    of (class, p, coefficients) in the order of the classes."""
    of_model = coefficients.groupBy("category", "left_out", "reg_param").agg(
        F.array_sort(F.collect_list(F.struct("class", "intercept", "coefficients"))).alias("known")
    )
    dot = lambda c: F.aggregate(
        F.zip_with(c["coefficients"], "x", lambda w, x: w * x), c["intercept"], lambda one, two: one + two
    )
    raised = lambda score: _bound(F.array_max(score), lambda top: F.transform(score, lambda s: F.exp(s - top)))
    total = lambda each: F.aggregate(each, F.lit(0.0), lambda one, two: one + two)
    shares = lambda each, sum_: F.zip_with(
        "known", each, lambda c, e: F.struct(c["class"].alias("class"), (e / sum_).alias("p"), c["coefficients"].alias("coefficients"))
    )
    classes = _bound(
        _bound(F.transform("known", dot), raised), lambda each: _bound(total(each), lambda sum_: shares(each, sum_))
    )
    return rows.join(of_model, "category").withColumn("classes", classes).drop("known")


def predicted(rows: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Adds ``prediction``, the likeliest class (the smallest of equal ones), per model."""
    best = F.array_max(F.transform("classes", lambda c: F.struct(c["p"].alias("p"), (-c["class"]).alias("less"))))
    return probabilities(rows, coefficients).withColumn("prediction", (-best["less"]).cast("double")).drop("classes")


def moments(rows: DataFrame, coefficients: DataFrame) -> DataFrame:
    """The optimum as data, for models without a left-out fold: per model, class and input (the last
    one is the intercept's 1) the sum of the input over the class's rows, ``observed``, the sum of
    the input times the class's probability over all rows, ``expected``, and ``slope``, the
    derivative of the objective in units of the input's standard deviation.

    Where the slope is 0 for all classes and inputs the model is at the one optimum there is, since
    the objective is convex; without a penalty ``expected`` then equals ``observed``.
    """
    models = coefficients.where("left_out = -1")
    first = models.select("coefficients").first()
    inputs = range(len(first[0]) + 1 if first else 1)
    one_x = F.concat("x", F.array(F.lit(1.0))).alias("one_x")
    held = rows.select("category", F.col("label").cast("int").alias("label"), one_x, "x").repartition(width_for(rows, ROWS))
    spread = held.select("category", F.posexplode("one_x").alias("input", "value")).groupBy("category", "input").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("variance")
    )
    # A row per class, not per class and input: all inputs are summed side by side.
    cells = probabilities(held, models).select("category", "reg_param", "label", "one_x", F.explode("classes").alias("c")).select(
        "category", "reg_param", F.col("c.class").alias("class"), F.col("c.p").alias("p"), "one_x", (F.col("c.class") == F.col("label")).alias("own")
    )
    value = lambda i: F.get("one_x", F.lit(i))
    both = [
        F.struct(
            F.sum(F.when(F.col("own"), value(i)).otherwise(0.0)).alias("observed"),
            F.sum(F.col("p") * value(i)).alias("expected"),
        )
        for i in inputs
    ]
    summed = cells.groupBy("category", "reg_param", "class").agg(F.array(*both).alias("both"))
    weights = models.select("category", "reg_param", "class", F.concat("coefficients", F.array(F.lit(0.0))).alias("weights"))
    sums = (
        summed.join(weights, ["category", "reg_param", "class"])
        .select("category", "reg_param", "class", "weights", F.posexplode("both").alias("input", "sums"))
        .select("category", "reg_param", "class", "input", "sums.*", F.get("weights", F.col("input")).alias("weight"))
    )
    varies = F.col("variance") > CONSTANT * F.col("mean") * F.col("mean")
    scale = F.when(varies, F.sqrt("variance")).otherwise(F.lit(1.0))
    gap = (F.col("expected") - F.col("observed")) / F.col("n")
    return (
        sums.join(spread, ["category", "input"])
        .withColumn("slope", gap / scale + F.col("reg_param") * F.col("weight") * scale)
        .select("category", "reg_param", "class", "input", "observed", "expected", "slope")
    )
