"""Learning expertise from the features with Spark ML, and scoring users with it."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.operators import logistic, metrics
from reviewlens.operators.scale import cut_lineage

# Model inputs in the order of the vector, and the categories that are modelled.
INPUTS = [
    "average_stars",
    "cat_avg_review_len",
    "cat_avg_stars",
    "cat_business_count",
    "cat_review_count",
    "months_yelping",
    "review_count",
    "votes_cool",
    "votes_funny",
    "votes_useful",
]
CATEGORIES = ["Restaurants", "Shopping", "Beauty and Spa", "Health and Medical"]
SPLIT_SEED = 11
PENALTIES = [0.1, 0.01]
FOLDS = 2


def assembled(features: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """Add the vector ``features`` of the ten inputs; rows with a null input are left out, or
    get NaN entries with ``keep_nulls``."""
    return VectorAssembler(
        inputCols=INPUTS, outputCol="features", handleInvalid="keep" if keep_nulls else "skip"
    ).transform(features)


def with_split(rows: DataFrame, seed: int = SPLIT_SEED, tenths: int = 7) -> DataFrame:
    """Add ``is_train``, true for seven tenths of the users. It hangs on the user id alone, so
    partitioning, retries and added columns do not move a user; the hash is one every engine has.
    Rows without a user id hang together."""
    text = F.concat(F.coalesce(F.col("user_id").cast("string"), F.lit("")), F.lit(f":{seed}"))
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 10
    return rows.withColumn("is_train", bucket < tenths)


def training_rows(features: DataFrame, category: str | None = None) -> DataFrame:
    """Assembled and split rows written out once, since every fit passes over them repeatedly.

    Users with a null input have null ``features``: no fit uses them, and scoring keeps them.
    """
    chosen = features if category is None else features.where(F.col("category") == category)
    narrow = chosen.select("user_id", "category", "elite", "elite_cat", *INPUTS)
    whole = reduce(lambda one, two: one & two, [F.col(name).isNotNull() for name in INPUTS])
    rows = with_split(assembled(narrow, keep_nulls=True)).withColumn("features", F.when(whole, F.col("features")))
    return cut_lineage(rows.select("user_id", "category", "elite", "elite_cat", "features", "is_train"))


def train_part(rows: DataFrame) -> DataFrame:
    return rows.where("is_train AND features IS NOT NULL")


def test_part(rows: DataFrame) -> DataFrame:
    return rows.where("NOT is_train AND features IS NOT NULL")


test_part.__test__ = False  # the name is not meant for test collection


def fit_tree(train: DataFrame) -> Model:
    tree = DecisionTreeRegressor(labelCol="elite", featuresCol="features", seed=SPLIT_SEED)
    return Pipeline(stages=[tree]).fit(train)


def fit_forest(train: DataFrame) -> Model:
    return RandomForestRegressor(
        labelCol="elite",
        featuresCol="features",
        numTrees=7,
        maxDepth=6,
        maxBins=32,
        featureSubsetStrategy="auto",
        impurity="variance",
        seed=SPLIT_SEED,
    ).fit(train)


def _class_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("label", F.col("elite_cat").cast("double"))


def fit_logistic(train: DataFrame) -> Model:
    """Multinomial logistic regression on the expertise class."""
    return LogisticRegression(family="multinomial").fit(_class_rows(train))


def fit_logistic_folds(train: DataFrame) -> CrossValidatorModel:
    """Choice between two penalties by F1 over two folds, the folds set by user id."""
    model = LogisticRegression(maxIter=10)
    grid = ParamGridBuilder().addGrid(model.regParam, PENALTIES).build()
    fold = F.pmod(F.xxhash64("user_id", F.lit(SPLIT_SEED + 1)), F.lit(FOLDS)).cast("int")
    return CrossValidator(
        estimator=Pipeline(stages=[model]),
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(metricName="f1"),
        numFolds=FOLDS,
        foldCol="fold",
        parallelism=2,
    ).fit(_class_rows(train).withColumn("fold", fold))


def class_inputs(rows: DataFrame) -> DataFrame:
    """Training rows as :mod:`logistic` takes them: category, label, x, and the fold of the user."""
    fold = F.pmod(F.xxhash64("user_id", F.lit(SPLIT_SEED + 1)), F.lit(FOLDS)).cast("int")
    return train_part(rows).select(
        "category", F.col("elite_cat").cast("int").alias("label"), vector_to_array("features").alias("x"), fold.alias("fold")
    )


def folds_together(rows: DataFrame) -> DataFrame:
    """(category, reg_param, avg_f1): the cross-validation of all categories at once, each model
    brought to its optimum; the weighted F1 of the left-out folds, averaged."""
    inputs = cut_lineage(class_inputs(rows))
    found = logistic.fit_together(inputs, PENALTIES, FOLDS)
    scored = logistic.predicted(inputs, found).where("left_out = fold")
    of_fold = metrics.weighted_f1(scored, "category", "reg_param", "left_out")
    return of_fold.groupBy("category", "reg_param").agg(F.avg("weighted_f1").alias("avg_f1"))


def leaf_checks(train: DataFrame, model: Model) -> DataFrame:
    """(leaf, rows, label_sum, prediction, mean): a regression tree's leaves with what it predicts
    there and the mean label of the training rows that reach them."""
    tree = model.stages[-1].copy().setLeafCol("leaf")
    return (
        tree.transform(train)
        .groupBy("leaf")
        .agg(
            F.count("*").alias("rows"),
            F.sum("elite").alias("label_sum"),
            F.min("prediction").alias("prediction"),
            F.max("prediction").alias("most"),
        )
        .withColumn("mean", F.col("label_sum") / F.col("rows"))
    )


def forest_checks(rows: DataFrame, model: Model) -> DataFrame:
    """Each row's forest prediction and the mean of its trees' predictions."""
    scored = model.transform(rows)
    trees = []
    for number, tree in enumerate(model.trees):
        scored = tree.copy().setPredictionCol(f"tree{number}").transform(scored)
        trees.append(F.col(f"tree{number}"))
    return scored.select("user_id", "category", "prediction", (reduce(lambda a, b: a + b, trees) / len(trees)).alias("mean"))


def fold_metrics(model: CrossValidatorModel) -> list[tuple[float, float]]:
    """(penalty, mean F1) per grid entry."""
    return [
        (float(next(iter(setting.values()))), float(metric))
        for setting, metric in zip(model.getEstimatorParamMaps(), model.avgMetrics)
    ]


def predict_elite(model: Model, rows: DataFrame) -> DataFrame:
    return model.transform(rows).select(
        "user_id", "category", F.col("elite").alias("label"), "prediction"
    )


def predict_class(model: Model, rows: DataFrame) -> DataFrame:
    return model.transform(_class_rows(rows)).select(
        "user_id", "category", "label", "probability", "prediction"
    )


def category_predictions(rows: DataFrame, category: str, fit=fit_forest) -> DataFrame:
    """Fit on the category's training users and score all its users; a user with a null input
    gets a null prediction."""
    chosen = rows.where(F.col("category") == category)
    model = fit(train_part(chosen))
    scored = model.transform(chosen.where("features IS NOT NULL"))
    return scored.select("user_id", "prediction", "category").union(
        chosen.where("features IS NULL").select(
            "user_id", F.lit(None).cast("double").alias("prediction"), "category"
        )
    )


def all_category_predictions(rows: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Predictions of every modelled category; each fit is a Spark job of its own. Categories
    without any training user give no rows."""
    scored = []
    for category in categories or CATEGORIES:
        trainable = train_part(rows.where(F.col("category") == category))
        if not trainable.isEmpty():
            scored.append(category_predictions(rows, category))
    if not scored:
        return rows.select("user_id", F.col("elite").alias("prediction"), "category").limit(0)
    return reduce(DataFrame.union, scored)


def model_quality(rows: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Quality of the three models on each category's held-out users: (category, model, metric,
    value, rows). Errors of the regressions, accuracy and weighted F1 of the classes. Predictions
    are stored once and measured with plain aggregates."""
    predicted = []
    for category in categories or CATEGORIES:
        chosen = rows.where(F.col("category") == category)
        train, test = train_part(chosen), test_part(chosen)
        if train.isEmpty():
            continue
        for name, fit, predict in (
            ("tree", fit_tree, predict_elite),
            ("forest", fit_forest, predict_elite),
            ("logistic", fit_logistic, predict_class),
        ):
            found = predict(fit(train), test)
            predicted.append(
                found.select("category", F.lit(name).alias("model"), "label", "prediction")
            )
    if not predicted:
        schema = "category string, model string, metric string, value double, rows long"
        return rows.sparkSession.createDataFrame([], schema)
    stored = cut_lineage(reduce(DataFrame.union, predicted))
    regressions, classes = stored.where("model <> 'logistic'"), stored.where("model = 'logistic'")
    measured = [
        (regressions, "mse", metrics.mse),
        (regressions, "rmse", metrics.rmse),
        (classes, "accuracy", metrics.accuracy),
        (classes, "weighted_f1", metrics.weighted_f1),
    ]
    keys = ["category", "model"]
    values = [
        measure(part, *keys).select(*keys, F.lit(name).alias("metric"), F.col(name).alias("value"))
        for part, name, measure in measured
    ]
    sizes = stored.groupBy(*keys).agg(F.count("*").alias("rows"))
    return reduce(DataFrame.union, values).join(sizes, keys).select(*keys, "metric", "value", "rows")
