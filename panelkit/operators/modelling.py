"""ML-*: lag-feature regressors with pyspark.ml (distributed fits).

OLS is ``LinearRegression(solver='normal', regParam=0)``: the normal
equations are accumulated with one tree aggregation over the executors.
The forest is ``RandomForestRegressor`` (level-wise histograms); with
``featureSubsetStrategy='all'`` every split sees every feature.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelkit.operators.relational import unpivot_columns
from panelkit.operators.stats import regression_metrics


def _assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error")


def fit_ols(train: DataFrame, features: Sequence[str], label: str, prediction: str = "prediction") -> PipelineModel:
    """ML-1: ordinary least squares with intercept, no scaling, no penalty."""
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol=prediction,
                          solver="normal", regParam=0.0, elasticNetParam=0.0,
                          standardization=False, fitIntercept=True)
    return Pipeline(stages=[_assembler(features), lr]).fit(train)


def fit_forest(train: DataFrame, features: Sequence[str], label: str, prediction: str = "prediction",
               num_trees: int = 200, max_depth: int = 5, seed: int = 42, max_bins: int = 64) -> PipelineModel:
    """ML-2: random forest regressor (all features per split)."""
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, predictionCol=prediction,
                               numTrees=num_trees, maxDepth=max_depth, seed=seed, maxBins=max_bins,
                               featureSubsetStrategy="all")
    return Pipeline(stages=[_assembler(features), rf]).fit(train)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """ML-3: per-row predictions, helper vector dropped."""
    return model.transform(df).drop("features")


def coefficients(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """ML-4: intercept and named weights as a small table."""
    lr = model.stages[-1]
    rows = [("intercept", float(lr.intercept))] + [(f, float(w)) for f, w in zip(features, lr.coefficients)]
    return spark.createDataFrame(rows, "term string, estimate double")


def importances(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """ML-5: feature importances, rank 1 = most important."""
    imp = model.stages[-1].featureImportances
    rows = sorted(((f, float(imp[i])) for i, f in enumerate(features)), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame([(f, v, i + 1) for i, (f, v) in enumerate(rows)], "feature string, importance double, rank int")


def holdout_table(models: dict, df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """ML-6: one prediction column per model, chained transforms (no join).
    The feature vector is assembled once and reused by every model."""
    out = _assembler(features, "features").transform(df)
    for name, m in models.items():
        out = m.stages[-1].copy({m.stages[-1].predictionCol: f"{name}_predicted"}).transform(out)
    return out.select(*keep, *[f"{n}_predicted" for n in models])


def metrics_table(preds: DataFrame, y: str, model_cols: Sequence[str], keys: Sequence[str] = ("split",),
                  id_cols: Sequence[str] = ()) -> DataFrame:
    """ML-7: (model x split) rows of MAE / RMSE / R2 and row counts."""
    long = unpivot_columns(preds, [*id_cols, *keys, y], model_cols, "model", "y_pred")
    return regression_metrics(long, y, "y_pred", keys=["model", *keys])


def evaluate_frozen(holdout: DataFrame, y: str, model_cols: Sequence[str], baseline: str,
                    digits: int = 3) -> DataFrame:
    """ML-8: metrics of every prediction column present in a frozen holdout
    and each one's improvement over the baseline column (MAE/RMSE: baseline
    minus model, R2: model minus baseline, from the rounded metrics)."""
    from panelkit.operators.relational import versus_baseline
    long = unpivot_columns(holdout, [y], model_cols, "model", "y_pred")
    m = regression_metrics(long, y, "y_pred", keys=["model"], digits=digits)
    return versus_baseline(m, "model", baseline, digits=digits)


def residuals(holdout: DataFrame, time: str, y: str, model_cols: Sequence[str], roles: dict | None = None,
              keep: Sequence[str] = ()) -> DataFrame:
    """ML-9: residual = predicted - actual, absolute error, quarter label."""
    from panelkit.functions.dates import quarter_label
    long = unpivot_columns(holdout, [time, *keep, y], model_cols, "model", "y_pred")
    roles = roles or {}
    role = F.element_at(F.create_map(*[F.lit(x) for kv in roles.items() for x in kv]), F.col("model")) if roles else F.lit(None)
    return long.select(time, *keep, "model", role.cast("string").alias("model_role"), F.col(y).alias("y_true"), "y_pred",
                       (F.col("y_pred") - F.col(y)).alias("residual"),
                       F.abs(F.col("y_pred") - F.col(y)).alias("absolute_error"),
                       quarter_label(F.col(time)).alias("quarter"))


def save_model(model: PipelineModel, path: str) -> None:
    """SNK-3."""
    model.write().overwrite().save(path)


def load_model(path: str, features: Sequence[str] | None = None) -> PipelineModel:
    """SNK-3: a saved model. With ``features``, one that was fitted on other
    features (or in another order) is refused."""
    model = PipelineModel.load(path)
    own = list(model.stages[0].getInputCols())
    if features is not None and own != list(features):
        raise ValueError(f"the model was fitted on {own}, not on {list(features)}")
    return model


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The trees of a saved forest (ML-2) as a table: tree, node (0 is the root),
    feature, threshold, left, right (-1 in leaves), value, gain, weight."""
    n = F.col("nodeData")
    d = spark.read.parquet(f"{path.rstrip('/')}/stages/1_*/data")
    return d.select(F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
                    F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
                    n["prediction"].alias("value"), n["gain"].alias("gain"), F.get(n["impurityStats"], F.lit(0)).alias("weight"))


def score_nodes(nodes: DataFrame, df: DataFrame, features: Sequence[str], depth: int, out: str = "prediction") -> DataFrame:
    """ML-3 from a node table: the mean over trees of the leaf that a row falls
    into, as an expression. The table enters as one value, bounded by the
    forest's parameters (trees x 2^(depth + 1) nodes)."""
    tree = F.sort_array(F.collect_list(F.struct("node", "feature", "threshold", "left", "right", "value"))).alias("nodes")
    whole = nodes.groupBy("tree").agg(tree).agg(F.sort_array(F.collect_list(F.struct("tree", "nodes"))).alias("forest"))
    x = F.array(*[F.col(c).cast("double") for c in features])

    def leaf(t: Column) -> Column:
        def down(at, _):
            here = F.get(t, at)
            below = F.when(F.get(F.col("_x"), here["feature"]) <= here["threshold"], here["left"]).otherwise(here["right"])
            return F.when(here["left"] < 0, at).otherwise(below)
        return F.get(t, F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), down))["value"]

    scored = df.withColumns({"_x": x, "_forest": whole.select("forest").scalar()})
    total = F.aggregate("_forest", F.lit(0.0), lambda a, t: a + leaf(t["nodes"]))
    return scored.withColumn(out, total / F.size("_forest")).drop("_x", "_forest")


def node_importances(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """ML-5 from a node table: per tree the share of each feature in the weighted
    gains, averaged over the trees that split, scaled to a sum of 1."""
    g = nodes.where("left >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("g"))
    per = g.join(g.groupBy("tree").agg(F.sum("g").alias("total")), "tree").groupBy("feature").agg(F.sum(F.col("g") / F.col("total")).alias("s"))
    share = per.withColumn("importance", F.col("s") / per.select(F.sum("s")).scalar())
    name = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("feature") + 1)
    return share.select(name.alias("feature"), "importance")
