"""Model training, batch prediction and persistence (survey M5-M11, S9).

The reference's solvers are replaced by counterparts with the same objective where
one exists:
* multinomial logistic regression with L2: sklearn minimises
  ``C * sum(loss) + ||w||^2 / 2``; MLlib minimises ``mean(loss) + reg/2
  ||w||^2``, so ``regParam = 1 / (C * n_train)``;
* the 64-32 ReLU network -> ``MultilayerPerceptronClassifier`` (sigmoid
  hidden units, softmax output; no dropout) with early stopping on a
  separate validation split done as staged fits from the previous weights;
* boosted trees -> ``boosted_trees.BoostedTrees`` (learning rate, tree count as
  given, leaf-wise growth).
Parity is at the metric level; the solvers differ.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import (IndexToString, PCA, StringIndexer, UnivariateFeatureSelector,
                                VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.operators.boosted_trees import BoostedTrees


def as_vector(c) -> Column:
    """array<double> column -> MLlib vector (JVM-side)."""
    return array_to_vector(F.col(c) if isinstance(c, str) else c)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """M5: one feature vector in a fixed column order; array columns are
    converted to vectors first.  A null number counts as 0 (the mean of a
    standardised column), as it does in the sparse kNN features."""
    tmp, inputs = df, []
    for c in cols:
        dt = df.schema[c].dataType.simpleString()
        if dt.startswith("array"):
            tmp = tmp.withColumn(f"__v_{c}", as_vector(F.col(c).cast("array<double>")))
            inputs.append(f"__v_{c}")
        elif dt != "vector" and not dt.startswith("struct"):
            tmp = tmp.withColumn(f"__v_{c}", F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
            inputs.append(f"__v_{c}")
        else:
            inputs.append(c)
    va = VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="error")
    return va.transform(tmp).drop(*[i for i in inputs if i.startswith("__v_")])


def text_and_numbers(text: list[str], width: int, label: str, numbers: str = "numbers",
                     out: str = "features") -> Pipeline:
    """Feature stages of a dense network: of each sparse text vector the
    ``width`` terms with the highest F statistic against the label, and a
    vector of numbers.  MLlib's network is dense, so whole vocabularies
    (10,000 terms a field) would make its first layer the cost of the job."""
    stages = []
    for c in text:
        selector = UnivariateFeatureSelector(featuresCol=c, outputCol=f"{c}_selected",
                                             labelCol=label, selectionMode="numTopFeatures")
        stages.append(selector.setFeatureType("continuous").setLabelType("categorical")
                      .setSelectionThreshold(width))
    return Pipeline(stages=[*stages, VectorAssembler(
        inputCols=[numbers, *[f"{c}_selected" for c in text]], outputCol=out)])


# ---- PCA --------------------------------------------------------------------

@dataclass
class PCAResult:
    mean: list
    components: list          # k lists of d loadings, sign-normalised
    explained_variance: list = field(default_factory=list)

    def transform(self, df: DataFrame, vec_col: str, out: str = "pca") -> DataFrame:
        """Centre, then project on each component (array arithmetic, no UDF)."""
        x = F.col(vec_col).cast("array<double>")
        centred = F.zip_with(x, F.array(*[F.lit(float(m)) for m in self.mean]),
                             lambda a, b: a - b)
        comps = []
        for comp in self.components:
            w = F.array(*[F.lit(float(v)) for v in comp])
            comps.append(F.aggregate(F.zip_with(centred, w, lambda a, b: a * b),
                                     F.lit(0.0), lambda acc, v: acc + v))
        return df.withColumn(out, F.array(*comps))


def fit_pca(df: DataFrame, vec_col: str, k: int) -> PCAResult:
    """PCA on mean-centred data (MLlib's transform does not centre);
    each component is flipped so its largest-magnitude loading is positive."""
    v = df.select(as_vector(F.col(vec_col).cast("array<double>")).alias("v"))
    mean = v.select(Summarizer.mean(F.col("v")).alias("m")).first()["m"].toArray()
    centred = v.select(as_vector(F.zip_with(vector_to_array("v"),
                                            F.array(*[F.lit(float(m)) for m in mean]),
                                            lambda a, b: a - b)).alias("v"))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(centred)
    pc = model.pc.toArray()              # d x k, fitted parameters only
    comps = []
    for j in range(pc.shape[1]):
        col = pc[:, j]
        sign = 1.0 if col[abs(col).argmax()] >= 0 else -1.0
        comps.append([float(sign * c) for c in col])
    return PCAResult([float(m) for m in mean], comps,
                     [float(e) for e in model.explainedVariance.toArray()])


# ---- classifiers / regressors -------------------------------------------------

def logistic_regression(features: str, label: str, n_train: int, C: float = 1438.44988828766,
                        max_iter: int = 10000, tol: float = 1e-6) -> Pipeline:
    """M6: multinomial L2 logistic regression with the reference's C.  The solver is
    another, so its tolerance is not the reference's but tight enough that a
    tighter one changes nothing that is predicted.  Rows without a label are filtered before the split."""
    idx = StringIndexer(inputCol=label, outputCol="__label_idx", handleInvalid="error",
                        stringOrderType="alphabetAsc")
    lr = LogisticRegression(featuresCol=features, labelCol="__label_idx", family="multinomial",
                            regParam=1.0 / (C * max(n_train, 1)), elasticNetParam=0.0,
                            standardization=False, maxIter=max_iter, tol=tol,
                            predictionCol="__pred_idx")
    return Pipeline(stages=[idx, lr])


def finish_labels(model: PipelineModel, scored: DataFrame, out: str = "prediction") -> DataFrame:
    """Map indexed predictions back to the original label values."""
    labels = model.stages[0].labels
    back = IndexToString(inputCol="__pred_idx", outputCol=out, labels=labels)
    return back.transform(scored)


def _log_loss(scored: DataFrame, label_idx: str) -> float:
    p = F.element_at(vector_to_array("probability"), F.col(label_idx).cast("int") + 1)
    return scored.agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15))))).first()[0]


def train_mlp(train: DataFrame, valid: DataFrame, features: str, label: str, n_features: int,
              hidden=(64, 32), max_epochs: int = 100, patience: int = 10, stage_iters: int = 10,
              seed: int = 42, block_size: int = 32):
    """M7: binary MLP with early stopping on a *validation* split (not the
    test split): train in stages of ``stage_iters`` solver iterations from
    the previous weights, keep the weights with the best validation log-loss,
    stop once ``patience`` iterations pass without improvement."""
    layers = [n_features, *hidden, 2]
    lab = F.col(label).cast("double")
    tr = train.withColumn("__y", lab)
    va = valid.withColumn("__y", lab)
    best, best_loss, since, weights, model = None, float("inf"), 0, None, None
    for _ in range(0, max_epochs, stage_iters):
        mlp = MultilayerPerceptronClassifier(featuresCol=features, labelCol="__y", layers=layers,
                                             maxIter=stage_iters, seed=seed, blockSize=block_size)
        if weights is not None:
            mlp.setInitialWeights(weights)
        model = mlp.fit(tr)
        weights = model.weights
        loss = _log_loss(model.transform(va), "__y")
        if loss < best_loss - 1e-12:
            best, best_loss, since = model, loss, 0
        else:
            since += stage_iters
            if since >= patience:
                break
    return best or model


def gbt_regressor(features: str, label: str, n_estimators: int = 100, learning_rate: float = 0.1,
                  num_leaves: int = 31, max_bins: int = 255) -> BoostedTrees:
    """M8/M9: boosted regression trees, grown leaf by leaf."""
    return BoostedTrees(features, label, n_estimators, learning_rate, num_leaves,
                        max_bins=max_bins)


def predictions(scored: DataFrame, actual: str, predicted: str = "prediction") -> DataFrame:
    """The (Actual, Predicted) table."""
    return scored.select(F.col(actual).alias("Actual"), F.col(predicted).alias("Predicted"))


def save_model(model, path: str) -> str:
    """Persist any MLlib model; a single one as a pipeline of one stage,
    so that ``load_pipeline`` reads them all."""
    if not isinstance(model, PipelineModel):
        model = PipelineModel(stages=[model])
    model.write().overwrite().save(path)
    return path


def save_pca(spark: SparkSession, result: PCAResult, path: str) -> str:
    """The projection as one row."""
    row = [(result.mean, result.components, result.explained_variance)]
    spark.createDataFrame(row, "mean array<double>, components array<array<double>>, "
                               "explained_variance array<double>").write.parquet(path)
    return path


def load_pca(spark: SparkSession, path: str) -> PCAResult:
    r = spark.read.parquet(path).first()
    return PCAResult(r["mean"], r["components"], r["explained_variance"])


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
