"""Target-attainment classifier on the feature table (pyspark.ml).

Logistic regression with balanced class weights, a deterministic hash split
on the municipality (all years of a municipality fall on the same side) and
predictions exposing the probability of each class picked by label.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letrado.functions.scalar import round2
from letrado.session import materialize

# Fixed model settings.
CATEGORICAL = "sigla_uf"
NUMERIC = ["indicador_lag1", "indicador_lag2", "tendencia_historica", "gap_historico_vs_meta_municipio",
           "gap_historico_vs_meta_nacional", "meta_municipio", "meta_nacional"]
LABEL = "meta_atingida"
MAX_ITER = 20
TRAIN_BUCKETS = 8          # of 10 hash buckets go to training


def labelled(features: DataFrame) -> DataFrame:
    return features.where(F.col(LABEL).isNotNull()).withColumn("label", F.col(LABEL).cast("double"))


def class_weights(features: DataFrame) -> DataFrame:
    """weight(class) = n / (2 * n_class): both classes weigh the same in total.

    One aggregate gives n and both class counts; ``inline`` turns it into one
    row per class present (no join)."""
    lab = features.where(F.col(LABEL).isNotNull())
    a = lab.agg(F.count(F.lit(1)).alias("n"),
                F.count_if(F.col(LABEL)).alias("n_true"),
                F.count_if(~F.col(LABEL)).alias("n_false"))
    rows = F.array(F.struct(F.lit(True).alias(LABEL), F.col("n_true").alias("n_class"), F.col("n").alias("n")),
                   F.struct(F.lit(False).alias(LABEL), F.col("n_false").alias("n_class"), F.col("n").alias("n")))
    per = a.select(F.inline(rows)).where(F.col("n_class") > 0)
    return per.select(LABEL, "n_class", "n", (F.col("n") / (F.lit(2) * F.col("n_class"))).alias("weight"))


def with_weights(df: DataFrame) -> DataFrame:
    # at most one row per label value (two), so broadcasting it is bounded
    w = class_weights(df).select(LABEL, "weight")
    return df.join(F.broadcast(w), LABEL, "left")


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    # the first 28 bits of the id's MD5: the same split in any SQL engine
    bucket = F.conv(F.substring(F.md5(F.col("id_municipio").cast("binary")), 1, 7), 16, 10).cast("bigint") % 10
    return df.where(bucket < TRAIN_BUCKETS), df.where(bucket >= TRAIN_BUCKETS)


def pipeline() -> Pipeline:
    imputed = [f"{c}_imp" for c in NUMERIC]
    return Pipeline(stages=[
        Imputer(inputCols=NUMERIC, outputCols=imputed, strategy="mean"),
        StringIndexer(inputCol=CATEGORICAL, outputCol=f"{CATEGORICAL}_idx", handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{CATEGORICAL}_idx"], outputCols=[f"{CATEGORICAL}_oh"], handleInvalid="keep"),
        VectorAssembler(inputCols=[f"{CATEGORICAL}_oh", *imputed], outputCol="features", handleInvalid="keep"),
        LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                           maxIter=MAX_ITER, family="binomial"),
    ])


def train(features: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training side; the weights come from that side alone."""
    tr, te = split(labelled(features))
    return pipeline().fit(with_weights(tr)), te


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Probability of each class by label value (1.0 = goal met), ranked by risk."""
    p = model.transform(features.withColumn("label", F.col(LABEL).cast("double")))
    probs = vector_to_array("probability")
    return (p.select("id_municipio", "nome", "sigla_uf", "ano",
                     (F.col("prediction") == 1.0).alias("predicted_meta_atingida"),
                     probs[0].alias("prob_nao_atingir"), probs[1].alias("prob_atingir"))
             .orderBy(F.col("prob_nao_atingir").desc_nulls_last(), "id_municipio", "ano"))


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    """Of the positive class (goal met) on the held-out side: precision, recall, accuracy, f1,
    log loss and ROC AUC.

    The scored rows are written once: one aggregate gives the four counts and the
    log loss, one more pass the AUC.  A ratio without rows is 0.
    """
    probs = vector_to_array("probability")
    p = materialize(model.transform(test).select("label", "prediction", "rawPrediction", probs[1].alias("p1")), "scored")
    y, hat = F.col("label") == 1.0, F.col("prediction") == 1.0
    likely = F.greatest(F.when(y, F.col("p1")).otherwise(1 - F.col("p1")), F.lit(1e-15))
    a = p.agg(F.count_if(y & hat).alias("tp"), F.count_if(~y & hat).alias("fp"), F.count_if(y & ~hat).alias("fn"),
              F.count_if(~y & ~hat).alias("tn"), F.coalesce(F.avg(-F.log(likely)), F.lit(0.0)).alias("log_loss"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def ratio(k, n):
        return F.when(n > 0, k / n).otherwise(F.lit(0.0))

    auc = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC").evaluate(p)
    return a.select(ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
                    ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                    ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"), "log_loss", F.lit(float(auc)).alias("roc_auc"))


def split_counts(features: DataFrame) -> DataFrame:
    """Labelled rows and goals met on either side of the split."""
    tr, te = split(labelled(features))
    both = tr.select(F.lit("train").alias("side"), "label").unionByName(te.select(F.lit("test").alias("side"), "label"))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("label").cast("bigint").alias("n_met"))


def prediction_checks(predictions: DataFrame) -> DataFrame:
    """What holds for any model: every row scored once, probabilities that add up
    to 1, the predicted class the likelier one."""
    p = F.col("prob_atingir")
    return predictions.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id_municipio", "ano").alias("n_keys"),
        F.count_if(F.abs(p + F.col("prob_nao_atingir") - 1) > 1e-9).alias("n_bad_sums"),
        F.count_if((p < 0) | (p > 1)).alias("n_bad_probs"),
        F.count_if(F.col("predicted_meta_atingida") != (p > 0.5)).alias("n_bad_class"))


def evaluation_checks(metrics: DataFrame, test: DataFrame) -> DataFrame:
    """The evaluated metrics beside what they must satisfy: all within [0, 1], f1 the
    harmonic mean of precision and recall, on all held-out rows."""
    cols = ("precision", "recall", "accuracy", "f1_score", "roc_auc")
    outside = F.array(*[F.when((F.col(c) < 0) | (F.col(c) > 1), 1).otherwise(0) for c in cols])
    p, r = F.col("precision"), F.col("recall")
    harmonic = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return metrics.select(F.aggregate(outside, F.lit(0), lambda a, x: a + x).alias("n_outside"),
                          (F.abs(harmonic - F.col("f1_score")) < 1e-9).alias("f1_is_harmonic"),
                          (F.col("log_loss") >= 0).alias("log_loss_positive"),
                          F.lit(test.count()).cast("bigint").alias("n_test"))


def cluster_totals(clusters: DataFrame) -> DataFrame:
    return clusters.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id_municipio", "ano").alias("n_keys"),
                        F.count_distinct("cluster").alias("n_clusters"), F.min("cluster").cast("int").alias("low"),
                        F.max("cluster").cast("int").alias("high"))


def uf_convergence(evolucao_uf: DataFrame) -> DataFrame:
    """Spread of the state means per year (falling = states converging)."""
    return evolucao_uf.groupBy("ano").agg(
        F.count(F.lit(1)).alias("n_ufs"),
        round2(F.stddev_samp("indicador_medio")).alias("desvio_entre_ufs"),
        round2(F.max("indicador_medio") - F.min("indicador_medio")).alias("amplitude_entre_ufs"))


CLUSTER_FEATURES = ["indicador_lag1", "tendencia_historica", "gap_historico_vs_meta_municipio",
                    "gap_historico_vs_meta_nacional"]


def vulnerability_clusters(features: DataFrame, k: int = 4, seed: int = 42) -> DataFrame:
    """Group municipality-years by their historical gaps and trend (k-means on
    standardised features); clusters are numbered by mean lag-1 indicator, 0 = lowest."""
    from pyspark.ml.feature import StandardScaler

    imputed = [f"{c}_imp" for c in CLUSTER_FEATURES]
    model = Pipeline(stages=[
        Imputer(inputCols=CLUSTER_FEATURES, outputCols=imputed, strategy="mean"),
        VectorAssembler(inputCols=imputed, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster"),
    ]).fit(features)
    # The k centres are part of the fitted model (already on the driver).
    # Standardising keeps each feature's order, so ordering centres by their
    # first coordinate orders clusters by mean lag-1 indicator.
    centers = model.stages[-1].clusterCenters()
    ranked = sorted(range(len(centers)), key=lambda i: (float(centers[i][0]), i))
    rank = F.create_map(*[x for r, i in enumerate(ranked) for x in (F.lit(i), F.lit(r))])
    return model.transform(features).select("id_municipio", "ano", rank[F.col("cluster")].alias("cluster"))
