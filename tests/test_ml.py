"""Model invariants (a vendor model cannot be matched value for value)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from letrado.plans import ml
from letrado.queries import QUERIES, _features


def test_class_weights_balance_the_classes(spark):
    w = {r["meta_atingida"]: r for r in ml.class_weights(_features(spark, SF_SMALL)).collect()}
    assert set(w) == {True, False}
    total = sum(r["weight"] * r["n_class"] for r in w.values())
    assert abs(w[True]["weight"] * w[True]["n_class"] - total / 2) < 1e-6


def test_split_is_by_municipality_and_deterministic(spark):
    f = _features(spark, SF_SMALL)
    tr, te = ml.split(f)
    assert tr.count() + te.count() == f.count()
    both = tr.select("id_municipio").intersect(te.select("id_municipio"))
    assert both.count() == 0
    assert tr.count() == ml.split(f)[0].count()


def test_predictions_are_probabilities_ranked_by_risk(spark):
    p = QUERIES["ml_predict"](spark, SF_SMALL)
    rows = p.collect()
    assert len(rows) == _features(spark, SF_SMALL).count()
    assert all(abs(r["prob_atingir"] + r["prob_nao_atingir"] - 1.0) < 1e-9 for r in rows)
    risks = [r["prob_nao_atingir"] for r in rows]
    assert risks == sorted(risks, reverse=True)
    assert p.where(F.col("predicted_meta_atingida") != (F.col("prob_atingir") > 0.5)).count() == 0


def test_evaluation_metrics_are_well_formed(spark):
    # of the positive class, recomputed by hand from the scored held-out rows
    model, test = ml.train(_features(spark, SF_SMALL))
    m = ml.evaluate(model, test).first()
    rows = [(r.label == 1.0, r.prediction == 1.0) for r in model.transform(test).select("label", "prediction").collect()]
    tp, fp = sum(y and h for y, h in rows), sum(h and not y for y, h in rows)
    fn, tn = sum(y and not h for y, h in rows), sum(not y and not h for y, h in rows)
    assert abs(m["precision"] - tp / max(tp + fp, 1)) < 1e-12 and abs(m["recall"] - tp / max(tp + fn, 1)) < 1e-12
    assert abs(m["accuracy"] - (tp + tn) / len(rows)) < 1e-12
    assert 0.0 <= m["roc_auc"] <= 1.0 and m["log_loss"] > 0


def test_class_weights_do_not_see_the_held_out_side(spark):
    f = _features(spark, SF_SMALL)
    tr, te = ml.split(ml.labelled(f))
    flipped = tr.unionByName(te.withColumn("meta_atingida", ~F.col("meta_atingida")).withColumn("label", 1 - F.col("label")))
    a = ml.train(f)[0].stages[-1].coefficients
    b = ml.train(flipped.drop("label"))[0].stages[-1].coefficients
    assert abs(a.toArray() - b.toArray()).max() < 1e-9


def test_separable_data_is_learned(spark):
    rows = []
    for i in range(400):
        lag1 = float(i % 100)
        rows.append((str(i), 2000 + i % 3, "S" + str(i % 3), lag1, lag1 - 1, 1.0, lag1 - 50, lag1 - 55, 50.0, 55.0,
                     lag1 >= 50))
    f = spark.createDataFrame(rows, "id_municipio string, ano int, sigla_uf string, indicador_lag1 double, "
                                    "indicador_lag2 double, tendencia_historica double, "
                                    "gap_historico_vs_meta_municipio double, gap_historico_vs_meta_nacional double, "
                                    "meta_municipio double, meta_nacional double, meta_atingida boolean")
    model, test = ml.train(f.withColumn("nome", F.lit("x")))
    assert ml.evaluate(model, test).first()["roc_auc"] > 0.9


def test_clusters_are_numbered_by_level(spark):
    c = QUERIES["ml_clusters"](spark, SF_SMALL)
    f = _features(spark, SF_SMALL)
    j = c.join(f, ["id_municipio", "ano"]).groupBy("cluster").agg(F.avg("indicador_lag1").alias("m"))
    means = [r["m"] for r in j.orderBy("cluster").collect()]
    assert means == sorted(means)
