"""Invariants of the models, which have no SQL twin."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.config import MiningLimits
from millrace.operators import mining
from millrace.queries.base import Tables
from millrace.queries.warehouse import fact

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def facts(spark):
    rows = fact(Tables(spark, FOLDER)).persist()
    yield rows
    rows.unpersist()


def test_clusters_partition_the_profiles(spark, facts):
    features = mining.cluster_features(facts).persist()
    limits = MiningLimits(kmeans_restarts=3)
    result = mining.kmeans(features, 5, limits)
    profile = mining.cluster_profile(result.assigned).orderBy("cluster").collect()
    assert [r["cluster"] for r in profile] == [1, 2, 3, 4, 5]
    assert sum(r["cantidad_perfiles"] for r in profile) == features.count()
    assert sum(r["porcentaje"] for r in profile) == pytest.approx(100, abs=0.05)
    assert result.centers == sorted(result.centers)
    one = mining.kmeans(features, 5, MiningLimits(kmeans_restarts=1))
    assert result.cost <= one.cost + 1e-9


def test_assignment_is_the_nearest_center(spark, facts):
    features = mining.cluster_features(facts)
    result = mining.kmeans(features, 3, MiningLimits(kmeans_restarts=1))
    rows = result.assigned.collect()
    points = np.array([[r["edad_z"], r["salario_usd_z"], r["pais_z"]] for r in rows])
    distance = ((points[:, None, :] - np.array(result.centers)[None]) ** 2).sum(-1)
    assert (distance.argmin(1) + 1).tolist() == [r["cluster"] for r in rows]


def test_linear_fit_is_least_squares(spark, facts):
    table = mining.random_split(mining.regression_table(facts), "id_registro")
    model, _ = mining.fit_linear(table)
    train = table.where(~F.col("es_prueba")).toPandas()
    x = np.column_stack([np.ones(len(train)), train[list(mining.REGRESSION_FEATURES)].to_numpy(float)])
    want = np.linalg.lstsq(x, train["label"].to_numpy(float), rcond=None)[0]
    np.testing.assert_allclose([model.intercept, *model.coefficients], want, rtol=1e-4, atol=1e-6)


def test_forest_beats_guessing(spark):
    """A label that follows one feature is learned, and that feature gets the weight."""
    df = spark.range(2000).select(
        F.col("id").alias("id_registro"),
        (F.col("id") % 7).alias("tecnologia_principal"),
        (F.xxhash64("id") % 5).alias("pais"),
        (F.col("id") % 3).alias("nivel_experiencia"),
        ((F.col("id") % 7) > 3).cast("int").alias("label"),
    )
    table = mining.stratified_split(df, "id_registro", "label")
    limits = MiningLimits(trees=10)
    model, predicted = mining.fit_forest_classifier(table, limits=limits, max_depth=4)
    assert mining.classification_scores(predicted).first()["precision"] > 0.95
    weights = {r["caracteristica"]: r["importancia"] for r in mining.importances(spark, mining.CLASSIFIER_FEATURES, model).collect()}
    assert sum(weights.values()) == pytest.approx(1, abs=1e-3)
    assert max(weights, key=weights.get) == "tecnologia_principal"
    _, logistic = mining.fit_logistic(table)
    majority = table.agg(F.max(F.lit(4 / 7))).first()[0]
    assert mining.classification_scores(logistic).first()["precision"] > majority


def test_forest_regression_learns_a_step(spark):
    df = spark.range(2000).select(
        F.col("id").alias("id_registro"),
        (F.col("id") % 100).cast("double").alias("inversion_usd"),
        (F.col("id") % 12).cast("double").alias("duracion_meses"),
        (F.col("id") % 5).cast("double").alias("satisfaccion_promedio"),
        F.when(F.col("id") % 100 > 50, 200.0).otherwise(20.0).alias("label"),
    )
    table = mining.random_split(df, "id_registro")
    _, predicted = mining.fit_forest_regressor(table, limits=MiningLimits(trees=5), max_depth=3)
    scores = mining.regression_scores(predicted).first()
    assert scores["r2_score"] > 0.9 and scores["precision"] == "Alta"


def test_all_analyses_run(spark, facts):
    results = mining.run_analyses(facts, MiningLimits(kmeans_restarts=1, trees=3, min_support=0.02))
    assert results["resumen_ejecucion"] == {"analisis_exitosos": 4, "total_analisis": 4, "tasa_exito": "100.0%"}
    assert mining.mining_summary(spark, results).where("exito").count() == 4


def test_rules_of_the_whole_lattice(spark):
    """All ways to cut every frequent set, against counting by hand."""
    from itertools import combinations

    baskets = [["a", "b", "c", "d"]] * 5 + [["a", "b", "c"]] * 4 + [["c", "a"]] * 3 + [["b", "d", "b"]] * 2 + [["e"]] * 2 + [[]]
    sets = [frozenset(b) for b in baskets]
    n = len(sets)
    count = {}
    for size in range(1, 5):
        for items in combinations("abcde", size):
            k = sum(set(items) <= s for s in sets)
            if k / n >= 0.2:
                count[frozenset(items)] = k
    want = set()
    for whole, k in count.items():
        for size in range(1, len(whole)):
            for left in map(frozenset, combinations(sorted(whole), size)):
                if k / count[left] >= 0.5:
                    lift = k / count[left] / (count[whole - left] / n)
                    want.add((tuple(sorted(left)), tuple(sorted(whole - left)), k, round(k / n, 9), round(k / count[left], 9), round(lift, 9)))
    found = mining.frequent_itemsets(spark.createDataFrame([(b,) for b in baskets], "items array<string>"), 0.2)
    got = [tuple(tuple(v) if isinstance(v, list) else round(v, 9) for v in r) for r in mining.lattice_rules(found, 0.5).collect()]
    assert len(got) == len(want) and set(got) == want
    assert any(len(r[0]) == 2 and len(r[1]) == 2 for r in want)
    texts = {(r["si_usa"], r["entonces_usa"]) for r in mining.association_rules(found, 0.5).collect()}
    assert texts == {(" + ".join(r[0]), " + ".join(r[1])) for r in want}
    assert mining.lattice_rules(found.where("size(items) = 1")).count() == 0


@pytest.fixture(scope="module")
def samples(spark):
    df = spark.range(1500).select(
        F.col("id").alias("id_registro"),
        (F.col("id") % 7).alias("tecnologia_principal"),
        (F.xxhash64("id") % 5).alias("pais"),
        (F.col("id") % 3).alias("nivel_experiencia"),
        ((F.col("id") % 7 + F.xxhash64("id") % 4) > 3).cast("int").alias("label"),
    )
    return mining.stratified_split(df, "id_registro", "label")


@pytest.mark.parametrize("fit", [mining.fit_forest_classifier, mining.fit_forest_regressor])
@pytest.mark.parametrize("depth", [1, 6])
def test_nodes_say_what_the_model_says(spark, samples, fit, depth):
    model, told = fit(samples, mining.CLASSIFIER_FEATURES, MiningLimits(trees=7), depth)
    nodes = model.nodes(spark)
    assert nodes.select("arbol").distinct().count() == 7
    both = mining.score_nodes(told, nodes, mining.CLASSIFIER_FEATURES, "by_nodes")
    assert both.where(F.abs(F.col("by_nodes") - F.col("prediction")) > 1e-9).count() == 0 < both.count()
    own = {r[0]: r[1] for r in mining.importances(spark, mining.CLASSIFIER_FEATURES, model).collect()}
    of_nodes = {r[0]: r[1] for r in mining.node_importances(nodes, mining.CLASSIFIER_FEATURES).collect()}
    assert of_nodes == pytest.approx(own, abs=2e-4)


def test_rows_are_scored_without_the_trees(spark, samples):
    """No row carries the forest, gaps go right, and stored rows of one file are dealt over the cores for the training."""
    model, told = mining.fit_forest_regressor(samples, mining.CLASSIFIER_FEATURES, MiningLimits(trees=5), 5)
    both = mining.score_nodes(told.withColumn("pais", F.when(F.col("label") == 1, F.col("pais"))), model.nodes(spark), mining.CLASSIFIER_FEATURES, "p")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "__trees" not in plan and "ubquery" not in plan
    gaps = both.where("pais is null").select(F.count("*"), F.count("p")).first()
    assert 0 < gaps[0] == gaps[1]
    stored = spark.range(450_000, numPartitions=1)
    assert mining.spread(stored).rdd.getNumPartitions() == 5
    assert mining.spread(stored.limit(500)).rdd.getNumPartitions() == 1


def test_a_forest_of_leaves(spark, samples):
    """Without a split all rows get one answer and no feature has a weight."""
    one = samples.withColumn("label", F.lit(1.0))
    model, told = mining.fit_forest_regressor(one, mining.CLASSIFIER_FEATURES, MiningLimits(trees=3), 4)
    nodes = model.nodes(spark)
    assert {r[0] for r in mining.score_nodes(told, nodes, mining.CLASSIFIER_FEATURES, "p").select("p").distinct().collect()} == {1.0}
    assert {r[1] for r in mining.node_importances(nodes, mining.CLASSIFIER_FEATURES).collect()} == {0.0}


def test_models_are_read_back_and_score_in_many_runs(spark, samples):
    """Fitting, storing, dropping and scoring again and again in one session; a stored model scores by its path alone."""
    import gc

    for _ in range(30):
        model, told = mining.fit_forest_classifier(samples, limits=MiningLimits(trees=2), max_depth=3)
        scores = mining.classification_scores(told).first()
        assert not model.model.hasSummary
        assert scores["precision"] > 0.7
        gc.collect()
    again = mining.load_model(model.path, type(model.model))
    assert mining.classification_scores(again.score(told.drop("rawPrediction", "probability", "prediction"))).first() == scores
    _, logistic = mining.fit_logistic(samples)
    assert mining.classification_scores(logistic).first()["precision"] > 0.5


@pytest.mark.parametrize("fit", [mining.fit_forest_classifier, mining.fit_forest_regressor])
def test_large_tables_are_read_once_for_a_forest(spark, monkeypatch, fit):
    """Trees of cells judge as well as those of rows, by the same features, and only two rows are given to the learner."""
    from pyspark.ml import base

    features = ("x", "y", "z")
    rows = spark.range(12_000).select(
        F.col("id").cast("string").alias("id_registro"), (F.pmod(F.xxhash64("id"), F.lit(1_000)) / 10.0).alias("x"),
        F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(5)).cast("double").alias("y"), F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(90)).alias("z"),
    )
    rows = mining.random_split(rows.withColumn("label", ((F.col("x") > 33) & (F.col("y") != 2)).cast("int")), "id_registro")
    limits, seen, plain = MiningLimits(trees=9), [], base.Estimator.fit

    def counted(self, data, *more):
        seen.append(data.count())
        return plain(self, data, *more)

    monkeypatch.setattr(base.Estimator, "fit", counted)
    by_rows, told = fit(rows, features, limits, 5)
    right = F.avg((F.round("prediction") == F.col("label")).cast("int"))
    assert told.select(right).first()[0] > 0.99 and seen.pop() > 8_000
    monkeypatch.setattr(mining, "ROWS_PER_TASK", 1_000)
    model, told = fit(rows, features, limits, 5)
    assert seen == [2] and told.select(right).first()[0] > 0.99
    nodes = model.nodes(spark)
    assert nodes.where("nodo = 0").count() == 9 and nodes.where("filas < 1").count() == 0
    assert nodes.where("nodo = 0").agg(F.avg("filas")).first()[0] == pytest.approx(rows.where("not es_prueba").count(), rel=0.02)
    own = {r[0]: r[1] for r in mining.importances(spark, features, model).collect()}
    assert own == pytest.approx({r[0]: r[1] for r in mining.importances(spark, features, by_rows).collect()}, abs=0.15)
