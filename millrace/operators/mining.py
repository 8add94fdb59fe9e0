"""Mining: association rules, clusters, regression and classification on the fact table.

The counting, filling, encoding, splitting and scoring are DataFrame work; the models come from
``pyspark.ml``. An analysis with too little data raises ``NotEnoughData``; ``run_analyses``
turns that into an entry with an ``error``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import MiningLimits
from millrace.functions.numbers import round_half_even
from millrace.operators import forests
from millrace.operators.lookup import join_lookup, scalars
from millrace.operators.quantiles import quantile_table, table_quantiles
from millrace.operators.transform import label_encode, label_encode_all
from millrace.operators.warehouse import INVESTMENTS, JOBS, PROFILES
from millrace.session import scratch_path, settle, written

# The grades of a score, lowest limit excluded.
R2_GRADES = ((0.7, "Alta"), (0.5, "Media"))
ACCURACY_GRADES = ((0.8, "Alta"), (0.6, "Media"))
LOWEST_GRADE = "Baja"
# Training rows that are worth a task, and tasks for each core.
ROWS_PER_TASK, TASKS_PER_CORE = 100_000, 3
CLUSTER_FEATURES = ("edad", "salario_usd", "pais")
REGRESSION_FEATURES = ("inversion_usd", "duracion_meses", "satisfaccion_promedio")
CLASSIFIER_FEATURES = ("tecnologia_principal", "pais", "nivel_experiencia")


class NotEnoughData(ValueError):
    """An analysis has fewer rows than it needs."""


def grade(score: Column, grades: Sequence[tuple[float, str]]) -> Column:
    chain = F
    for limit, name in grades:
        chain = chain.when(score > limit, F.lit(name))
    return chain.otherwise(F.lit(LOWEST_GRADE))


def spread(rows: DataFrame) -> DataFrame:
    """Stored rows dealt over the cores if their files make too few tasks, as for a model that passes over them many times.

    No more than ``TASKS_PER_CORE`` tasks a core, as each of a forest sends the counts of all open nodes.
    """
    tasks = min(-(-rows.count() // ROWS_PER_TASK), TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(tasks) if tasks > rows.rdd.getNumPartitions() else rows


# -- association rules --------------------------------------------------------------------


def baskets(fact: DataFrame) -> DataFrame:
    """Records with a language and a framework, as items ``lang_…`` and ``fw_…``."""
    both = fact.where(F.col("tecnologia_principal").isNotNull() & F.col("framework_herramienta").isNotNull())

    def item(prefix: str, column: str) -> Column:
        c = F.col(column)
        return F.when(c != "Unknown", F.concat(F.lit(prefix), c))

    items = F.array_compact(F.array(item("lang_", "tecnologia_principal"), item("fw_", "framework_herramienta")))
    return both.select("id_registro", items.alias("items")).where(F.size("items") > 0)


def frequent_itemsets(basket: DataFrame, min_support: float = MiningLimits.min_support) -> DataFrame:
    """Item sets in at least that share of the baskets: ``items, frecuencia, soporte``.

    Baskets may have any number of items; an item counts once in a basket. Item sets are sorted.
    """
    found = FPGrowth(itemsCol="items", minSupport=min_support).fit(basket.select(F.array_distinct("items").alias("items"))).freqItemsets
    counts = found.select(F.sort_array("items").alias("items"), F.col("freq").alias("frecuencia"))
    total = scalars(basket, n=F.count(F.lit(1)))["n"]
    return counts.withColumn("soporte", F.try_divide(F.col("frecuencia").cast("double"), total)).where(
        F.col("soporte") >= min_support
    )


def _splits(items: Column) -> Column:
    """All ways to cut a set into two sides that are not empty, in the order of its items."""
    ways = F.sequence(F.lit(1).cast("long"), F.pow(F.lit(2.0), F.size(items)).cast("long") - 2)

    def side(way: Column, bit: int) -> Column:
        return F.filter(items, lambda item, i: F.getbit(way, i) == bit)

    return F.transform(ways, lambda way: F.struct(side(way, 1).alias("antecedentes"), side(way, 0).alias("consecuentes")))


def lattice_rules(itemsets: DataFrame, min_confidence: float = MiningLimits.min_confidence) -> DataFrame:
    """Rules with any number of items on either side:
    ``antecedentes, consecuentes, frecuencia, soporte, confianza, elevacion``.

    Every part of a frequent set is frequent itself, so the counts of both sides are rows of ``itemsets``, found by joins on
    the sorted items, and there are no more ways to cut than pairs of a set and a part of it in that table.
    """
    counts = itemsets.select(F.sort_array("items").alias("items"), "frecuencia", "soporte")
    cut = counts.where(F.size("items") > 1).select(F.inline(_splits(F.col("items"))), "frecuencia", "soporte")
    left = counts.select(F.col("items").alias("antecedentes"), F.col("frecuencia").alias("__left"))
    right = counts.select(F.col("items").alias("consecuentes"), F.col("soporte").alias("__right"))
    sure = cut.join(left, "antecedentes").withColumn("confianza", F.col("frecuencia").cast("double") / F.col("__left"))
    told = sure.where(F.col("confianza") >= min_confidence).join(right, "consecuentes")
    return told.select(
        "antecedentes", "consecuentes", "frecuencia", "soporte", "confianza", (F.col("confianza") / F.col("__right")).alias("elevacion")
    )


def association_rules(itemsets: DataFrame, min_confidence: float = MiningLimits.min_confidence) -> DataFrame:
    """All rules as text: ``si_usa, entonces_usa, confianza, soporte``; several items of a side are joined by `` + ``."""
    sides = {"si_usa": "antecedentes", "entonces_usa": "consecuentes"}
    joined = [F.array_join(items, " + ").alias(side) for side, items in sides.items()]
    return lattice_rules(itemsets, min_confidence).select(*joined, "confianza", "soporte")


def top_rules(rules: DataFrame, k: int = 5) -> DataFrame:
    best = rules.orderBy(F.desc("confianza"), "si_usa", "entonces_usa").limit(k)
    return best.withColumns({c: round_half_even(F.col(c), 3) for c in ("confianza", "soporte")})


# -- clusters -----------------------------------------------------------------------------


def standardized(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``column_z``: mean 0 and population deviation 1; a constant column becomes 0."""
    held = scalars(df, **{c: F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")) for c in columns})
    stats = F.col("__s")
    scaled = {
        f"{c}_z": (F.col(c) - stats[c]["m"]) / F.when(stats[c]["s"] == 0, F.lit(1.0)).otherwise(stats[c]["s"])
        for c in columns
    }
    return df.withColumn("__s", held).withColumns(scaled).drop("__s")


def cluster_features(fact: DataFrame) -> DataFrame:
    """Profiles with age and salary (gaps at the median) and the country code, standardized.

    ``edad`` and ``salario_usd`` keep their gaps for the cluster profile.
    """
    people = fact.where(F.col("fuente_datos") == PROFILES).select(
        "id_registro", "edad", "salario_usd", F.coalesce("pais_normalizado", F.lit("Unknown")).alias("pais_normalizado")
    )
    held = table_quantiles(people, ["edad", "salario_usd"], [0.5])
    middle = F.col("__median")
    coded = label_encode(people, "pais_normalizado", "__pais").withColumn("__median", held)
    filled = coded.select(
        "id_registro", "edad", "salario_usd", "pais_normalizado",
        F.coalesce("edad", middle["edad"][0]).alias("__edad"),
        F.coalesce("salario_usd", middle["salario_usd"][0]).alias("__salario"),
        F.col("__pais").cast("double").alias("__pais"),
    )
    scaled = standardized(filled, ["__edad", "__salario", "__pais"])
    names = {"edad": "__edad_z", "salario_usd": "__salario_z", "pais": "__pais_z"}
    return scaled.select(
        "id_registro", "edad", "salario_usd", "pais_normalizado",
        *[F.col(names[c]).alias(f"{c}_z") for c in CLUSTER_FEATURES],
    )


def cluster_count(rows: int) -> int:
    return max(2, min(5, rows // 20))


@dataclass(frozen=True)
class Clustering:
    assigned: DataFrame
    k: int
    cost: float
    centers: list[list[float]]


def kmeans(features: DataFrame, k: int, limits: MiningLimits = MiningLimits()) -> Clustering:
    """Best of several k-means runs; clusters are numbered from 1 in the order of their centers.

    The rows are written first and spread over the cores. The runs share one stored copy of the vectors.
    Spark may drop it under memory pressure or with an executor and reads the rows again.
    """
    columns = [f"{c}_z" for c in CLUSTER_FEATURES]
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(spread(written(features, "features")))
    vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        runs = [
            KMeans(k=k, seed=limits.seed + i, featuresCol="features", predictionCol="__cluster").fit(vectors)
            for i in range(limits.kmeans_restarts)
        ]
        best = min(runs, key=lambda m: m.summary.trainingCost)
        cost = best.summary.trainingCost
    finally:
        vectors.unpersist()
    centers = [[float(x) for x in c] for c in best.clusterCenters()]
    order = sorted(range(len(centers)), key=lambda i: centers[i])
    number = F.coalesce(*[F.when(F.col("__cluster") == old, F.lit(new)) for new, old in enumerate(order, 1)])
    assigned = best.transform(vectors).withColumn("cluster", number).drop("features", "__cluster")
    return Clustering(assigned, len(centers), cost, [centers[i] for i in order])


def cluster_profile(assigned: DataFrame) -> DataFrame:
    """Size, share, mean age and salary and the most common country of each cluster.

    Counting by cluster and country first leaves a small table for the second grouping.
    """
    places = assigned.groupBy("cluster", "pais_normalizado").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("edad").alias("n_edad"),
        F.sum("edad").alias("s_edad"),
        F.count("salario_usd").alias("n_sal"),
        F.sum("salario_usd").alias("s_sal"),
    )
    total = scalars(assigned, n=F.count(F.lit(1)))["n"]
    share = round_half_even(F.col("cantidad_perfiles") * F.lit(100.0) / total, 2)
    named = F.when(F.col("pais_normalizado").isNotNull(), F.struct(-F.col("n"), F.col("pais_normalizado")))
    return places.groupBy("cluster").agg(
        F.sum("n").alias("cantidad_perfiles"),
        round_half_even(F.try_divide(F.sum("s_edad"), F.sum("n_edad")), 2).alias("edad_promedio"),
        round_half_even(F.try_divide(F.sum("s_sal"), F.sum("n_sal")), 2).alias("salario_promedio"),
        F.min_by("pais_normalizado", named).alias("pais_predominante"),
    ).withColumn("porcentaje", share)


# -- splits and scores --------------------------------------------------------------------


def hash_share(*parts: Column) -> Column:
    """Number in [0, 1) that depends on the values only, evenly spread."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def random_split(df: DataFrame, key: str, test_share: float = MiningLimits.test_share) -> DataFrame:
    """Add ``es_prueba``: the same rows are test rows in every run."""
    return df.withColumn("es_prueba", hash_share(F.col(key)) < test_share)


def stratified_split(
    df: DataFrame, key: str, label: str, test_share: float = MiningLimits.test_share
) -> DataFrame:
    """As ``random_split`` with the share kept within each label.

    The cut of each label is the exact quantile of its hashes, so no label is numbered row by row.
    """
    hashed = df.withColumn("__h", hash_share(F.col(key)))
    cuts = quantile_table(hashed, ["__h"], [test_share], [label]).select(label, F.col("q")[0].alias("__cut"))
    joined = join_lookup(hashed, settle(cuts), [label])
    return joined.withColumn("es_prueba", F.col("__h") <= F.col("__cut")).drop("__h", "__cut")


def classification_scores(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, its grade and the confusion counts of a 0/1 label."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    scores = predictions.agg(
        F.avg(F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)).alias("precision"),
        F.count_if(y & p).alias("verdaderos_positivos"),
        F.count_if(~y & p).alias("falsos_positivos"),
        F.count_if(y & ~p).alias("falsos_negativos"),
        F.count_if(~y & ~p).alias("verdaderos_negativos"),
    )
    return scores.withColumn("calidad", grade(F.col("precision"), ACCURACY_GRADES))


def regression_scores(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """R² and its grade, from one aggregate."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    r2 = F.lit(1.0) - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y))
    return predictions.agg(r2.alias("r2_score")).withColumn("precision", grade(F.col("r2_score"), R2_GRADES))


def best_model(first: str, first_score: float, second: str, second_score: float) -> str:
    """The second model wins only if it is strictly better."""
    return second if second_score > first_score else first


def importances(spark: SparkSession, names: Sequence[str], model) -> DataFrame:
    """Feature importances of a forest, one row per feature."""
    values = [(n, round(float(v), 4)) for n, v in zip(names, model.featureImportances.toArray(), strict=True)]
    return spark.createDataFrame(values, "caracteristica string, importancia double")


# -- regression ---------------------------------------------------------------------------


def regression_table(fact: DataFrame) -> DataFrame:
    """Programmes with participants and investment; duration gaps at the median, satisfaction
    gaps at the mean; ``label`` is the number of participants."""
    known = fact.where(
        (F.col("fuente_datos") == INVESTMENTS)
        & F.col("participantes").isNotNull()
        & F.col("inversion_usd").isNotNull()
    ).select("id_registro", "participantes", *REGRESSION_FEATURES)
    middle = table_quantiles(known, ["duracion_meses"], [0.5])["duracion_meses"][0]
    mean = scalars(known, m=F.avg("satisfaccion_promedio"))["m"]
    return known.select(
        "id_registro",
        "inversion_usd",
        F.coalesce("duracion_meses", middle, F.lit(0.0)).alias("duracion_meses"),
        F.coalesce("satisfaccion_promedio", mean, F.lit(0.0)).alias("satisfaccion_promedio"),
        F.col("participantes").alias("label"),
    )


def single_regression(table: DataFrame, feature: str, label: str = "label") -> DataFrame:
    """Least-squares line of one feature in closed form."""
    y, x = F.col(label), F.col(feature)
    return table.agg(
        F.regr_slope(y, x).alias("pendiente"), F.regr_intercept(y, x).alias("intercepto"), F.regr_r2(y, x).alias("r2")
    )


@contextmanager
def _assembled(table: DataFrame, features: Sequence[str]):
    """Training and test rows with their feature vectors.

    The rows are written first, so neither a pass of the training nor the scoring works them out again, and spread over the cores; the
    vectors of the training rows are kept while a model passes over them.
    """
    rows = spread(written(table, "samples"))
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(rows)
    train = vectors.where(~F.col("es_prueba")).select("label", "features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield train, vectors.where("es_prueba")
    finally:
        train.unpersist()


@dataclass(frozen=True)
class StoredModel:
    """A fitted model as it was read back from the shared folder.

    What is read back has no training summary, so a scoring plan carries weights and nodes and no reference to the training rows,
    and a later session can score with ``path`` alone.
    """

    path: str
    model: object

    def score(self, rows: DataFrame) -> DataFrame:
        return self.model.transform(rows)

    def nodes(self, spark: SparkSession) -> DataFrame:
        return forest_nodes(spark, self.path)

    def __getattr__(self, name: str):
        if name.startswith("__"):  # not while it is copied or unpickled
            raise AttributeError(name)
        return getattr(self.model, name)


def store_model(spark: SparkSession, model, name: str) -> StoredModel:
    path = scratch_path(spark, name)
    model.write().save(path)
    return load_model(path, type(model))


def load_model(path: str, kind: type) -> StoredModel:
    return StoredModel(path, kind.load(path))


def _fitted(learner, table: DataFrame, features: Sequence[str], name: str) -> tuple[StoredModel, DataFrame]:
    with _assembled(table, features) as (train, test):
        model = store_model(table.sparkSession, learner(train) if callable(learner) else learner.fit(train), name)
    return model, model.score(test)


def _fitted_forest(
    learner, classes: int, table: DataFrame, features: Sequence[str], limits: MiningLimits, max_depth: int | None
) -> tuple[StoredModel, DataFrame]:
    """Beyond ``ROWS_PER_TASK`` training rows and with few features the trees grow from cells, as ``forests`` says."""
    rows = written(table, "samples")
    train = rows.where(~F.col("es_prueba"))
    if not forests.fits(features) or train.count() <= ROWS_PER_TASK:
        return _fitted(learner, rows, features, "forest")
    spark, subset = table.sparkSession, -int(-(len(features) ** 0.5) // 1) if classes else len(features)
    nodes = forests.nodes(train, features, classes, limits.trees, subset, max_depth or limits.max_depth, limits.min_leaf, limits.seed)
    # a forest of as many trees with a row of each class, whose nodes are replaced
    pattern = [(float(k), Vectors.dense([float(k)] * len(features))) for k in range(classes or 2)]
    empty = store_model(spark, learner.fit(spark.createDataFrame(pattern, ["label", "features"])), "forest")
    path = empty.path
    stored = spark.read.parquet(f"{path}/data").schema
    weight = F.aggregate("sumas", F.lit(0.0), lambda a, x: a + x) if classes else F.col("sumas")[0]
    node = F.struct(
        F.col("nodo").alias("id"), F.col("prediccion").alias("prediction"), F.col("impureza").alias("impurity"),
        F.col("sumas").alias("impurityStats"), weight.cast("long").alias("rawCount"), F.col("ganancia").alias("gain"),
        F.col("izquierdo").alias("leftChild"), F.col("derecho").alias("rightChild"),
        F.struct(
            F.col("caracteristica").alias("featureIndex"),
            F.when(F.col("izquierdo") < 0, F.array().cast("array<double>")).otherwise(F.array("umbral")).alias("leftCategoriesOrThreshold"),
            F.lit(-1).alias("numCategories"),
        ).alias("split"),
    )
    told = nodes.select(F.col("arbol").alias("treeID"), node.alias("nodeData")).to(stored)
    told.write.mode("overwrite").parquet(f"{path}/data")
    model = load_model(path, type(empty.model))
    test = VectorAssembler(inputCols=list(features), outputCol="features").transform(rows.where("es_prueba"))
    return model, model.score(test)


def fit_linear(table: DataFrame, features: Sequence[str] = REGRESSION_FEATURES):
    """Model and test predictions of a least-squares fit on the training rows."""
    return _fitted(LinearRegression(solver="normal"), table, features, "linear")


def fit_forest_regressor(
    table: DataFrame, features: Sequence[str] = REGRESSION_FEATURES, limits: MiningLimits = MiningLimits(),
    max_depth: int | None = None,
):
    forest = RandomForestRegressor(
        numTrees=limits.trees, seed=limits.seed, featureSubsetStrategy="all", maxDepth=max_depth or limits.max_depth,
        minInstancesPerNode=limits.min_leaf,
    )
    return _fitted_forest(forest, 0, table, features, limits, max_depth)


# -- forests as tables --------------------------------------------------------------------


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """A stored forest as rows: ``arbol, nodo, izquierdo, derecho, caracteristica, umbral, ganancia, filas, valor``.

    ``valor`` is what a leaf says: its mean, or the share of each class. Inner nodes have both children, leaves -1. Rows with
    ``umbral`` or less go left.
    """
    node, split = F.col("nodeData"), F.col("nodeData.split")
    stored = spark.read.parquet(f"{path}/data")
    kind = spark.read.json(f"{path}/metadata").select(F.col("class").contains("Classification")).first()[0]
    total = F.aggregate(node["impurityStats"], F.lit(0.0), lambda a, x: a + x)
    shares = F.transform(node["impurityStats"], lambda x: F.try_divide(x, total))
    return stored.select(
        F.col("treeID").alias("arbol"),
        node["id"].alias("nodo"),
        node["leftChild"].alias("izquierdo"),
        node["rightChild"].alias("derecho"),
        split["featureIndex"].alias("caracteristica"),
        F.get(split["leftCategoriesOrThreshold"], F.lit(0)).alias("umbral"),
        node["gain"].alias("ganancia"),
        node["rawCount"].alias("filas"),
        (shares if kind else F.array(node["prediction"])).alias("valor"),
    )


def score_nodes(
    rows: DataFrame, nodes: DataFrame, features: Sequence[str], prediction: str = "prediction", max_depth: int = 30
) -> DataFrame:
    """Adds what the forest says of each row. 30 is the deepest a tree can be.

    All trees travel as one value with the plan, once per task and never with a row: their number and depth are settings, so its size
    does not grow with the data. Each step takes all rows of a batch one level down, the columns of the features alone go to it.
    A regression forest gives the mean of its trees, a classifier the class with the largest sum of shares, the first of equal ones.
    """
    columns = ["arbol", "nodo", "izquierdo", "derecho", "caracteristica", "umbral", "valor"]
    table = nodes.select(*columns).orderBy("arbol", "nodo").toPandas()
    trees = [
        (
            tree["nodo"].to_numpy(np.int64),
            np.stack([tree["izquierdo"], tree["derecho"]]).astype(np.int64),
            tree["caracteristica"].to_numpy(np.int64),
            tree["umbral"].to_numpy(np.float64),
            np.array(tree["valor"].tolist(), np.float64),
        )
        for _, tree in table.groupby("arbol", sort=True)
    ]

    @F.pandas_udf("double")
    def say(*values: pd.Series) -> pd.Series:
        x = np.stack([v.to_numpy(np.float64, na_value=np.nan) for v in values])
        every, sums = np.arange(x.shape[1]), 0.0
        for numbers, children, feature, limit, said in trees:
            at = np.zeros(x.shape[1], np.int64)  # the place of the root, which has the lowest number
            below = np.searchsorted(numbers, children)
            leaf = children[0] < 0
            for _ in range(max_depth):
                if leaf[at].all():
                    break
                # a gap is above every limit
                down = below[np.where(x[np.maximum(feature[at], 0), every] <= limit[at], 0, 1), at]
                at = np.where(leaf[at], at, down)
            sums = sums + said[at]
        answer = sums[:, 0] / len(trees) if sums.shape[1] == 1 else sums.argmax(axis=1).astype(np.float64)
        return pd.Series(answer)

    return rows.withColumn(prediction, say(*[F.col(f"`{c}`").cast("double") for c in features]))


def node_importances(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """Share of each feature in what the splits of the trees gain; every tree weighs the same."""
    gains = nodes.where("izquierdo >= 0").groupBy("arbol", "caracteristica").agg(F.sum(F.col("ganancia") * F.col("filas")).alias("g"))
    total = gains.groupBy("arbol").agg(F.sum("g").alias("t"))
    share = gains.join(total, "arbol").where("t > 0").groupBy("caracteristica").agg(F.sum(F.col("g") / F.col("t")).alias("s"))
    whole = scalars(share, t=F.sum("s"))["t"]
    named = nodes.sparkSession.createDataFrame(list(enumerate(names)), "caracteristica int, nombre string")
    return named.join(share, "caracteristica", "left").select(
        F.col("nombre").alias("caracteristica"), round_half_even(F.coalesce(F.col("s") / whole, F.lit(0.0)), 4).alias("importancia")
    )


# -- classification -----------------------------------------------------------------------


def demand_label(fact: DataFrame) -> DataFrame:
    """Jobs with a salary; ``label`` is 1 above the median salary."""
    jobs = fact.where((F.col("fuente_datos") == JOBS) & F.col("salario_usd").isNotNull())
    middle = table_quantiles(jobs, ["salario_usd"], [0.5])["salario_usd"][0]
    return jobs.withColumn("label", (F.col("salario_usd") > middle).cast("int"))


def classifier_table(fact: DataFrame) -> DataFrame:
    """Codes of language, country and level (gaps are ``Unknown``) beside the label."""
    source = {"tecnologia_principal": "tecnologia_principal", "pais": "pais_normalizado", "nivel_experiencia": "nivel_experiencia"}
    table = demand_label(fact).select(
        "id_registro", "label", *[F.coalesce(c, F.lit("Unknown")).alias(name) for name, c in source.items()]
    )
    coded = label_encode_all(table, {c: f"__{c}" for c in CLASSIFIER_FEATURES})
    return coded.select("id_registro", "label", *[F.col(f"__{c}").alias(c) for c in CLASSIFIER_FEATURES])


def fit_forest_classifier(
    table: DataFrame, features: Sequence[str] = CLASSIFIER_FEATURES, limits: MiningLimits = MiningLimits(),
    max_depth: int | None = None,
):
    forest = RandomForestClassifier(
        numTrees=limits.trees, seed=limits.seed, maxDepth=max_depth or limits.max_depth, minInstancesPerNode=limits.min_leaf
    )
    return _fitted_forest(forest, 2, table, features, limits, max_depth)


def fit_logistic(table: DataFrame, features: Sequence[str] = CLASSIFIER_FEATURES):
    """L2 penalty of weight 1 on the summed loss, hence 1/n on Spark's mean loss."""

    def fit(train: DataFrame):
        return LogisticRegression(regParam=1.0 / max(1, train.count()), standardization=False, maxIter=1000).fit(train)

    return _fitted(fit, table, features, "logistic")


# -- analyses -----------------------------------------------------------------------------


def _need(rows: int, least: int, what: str) -> None:
    if rows < least:
        raise NotEnoughData(f"{what}: {rows} rows, {least} needed")


def analyze_associations(fact: DataFrame, limits: MiningLimits = MiningLimits()) -> dict:
    basket = baskets(fact)
    total = basket.count()
    _need(total, limits.min_baskets, "associations")
    itemsets = settle(frequent_itemsets(basket, limits.min_support))
    found = itemsets.count()
    if not found:
        raise NotEnoughData("associations: no frequent pattern")
    rules = association_rules(itemsets, limits.min_confidence)
    return {
        "total_transacciones": total,
        "patrones_frecuentes": found,
        "reglas_asociacion": rules.count(),
        "top_combinaciones": [r.asDict() for r in top_rules(rules).collect()],
    }


def analyze_clusters(fact: DataFrame, limits: MiningLimits = MiningLimits()) -> dict:
    rows = fact.where(F.col("fuente_datos") == PROFILES).count()
    _need(rows, limits.min_profiles, "clusters")
    result = kmeans(cluster_features(fact), cluster_count(rows), limits)
    profile = settle(cluster_profile(result.assigned))
    return {
        "num_clusters": result.k,
        "caracteristicas_usadas": list(CLUSTER_FEATURES),
        "clusters": [r.asDict() for r in profile.orderBy("cluster").collect()],
    }


def analyze_regression(fact: DataFrame, limits: MiningLimits = MiningLimits()) -> dict:
    table = random_split(regression_table(fact), "id_registro", limits.test_share)
    table.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _need(table.count(), limits.min_investments, "regression")
        line = regression_scores(fit_linear(table)[1]).first()
        forest, predicted = fit_forest_regressor(table, limits=limits)
        trees = regression_scores(predicted).first()
    finally:
        table.unpersist()
    return {
        "modelo_lineal": _rounded_scores(line),
        "modelo_random_forest": _rounded_scores(trees),
        "mejor_modelo": best_model("Regresión Lineal", line["r2_score"], "Random Forest", trees["r2_score"]),
        "caracteristicas_importantes": [
            r.asDict() for r in importances(fact.sparkSession, REGRESSION_FEATURES, forest).collect()
        ],
    }


def analyze_classification(fact: DataFrame, limits: MiningLimits = MiningLimits()) -> dict:
    table = stratified_split(classifier_table(fact), "id_registro", "label", limits.test_share)
    table.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {r["label"]: r["count"] for r in table.groupBy("label").count().collect()}
        _need(sum(sizes.values()), limits.min_jobs, "classification")
        if len(sizes) < 2:
            raise NotEnoughData("classification: the label has one class only")
        forest, predicted = fit_forest_classifier(table, limits=limits)
        trees = classification_scores(predicted).first()
        logistic = classification_scores(fit_logistic(table)[1]).first()
    finally:
        table.unpersist()
    return {
        "modelo_random_forest": {"precision": round(trees["precision"], 4), "calidad": trees["calidad"]},
        "modelo_logistic_regression": {"precision": round(logistic["precision"], 4), "calidad": logistic["calidad"]},
        "mejor_modelo": best_model("Regresión Logística", logistic["precision"], "Random Forest", trees["precision"]),
        "caracteristicas_importantes": [
            r.asDict() for r in importances(fact.sparkSession, CLASSIFIER_FEATURES, forest).collect()
        ],
    }


def _rounded_scores(row) -> dict:
    return {"r2_score": round(row["r2_score"], 4), "precision": row["precision"]}


ANALYSES: dict[str, Callable[[DataFrame, MiningLimits], dict]] = {
    "asociaciones": analyze_associations,
    "clustering": analyze_clusters,
    "regresion": analyze_regression,
    "clasificacion": analyze_classification,
}


def run_analyses(fact: DataFrame, limits: MiningLimits = MiningLimits(), at: datetime | None = None) -> dict:
    """All four analyses, each on its own; too little data becomes an ``error`` entry."""
    results = {}
    for name, analyze in ANALYSES.items():
        try:
            results[name] = analyze(fact, limits)
        except NotEnoughData as short:
            results[name] = {"error": str(short)}
    successes = sum("error" not in r for r in results.values())
    return {
        "fecha_analisis": (at or datetime.now()).isoformat(),
        "total_registros_analizados": fact.count(),
        "analisis_realizados": results,
        "resumen_ejecucion": {
            "analisis_exitosos": successes,
            "total_analisis": len(results),
            "tasa_exito": f"{successes / len(results) * 100:.1f}%",
        },
    }


def mining_summary(spark: SparkSession, results: dict) -> DataFrame:
    """One row per analysis: whether it succeeded and its result as JSON."""
    import json

    rows = [
        (name, "error" not in r, r.get("error"), json.dumps(r, ensure_ascii=False, sort_keys=True))
        for name, r in results["analisis_realizados"].items()
    ]
    return spark.createDataFrame(rows, "analisis string, exito boolean, error string, resultado string")
