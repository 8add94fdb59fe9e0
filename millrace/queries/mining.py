"""Mining queries. Forests and clusters have no SQL twin; their checks and the tests hold what must be true of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.config import MiningLimits
from millrace.functions.numbers import round_half_even
from millrace.operators import mining
from millrace.queries.base import query, r, rounded
from millrace.queries.marts import PROFILE, WITH_ASSIGNED, assigned
from millrace.queries.warehouse import FACT, fact
from millrace.session import settle

BASKETS = f"""SELECT id_registro, list_filter([CASE WHEN tecnologia_principal <> 'Unknown' THEN concat('lang_', tecnologia_principal) END,
 CASE WHEN framework_herramienta <> 'Unknown' THEN concat('fw_', framework_herramienta) END], lambda x: x IS NOT NULL) AS items
 FROM ({FACT}) WHERE tecnologia_principal IS NOT NULL AND framework_herramienta IS NOT NULL"""
BASKETS = f"SELECT * FROM ({BASKETS}) WHERE len(items) > 0"
SUPPORT, CONFIDENCE = 0.02, 0.3


@query("basket_encode", f"SELECT id_registro, array_to_string(items, '|') AS items FROM ({BASKETS})")
def _(t):
    return mining.baskets(fact(t)).withColumn("items", F.array_join("items", "|"))


ITEMSETS = f"""SELECT items, count(*) AS frecuencia, count(*) * 1.0::DOUBLE / (SELECT count(*) FROM ({BASKETS})) AS soporte FROM (
 SELECT [unnest(items)] AS items FROM ({BASKETS}) UNION ALL SELECT list_sort(items) FROM ({BASKETS}) WHERE len(items) = 2)
 GROUP BY items HAVING count(*) * 1.0::DOUBLE / (SELECT count(*) FROM ({BASKETS})) >= {SUPPORT}"""


@query(
    "frequent_itemsets",
    f"SELECT array_to_string(items, '|') AS items, frecuencia, {r('soporte')} AS soporte FROM ({ITEMSETS})",
)
def _(t):
    found = mining.frequent_itemsets(mining.baskets(fact(t)), SUPPORT)
    return rounded(found.withColumn("items", F.array_join("items", "|")))


RULES = f"""WITH s AS ({ITEMSETS}), d AS (SELECT items[1] AS si_usa, items[2] AS entonces_usa, frecuencia, soporte FROM s WHERE len(items) = 2
 UNION ALL SELECT items[2], items[1], frecuencia, soporte FROM s WHERE len(items) = 2)
 SELECT si_usa, entonces_usa, d.frecuencia * 1.0::DOUBLE / s.frecuencia AS confianza, d.soporte
 FROM d JOIN s ON len(s.items) = 1 AND s.items[1] = si_usa WHERE d.frecuencia * 1.0::DOUBLE / s.frecuencia >= {CONFIDENCE}"""


@query(
    "association_rules",
    f"SELECT si_usa, entonces_usa, {r('confianza')} AS confianza, {r('soporte')} AS soporte FROM ({RULES})",
)
def _(t):
    found = mining.frequent_itemsets(mining.baskets(fact(t)), SUPPORT)
    return rounded(mining.association_rules(found, CONFIDENCE))


@query(
    "top_rules",
    f"""SELECT si_usa, entonces_usa, {r('c', 3)} AS confianza, {r('soporte', 3)} AS soporte
 FROM (SELECT si_usa, entonces_usa, confianza AS c, soporte FROM ({RULES}) ORDER BY c DESC, si_usa, entonces_usa LIMIT 5)""",
)
def _(t):
    found = mining.frequent_itemsets(mining.baskets(fact(t)), SUPPORT)
    return rounded(mining.top_rules(mining.association_rules(found, CONFIDENCE)), 3)


# Jobs as baskets of up to four items, and all their parts by the bits of a number.
WIDE = """SELECT id_oferta, list_filter([concat('lang_', lenguaje), concat('fw_', framework), concat('nivel_', nivel_seniority), concat('modo_', modalidad)],
 lambda x: len(x) > 6) AS items FROM {jobs}"""
PARTS = f"""SELECT list_sort([items[i] FOR i IN range(1, 5) IF i <= len(items) AND (way >> (i - 1)) & 1 = 1]) AS items FROM ({WIDE}), range(1, 16) w(way)
 WHERE way < (1 << len(items))"""
WIDE_SETS = f"""SELECT items, count(*) AS frecuencia, count(*) * 1.0::DOUBLE / (SELECT count(*) FROM {{jobs}}) AS soporte FROM ({PARTS}) GROUP BY items
 HAVING count(*) * 1.0::DOUBLE / (SELECT count(*) FROM {{jobs}}) >= {SUPPORT}"""


@query(
    "lattice_rules",
    f"""WITH s AS ({WIDE_SETS}), d AS (SELECT [items[i] FOR i IN range(1, 5) IF i <= len(items) AND (way >> (i - 1)) & 1 = 1] AS a,
 [items[i] FOR i IN range(1, 5) IF i <= len(items) AND (way >> (i - 1)) & 1 = 0] AS c, frecuencia, soporte FROM s, range(1, 16) w(way) WHERE way < (1 << len(items)) - 1)
 SELECT array_to_string(a, '|') AS antecedentes, array_to_string(c, '|') AS consecuentes, d.frecuencia, {r("d.soporte")} AS soporte,
 {r("d.frecuencia * 1.0::DOUBLE / x.frecuencia")} AS confianza, {r("d.frecuencia * 1.0::DOUBLE / x.frecuencia / y.soporte")} AS elevacion
 FROM d JOIN s x ON x.items = a JOIN s y ON y.items = c WHERE d.frecuencia * 1.0::DOUBLE / x.frecuencia >= {CONFIDENCE}""",
)
def _(t):
    named = {"lang_": "lenguaje", "fw_": "framework", "nivel_": "nivel_seniority", "modo_": "modalidad"}
    items = F.filter(F.array(*[F.concat(F.lit(p), F.coalesce(c, F.lit(""))) for p, c in named.items()]), lambda x: F.length(x) > 6)
    found = settle(mining.frequent_itemsets(t.jobs.select(items.alias("items")), SUPPORT))
    rules = mining.lattice_rules(found, CONFIDENCE)
    return rounded(rules.withColumns({c: F.array_join(c, "|") for c in ("antecedentes", "consecuentes")}))


@query(
    "cluster_features",
    f"""WITH p AS (SELECT id_registro, edad, salario_usd, pais_normalizado FROM ({FACT}) WHERE fuente_datos = 'perfiles_habilidades'),
 f AS (SELECT *, coalesce(edad, (SELECT median(edad) FROM p)) AS e, coalesce(salario_usd, (SELECT median(salario_usd) FROM p)) AS s,
 CAST(dense_rank() OVER (ORDER BY pais_normalizado) - 1 AS DOUBLE) AS c FROM p),
 m AS (SELECT avg(e) AS me, stddev_pop(e) AS se, avg(s) AS ms, stddev_pop(s) AS ss, avg(c) AS mc, stddev_pop(c) AS sc FROM f)
 SELECT id_registro, {r("edad")} AS edad, {r("salario_usd")} AS salario_usd, pais_normalizado, {r("(e - me) / se")} AS edad_z,
 {r("(s - ms) / ss")} AS salario_usd_z, {r("(c - mc) / sc")} AS pais_z FROM f, m""",
)
def _(t):
    return rounded(mining.cluster_features(fact(t)))


@query("kmeans_assign")
def _(t):
    rows = t.profiles.count()
    return mining.kmeans(mining.cluster_features(fact(t)), mining.cluster_count(rows)).assigned


@query(
    "kmeans_checks",
    f"""SELECT count(*) AS filas, greatest(2, least(5, count(*) // 20)) AS k, greatest(2, least(5, count(*) // 20)) AS usados,
 CAST(0 AS BIGINT) AS lejos_de_su_centro, true AS coste_cuadra FROM ({FACT}) WHERE fuente_datos = 'perfiles_habilidades'""",
)
def _(t):
    """Every row lies at its nearest center, all clusters are used and the distances add up to the cost.

    The model states the cost before the last, small move of its centers, which can only lower it.
    """
    found = mining.kmeans(mining.cluster_features(fact(t)), mining.cluster_count(t.profiles.count()))
    axes = [F.col(f"{c}_z") for c in mining.CLUSTER_FEATURES]
    away = [sum((x - F.lit(v)) * (x - F.lit(v)) for x, v in zip(axes, center, strict=True)) for center in found.centers]
    own = F.element_at(F.array(*away), F.col("cluster"))
    return found.assigned.agg(
        F.count(F.lit(1)).alias("filas"),
        F.lit(found.k).cast("long").alias("k"),
        F.count_distinct("cluster").alias("usados"),
        F.count_if(own > F.array_min(F.array(*away)) + 1e-9).alias("lejos_de_su_centro"),
        F.sum(own).between(found.cost * 0.99, found.cost * (1 + 1e-9)).alias("coste_cuadra"),
    )


@query("cluster_profile", f"{WITH_ASSIGNED} {PROFILE}")
def _(t):
    return rounded(mining.cluster_profile(assigned(t)), 2)


REG = f"""SELECT id_registro, inversion_usd, coalesce(duracion_meses, (SELECT median(duracion_meses) FROM k), 0) AS duracion_meses,
 coalesce(satisfaccion_promedio, (SELECT avg(satisfaccion_promedio) FROM k), 0) AS satisfaccion_promedio, participantes AS label FROM k"""
WITH_KNOWN = f"""WITH k AS (SELECT * FROM ({FACT}) WHERE fuente_datos = 'inversiones_tech' AND participantes IS NOT NULL AND inversion_usd IS NOT NULL)"""


@query(
    "regression_table",
    f"{WITH_KNOWN} SELECT id_registro, {r('inversion_usd')} AS inversion_usd, {r('duracion_meses')} AS duracion_meses, {r('satisfaccion_promedio')} AS satisfaccion_promedio, {r('label')} AS label FROM ({REG})",
)
def _(t):
    return rounded(mining.regression_table(fact(t)))


@query(
    "linear_regression",
    f"""{WITH_KNOWN} SELECT {r("regr_slope(label, inversion_usd)", 9)} AS pendiente, {r("regr_intercept(label, inversion_usd)", 4)} AS intercepto,
 {r("regr_r2(label, inversion_usd)")} AS r2 FROM ({REG})""",
)
def _(t):
    line = mining.single_regression(mining.regression_table(fact(t)), "inversion_usd")
    return _rounded_line(line)


def _rounded_line(line):
    return line.select(
        (round_half_even(F.col("pendiente"), 9) + 0.0).alias("pendiente"),
        (round_half_even(F.col("intercepto"), 4) + 0.0).alias("intercepto"),
        (round_half_even(F.col("r2"), 6) + 0.0).alias("r2"),
    )


def _regression(t):
    return mining.random_split(mining.regression_table(fact(t)), "id_registro")


def _linear_predictions(t):
    return mining.fit_linear(_regression(t))[1].select("id_registro", "label", "prediction")


# Least squares of three features on the training rows, each feature made orthogonal to those before it.
LEAST_SQUARES = f"""{WITH_KNOWN}, d AS (SELECT id_registro, inversion_usd AS x1, duracion_meses AS x2, satisfaccion_promedio AS x3, label,
 CAST(CAST('0x' || substr(md5(id_registro), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE < 0.3 AS prueba FROM ({REG})),
 a AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(label) AS my, regr_slope(x2, x1) AS b21, regr_slope(x3, x1) AS b31
 FROM d WHERE NOT prueba),
 e AS (SELECT id_registro, label, prueba, my, x1 - m1 AS u1, x2 - m2 - b21 * (x1 - m1) AS u2, x3 - m3 - b31 * (x1 - m1) AS v3 FROM d, a),
 f AS (SELECT sum(v3 * u2) / sum(u2 * u2) AS b32 FROM e WHERE NOT prueba),
 g AS (SELECT e.*, v3 - b32 * u2 AS u3 FROM e, f),
 h AS (SELECT sum((label - my) * u1) / sum(u1 * u1) AS c1, sum((label - my) * u2) / sum(u2 * u2) AS c2,
 sum((label - my) * u3) / sum(u3 * u3) AS c3 FROM g WHERE NOT prueba)"""


@query(
    "linear_regression_multi",
    f"""{LEAST_SQUARES} SELECT id_registro, {r("label", 4)} AS label, {r("my + c1 * u1 + c2 * u2 + c3 * u3", 4)} AS prediction
 FROM g, h WHERE prueba""",
)
def _(t):
    return rounded(_linear_predictions(t), 4)


@query("rf_regression")
def _(t):
    return mining.regression_scores(mining.fit_forest_regressor(_regression(t))[1])


@query("feature_importance")
def _(t):
    model, _ = mining.fit_forest_regressor(_regression(t))
    return mining.importances(t.spark, mining.REGRESSION_FEATURES, model)


@query(
    "forest_regression_checks",
    f"""{WITH_KNOWN} SELECT count(*) AS filas, CAST(0 AS BIGINT) AS distintas, CAST(50 AS BIGINT) AS arboles, true AS importancias_iguales FROM ({REG})
 WHERE CAST(CAST('0x' || substr(md5(id_registro), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE < 0.3""",
)
def _(t):
    """The table of nodes says of every test row what the model says, and weighs the features alike."""
    model, told = mining.fit_forest_regressor(_regression(t))
    return _against_nodes(t, model, told, mining.REGRESSION_FEATURES)


def _against_nodes(t, model, told, features):
    nodes = settle(model.nodes(t.spark))
    both = mining.score_nodes(told, nodes, features, "por_nodos", MiningLimits.max_depth)
    apart = F.abs(F.col("prediction") - F.col("por_nodos")) > 1e-9 * F.greatest(F.lit(1.0), F.abs("prediction"))
    shares = mining.importances(t.spark, features, model).withColumnRenamed("importancia", "del_modelo")
    shares = shares.join(mining.node_importances(nodes, features), "caracteristica")
    equal = shares.agg(F.coalesce(F.max(F.abs(F.col("importancia") - F.col("del_modelo"))) < 2e-4, F.lit(False))).scalar()
    return both.agg(
        F.count(F.lit(1)).alias("filas"),
        F.count_if(apart | F.col("por_nodos").isNull()).alias("distintas"),
        nodes.agg(F.count_distinct("arbol")).scalar().alias("arboles"),
        equal.alias("importancias_iguales"),
    )


LABELLED = f"""SELECT id_registro, salario_usd, CAST(salario_usd > (SELECT median(salario_usd) FROM ({FACT}) WHERE fuente_datos = 'empleos_tech') AS INT) AS label,
 tecnologia_principal, pais_normalizado, nivel_experiencia FROM ({FACT}) WHERE fuente_datos = 'empleos_tech' AND salario_usd IS NOT NULL"""


@query("median_label", f"SELECT id_registro, salario_usd, label FROM ({LABELLED})")
def _(t):
    return mining.demand_label(fact(t)).select("id_registro", "salario_usd", "label")


def _code(column: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY coalesce({column}, 'Unknown')) - 1 AS INT)"


@query(
    "classifier_table",
    f"""SELECT id_registro, label, {_code("tecnologia_principal")} AS tecnologia_principal, {_code("pais_normalizado")} AS pais,
 {_code("nivel_experiencia")} AS nivel_experiencia FROM ({LABELLED})""",
)
def _(t):
    return mining.classifier_table(fact(t))


HASHED = f"""SELECT id_registro, label, CAST(CAST('0x' || substr(md5(id_registro), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE AS h FROM ({LABELLED})"""


@query("random_split", f"SELECT id_registro, h < 0.3 AS es_prueba FROM ({HASHED})")
def _(t):
    jobs = mining.demand_label(fact(t)).select("id_registro")
    return mining.random_split(jobs, "id_registro")


@query(
    "stratified_split",
    f"""SELECT id_registro, label, h <= cut AS es_prueba FROM ({HASHED}) JOIN
 (SELECT label, quantile_cont(h, 0.3) AS cut FROM ({HASHED}) GROUP BY label) USING (label)""",
)
def _(t):
    jobs = mining.demand_label(fact(t)).select("id_registro", "label")
    return mining.stratified_split(jobs, "id_registro", "label")


def _classification(t):
    return mining.stratified_split(mining.classifier_table(fact(t)), "id_registro", "label")


@query("rf_classifier")
def _(t):
    return mining.classification_scores(mining.fit_forest_classifier(_classification(t))[1])


@query("logistic_regression")
def _(t):
    return mining.classification_scores(mining.fit_logistic(_classification(t))[1])


TESTED = f"""SELECT count(*) FILTER (label = 1) AS positivos, count(*) FILTER (label = 0) AS negativos FROM ({HASHED}) JOIN
 (SELECT label, quantile_cont(h, 0.3) AS cut FROM ({HASHED}) GROUP BY label) USING (label) WHERE h <= cut"""


@query("classifier_checks", f"SELECT modelo, t.* FROM ({TESTED}) t, (VALUES ('bosque'), ('logistica')) m(modelo)")
def _(t):
    """Both models judge every test row of both labels."""
    table = settle(_classification(t))
    scores = {
        "bosque": mining.classification_scores(mining.fit_forest_classifier(table)[1]),
        "logistica": mining.classification_scores(mining.fit_logistic(table)[1]),
    }
    right = F.col("verdaderos_positivos") + F.col("falsos_negativos")
    wrong = F.col("falsos_positivos") + F.col("verdaderos_negativos")
    rows = [s.select(F.lit(m).alias("modelo"), right.alias("positivos"), wrong.alias("negativos")) for m, s in scores.items()]
    return rows[0].unionByName(rows[1])


@query(
    "forest_classifier_checks",
    f"SELECT positivos + negativos AS filas, CAST(0 AS BIGINT) AS distintas, CAST(50 AS BIGINT) AS arboles, true AS importancias_iguales FROM ({TESTED})",
)
def _(t):
    """As for the regression forest: every test row, by the nodes and by the model."""
    model, told = mining.fit_forest_classifier(_classification(t))
    return _against_nodes(t, model, told, mining.CLASSIFIER_FEATURES)


PREDICTED = f"""SELECT label, CASE WHEN nivel_experiencia = 'Senior' OR salario_usd > 70000 THEN 1 ELSE 0 END AS prediction FROM ({LABELLED})"""


@query(
    "evaluate_predictions",
    f"""SELECT *, CASE WHEN precision > 0.8 THEN 'Alta' WHEN precision > 0.6 THEN 'Media' ELSE 'Baja' END AS calidad FROM (
 SELECT {r("avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END)")} AS precision,
 count(*) FILTER (label = 1 AND prediction = 1) AS verdaderos_positivos, count(*) FILTER (label = 0 AND prediction = 1) AS falsos_positivos,
 count(*) FILTER (label = 1 AND prediction = 0) AS falsos_negativos, count(*) FILTER (label = 0 AND prediction = 0) AS verdaderos_negativos
 FROM ({PREDICTED}))""",
)
def _(t):
    guess = F.when((F.col("nivel_experiencia") == "Senior") | (F.col("salario_usd") > 70000), 1).otherwise(0)
    return rounded(mining.classification_scores(mining.demand_label(fact(t)).withColumn("prediction", guess)))


@query(
    "evaluate_regression",
    f"""{WITH_KNOWN} SELECT {r("r2")} AS r2_score, CASE WHEN r2 > 0.7 THEN 'Alta' WHEN r2 > 0.5 THEN 'Media' ELSE 'Baja' END AS precision FROM (
 SELECT 1 - sum((label - p) * (label - p)) / (var_pop(label) * count(*)) AS r2 FROM (SELECT label, 5 + inversion_usd / 2500 AS p FROM ({REG})))""",
)
def _(t):
    guess = F.lit(5) + F.col("inversion_usd") / 2500
    return rounded(mining.regression_scores(mining.regression_table(fact(t)).withColumn("prediction", guess)))


@query("mining_summary")
def _(t):
    rows = fact(t).persist()
    try:
        return mining.mining_summary(t.spark, mining.run_analyses(rows))
    finally:
        rows.unpersist()
