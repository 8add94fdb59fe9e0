"""Hand-made frames: nulls, ties, constants, empty tables and values on the edges."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions import bands, text
from millrace.functions.dates import parse_date
from millrace.functions.numbers import parse_currency, round_half_even
from millrace.operators import clean, marts, measures, mining, transform, validate, warehouse


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


# -- expressions --------------------------------------------------------------------------


def test_clean_text(spark):
    values = ["  a \t b c ", "nan", " nan ", "", None, "x\n\ny", "a\x1cb"]
    assert column(spark, values, "string", text.clean_text) == ["a b c", None, None, "", None, "x y", "a b"]


def test_title_case_follows_letters(spark):
    values = ["node.js o'neil", "SAN josé", "3d maps", "ñandú-x", None, "", "plain words", "a1b2", "o''x", " straße", "ÁREA  x"]
    assert column(spark, values, "string", text.title_case) == [v.title() if v is not None else None for v in values]


def test_word_count(spark):
    values = ["", " ", "a", " a  b\tc ", "é è", None]
    assert column(spark, values, "string", text.word_count) == [0, 0, 1, 3, 2, None]


def test_keywords_are_substrings(spark):
    hit = lambda k: (lambda c: text.has_keyword(c, k))
    assert column(spark, ["JavaScript", "email", None], "string", hit("java")) == [True, False, False]
    assert column(spark, ["JavaScript", "email", None], "string", hit("ai")) == [False, True, False]


def test_currency(spark):
    values = ["USD 80240", "US$ 89.522", "$110,022", "93157", "€ -5", "???", "1.2.3", "", None]
    want = [80240.0, 89.522, 110022.0, 93157.0, -5.0, None, None, None, None]
    assert column(spark, values, "string", parse_currency) == want
    grouped = column(spark, ["US$ 89.522", "1.234.567", "3.5"], "string", lambda c: parse_currency(c, "."))
    assert grouped == [89522.0, 1234567.0, 3.5]


def test_emails(spark):
    values = [" A.b@Mail.COM ", "a@b", "no", "x@y.io", None, "a b@c.de"]
    assert column(spark, values, "string", text.email_or_null) == ["a.b@mail.com", None, None, "x@y.io", None, None]


def test_dates(spark):
    values = ["2024-02-29", "29/02/2024", "2024/03/01", "2023-02-29", "soon", None]
    got = column(spark, values, "string", lambda c: parse_date(c).cast("date").cast("string"))
    assert got == ["2024-02-29", "2024-02-29", "2024-03-01", None, None, None]


def test_rounding_as_numpy(spark):
    values = [0.125, 0.375, 1.005, 2.5, -0.125, None]
    want = [0.12, 0.38, 1.0, 2.5, -0.12, None]
    assert column(spark, values, "double", lambda c: round_half_even(c, 2)) == want


@pytest.mark.parametrize("lowest", [False, True])
def test_bands_match_pandas_cut(spark, lowest):
    b = bands.SALARY_RANGE
    values = [-1.0, 0.0, 0.01, 50_000.0, 50_000.01, 75_000.0, 100_000.0, 150_000.0, 1e12, None]
    want = pd.cut(pd.Series(values), list(b.edges), labels=list(b.labels), include_lowest=lowest)
    got = column(spark, values, "double", lambda c: bands.band(c, b, lowest))
    assert got == [None if pd.isna(v) else v for v in want]


def test_band_definitions_are_checked():
    with pytest.raises(ValueError):
        bands.Bands((0, 1), ("a", "b"))
    with pytest.raises(ValueError):
        bands.Bands((0, 0, 1), ("a", "b"))


# -- cleaning -----------------------------------------------------------------------------


def test_full_row_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (1, "a"), (2, "a")], "a int, b string")
    assert clean.drop_duplicates(df).count() == 3
    assert clean.duplicate_counts(df).first().asDict() == {"rows_in": 5, "rows_out": 3, "removed": 2}


def test_subset_duplicates_keep_the_first(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("x", 5), ("x", 4)], "k string, o int")
    rows = clean.drop_duplicates(df, ["k"], [F.col("o")]).collect()
    assert {(r["k"], r["o"]) for r in rows} == {(None, 1), ("x", 4)}
    with pytest.raises(ValueError):
        clean.drop_duplicates(df, ["k"])


def test_mode_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "x string")
    assert clean.fill_missing(df, {"x": "mode"}).where("x = 'a'").count() == 3


def test_statistics_follow_the_column_order(spark):
    """Rows dropped for an earlier column do not count in the mean of a later one."""
    df = spark.createDataFrame([(None, 100.0, 100.0), (1, 2.0, 2.0), (2, None, None)], "b int, c double, a double")
    first = clean.fill_missing(df.select("a", "b"), {"a": "mean", "b": "drop"}).where("b = 2").first()
    assert first["a"] == 51.0
    later = clean.fill_missing(df.select("b", "c"), {"b": "drop", "c": "mean"}).where("b = 2").first()
    assert later["c"] == 2.0


def test_numeric_strategies_leave_text_alone(spark):
    df = spark.createDataFrame([("1",), (None,)], "x string")
    for s in ("mean", "median", "zero"):
        assert clean.fill_missing(df, {"x": s}).where("x IS NULL").count() == 1
    with pytest.raises(ValueError):
        clean.fill_missing(df, {"x": "guess"})


def test_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "i int, x double")
    for s in ("mean", "median", "mode"):
        assert clean.fill_missing(df, {"x": s}).where("x IS NULL").count() == 2


def test_outliers(spark):
    df = spark.createDataFrame([(1.0, 7, "t")] * 30 + [(500.0, 7, "t")], "x double, c int, s string")
    got = clean.null_outliers(df, ["x", "c", "s", "absent"])
    assert got.where("x IS NULL").count() == 1
    assert got.where("c IS NULL").count() == 0
    one = spark.createDataFrame([(1.0,)], "x double")
    assert clean.null_outliers(one, ["x"]).first()["x"] == 1.0


def test_categories_off_the_list(spark):
    df = spark.createDataFrame([("full TIME",), ("other",), (None,)], "x string")
    rows = [r[0] for r in clean.clean_categories(df, "x", ["Full Time"]).collect()]
    assert rows == ["Full Time", "Other", "Other"]
    assert [r[0] for r in clean.clean_categories(df, "x").collect()] == ["Full Time", "Other", None]


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double, s string, e string")
    config = {"missing_strategy": {"x": "median", "s": "mode"}, "numeric_columns": ["x"], "text_columns": ["s"], "email_columns": ["e"]}
    assert clean.clean_frame(df, config).count() == 0
    assert clean.null_profile(df).where("null_count = 0 AND null_pct IS NULL").count() == 3


# -- transformation -----------------------------------------------------------------------


def test_names():
    assert [transform.normalized_name(n) for n in ("Área_Tecnológica", " Inversión (USD) ", "_A  b_")] == [
        "área_tecnológica", "inversión_usd", "a_b",
    ]


def test_name_collisions_raise(spark):
    with pytest.raises(ValueError):
        transform.normalize_names(spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int"))


def test_one_hot_and_labels(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "x string")
    rows = transform.label_encode(transform.one_hot(df, "x"), "x").collect()
    got = {r["x"]: (r["x_b"], r["x_c"], r["x_encoded"]) for r in rows}
    assert got == {"a": (False, False, 0), "b": (True, False, 1), "c": (False, True, 2), None: (False, False, -1)}
    with pytest.raises(ValueError):
        transform.categories(df, "x", 2)


def test_label_codes_of_several_columns(spark):
    df = spark.createDataFrame([("b", 2, "x"), ("a", 10, None), (None, 9, "y")], "s string, n int, u string")
    rows = transform.label_encode_all(df, {"s": "cs", "n": "cn", "u": "cu"}).orderBy("n").collect()
    assert [(r["cs"], r["cn"], r["cu"]) for r in rows] == [(1, 0, 0), (-1, 1, 1), (0, 2, -1)]


def test_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    for method in ("min_max", "z_score", "robust"):
        assert transform.scale(df, ["x"], method).where("x_normalized IS NOT NULL").count() == 0
    binned = [r[0] for r in transform.bin_equal_width(df, "x", 5).select("x_binned").collect()]
    assert binned == [2, 2, None]


@pytest.mark.parametrize("bins", [2, 3, 7])
def test_bins_match_pandas(spark, bins):
    values = [1.0, 1.0, 2.0, 3.5, 4.0, 4.0, 4.0, 9.0, 10.0, 2.5, 7.25]
    series = pd.Series(values)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    width = [r[0] for r in transform.bin_equal_width(df, "x", bins).orderBy("i").select("x_binned").collect()]
    assert width == pd.cut(series, bins, labels=False, include_lowest=True).tolist()
    quant = [r[0] for r in transform.bin_quantile(df, "x", bins).orderBy("i").select("x_binned").collect()]
    assert quant == pd.qcut(series, bins, labels=False, duplicates="drop").tolist()


def test_quantile_labels_must_fit(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (2.0,)], "x double")
    with pytest.raises(Exception, match="labels and quantile bins differ"):
        transform.bin_quantile(df, "x", 4, list("abcd")).collect()


LEFT = [(1, "a", 10), (None, "b", 11), (2, "c", 12), (2, "d", 13)]
RIGHT = [(2, "x", 20), (None, "y", 21), (3, "z", 22)]


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer", "cross"])
def test_merge_matches_pandas(spark, how):
    left = spark.createDataFrame(LEFT, "k int, v string, l int")
    right = spark.createDataFrame(RIGHT, "k int, v string, r int")
    pl, pr = pd.DataFrame(LEFT, columns=["k", "v", "l"]), pd.DataFrame(RIGHT, columns=["k", "v", "r"])
    if how == "cross":
        got, want = transform.merge(left, right, how=how), pl.merge(pr, how="cross")
    else:
        got, want = transform.merge(left, right, "k", "k", how), pl.merge(pr, left_on="k", right_on="k", how=how)
    assert got.columns == list(want.columns)
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in want.itertuples(index=False)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [tuple(int(v) if isinstance(v, float) else v for v in r) for r in rows], key=repr
    )


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_merge_deals_hot_keys_over_tasks(spark, how, monkeypatch):
    """Pairs of a key with many rows on both sides, null and equal rows included, come from many tasks and are all there once."""
    monkeypatch.setattr(transform, "PAIRS_PER_BLOCK", 500, raising=False)
    many = [(None, "n", i % 40) for i in range(200)] + [(7, "s", 1)] * 60 + [(1, "a", i) for i in range(30)]
    left = [*many, (2, "c", 12), (3, "only", 1)]
    right = [(None, "r", i) for i in range(90)] + [(7, "t", 2)] * 50 + [(1, "b", 5), (2, "x", 20), (4, "z", 22)]
    dl, dr = spark.createDataFrame(left, "k int, v string, l int"), spark.createDataFrame(right, "k int, v string, r int")
    got = transform.merge(dl, dr, "k", "k", how).withColumn("task", F.spark_partition_id()).toPandas()
    want = pd.DataFrame(left, columns=["k", "v", "l"]).merge(pd.DataFrame(right, columns=["k", "v", "r"]), on="k", how=how)
    pd.testing.assert_series_equal(
        got.drop(columns="task").astype("object").fillna("-").value_counts().sort_index(),
        want.astype("object").fillna("-").value_counts().sort_index(),
    )
    for some in (got["k"].isna(), got["k"] == 7):
        assert got[some].groupby("task").size().max() < 0.6 * some.sum()


def test_ids_of_periods_are_counted_in_many_tasks(spark):
    """Dated rows of one file are dealt over tasks, so that none holds all distinct ids; frequent ids are dealt, too."""
    rows = spark.range(20_000, numPartitions=1).select(
        F.expr("make_date(2020 + cast(id % 2 as int), 1 + cast(id % 12 as int), 1)").alias("d"), F.lit(1.0).alias("salario_usd"),
        F.lit(30.0).alias("edad"), F.when(F.col("id") % 2 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("id_registro"),
    )
    counts = marts._period_counts(rows, "d", [["__year"], ["__year", "__quarter"]])
    assert "RoundRobinPartitioning" in counts._jdf.queryExecution().executedPlan().toString()
    got = {r["Periodo"]: r["Registros_Unicos"] for r in marts.period_table(rows, "d").collect()}
    assert got["Año 2020"] == 1 and got["Año 2021"] == 10_000 and got["Q4-2021"] == 3332


def test_merge_on_different_names(spark):
    left = spark.createDataFrame(LEFT, "a int, v string, l int")
    right = spark.createDataFrame(RIGHT, "b int, v string, r int")
    got = transform.merge(left, right, "a", "b", "outer")
    assert got.columns == ["a", "v_x", "l", "b", "v_y", "r"]
    assert got.count() == 5


def test_merge_without_keys_and_without_null_keys(spark):
    left = spark.createDataFrame([(1, "x"), (None, "y")], "k int, l string")
    right = spark.createDataFrame([(1, 5), (None, 6)], "k int, r int")
    assert sorted(transform.merge(left, right).collect(), key=str) == [(1, "x", 5), (None, "y", 6)]
    assert transform.merge(left, right, null_keys=False).collect() == [(1, "x", 5)]


def test_pivot_of_several_functions_and_a_name_with_a_point(spark):
    rows = [("r", "c1", 1, 1.0), ("r", "c1", 2, 5.0), ("r", "c1", 3, 9.5), ("r", "c2", 1, None)]
    df = spark.createDataFrame(rows, "i string, c string, o int, `v.x` double")
    got = transform.pivot(df, "i", "c", "v.x", ["median", "first", "last"], ["c1", "c2"], order_by="o").first().asDict()
    assert got == {"i": "r", "median_v.x_c1": 5.0, "median_v.x_c2": 0.0, "first_v.x_c1": 1.0, "first_v.x_c2": 0.0, "last_v.x_c1": 9.5, "last_v.x_c2": 0.0}
    assert "a.b_y" in transform.one_hot(df.sparkSession.createDataFrame([("x",), ("y",)], "`a.b` string"), "a.b").columns


def test_nan_is_a_gap(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    assert [r[0] for r in clean.fill_missing(df, {"x": "mean"}).collect()] == [1.0, 2.0, 2.0, 3.0]
    wide = spark.createDataFrame([(float(i % 2),) for i in range(40)] + [(1e6,), (float("nan"),)], "x double")
    assert [r[0] for r in clean.null_outliers(wide, ["x"]).collect()].count(None) == 2
    assert transform.add_band(df, "x", bands.SALARY_RANGE, "b").where("x = double('NaN')").first()["b"] is None


def test_iso_date_times(spark):
    texts = ["2024-11-16 10:30:00", "2024-11-16T10:30:00Z", "2024-1-5", "2024-11-16T12:30:00+0200", "2024-13-01 00:00:00", "soon"]
    got = clean.standardize_dates(spark.createDataFrame([(t,) for t in texts], "d string"), ["d"]).select(F.date_format("d", "yyyy-MM-dd HH:mm"))
    assert [r[0] for r in got.collect()] == ["2024-11-16 10:30", "2024-11-16 10:30", "2024-01-05 00:00", "2024-11-16 10:30", None, None]


def test_itemsets_of_three(spark):
    baskets = spark.createDataFrame([(i, ["a", "b", "c"]) for i in range(12)], "id int, items array<string>")
    got = {tuple(r["items"]): r["frecuencia"] for r in mining.frequent_itemsets(baskets, 0.5).collect()}
    assert got == dict.fromkeys([("a",), ("b",), ("c",), ("a", "b"), ("a", "c"), ("b", "c"), ("a", "b", "c")], 12)


def test_aggregate_names_and_nulls(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), (None, 3, 9.0), ("b", 4, None)], "k string, o int, x double")
    got = transform.aggregate(df, ["k"], {"x": ["sum", "first", "size"], "o": "max"}, [F.col("o")])
    rows = {r["k"]: r.asDict() for r in got.collect()}
    assert rows["a"] == {"k": "a", "x_sum": 1.0, "x_first": 1.0, "x_size": 2, "o_max": 2}
    assert rows["b"] == {"k": "b", "x_sum": 0.0, "x_first": None, "x_size": 1, "o_max": 4}
    assert transform.aggregate(df, ["k"], {"x": "mean"}).columns == ["k", "x"]
    with pytest.raises(ValueError):
        transform.aggregate(df, ["absent"], {"x": "mean"})


def test_pivot_matches_pandas(spark):
    rows = [("r1", "c1", 1.0), ("r1", "c2", None), ("r1", "c1", 4.0), ("r2", "c2", 7.0), (None, "c1", 1.0), ("r3", "c1", None)]
    frame = pd.DataFrame(rows, columns=["i", "c", "v"])
    want = frame.pivot_table(index="i", columns="c", values="v", aggfunc="mean", fill_value=0).reset_index()
    got = transform.pivot(spark.createDataFrame(rows, "i string, c string, v double"), "i", "c", "v")
    assert got.columns == list(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.itertuples(index=False)))


# -- validation ---------------------------------------------------------------------------


def test_report_verdicts(spark):
    df = spark.createDataFrame([(i, None if i % 2 else 1.0) for i in range(200)], "id int, x double")

    def verdict(config):
        return validate.validation_report(df, config).where("part = 'overall'").first()["status"]

    assert verdict({"required_columns": ["id"]}) == "passed"
    assert verdict({}) == "warning"
    assert verdict({"required_columns": ["gone", "x"]}) == "failed"
    assert verdict({"required_columns": ["id"], "schema": {"id": "int64"}}) == "passed"
    assert verdict({"required_columns": ["id"], "schema": {"id": "int64", "gone": "string"}}) == "failed"
    rule = {"type": "range", "column": "id", "min": 0, "max": 198}
    assert verdict({"required_columns": ["id"], "business_rules": {"r": rule}}) == "failed"
    assert verdict({"required_columns": ["id"], "business_rules": {"r": {**rule, "column": "gone"}}}) == "passed"


def test_report_reads_the_table_once(spark):
    """All checks share one aggregate; the other scan is the duplicate count."""
    df = spark.range(1000).selectExpr("id", "id % 7 AS age")
    plan = validate.validation_report(df, {})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 1000") == 2


def test_rules_refuse_unknown_operators(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        validate.rule_checks(df, {"r": {"type": "relationship", "column1": "a", "column2": "b", "operator": "~"}})
    with pytest.raises(ValueError):
        validate.rule_checks(df, {"r": {"type": "odd", "column": "a"}})


def test_a_rule_that_cannot_be_evaluated_does_not_stop_the_others(spark):
    df = spark.createDataFrame([("abc", 1), ("7", 9)], "t string, n int")
    rules = {
        "text": {"type": "range", "column": "t", "min": 1, "max": 5},
        "sides": {"type": "relationship", "column1": "t", "column2": "n"},
        "codes": {"type": "categorical", "column": "t", "valid_values": [7]},
    }
    report = validate.validation_report(df, {"business_rules": rules, "required_columns": []})
    got = {r["check"]: (r["status"], r["value"]) for r in report.where("part = 'rules'").collect()}
    assert got == {"text": ("error", None), "sides": ("error", None), "codes": ("failed", 2.0)}
    assert validate.rules_status(report).first()["status"] == "failed"
    only = validate.validation_report(df, {"business_rules": {"text": rules["text"]}})
    assert validate.rules_status(only).first()["status"] == "error"
    assert only.where("part = 'overall'").first()["status"] == "passed"


def test_checks_on_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, price double, hire_date timestamp")
    statuses = {r["check"]: r["status"] for r in validate.validation_report(df, {}).where("part = 'quality'").collect()}
    assert statuses["min_rows"] == "failed"
    assert statuses["negative"] == statuses["large"] == statuses["duplicates"] == "passed"


@pytest.mark.parametrize("score,band", [(90.01, "EXCELENTE"), (90.0, "BUENO"), (80.0, "REGULAR"), (70.0, "NECESITA_MEJORA")])
def test_quality_bands(spark, score, band):
    assert spark.range(1).select(validate.quality_band(F.lit(score))).first()[0] == band


# -- warehouse, tables, measures ----------------------------------------------------------


def test_accent_folding_finds_the_columns(spark):
    from datetime import datetime

    people = spark.createDataFrame([("p", 4.0, "Perú")], "id_persona string, `años_experiencia` double, `país` string")
    for fold, want in ((True, 4.0), (False, None)):
        row = warehouse.map_source(people, warehouse.PROFILES_SOURCE, datetime(2024, 1, 1), fold).first()
        assert (row["anos_experiencia"], row["pais"], row["fuente_datos"]) == (want, "Perú", "perfiles_habilidades")


def test_empty_bands_are_listed(spark):
    df = spark.createDataFrame([("<50K",), (None,)], "b string")
    rows = warehouse.band_distribution(df, "b", bands.SALARY_RANGE).collect()
    assert {r["banda"]: r["registros"] for r in rows}["150K+"] == 0 and len(rows) == 5


def test_no_salaries_give_zero(spark):
    df = spark.createDataFrame([(None,)], "salario_usd double")
    assert tuple(warehouse.salary_metrics(df).first()) == (0, 0.0, 0.0)


def test_rank_with_ties_and_missing_salary(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", None), ("c", 9.0), ("d", 5.0)], "c string, Salario_Promedio double")
    assert {r["c"]: r["Ranking_Salario"] for r in marts.add_salary_rank(df).collect()} == {"c": 1, "a": 2, "d": 2, "b": 3}


@pytest.mark.parametrize("salary,band", [(80_000.0, "Premium"), (79_999.9, "Alto"), (25_000.0, "Medio"), (0.0, "Emergente"), (None, "Emergente")])
def test_cluster_bands(spark, salary, band):
    assert spark.range(1).select(marts.cluster_band(F.lit(salary).cast("double"))).first()[0] == band


def test_growth_needs_the_month_before(spark):
    df = spark.createDataFrame([("2024-01-05", 1), ("2024-02-01", 2), ("2024-02-09", 3), ("2024-04-01", 4)], "d string, i int")
    rows = measures.monthly_growth(df.withColumn("d", F.to_timestamp("d")), "d", "i").orderBy("mes").collect()
    assert [(r["registros"], r["tasa_crecimiento"]) for r in rows] == [(1, None), (2, 1.0), (1, None)]


# -- mining -------------------------------------------------------------------------------


def test_rules_of_known_baskets(spark):
    rows = [(i, ["lang_a", "fw_x"]) for i in range(6)] + [(i, ["lang_a"]) for i in range(6, 8)] + [(8, ["fw_x"]), (9, ["fw_y"])]
    items = mining.frequent_itemsets(spark.createDataFrame(rows, "id_registro int, items array<string>"))
    assert {(tuple(r["items"]), r["frecuencia"]) for r in items.collect()} == {
        (("lang_a",), 8), (("fw_x",), 7), (("fw_y",), 1), (("fw_x", "lang_a"), 6),
    }
    found = {(r["si_usa"], r["entonces_usa"]): (r["confianza"], r["soporte"]) for r in mining.association_rules(items).collect()}
    assert found == {("lang_a", "fw_x"): (0.75, 0.6), ("fw_x", "lang_a"): (6 / 7, 0.6)}


def test_grades(spark):
    got = spark.createDataFrame([(0.8,), (0.81,), (0.6,), (0.61,)], "a double").select(
        mining.grade(F.col("a"), mining.ACCURACY_GRADES)
    )
    assert [r[0] for r in got.collect()] == ["Media", "Alta", "Baja", "Media"]


def test_stratified_split_keeps_shares(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    rows = mining.stratified_split(df, "id", "label").groupBy("label").agg(F.avg(F.col("es_prueba").cast("int")).alias("s")).collect()
    assert len(rows) == 2 and all(math.isclose(r["s"], 0.3, abs_tol=0.003) for r in rows)


def test_small_tables_are_reported(spark):
    from datetime import datetime

    empty = [spark.createDataFrame([], f"{k} string") for k in ("id_oferta", "id_programa", "id_persona")]
    fact = warehouse.build_fact(*empty, datetime(2024, 1, 1))
    results = mining.run_analyses(fact)
    assert results["resumen_ejecucion"]["analisis_exitosos"] == 0
    assert all("error" in r for r in results["analisis_realizados"].values())
