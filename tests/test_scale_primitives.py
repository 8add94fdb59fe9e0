"""Quantiles, ranks and forward fill against brute force on skewed fixtures."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import quantiles, slices


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds two thirds of the rows, one value a third of them; some nulls."""
    rng = np.random.default_rng(7)
    n = 30_000
    frame = pd.DataFrame(
        {
            "id": np.arange(n),
            "k": rng.choice(["hot", "a", "b", None], n, p=[0.66, 0.2, 0.1, 0.04]),
            "x": np.where(rng.random(n) < 0.33, 5.0, np.round(rng.lognormal(3, 2, n), 2)),
        }
    )
    frame.loc[rng.random(n) < 0.1, "x"] = None
    return frame


def _spark_frame(spark, frame):
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]
    rows = [(int(i), k, None if x is None else float(x)) for i, k, x in rows]
    return spark.createDataFrame(rows, "id long, k string, x double").repartition(6)


@pytest.mark.parametrize("accuracy", [500, 100_000])
def test_table_quantiles_are_exact(spark, skewed, accuracy):
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = _spark_frame(spark, skewed)
    got = quantiles.quantile_table(df, ["x", "id"], probs, accuracy=accuracy).collect()
    assert {r["column"] for r in got} == {"x", "id"}
    for r in got:
        np.testing.assert_allclose(r["q"], skewed[r["column"]].quantile(probs), rtol=1e-12)
        assert r["n"] == skewed[r["column"]].notna().sum()


@pytest.mark.parametrize("accuracy", [500, 100_000])
def test_group_quantiles_are_exact(spark, skewed, accuracy):
    df = _spark_frame(spark, skewed)
    got = quantiles.quantile_table(df, ["x"], [0.25, 0.5, 0.75], keys=["k"], accuracy=accuracy).collect()
    want = skewed.assign(k=skewed["k"].fillna("<null>")).groupby("k")["x"].quantile([0.25, 0.5, 0.75]).unstack()
    assert len(got) == len(want) == 4
    for r in got:
        np.testing.assert_allclose(r["q"], want.loc[r["k"] or "<null>"], rtol=1e-12)


def test_brackets_send_few_values(spark):
    df = spark.range(400_000).select((F.xxhash64("id") % 1_000_000_007).cast("double").alias("x"))
    b = quantiles._brackets(df, ["x"], [], [0.5], 10_000).first()
    inside = df.where(F.col("x").between(b["lo0"], b["hi0"])).count()
    assert inside <= 400_000 * 10 / 10_000


@pytest.mark.parametrize("rows", [30_000, 120_000])
def test_last_window_is_bounded(spark, monkeypatch, rows):
    """However many rows there are, the last window orders at most ``limit`` rows of a group."""
    seen = []
    picked = quantiles._picked

    def watched(counts, group, probs):
        seen.append(quantiles._largest(counts, group))
        return picked(counts, group, probs)

    monkeypatch.setattr(quantiles, "_picked", watched)
    frame = pd.DataFrame({"k": np.arange(rows) % 3, "x": np.random.default_rng(rows).lognormal(0, 3, rows)})
    frame["k"] = frame["k"].clip(upper=1)
    df = spark.createDataFrame(frame)
    probs = [0.0, 0.25, 0.5, 1.0]
    for keys in ([], ["k"]):
        got = quantiles.quantile_table(df, ["x"], probs, keys, accuracy=50, limit=2_500).collect()
        for r in got:
            want = frame[frame["k"] == r["k"]] if keys else frame
            np.testing.assert_allclose(r["q"], want["x"].quantile(probs), rtol=1e-12)
        assert len(got) == (2 if keys else 1)
    assert max(seen) <= 2_500


def test_missed_brackets_widen(spark, skewed):
    df = _spark_frame(spark, skewed)
    probs = [0.1, 0.5, 0.9]
    got = quantiles.quantile_table(df, ["x", "id"], probs, accuracy=50, slack=0.0).collect()
    for r in got:
        np.testing.assert_allclose(r["q"], skewed[r["column"]].quantile(probs), rtol=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "id long, x double")
    assert quantiles.quantile_table(df, ["x"], [0.5]).count() == 0
    assert df.select(quantiles.table_quantiles(df, ["x"], [0.5])["x"].alias("m")).first()["m"] is None


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_forward_fill(spark, skewed, keys):
    df = _spark_frame(spark, skewed)
    got = slices.forward_fill(df, ["x"], [F.col("id")], keys).toPandas().sort_values("id")
    filled = skewed.fillna({"k": "<null>"}).groupby("k")["x"].ffill() if keys else skewed["x"].ffill()
    np.testing.assert_array_equal(got["x"].to_numpy(), filled.to_numpy())


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("dense", [True, False])
def test_rank_within(spark, skewed, keys, dense):
    frame = skewed.dropna()
    df = _spark_frame(spark, frame)
    order = [F.col("x")] if dense else [F.col("x"), F.col("id")]
    got = slices.rank_within(df, order, "r", keys, dense).toPandas().set_index("id")["r"].sort_index()
    base = frame.sort_values(["x", "id"])
    if dense:
        want = base.groupby("k")["x"].rank(method="dense") if keys else base["x"].rank(method="dense")
    elif keys:
        want = base.groupby("k").cumcount() + 1
    else:
        want = pd.Series(np.arange(1, len(base) + 1), index=base.index)
    want.index = base["id"]
    np.testing.assert_array_equal(got.to_numpy(), want.sort_index().to_numpy())


def test_slices_split_the_rows(spark):
    df = spark.range(100_000)
    sizes = slices.with_slice(df, F.struct("id")).groupBy("__slice").count().toPandas()["count"]
    assert 80 <= len(sizes) <= 200
    assert sizes.max() < 100_000 * 0.1


def _largest_slice(df, *order):
    key = F.struct(*order, slices.tie_breaker(df))
    return slices.with_slice(df, key).groupBy("__slice").count().agg(F.max("count")).first()[0]


def test_slices_split_ties_and_hot_ranges(spark):
    tied = spark.range(100_000).select("id", (F.col("id") % 100).alias("day"))
    assert _largest_slice(tied, "day") < 10_000
    # one key holds a third of the rows, all of them on one day
    hot = spark.range(90_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("day"))
    assert _largest_slice(hot, "day") < 9_000


def test_slices_grow_with_the_rows(spark):
    df = spark.range(60_000)
    many = slices.with_slice(df, F.struct("id"), rows_per_slice=100).groupBy("__slice").count().toPandas()["count"]
    assert 450 <= len(many) <= 750 and many.max() < 2_000


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_forward_fill_under_ties(spark, keys):
    """A null takes the last value among the rows before it, in the order of day and row hash."""
    df = spark.range(5_000).select(
        "id", (F.col("id") % 20).alias("day"), (F.col("id") % 3).cast("string").alias("k"),
        F.when(F.col("id") % 4 == 0, F.col("id").cast("double")).alias("x"),
    )
    frame = df.withColumn("tie", slices.tie_breaker(df)).toPandas().sort_values(["day", "tie"])
    want = (frame.groupby("k")["x"] if keys else frame["x"]).ffill().set_axis(frame["id"]).sort_index()
    got = slices.forward_fill(df, ["x"], [F.col("day")], keys).toPandas().set_index("id")["x"].sort_index()
    np.testing.assert_array_equal(got.to_numpy(), want.to_numpy())


def _fill_by_hand(rows):
    """(key, order, value) in order: the last value above, per key."""
    last, out = {}, []
    for k, o, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        last[k] = v if v is not None else last.get(k)
        out.append((k, o, last[k]))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows_per_slice", [20, 10**6])
def test_only_hot_keys_are_cut(spark, rows_per_slice):
    """A key with a third of the rows and a null key are filled like the others."""
    rows = [(0 if i % 3 == 0 else None if i % 7 == 1 else i % 40, i, None if i * 7919 % 5 else i) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, o int, v int").repartition(5)
    filled = slices.forward_fill(df, ["v"], [F.col("o")], ["k"], rows_per_slice)
    assert filled.columns == ["k", "o", "v"]
    assert sorted(map(tuple, filled.collect()), key=str) == _fill_by_hand(rows)
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    assert ("__slice" in plan) == (rows_per_slice == 20)


def test_copies_are_counted_by_digest(spark):
    from millrace.operators import clean, validate

    rows = [("a", 1, 0.0), ("a", 1, -0.0), ("a", None, 1.0), (None, 1, 1.0), ("b", 2, float("nan")), ("b", 2, float("nan")), ("", None, None), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "t string, n int, x double")
    row = clean.duplicate_counts(df).first()
    assert (row["rows_in"], row["rows_out"], row["removed"]) == (9, df.dropDuplicates().count(), 3)
    found = validate.check_duplicates(df)
    assert found.first()["value"] == 3
    exchanged = [line for line in found._jdf.queryExecution().executedPlan().toString().split("\n") if "hashpartitioning" in line]
    assert exchanged and all("__d0" in line and "t#" not in line for line in exchanged)
    with pytest.raises(ValueError):
        clean.duplicate_counts(df.select(F.create_map("t", "n").alias("m")))


def test_pivot_of_medians_holds_no_cell(spark):
    from statistics import median

    from millrace.operators import transform

    rows = [(i % 3, "ab"[i % 2], float(i * 37 % 101) if i % 11 else None, i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, c string, v double, w int")
    wide = transform.pivot(df, "k", "c", ["v", "w"], ["median", "max"], ["a", "b", "none"])
    assert "percentile" not in wide._jdf.queryExecution().optimizedPlan().toString().lower()
    for r in wide.collect():
        for c in "ab":
            own = [x for x in rows if x[0] == r["k"] and x[1] == c]
            assert r[f"median_v_{c}"] == median(x[2] for x in own if x[2] is not None)
            assert r[f"median_w_{c}"] == median(x[3] for x in own)
            assert r[f"max_w_{c}"] == 4
        assert r["median_v_none"] == r["max_v_none"] == 0


def test_invalid_values_stand_in_the_report(spark):
    from millrace.operators import validate

    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 3)], "t string, n int")
    rules = {"r": {"type": "categorical", "column": "t", "valid_values": ["a"]}, "s": {"type": "categorical", "column": "n", "valid_values": [1, 2]}}
    report = validate.validation_report(df, {"business_rules": rules})
    found = {(r["check"], r["column"]): (r["value"], r["pct"]) for r in report.where("part = 'invalid'").collect()}
    assert found == {("r", "b"): (2, 50), ("r", None): (1, 25), ("s", "3"): (2, 50)}
    most = validate.validation_report(df, {"business_rules": rules, "max_invalid_values": 1})
    assert {(r["check"], r["column"]) for r in most.where("part = 'invalid'").collect()} == {("r", "b"), ("s", "3")}
    assert validate.validation_report(df, {}).where("part = 'invalid'").count() == 0
