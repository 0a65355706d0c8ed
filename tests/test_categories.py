import importlib

import pytest
from conftest import rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from refillcast import learning as L


def test_numbers_equal_the_indexer(spark):
    """The same numbers as Spark's indexer, for ties, NULL, unseen labels and two columns."""
    data = [("b", "x"), ("a", "x"), ("c", None), ("c", "z"), (None, "y"), ("a", "x"), ("d", "q")]
    df = spark.createDataFrame(data, "color string, size string").repartition(3)
    cols = ["color", "size"]
    numbers = L.number_categories(df, cols)
    new = df.unionByName(spark.createDataFrame([("new", "x")], df.schema))
    ours = L.index_rows(new, numbers, cols)
    theirs = L.index_categories(cols).fit(df).transform(new)
    names = [*cols, "color__index", "size__index"]
    assert rows(ours, *names) == rows(theirs, *names)
    encode = lambda frame: rows(L.one_hot(cols).fit(frame).transform(frame).select(
        *cols, *[vector_to_array(f"{c}__encoded").cast("string") for c in cols]))
    assert encode(ours) == encode(theirs)
    assert L.category_sizes(numbers, [*cols, "none"]) == {"color": 4, "size": 4, "none": 0}


def test_no_labels(spark):
    df = spark.createDataFrame([(None,), (None,)], "color string")
    numbers = L.number_categories(df, ["color"])
    assert numbers.collect() == []
    assert rows(L.index_rows(df, numbers, ["color"]), "color__index") == [(0.0,), (0.0,)]


def test_very_many_labels_stay_off_the_driver(spark, monkeypatch):
    """200,000 labels in one column: dense numbers by falling frequency, and what is collected is one row a column."""
    n, seen = 200_000, []
    kind = type(spark.range(1))
    collect = kind.collect

    def watched(self):
        got = collect(self)
        seen.append(len(got))
        return got

    monkeypatch.setattr(kind, "collect", watched)
    df = spark.range(n + 500).select(F.concat(F.lit("label "), F.least("id", F.lit(n - 1))).alias("color"))
    numbers = L.number_categories(df, ["color"])
    indexed = L.index_rows(df, numbers, ["color"])
    encoded = L.one_hot(["color"]).fit(indexed).transform(indexed)
    got = numbers.agg(F.count(F.lit(1)), F.countDistinct("number"), F.min("number"), F.max("number")).first()
    assert tuple(got) == (n, n, 0, n - 1)
    assert numbers.where("number = 0").first()["value"] == f"label {n - 1}"
    assert encoded.where("color = 'label 0'").first()["color__encoded"].size == n
    after = numbers.where("number in (1, 2, 199999)").orderBy("number").select("value")
    assert max(seen) == 1 and [r[0] for r in collect(after)] == ["label 0", "label 1", "label 99999"]


def test_report_is_the_same_with_and_without_numbers(spark):
    df = spark.range(90).selectExpr(
        "id", "element_at(array('red', 'blue', 'green'), cast(id % 3 + 1 as int)) as color", "id % 7 / 7 as x",
        "id % 3 + id % 7 / 70 as y")
    spec = L.ElasticNetSpec(
        label="y", cat_features=["color"], num_features=["x"], log_transform=False, elastic_net_param=(0.0,),
        reg_param=(0.001,), top_features=3, folds=3, row_key=("id",))
    fitted = L.fit_replenishment_model(df, spec)
    model = L.preprocess(["color"], ["x"], "y", "minmax", 3).fit(df)
    plain = L.feature_dictionary(model, model.transform(df), ["color"], ["x"], False)
    names = ["feature_id", "feature_name", "orig_feature_name", "feature_type", "min", "max"]
    assert rows(fitted.report, *names) == rows(plain, *names)
    assert fitted.report.where("is_selected = 1").count() == 3
    again = fitted.preprocessing.transform(L.index_rows(df, fitted.categories, ["color"]))
    assert pytest.approx(L.evaluate(L.predict(fitted.cv_model, again), "y")) == L.evaluate(L.predict(fitted.cv_model, fitted.data), "y")


def fit_of(spark):
    df = spark.range(90).selectExpr(
        "id", "element_at(array('red', 'blue', 'green'), cast(id % 3 + 1 as int)) as color", "id % 7 / 7 as x",
        "id % 3 + id % 7 / 70 as y", *[f"id as other{i}" for i in range(40)])
    spec = L.ElasticNetSpec(
        label="y", cat_features=["color"], num_features=["x"], log_transform=False, elastic_net_param=(0.0,),
        reg_param=(0.001,), top_features=3, folds=3, row_key=("id",))
    return df, L.fit_replenishment_model(df, spec)


def test_fits_read_a_written_table_of_the_features_alone(spark, monkeypatch):
    """No scan of the fits joins the labels' numbers again, and the result keeps every column."""
    model, seen = importlib.import_module("refillcast.learning.elastic_net"), []
    validate = model.cross_validate
    monkeypatch.setattr(model, "cross_validate", lambda df, *rest: seen.append(df) or validate(df, *rest))
    df, fitted = fit_of(spark)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "__encoded" not in plan and "other0" not in plan
    assert set(df.columns) <= set(fitted.data.columns) and fitted.data.count() == 90
    names = ["fold", "y"]
    vector = vector_to_array("selected_features").cast("string").alias("v")
    assert rows(seen[0].select(*names, vector)) == rows(fitted.data.select(*names, vector))


def test_rows_go_through_the_joins_in_few_columns(spark):
    df, fitted = fit_of(spark)
    odd = df.withColumnRenamed("other0", "a.b").withColumn("color", F.when(F.col("id") % 5 > 0, F.col("color")))
    indexed = L.index_rows(odd, fitted.categories, ["color"])
    assert indexed.columns == [*odd.columns, "color__index"]
    assert rows(indexed.select("id", "`a.b`", "other39", "color")) == rows(odd.select("id", "`a.b`", "other39", "color"))
    top, wide = indexed._jdf.queryExecution().optimizedPlan(), []
    while not top.children().isEmpty():
        if "Join" in top.nodeName():
            wide.append(top.output().size())
        top = top.children().head()
    assert wide and max(wide) < 10
