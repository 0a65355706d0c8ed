import datetime as dt

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import functions as F

from refillcast import learning as L
from refillcast.learning import moments as M
from refillcast.session import fresh_path
from refillcast.sources import save_model

CATS = ["color"]
NUMS = ["x0", "x1", "x2", "x3", "x4"]
SPEC = L.ElasticNetSpec(
    label="y", cat_features=CATS, num_features=NUMS, log_transform=False, elastic_net_param=(0.0, 0.5),
    reg_param=(0.001,), top_features=3, folds=3, parallelism=2, row_key=("id",))


@pytest.fixture(scope="module")
def planted(spark):
    """y = 5 x4 + 2 x1 + 1 x2 + small noise; the other columns carry nothing."""
    df = spark.range(600).select(
        "id", *[((F.xxhash64(F.lit(n), "id") % 1000) / 1000.0 + 1).alias(n) for n in NUMS],
        F.element_at(F.array(F.lit("red"), F.lit("blue"), F.lit("green")), (F.col("id") % 3 + 1).cast("int")).alias("color"))
    noise = (F.xxhash64(F.lit("noise"), "id") % 1000) / 50000.0
    return df.withColumn("y", 5 * F.col("x4") + 2 * F.col("x1") + F.col("x2") + noise)


@pytest.fixture(scope="module")
def fitted(planted):
    return L.fit_replenishment_model(planted, SPEC, dt.datetime(2024, 1, 31))


def test_report_names_the_planted_features(fitted):
    selected = fitted.report.where("is_selected = 1").orderBy(F.abs("coefficients").desc())
    assert [r["feature_name"] for r in selected.collect()] == ["x4", "x1", "x2"]


def test_report_lists_every_slot_once(fitted):
    report = fitted.report.orderBy("feature_id").collect()
    assert [r["feature_id"] for r in report] == list(range(8))
    assert [r["feature_name"] for r in report] == ["blue", "green", "red", *NUMS]
    assert {r["apply_log"] for r in report} == {"Log Not Applied"}
    assert report[0]["min"] == 0.0 and report[0]["max"] == 1.0


def test_predictions_survive_saving(spark, fitted):
    path = save_model(fitted.cv_model, fresh_path(spark, "model"), dt.date(2024, 1, 31))
    assert path.endswith("__20240131")
    loaded = CrossValidatorModel.load(path)
    pick = lambda df: rows(df.select("id", "prediction"))
    assert pick(L.predict(loaded, fitted.data)) == pick(L.predict(fitted.cv_model, fitted.data))
    assert L.evaluate(L.predict(loaded, fitted.data), "y") < 0.5


def test_grid_crosses_all_values():
    full = L.ElasticNetSpec()
    assert len(L.grid(L.elastic_net(), full.elastic_net_param, full.reg_param)) == 42
    assert (full.folds, full.top_features, full.seed) == (25, 150, 42)


def test_features_in_use():
    assert len(L.candidate_num_features()) == 213
    assert len(L.NUM_FEATURES) == 27 and len(L.CAT_FEATURES) == 13
    assert "purchased_quantity_last3m" in L.NUM_FEATURES and "last3m_product_view" in L.NUM_FEATURES


def test_folds_do_not_depend_on_partitioning(planted):
    fold = lambda df: rows(df.select("id", L.fold_of(["id"], 5)))
    assert fold(planted.repartition(2)) == fold(planted.repartition(7))
    assert {f for _, f in fold(planted)} == set(range(5))


def test_same_metrics_on_any_partitioning(planted, fitted):
    again = L.fit_replenishment_model(planted.repartition(3), SPEC)
    assert again.cv_model.avgMetrics == pytest.approx(fitted.cv_model.avgMetrics, rel=1e-9)


def test_preprocessing_inside_folds(planted):
    got = L.fit_replenishment_model(planted, L.ElasticNetSpec(**{**SPEC.__dict__, "preprocess_in_folds": True}))
    best = got.report.where("is_selected = 1").orderBy(F.abs("coefficients").desc()).first()
    assert best["feature_name"] == "x4"


def test_unseen_and_null_categories_are_all_zero(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "color string")
    model = L.index_categories(CATS).fit(train)
    test = model.transform(spark.createDataFrame([("a",), ("new",), (None,)], "color string"))
    encoded = L.one_hot(CATS).fit(model.transform(train)).transform(test)
    assert [r[0] for r in encoded.select(vector_to_array("color__encoded")).collect()] == [[1, 0], [0, 0], [0, 0]]


def test_ties_of_categories_are_alphabetical(spark):
    model = L.index_categories(CATS).fit(spark.createDataFrame([("b",), ("a",)], "color string"))
    assert list(model.labelsArray[0]) == ["a", "b"]


def test_constant_feature_scales_to_half(spark):
    df = L.assemble(["x"]).transform(spark.createDataFrame([(3.0,), (3.0,)], "x double"))
    scaled = L.scaler("minmax").fit(df).transform(df)
    assert {r[0][0] for r in scaled.select("scaled_features").collect()} == {0.5}


def test_unknown_scaler_is_rejected():
    with pytest.raises(ValueError):
        L.scaler("MinMax")


def test_only_minmax_has_ranges(spark, planted):
    stages = L.preprocess(CATS, NUMS, "y", "standard", 3)
    assert L.slot_ranges(stages.fit(planted), spark) is None


def violation(model, data, label, spec_point):
    """How far a fit is from the optimum's conditions, against the greatest covariance with the label."""
    rows_ = data.select("selected_features", label).collect()
    c = np.cov(np.array([[*r[0].toArray(), r[1]] for r in rows_]).T, bias=True)
    mix, penalty = spec_point
    gram, cross, w = c[:-1, :-1], c[:-1, -1], model.coefficients.toArray()
    moving = np.diag(gram) > 1e-12
    return M.optimality(gram[np.ix_(moving, moving)], cross[moving], w[moving], mix * penalty, (1 - mix) * penalty / c[-1, -1] ** 0.5) / np.abs(cross).max()


def test_report_coefficients_meet_the_conditions_of_the_optimum(fitted):
    best = fitted.cv_model.bestModel
    point = best.getOrDefault("elasticNetParam"), best.getOrDefault("regParam")
    assert violation(best, fitted.data, "y", point) < 1e-3
    told = {r["feature_id"]: r["coefficients"] for r in fitted.report.where("is_selected = 1").collect()}
    chosen = sorted(fitted.preprocessing.stages[-1].selectedFeatures)
    assert told == dict(zip(chosen, best.coefficients.toArray().tolist()))


def test_fits_in_a_row_agree(planted):
    """Ten fits in one session, none of which may fail."""
    small = planted.where("id < 120")
    metrics = [L.fit_replenishment_model(small, SPEC).cv_model.avgMetrics for _ in range(10)]
    assert all(m == pytest.approx(metrics[0], rel=1e-9) for m in metrics)
