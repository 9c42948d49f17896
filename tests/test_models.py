import pytest
from pyspark.sql import functions as F

from offerwise import models
from offerwise.operators.metrics import with_class_weights
from offerwise.plans import audit, external, training
from offerwise.registry import inputs
from offerwise.schemas import FEATURES, PRICE_FEATURES, PROBABILITIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return with_class_weights(inputs.cohort(spark, SF_DIR)).persist()


@pytest.fixture(scope="module")
def constrained(rows):
    return models.fit_outcome_model(rows, FEATURES, training.PRODUCTION, "class_weight")


def off_sum(scored):
    total = sum((F.col(p) for p in PROBABILITIES), F.lit(0.0))
    return scored.where((F.abs(total - 1) > 1e-9) | total.isNull()).count()


def test_constrained_signs(constrained):
    inputs_of = models.fitting.model_inputs(FEATURES)
    matrix = constrained.stages[-1].coefficientMatrix.toArray()
    for feature in PRICE_FEATURES:
        accept, downgrade, churn = matrix[:, inputs_of.index(feature)]
        assert churn >= 0
        assert accept <= 0
        assert downgrade <= 0


def test_churn_never_falls_with_price(rows, constrained):
    scorer = models.scorer_of(constrained)
    for feature in PRICE_FEATURES:
        grid = audit.quantile_grid(rows, feature, 9)
        curve = audit.partial_dependence(rows, {"m": scorer}, feature, grid)
        assert audit.falling_steps(curve).first().falling_steps == 0


def test_column_scorer_equals_the_pipeline(rows, constrained):
    by_columns = models.scorer_of(constrained)(rows).select("purchaseid", *PROBABILITIES)
    pipeline = models.fitting.ModelScorer(constrained, FEATURES)
    by_model = pipeline(rows).select("purchaseid", *[F.col(p).alias(f"m_{p}") for p in PROBABILITIES])
    far = by_columns.join(by_model, "purchaseid").where(
        " or ".join(f"abs({p} - m_{p}) > 1e-9" for p in PROBABILITIES)
    )
    assert far.count() == 0


@pytest.mark.parametrize("family", ["forest", "boosted"])
def test_tree_families_give_probabilities(rows, family):
    learner = models.Learner(family, params={"maxDepth": 3} | (
        {"numTrees": 5} if family == "forest" else {"maxIter": 3}))
    model = models.fit_outcome_model(rows, FEATURES, learner)
    assert off_sum(models.scorer_of(model)(rows)) == 0


@pytest.mark.parametrize("family", ["logistic", "boosted"])
def test_calibrated_model_survives_saving(rows, tmp_path, family):
    params = {"maxIter": 20} if family == "logistic" else {"maxIter": 2, "maxDepth": 2}
    model = models.calibrate(rows, FEATURES, models.Learner(family, params=params), "class_weight")
    scored = models.scorer_of(model)(rows).select("purchaseid", *PROBABILITIES)
    assert off_sum(scored) == 0
    models.save_model(model, str(tmp_path / "model"))
    loaded = models.load_model(str(tmp_path / "model"))
    assert models.model_features(loaded) == list(FEATURES)
    again = models.scorer_of(loaded)(rows).select("purchaseid", *PROBABILITIES)
    assert again.exceptAll(scored).count() == 0


def test_scoring_fills_absent_features(spark, constrained):
    cohort = spark.createDataFrame(
        [("u", 100.0, 3.0, 0.0, 30)],
        "username string, catalog_price double, arpu double, arpu_trend double, duration int",
    )
    scored = models.scorer_of(constrained)(cohort)
    assert off_sum(scored) == 0


def test_tuning_returns_the_best_draw(rows):
    space = {"regParam": [0.001, 100.0], "maxIter": [20]}
    best, results = models.tune(rows, FEATURES, weight="class_weight", space=space, folds=2)
    assert len(results) == 2
    assert best.params == min(results, key=lambda r: r[1])[0]
    assert best.params["regParam"] == 0.001


def test_training_run(spark, tmp_path):
    run = training.train(
        inputs.mart(spark, SF_DIR), path=str(tmp_path / "m"), draws=1, folds=2,
        space={"regParam": [0.01], "maxIter": [20]},
    )
    report = {r["class"]: r for r in run.report.collect()}
    total = report["accuracy"].support
    assert total == sum(report[c].support for c in ("accept", "downgrade", "churn"))
    assert 0.15 * 1435 < total < 0.25 * 1435
    models.load_model(str(tmp_path / "m"))


def test_ablation_names_both_models(spark):
    rows = training.ablation(inputs.mart(spark, SF_DIR)).collect()
    assert [r.model for r in rows] == ["baseline", "enhanced"]
    assert rows[0].f1_gain_percent is None
    gain = (rows[1].macro_f1 - rows[0].macro_f1) / rows[0].macro_f1 * 100
    assert rows[1].f1_gain_percent == pytest.approx(gain)


def test_ablation_without_latent_features_warns(spark):
    mart = inputs.mart(spark, SF_DIR)
    with pytest.warns(UserWarning, match="latent"):
        training.ablation(mart, latent=("no_such_column",))


def test_external_run(spark):
    row = external.external_run(inputs.churn_export(spark, SF_DIR)).first()
    assert row.users > 0


def test_noise_is_standard_normal_and_stable(spark):
    keys = spark.range(20_000).selectExpr("cast(id as string) as customerID")
    noise = keys.withColumn("z", external.standard_normal(F.col("customerID")))
    mean, spread = noise.agg(F.avg("z"), F.stddev("z")).first()
    assert abs(mean) < 0.03
    assert abs(spread - 1) < 0.03
    assert noise.repartition(7).exceptAll(noise).count() == 0


def test_constraints_need_the_logistic_family():
    with pytest.raises(ValueError, match="constrained"):
        models.Learner("forest", rising_with_price=PRICE_FEATURES)
