"""Label-free reduction on the 60-row frame, fitted on train only."""
import numpy as np

from strata.operators import prep as PR


def frame(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(60):
        informative = None if i == 5 else float(rng.normal(0, 5))
        rows.append((i, informative, float(rng.normal(0, 0.001)), 1.0,
                     None if i < 58 else float(rng.normal(0, 1))))
    return spark.createDataFrame(rows, "id long, informative double, tiny_var double, constant double, "
                                       "has_nulls double")


FEATS = ["informative", "tiny_var", "constant", "has_nulls"]


def test_constant_dropped(spark):
    df = frame(spark)
    _, _, dropped = PR.drop_zero_variance(df, df, FEATS)
    assert dropped == ["constant"]


def test_high_null_dropped_and_rest_filled(spark):
    df = frame(spark).drop("constant")
    tr, te, high, fill = PR.drop_high_null_and_impute(df, df, ["informative", "tiny_var", "has_nulls"])
    assert high == ["has_nulls"]
    assert tr.filter("informative IS NULL").count() == 0
    vals = sorted(r[0] for r in frame(spark).filter("informative IS NOT NULL").select("informative").collect())
    assert abs(fill["informative"] - float(np.median(vals))) < 1e-12


def test_low_variance_dropped(spark):
    df = frame(spark).na.fill(0.0)
    _, _, keep = PR.variance_filter(df, df, ["informative", "tiny_var"], threshold=0.05)
    assert keep == ["informative"]


def test_fit_prep_order_and_apply(spark):
    df = frame(spark)
    prep = PR.fit_prep(df, FEATS, var_thresh=0.05)
    assert prep.zero_var == ["constant"] and prep.high_null == ["has_nulls"] and prep.kept == ["informative"]
    out = prep.transform(df)
    r = out.agg({"informative": "avg"}).first()[0]
    assert abs(r) < 1e-9  # standardised with train mean
    assert PR.FittedPrep.from_json(prep.to_json()) == prep
    assert prep.summary()["after_variance_filter"] == 1


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "label int")
    w = {r.label: r.weight for r in PR.class_weights(df).collect()}
    assert w == {0: 10 / 18, 1: 5.0}
