"""Evaluation operators against brute-force numpy on a tied score table."""
import numpy as np
import pytest

from strata.operators import evaluate as EV


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(2000) < 0.1).astype(int)
    p = np.round(np.clip(rng.random(2000) * 0.6 + 0.3 * y, 0, 1), 2)
    rows = [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "k long, label int, p double"), y, p


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def test_auc_tie_aware(scored):
    df, y, p = scored
    assert abs(EV.roc_auc(df).first().roc_auc - brute_auc(y, p)) < 1e-12


def test_sweep_matches_literal_grid(scored):
    df, y, p = scored
    rows = {round(r.threshold, 4): r for r in EV.threshold_sweep(df).collect()}
    assert len(rows) == 101
    for t in EV.sweep_grid():
        assert rows[t].tp == int(((p >= t) & (y == 1)).sum())
        assert rows[t].fp == int(((p >= t) & (y == 0)).sum())


def test_confusion_prf_and_zero_division(spark, scored):
    df, y, p = scored
    c = EV.confusion(df, 0.5).first()
    assert c.tp == int(((p >= 0.5) & (y == 1)).sum()) and c.tn == int(((p < 0.5) & (y == 0)).sum())
    none = EV.prf(df, 2.0).first()  # nothing flagged: 0/0 -> 0
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)


def test_choose_threshold_first_best_wins(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1)], "label int, p double")
    best = EV.best_threshold(EV.choose_threshold(df)).first()
    # F1 = 1 from 0.15 up to 0.50: the lowest of the tied thresholds wins
    assert best.threshold == 0.15 and best.f1 == 1.0


def test_roc_points_end_at_one(scored):
    df, y, p = scored
    pts = sorted(EV.roc_points(df).collect(), key=lambda r: -r.threshold)
    assert len(pts) == len(np.unique(p)) + 1 and pts[-1].fpr == 1.0 and pts[-1].tpr == 1.0
    assert (pts[0].fpr, pts[0].tpr) == (0.0, 0.0)     # nothing flagged


def test_winner_tie_goes_to_priority(spark):
    cmp_ = spark.createDataFrame([("forest", 0.5), ("boosted", 0.5)], "model string, f1 double")
    assert EV.winner(cmp_, {"boosted": 0, "forest": 1}).first().model == "boosted"


def test_parity_counts_lost_rows_and_the_gate_raises(spark):
    a = spark.createDataFrame([(i, i / 10) for i in range(10)], "k long, p double")
    r = EV.score_parity(a, a.filter("k < 3"), "k", 0.5).first()
    assert (r.n, r.n_flips, r.n_unmatched) == (3, 0, 7)
    EV.require_parity(a, a, "k", 0.5)
    with pytest.raises(EV.ParityError):
        EV.require_parity(a, a.filter("k < 3"), "k", 0.5)
