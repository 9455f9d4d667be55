"""The perimeter sweep against single runs of the whole pipeline."""

import numpy as np
import pytest

from lanewatch import constants as K
from lanewatch.operators.cleaning import apply_perimeter
from lanewatch.operators.detectors import ensemble as EN
from lanewatch.plans import pipeline as P
from lanewatch.sources import proxy
from tests.conftest import SMALL


def test_sweep_equals_single_runs(spark):
    """All four detectors in overlapping perimeters, one of few routes and one of none, at once."""
    alarms, travellers = proxy.alarm_feed(spark, SMALL), proxy.traveller_feed(spark, SMALL)
    perimeters = [{"anno": 1997}, {"anno": 1900}, {"anno": 1997, "zona": 1}]
    swept = {}
    for r in P.perimeter_risk(alarms, travellers, perimeters).collect():
        swept.setdefault(r.perimeter_id, {})[r.ROTTA] = r
    rows = {r.perimeter_id: r for r in P.perimeter_sweep(alarms, travellers, perimeters).collect()}
    assert rows[1].n_routes == 0 and all(rows[1][t] == 0 for t in K.RISK_TIERS) and 1 not in swept
    for i in swept:          # a perimeter with too few normal routes has no autoencoder
        fitted = any(r.score_ae for r in swept[i].values())
        weights = EN.effective_weights(active=["IF", "LOF", "Z", "AE"] if fitted else ["IF", "LOF", "Z"])
        for r in swept[i].values():
            blend = sum(w * r[K.DETECTOR_SCORE_COLUMNS[d]] for d, w in weights.items())
            assert r.ensemble_score == pytest.approx(min(max(blend, 0.0), 1.0))
    i = 2
    one = P.risk_pipeline(apply_perimeter(alarms, perimeters[i]), apply_perimeter(travellers, perimeters[i])).risk.collect()
    assert len(one) == len(swept[i]) == rows[i].n_routes > 0
    for r in one:
        for c in ("baseline_score", "score_if", "score_lof", "score_z"):
            assert swept[i][r.ROTTA][c] == pytest.approx(r[c], abs=1e-6), (r.ROTTA, c)
    # the autoencoder's fit follows the last digits of its inputs, which depend on the order of summation
    a, b = ([x[r.ROTTA].score_ae for r in one] for x in (swept[i], {r.ROTTA: r for r in one}))
    assert any(a) == any(b) and (not any(a) or np.corrcoef(a, b)[0, 1] > 0.97)
    assert any(r.score_ae for r in swept[0].values())
    assert np.mean([swept[i][r.ROTTA].final_risk == r.final_risk for r in one]) > 0.95
