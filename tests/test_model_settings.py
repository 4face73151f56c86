"""The queries of models run the whole job of their operators."""

import pytest

from ledgerloom.operators import ml
from ledgerloom.queries import modelling


class Stop(Exception):
    pass


@pytest.mark.parametrize("query, operator, own", [("lead_model", "train_lead_model", {}), ("ltv_model", "train_ltv", {"trees": 100}), ("tuned_model", "tune", {})])
def test_settings(spark, monkeypatch, query, operator, own):
    seen = []

    def record(*args, **how):
        seen.append((len(args), how))
        raise Stop

    monkeypatch.setattr(ml, operator, record)
    with pytest.raises(Stop):
        getattr(modelling, query)(spark, "/root/testdata/sf0.001")
    assert seen == [(4 if query == "ltv_model" else 3, own)]
