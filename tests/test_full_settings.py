"""Registered queries fit with the operators' full settings."""

from __future__ import annotations

import inspect

from riskloom.plans import training as T
from riskloom.queries import REGISTRY


class Asked(Exception):
    pass


def test_candidate_models(spark, monkeypatch):
    assert inspect.signature(T.compare_candidates).parameters["boosting_rounds"].default == 400
    assert inspect.signature(T.compare_candidates).parameters["trees"].default == 300

    def fake(*args, **options):
        raise Asked(options)

    monkeypatch.setattr(T, "compare_candidates", fake)
    try:
        REGISTRY["candidate_models"](spark, "/root/testdata/sf0.001")
    except Asked as asked:
        assert asked.args[0] == {}
    else:
        raise AssertionError("not called")
