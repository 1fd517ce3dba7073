"""Texts that are surely toxic but of a mild grade."""

import numpy as np
import pyarrow as pa

from tunelake.llm import toxicity


def test_mild_grades_are_rejected(spark):
    _, feature, _ = toxicity.features_of(pa.array(["vile"], pa.large_string()))
    odds = lambda p: np.log(p / (1 - p))
    model = toxicity.OrdinalModel(feature, np.array([odds(0.9) + 5]), np.array([5.0, odds(0.9) - odds(0.05) + 5, odds(0.9) - odds(0.01) + 5]))
    got = toxicity.score_toxicity(spark.createDataFrame([("vile",), ("kind",)], "text string"), model).collect()
    assert [(round(r.expected_severity, 2), r.toxic) for r in got] == [(0.96, True), (0.01, False)]
