"""What the driver holds."""

import numpy as np

from milldam.llm import toxicity


def test_the_fit_is_not_the_drivers(spark, monkeypatch):
    """The driver neither holds the kernel nor solves for it."""
    rows = [(i, "you utter moron go away" if i % 3 == 0 else f"a quiet day in town number {i} with rain", int(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")

    def failing(*args, **kwargs):
        raise AssertionError("fitted in the driver")

    monkeypatch.setattr(np.linalg, "eigh", failing)
    machine = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    scores = {r.doc_id: r.score for r in toxicity.scored(df, machine).collect()}
    assert scores[0] > 0.5 > scores[1]
