"""Training of the toxicity network keeps its small tables with the executors."""

import os

from strata.llm import toxicity
from strata.session import ensure_checkpoint_dir, local_path


def test_training_writes_no_table_of_hashes(spark):
    root = local_path(ensure_checkpoint_dir(spark))
    before = set(os.listdir(root))
    rows = [(f"clean text {i}", 0) for i in range(30)] + [(f"awful text {i}", 1) for i in range(20)] + [("clean text 1", 0), (None, 1), ("none", None)]
    model = toxicity.fit(spark.createDataFrame(rows, "text string, label int"), sample=10)
    assert "gram" in model and set(os.listdir(root)) == before      # a file for each shuffle partition before
    assert not spark.sparkContext._jsc.getPersistentRDDs().size()
