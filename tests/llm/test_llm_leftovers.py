"""The training-data queries leave their result, and the files that they were asked to write."""

from __future__ import annotations

import os

import corpus_pipeline
import pytest

from loomcorpus.llm import queries
from loomcorpus.operators import tables

SF = "/root/testdata/sf0.001"
#: Archives and shards are results themselves.
WRITTEN = {"op8_warc": 1, "op9_training_order": 1}


@pytest.mark.parametrize("name", [*sorted(queries.QUERIES), "pipeline"])
def test_only_results_stay(spark, name):
    folder = tables.scratch_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    query = corpus_pipeline.run if name == "pipeline" else queries.QUERIES[name]
    query(spark, SF).count()
    assert len(set(os.listdir(folder)) - before) <= WRITTEN.get(name, 1)
