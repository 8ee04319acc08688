"""What queries leave in the shared folder: at most the table that their result reads."""

from __future__ import annotations

import os

import pytest

from loomcorpus import plans
from loomcorpus.operators import tables

SF = "/root/testdata/sf0.001"
#: Queries over stored structures; all others are lazy, which the last test checks of them together.
STORED = ["v06_index_top_k", "v06_index_recall", "k01_catalogue_merge", "k08_snapshot_merge", "k12_point_merge", "j25_stored_lookup", "t02_stored_page", "l10_journalled_plan", "l09_sweep_plan", "l09_sweep_statistics"]


def held(spark):
    folder = tables.scratch_dir(spark).removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


@pytest.mark.parametrize("name", STORED)
def test_only_the_result_stays(spark, name):
    before = held(spark)
    plans.QUERIES[name](spark, SF).collect()
    assert len(held(spark) - before) <= 1


def test_other_queries_leave_one_table_at_most(spark):
    for name, query in plans.QUERIES.items():
        if name not in STORED:
            before = held(spark)
            query(spark, SF)
            assert len(held(spark) - before) <= 1, name
