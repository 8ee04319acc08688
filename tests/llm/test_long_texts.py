"""A text of more than 4096 full pieces shares no sequence with the next row."""

from __future__ import annotations

from loomcorpus.llm import packing


def test_full_pieces_have_sequences_of_their_own(spark):
    docs = spark.createDataFrame([(0, "a b " * 9000), (1, "c d " * 9000)], "doc_id long, text string").coalesce(1)
    rows = packing.pack(docs, size=4).toPandas()
    assert rows["piece"].max() > 4096
    assert rows.groupby("sequence_id")["length"].sum().max() <= 4
