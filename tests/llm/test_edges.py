"""Null ids, clashing columns, repeated rows and hot groups in every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loomcorpus.llm import decontaminate, jaccard, language, lines, materialise, packing, quality, sharding, urls, warc

PASSAGE = " ".join(f"w{i}" for i in range(60))
OWN = lambda i: " ".join(f"x{i}y{k}" for k in range(70))
#: Names that the operators use inside.
CLASHING = ["doc", "h", "row", "runs", "id", "node", "n", "c", "_gone", "size", "shared", "score", "lang_pred", "bits", "hashes", "prints", "contaminated", "new_text"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, OWN(i)) for i in range(30)] + [(None, OWN(99)), (None, None), (5, OWN(5)), (40, None), (41, ""), (42, OWN(3)), (43, OWN(3) + "\n" + PASSAGE)]
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)]).cache()


def test_every_row_comes_back(spark, docs):
    n = docs.count()
    bench = spark.createDataFrame([(1, PASSAGE), (None, OWN(1)), (2, None)], "item_id long, text string")
    packed = packing.pack(docs)
    assert packed.count() == n and packed.where("doc_id is null").count() == 2
    shards = sharding.assign_shards(docs, 4)
    assert shards.count() == n and shards.where("doc_id is null").count() == 2
    groups = {(r.doc_id, r.n_shingles): (r.component_id, r.n_links) for r in jaccard.jaccard_groups(docs).collect()}
    assert groups[None, 66] == groups[None, 0] == (None, 0) and groups[42, 66] == (3, 1) and groups[5, 66] == (5, 0)
    found = decontaminate.decontaminate(docs, bench)
    assert found.count() == n and [r.doc_id for r in found.where("contaminated").collect()] == [43]
    judged = quality.judge(docs, quality.fit(docs, spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, quality int")))
    assert judged.count() == n and judged.where("doc_id is null").count() == 2
    assert language.identify(docs).count() == n
    assert materialise.materialise(docs, size=64, per_shard=8).agg(F.sum("n_tokens")).first()[0] == packed.agg(F.sum("length")).first()[0]


def test_filters_keep_columns_and_null_ids(docs, spark):
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    cut = lines.dedup_lines(docs)
    assert cut.columns == [*docs.columns, "n_lines", "n_deleted"] and cut.count() == docs.count()
    assert {r.doc_id: r.n_deleted for r in cut.where("n_deleted > 0").collect()} == {42: 1, 43: 1}
    assert cut.where("doc_id = 43").first().text == PASSAGE and cut.where("doc_id is null").count() == 2
    for kept, gone in ((lines.keep_new_lines(docs), {42}), (jaccard.keep_one_per_group(docs), {42}), (decontaminate.drop_contaminated(docs, bench), {43}), (language.keep_identified(docs), {40, 41})):
        assert kept.columns == docs.columns
        left = [r.doc_id for r in kept.collect()]
        assert set(range(30)) <= set(left) and left.count(5) == 2 and None in left and not gone & set(left)
    assert {r.doc_id: r.n_chars for r in lines.keep_new_lines(docs).collect()}[43] == len(PASSAGE)


def test_ids_of_other_types(spark):
    rows = [(f"k{i:02}", OWN(i)) for i in range(6)] + [("k00x", OWN(0)), ("a", OWN(1) + " z")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_groups(docs).collect()}
    assert got == {"k00": "k00", "k00x": "k00", "a": "a", "k01": "a", **{f"k{i:02}": f"k{i:02}" for i in range(2, 6)}}
    assert packing.pack(docs).count() == sharding.assign_shards(docs, 3).count() == 8
    assert {r.doc_id for r in lines.dedup_lines(docs).where("n_deleted > 0").collect()} == {"k00x"}


def test_hot_groups(spark, monkeypatch):
    """A third of the rows are copies, a third near copies of one text, and one line and passage is everywhere."""
    monkeypatch.setattr(jaccard, "MAX_SENT_IDS", 5)
    monkeypatch.setattr(lines, "MAX_SENT", 0)
    monkeypatch.setattr(decontaminate, "MAX_SENT", 0)
    base = OWN(7).split(" ")
    near = [" ".join([*base[:k], f"new{k}", *base[k + 1 :]]) for k in range(60)]
    rows = [OWN(7)] * 60 + near + [OWN(100 + i) for i in range(60)]
    docs = spark.createDataFrame([(i, t + "\n" + PASSAGE) for i, t in enumerate(rows)], "doc_id long, text string").repartition(7)
    groups = {r.doc_id: (r.component_id, r.n_links) for r in jaccard.jaccard_groups(docs).collect()}
    assert all(groups[i] == (0, 119) for i in range(120)) and all(groups[i] == (i, 0) for i in range(120, 180))
    deleted = {r.doc_id: r.n_deleted for r in lines.dedup_lines(docs).collect()}
    assert deleted == {i: 0 if i == 0 else 2 if i < 60 else 1 for i in range(180)}
    bench = spark.createDataFrame([(1, PASSAGE), (2, "none of these words at all")], "item_id long, text string")
    found = decontaminate.decontaminate(docs, bench).collect()
    assert {(r.n_hit, r.n_items, r.contaminated) for r in found} == {(60, 1, True)} and len(found) == 180


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs, bench).count() == 0
    assert materialise.materialise(docs).count() == warc.archive(pages).count() == language.identify(docs).count() == 0
    assert urls.filter_urls(pages, urls.rules_table(spark, urls.RULES)).count() == lines.dedup_lines(docs).count() == 0
