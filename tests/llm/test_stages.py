"""Every stage of the corpus pipeline, by name, against its operator's report
on the same documents."""

from collections import Counter

import pytest

import corpus_pipeline as P
from statweave.llm import langid, mixing, packing, quality, simhash


@pytest.fixture(scope="module")
def docs(spark, edge_dir):
    return spark.read.parquet(f"{edge_dir}/documents.parquet")


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_names():
    assert [n for n, _ in P.STAGES] == ["quality", "language", "near_duplicates", "mixing", "packing"]


def test_quality_stage(spark, docs, edge_dir):
    out = P.quality_stage(spark, docs, edge_dir)
    report = quality.report(docs.select("doc_id", "text"))
    assert out.columns == docs.columns and ids(out) == ids(report.filter("kept"))
    assert 0 < out.count() < docs.count()


def test_language_stage(spark, docs, edge_dir):
    out = P.language_stage(spark, docs, edge_dir)
    named = {(r.doc_id, r.lang_pred) for r in langid.identify(docs.select("doc_id", "lang", "text")).collect()}
    assert out.columns == docs.columns
    got = ids(out)
    # Texts without a letter go; plain English and French stay.
    assert not any((i, "und") in named for i in got if i is not None)
    assert set(range(40)) <= set(got)


def test_dedupe_stage(spark, docs, edge_dir):
    out = P.dedupe_stage(spark, docs, edge_dir)
    groups = {r.component_id for r in simhash.classes(docs.select("doc_id", "text")).collect()}
    assert out.columns == docs.columns
    got = ids(out)
    # One row a group, its smallest id; a group of rows without any id has null.
    assert got == Counter(groups) and 120 not in got and got[3] == 1


def test_mixing_stage(spark, docs, edge_dir):
    out = P.mixing_stage(spark, docs, edge_dir)
    sizes = {r.doc_id: r.size for r in mixing.report(docs.select("doc_id", "source", "text")).collect()}
    decided, _ = mixing.mix(docs)
    exp = Counter()
    for r in decided.collect():
        exp[r.doc_id] += r.copies
    assert out.columns == docs.columns and ids(out) == +exp
    assert max(exp.values()) <= 3 * max(1, max(ids(docs).values())) and sizes[103] == 120_000


def test_mixing_stage_keeps_rows_whole(spark, docs, edge_dir):
    """Copies are whole rows; rows that share an id keep their own texts."""
    twice = docs.filter("doc_id in (0, 1)").union(docs.filter("doc_id = 2").withColumn(
        "doc_id", docs.doc_id * 0))
    whole = {tuple(r) for r in twice.collect()}
    assert {tuple(r) for r in P.mixing_stage(spark, twice, edge_dir).collect()} <= whole


def test_packing_stage(spark, docs, edge_dir):
    got = sorted((tuple(r) for r in P.packing_stage(spark, docs, edge_dir).collect()), key=str)
    assert got == sorted((tuple(r) for r in packing.pack(docs).collect()), key=str)
    tokens = Counter()
    for r in P.packing_stage(spark, docs, edge_dir).collect():
        tokens[r.sequence_id] += r.length
    assert all(n == 1024 or n & (n - 1) == 0 for n in tokens.values())
