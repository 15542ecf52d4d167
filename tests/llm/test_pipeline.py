"""The stages against brute force on the smallest table."""

import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tests.llm.test_operators import shingles

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the supplied tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r for r in docs.collect()]
    # near duplicates: one of each group of the stage's own input
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    sets = {r.doc_id: shingles(r.text) for r in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}
    for i in ids:
        for j in ids:
            o = len(sets[i] & sets[j])
            if j < i and sets[i] and 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o):
                a, b = max(root[i], root[j]), min(root[i], root[j])
                root = {k: b if r == a else r for k, r in root.items()}
    assert kept == set(root.values())
    # decontamination: no exact passage is left, and what goes has most of one
    plain = lambda t: " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower()))
    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in corpus_pipeline.decontamination(spark, docs, SF).collect()}
    for r in rows:
        if any(f" {i} " in f" {plain(r.text)} " for i in items):
            assert r.doc_id not in clean
    assert len(clean) > 0.8 * len(rows)


def test_stages_with_null_and_repeated_ids(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    one, two, three = (" ".join(f"{w}{k}" for k in range(40)) for w in ("one", "two", "three"))
    near = one.replace("one0 ", "other ")
    rows = [(None, one), (None, two), (3, near), (7, near), (7, three), (7, three), (8, None), (8, None)]
    docs = spark.createDataFrame([(d, t, "en", "web", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(3, near), (None, two), (7, three), (8, None), (8, None)], key=str)
    rows = [(None, f"x {item} y"), (None, one), (7, f"x {item} y"), (7, two), (9, item)]
    docs = spark.createDataFrame([(d, t, "en", "web", len(t)) for d, t in rows], docs.schema)
    got = corpus_pipeline.decontamination(spark, docs, SF).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, one), (7, two)], key=str)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = " ".join(f"Sentence {k} tells of something{k} that nobody{k} has told before." for k in range(12))
ROWS = [(1, PROSE), (None, PROSE.replace("tells", "speaks")), (1, "x"), (2, None), (3, ""), (4, "One two three. " * 3000), (5, PROSE), (5, PROSE)]


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(d, t, "en", None if d == 5 else "web", len(t or "")) for d, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("row_id", "component_id", "kept", "score", "size", "taken", "shard")})


def test_each_stage_on_odd_rows(spark, odd_docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    given = Counter((r.doc_id, r.text) for r in odd_docs.collect())
    quality = corpus_pipeline.quality(spark, odd_docs, SF)
    field = corpus_pipeline.fit_field(odd_docs, labels)
    judged = corpus_pipeline.judge_quality(odd_docs, field, ["doc_id", "text"]).where("kept").collect()
    assert Counter((r.doc_id, r.text) for r in quality.collect()) == Counter((r.doc_id, r.text) for r in judged)
    assert quality.columns == corpus_pipeline.COLUMNS and quality.where("text is null or text = '' or text = 'x'").count() == 0
    toxic = corpus_pipeline.toxicity(spark, odd_docs, SF)
    assert toxic.columns == corpus_pipeline.COLUMNS and Counter((r.doc_id, r.text) for r in toxic.collect()) == given
    alone = corpus_pipeline.near_duplicates(spark, odd_docs, SF)
    assert alone.columns == corpus_pipeline.COLUMNS
    assert Counter((r.doc_id, r.text) for r in alone.collect()) == Counter({k: 1 for k in given if k[0] != 5 or k[1] != PROSE}) | Counter({(2, None): 1, (3, ""): 1})
    clean = corpus_pipeline.decontamination(spark, odd_docs, SF)
    assert clean.columns == corpus_pipeline.COLUMNS and Counter((r.doc_id, r.text) for r in clean.collect()) == given
    mixed = corpus_pipeline.mixing(spark, odd_docs, SF).collect()
    assert mixed and all(r.text and 0 < r.taken <= r["size"] for r in mixed)
    most = Counter((r.doc_id, r.text) for r in mixed)
    assert all(n <= 3 * given[k] for k, n in most.items())


def test_each_stage_on_an_empty_table(spark, odd_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_docs.limit(0), SF).count() == 0


def test_run(spark):
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "lang", "source", "n_chars", "taken"} <= set(got.columns)
    rows = got.collect()
    assert 0 < len(rows) < 200 and all(0 < r.taken <= 3 * r["size"] for r in rows)


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)
