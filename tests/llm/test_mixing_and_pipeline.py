from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from quaymark.llm import mixing, near_dedup, queries
from tests.conftest import SMALL
from tools.check import compare, connect


def test_every_operator_has_a_query():
    assert set(queries.QUERIES) <= set(entry.queries()) and set(queries.SQL) <= set(queries.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equal_to_its_sql(spark, name):
    assert compare(spark, connect(SMALL), name, SMALL) == ""


def test_margins_reach_their_targets(spark):
    rows = mixing.facts(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    cells = mixing.rake(rows, power=0.5, rounds=30).collect()
    whole = sum(c.tokens for c in cells)
    for margin in mixing.MARGINS:
        have, got = Counter(), Counter()
        for c in cells:
            have[c[margin]] += c.tokens
            got[c[margin]] += c.weight
        flat = sum(n**0.5 for n in have.values())
        assert all(got[v] == pytest.approx(n**0.5 / flat * whole, rel=1e-3) for v, n in have.items())


def test_mixing_of_odd_rows(spark, odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.probability <= 1 for r in rows)
    assert len({r.kept for r in rows if r.doc_id == 3}) == 1
    drawn = mixing.sample(odd)
    assert drawn.columns == odd.columns
    assert Counter(r.doc_id for r in drawn.collect()) == Counter(r.doc_id for r in rows if r.kept)
    assert mixing.mix(none).count() == 0 and mixing.sample(none).count() == 0


def test_mixing_by_a_given_topic(spark, odd):
    rows = mixing.mix(odd.withColumn("theme", F.lit("all")), topic="theme").collect()
    assert {r.topic for r in rows} == {"all"}


def test_mixing_runs_no_python(spark):
    frame = queries.op9_source_mixing(spark, SMALL)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    columns, left = docs.columns, docs
    sizes, frames = [docs.count()], {}
    for name, function in corpus_pipeline.STAGES:
        left = function(spark, left, "/root/testdata/sf0.01")
        frames[name] = left = spark.createDataFrame(left.toPandas(), left.schema)
        sizes.append(left.count())
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert all(frames[n].columns == columns for n in names[:-1])
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > sizes[4] > 0
    bare = frames["exact dedup"].select(F.regexp_replace("text", "[\\x20\\x09-\\x0D]", "").alias("b"))
    assert bare.distinct().count() == bare.count()
    near = near_dedup.classes(frames["MinHash near-dedup"])
    assert near.where("NOT kept").count() == 0
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    good = {r.doc_id for r in docs.collect() if labels.get(r.doc_id) == 1}
    kept = {r.doc_id for r in frames["quality classifier"].collect()}
    assert len(good - kept) <= 0.01 * len(good)
    packed = frames[names[-1]].collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in frames[names[-2]].collect()}


def test_the_pipeline_takes_odd_documents(spark, odd, none, tmp_path):
    labels = spark.createDataFrame([(1, 1), (9, 0)], "doc_id long, quality int")
    for label, frame in (("odd", odd), ("none", none)):
        folder = f"{tmp_path}/{label}"
        frame.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        rows = corpus_pipeline.run(spark, folder).collect()
        pieces = defaultdict(list)
        for r in rows:
            pieces[r.doc_id].append(r.piece)
        assert all(sorted(p) == list(range(len(p))) for p in pieces.values())
        assert bool(rows) == (label == "odd")


def test_the_pipeline_is_its_stages(spark):
    rows = queries.pipeline(spark, SMALL).collect()
    assert rows and len({(r.doc_id, r.piece) for r in rows}) == len(rows)


def test_one_rare_document_does_not_set_the_budget(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source")
    rare = [(-1, "five words in a cell", None, "src0"), (-2, "five words in a cell", "en", None), (-3, "five words of another", "xx", "new")]
    base = {r.doc_id: r for r in mixing.mix(docs, keep=mixing.KEEP).collect()}
    whole = sum(r.tokens for r in base.values())
    assert sum(r.probability * r.tokens for r in base.values()) == pytest.approx(mixing.KEEP * whole, rel=1e-6)
    for row in rare:
        more = spark.createDataFrame([row], docs.schema)
        rows = {r.doc_id: r for r in mixing.mix(docs.unionByName(more), keep=mixing.KEEP).collect()}
        assert rows[row[0]].probability == pytest.approx(1.0, abs=1e-3)
        assert all(abs(rows[i].probability - r.probability) < 0.02 for i, r in base.items())
        tokens = sum(r.probability * r.tokens for r in rows.values())
        assert tokens == pytest.approx(mixing.KEEP * (whole + rows[row[0]].tokens), rel=1e-6)


def test_the_pipeline_mixes_within_its_budget(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    tall = docs.unionByName(docs.limit(1).withColumns({"doc_id": F.lit(-1).cast("long"), "text": F.lit("one two"), "source": F.lit("new")}))
    drawn = corpus_pipeline.mix_sources(spark, tall, SMALL)
    tokens = lambda frame: frame.agg(F.sum(mixing.words())).first()[0]
    assert drawn.where("doc_id = -1").count() == 1
    assert tokens(drawn) == pytest.approx(mixing.KEEP * tokens(tall), rel=0.15)
