"""What jobs leave on disk while they run."""

import os

import pytest
from pyspark.sql import functions as F

from marginalia.functions.durable import discard, durable, shared_folder
from marginalia.llm import common
from marginalia.operators import coref, segmentation, trees
from marginalia.plans import annotate as plan
from marginalia.session import write_step
from marginalia.sources import store


def shuffles(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return sum(blocks.apply(i).isShuffle() for i in range(blocks.size()))


def grouped(spark):
    return spark.range(1000).groupBy((F.col("id") % 100).alias("k")).agg(F.count("*").alias("n"))


def test_a_step_leaves_only_its_own_files(spark, tmp_path):
    df, before = grouped(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    held = shuffles(spark)
    df.write.parquet(str(tmp_path / "plain"))
    assert shuffles(spark) > held
    held = shuffles(spark)
    write_step(df, str(tmp_path / "step"))
    assert durable(df).count() == common.Steps(spark, "test").keep(df, "step").count() == 100
    # The counts above shuffle as well; only the writes are held to it.
    assert shuffles(spark) <= held + 2 * 4
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
    # The frame itself can be read again.
    assert df.count() == 100 and len(df.collect()) == 100


def test_steps_that_nothing_reads_go(spark):
    df = durable(spark.range(5), "gone")
    assert os.path.exists(df._step_folder)
    discard(df)
    assert not os.path.exists(df._step_folder)
    steps = common.Steps(spark, "kept")
    for name in "abc":
        steps.keep(spark.range(3), name)
    steps.only("b")
    assert os.listdir(steps.folder) == ["b"]


@pytest.fixture
def shuffled_joins(spark):
    """Tables of a test are so small that their joins would need no shuffle."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def left_of(spark, name):
    return {d for d in os.listdir(shared_folder(spark)) if d.startswith(name)}


def test_compaction_shuffles_one_bucket_at_a_time(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "store"), []
    first = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("TOKEN").alias("set"), F.col("id").alias("ann_id"),
                                    F.col("id").alias("start"), (F.col("id") + 1).alias("end"), F.lit("token").alias("type"),
                                    F.expr("CAST(map() AS map<string,string>)").alias("attrs"))
    store.write_annotations(first, path)
    store.write_annotations(first.where("doc_id < 50").withColumn("start", F.lit(7).cast("bigint")), path)
    want = sorted(map(tuple, store.read_sets(spark, path).collect()), key=repr)
    write = store.write_step

    def watched(df, folder, *by, **more):
        seen.append((folder, df.select("bucket").distinct().count()))
        write(df, folder, *by, **more)

    monkeypatch.setattr(store, "write_step", watched)
    store.compact(spark, path)
    assert len([n for folder, n in seen if "/rows/" in folder]) == store.BUCKETS
    assert all(n <= 1 for folder, n in seen if "/rows/" in folder)
    assert sorted(map(tuple, store.read_sets(spark, path).collect()), key=repr) == want
    assert len(store.manifest(spark, path)["commits"]) == 1


def test_trees_keep_the_rounds_they_read(spark):
    edges = spark.createDataFrame([(1, 1, None, "S"), (1, 2, 1, "NP"), (1, 3, 1, "VP")],
                                  "doc_id bigint, node_id bigint, parent_id bigint, label string")
    leaves = spark.createDataFrame([(1, 9, 2, "a", 0, 1), (1, 10, 3, "b", 2, 5)],
                                   "doc_id bigint, node_id bigint, parent_id bigint, label string, start bigint, end bigint")
    before = left_of(spark, "tree-")
    spans = {(r["node_id"], r["start"], r["end"]) for r in trees.tree_spans(edges, leaves).collect()}
    assert spans == {(1, 0, 5), (2, 0, 1), (3, 2, 5)}
    kept = left_of(spark, "tree-") - before
    assert len(kept) == 2 and not any(d.startswith("tree-edges") for d in kept)


def test_dependencies_meet_their_tokens_alone(spark, shuffled_joins):
    toks = spark.createDataFrame([(1, 0, n, 2 * n, 2 * n + 1) for n in range(1, 5)], "doc_id bigint, sent_no bigint, tok_no bigint, start bigint, end bigint")
    edges = spark.createDataFrame([(1, 0, 1, 2, "nsubj", 1), (1, 0, 3, 1, "conj", 1), (1, 0, 4, 3, "conj", 1)],
                                  "doc_id bigint, sent_no bigint, dep_no bigint, gov_no bigint, relation string, seq bigint")
    deps = trees.dependency_spans(toks, edges)
    assert exchanges(deps) == 2
    deps = durable(deps)
    out = trees.resolve_conjunctions(deps)
    # Nodes that are no conjunction are not shuffled.
    assert exchanges(out) == 2 and "Union" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["tok_no"], r["type"], r["gov_id"]) for r in out.collect()) == [(1, "nsubj", 2), (2, "ROOT", None), (3, "nsubj", 2), (4, "nsubj", 2)]


def test_mentions_are_shuffled_once_at_a_time(spark):
    nps = spark.createDataFrame([(1, i, i, i, i + 1, t, t) for i, t in enumerate(["He", "a cat", "he", "A cat"], 1)],
                                "doc_id bigint, ce_id bigint, sent_no bigint, start bigint, end bigint, text string, head string")
    before = left_of(spark, "mentions-")
    scored = coref.pair_scores(coref.candidate_features(nps))
    assert exchanges(scored) == 1
    assert len(left_of(spark, "mentions-") - before) == 1
    assert sorted((r["i"], r["j"]) for r in scored.collect()) == [(1, 2), (1, 3), (2, 3), (2, 4), (3, 4)]
    before = left_of(spark, "links")
    assert coref.coref_links(scored, nps).count() == 5
    assert len(left_of(spark, "links") - before) == 1


def test_steps_of_an_annotation_go_when_its_layers_are_written(spark):
    docs = spark.createDataFrame([(1, "The cat saw Apache. It ran."), (2, "A dog.")], "doc_id bigint, text string")
    held = durable(plan.sentence_layer(segmentation.sentences(docs.where("doc_id = 1"))), "held")
    names = ("state", "tagged", "entities", "phrases", "layers")
    before = {name: left_of(spark, name) for name in names}
    layers, links = plan.annotate(docs, held)
    kept = {name: len(left_of(spark, name) - before[name]) for name in names}
    assert kept == {"state": 0, "tagged": 0, "entities": 0, "phrases": 1, "layers": 1}
    assert layers.where("set = 'NP'").count() == 4 and links.count() >= 0
