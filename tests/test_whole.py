"""Nothing is cut silently, stores lose nothing, and loops end."""

import pytest
from pyspark.sql import functions as F

from marginalia import schema as S
from marginalia.catalog import inputs
from marginalia.catalog.queries import QUERIES
from marginalia.functions import durable
from marginalia.operators import audit, coref, segmentation, spans, tagging, trees
from marginalia.plans import annotate as plan
from marginalia.sources import store


def flat(ann):
    return sorted((r["doc_id"], r["set"], r["start"], r["end"]) for r in ann.collect())


def made(spark, *rows):
    empty = F.array().cast("array<string>")
    frame = spark.createDataFrame([(d, s, i, a, b, "x") for i, (d, s, a, b) in enumerate(rows)],
                                  "doc_id bigint, `set` string, ann_id bigint, start bigint, `end` bigint, type string")
    return frame.withColumn("attrs", F.map_from_arrays(empty, empty))


def test_a_long_document_gets_every_layer(spark):
    text = "The red fox saw a big dog. " * 1200
    d = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    layers, links = plan.annotate(d)
    sizes = {r["set"]: r["count"] for r in layers.groupBy("set").count().collect()}
    assert sizes["SENT"] == 1200 and sizes["TOKEN"] == sizes["POS"] == 1200 * 8 and sizes["NP"] == 1200
    assert layers.where("set = 'POS'").agg(F.max("end")).first()[0] == len(text) - 1
    assert links.count() > 0
    assert coref.mention_pairs(tagging.base_noun_phrases(d)).agg(F.max("j")).first()[0] == 1200


def test_a_sentence_of_many_phrases_gives_few_pairs(spark):
    text = " and ".join(f"dog{i}" for i in range(5000))
    d = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    nps = tagging.base_noun_phrases(d)
    assert nps.count() == 5000
    assert 4999 <= coref.mention_pairs(nps).count() < 15000


def test_stored_rows_stay(spark):
    d = spark.createDataFrame([(1, "A dog."), (2, "")], "doc_id bigint, text string")
    held = made(spark, (1, "PAR", 0, 6), (2, "PAR", 0, 0), (3, "PAR", 0, 9), (3, "TOKEN", 0, 2), (1, "NE", 2, 5))
    got = flat(plan.base_layers(d, held))
    assert set(flat(held)) <= set(got)
    assert (1, "SENT", 0, 6) in got


def test_put_replaces_and_empties(spark):
    path = durable.new_folder(spark, "put")
    store.write_annotations(made(spark, (1, "PAR", 0, 5), (1, "NE", 0, 2), (2, "PAR", 0, 7)), path)
    store.write_annotations(made(spark, (1, "PAR", 0, 3)), path)
    assert flat(store.read_sets(spark, path)) == [(1, "NE", 0, 2), (1, "PAR", 0, 3), (2, "PAR", 0, 7)]
    cells = spark.createDataFrame([(1, "NE"), (2, "PAR")], "doc_id bigint, `set` string")
    store.replace_sets(spark, path, made(spark, (2, "PAR", 1, 2)), cells)
    assert flat(store.read_sets(spark, path)) == [(1, "PAR", 0, 3), (2, "PAR", 1, 2)]
    left = store.upsert_annotations(made(spark, (1, "NE", 0, 2)), made(spark, (2, "NE", 0, 1)).where("1 = 0"), cells)
    assert flat(left) == []


def test_repair_rewrites_changed_cells_only(spark):
    path = durable.new_folder(spark, "repair")
    d = spark.createDataFrame([(1, "A dog."), (2, "A cat.")], "doc_id bigint, text string")
    store.write_annotations(made(spark, (1, "NE", 2, 90), (1, "PAR", 0, 6), (2, "NE", 0, 2), (2, "NE", 3, 3)), path)
    cells = plan.repair_store(d, path)
    assert sorted(map(tuple, cells.collect())) == [(1, "NE"), (2, "NE")]
    assert flat(store.read_sets(spark, path)) == [(1, "PAR", 0, 6), (2, "NE", 0, 2)]
    assert plan.repair_store(d, path).isEmpty()
    assert audit.changed_sets(store.read_sets(spark, path), d).isEmpty()


def test_inverted_spans_are_contained_by_the_predicate(spark):
    schema = "doc_id bigint, start bigint, `end` bigint"
    a = [(1, s, e) for s, e in [(12, 11), (700, 3), (5, 5), (300, 900), (0, 2000)]]
    b = [(1, s, e) for s, e in [(0, 20), (400, 500), (0, 3000), (20, 0), (300, 900)]]
    got = spans.contained_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).collect()
    want = [(x, y) for _, x, y in [(0, p, q) for p in a for q in b] if x[1] >= y[1] and x[2] <= y[2]]
    assert sorted(((1, r["a_start"], r["a_end"]), (1, r["b_start"], r["b_end"])) for r in got) == sorted(want)


def test_trees_end_on_cycles_and_reach_deep(spark):
    deep = [(1, i, i - 1 if i else None, "n") for i in range(1000)]
    cycle = [(2, 0, 2, "a"), (2, 1, 0, "b"), (2, 2, 1, "c"), (2, 3, 2, "d")]
    edges = spark.createDataFrame(deep + cycle, "doc_id bigint, node_id bigint, parent_id bigint, label string")
    leaves = spark.createDataFrame([(1, 5000, 999, "x", 3, 4), (1, 5001, 10, "y", 0, 1), (2, 9, 3, "z", 7, 8)],
                                   "doc_id bigint, node_id bigint, parent_id bigint, label string, start bigint, `end` bigint")
    got = {(r["doc_id"], r["node_id"]): (r["start"], r["end"]) for r in trees.tree_spans(edges, leaves).collect()}
    assert got[1, 0] == (0, 4) and got[1, 500] == (3, 4) and got[1, 10] == (0, 4) and got[1, 999] == (3, 4)
    assert {got[2, n] for n in range(4)} == {(7, 8)}
    assert sorted(r["node_id"] for r in trees.without_root(edges).collect()) == [0, 1, 2, 3]


def test_children_in_the_order_of_insertion(spark):
    edges = spark.createDataFrame([(1, 0, None, 0), (1, 7, 0, 1), (1, 3, 0, 2), (1, 5, 0, 3)],
                                  "doc_id bigint, node_id bigint, parent_id bigint, seq bigint")
    assert trees.child_ids(edges).first()["child_ids"] == "7,3,5"
    assert trees.child_ids(edges.drop("seq")).first()["child_ids"] == "3,5,7"


@pytest.mark.parametrize("name", ["check_annotations", "contained_join", "overlap_join", "named_entities", "mention_pairs",
                                  "strip_report", "entities_by_type", "dependency_spans", "annotate_links"])
def test_no_exploded_rows_are_broadcast(spark, folder, name):
    lines = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            for below in lines[i + 1:]:
                if depth(below) <= depth(line):
                    break
                assert "Generate" not in below


def test_both_sides_of_a_block_agree(spark):
    for n in (1020, 1024, 1025, 1030, 5000):
        text = ("Ab c. d\n" * n)[:n]
        d = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
        toks = segmentation.tokens(d).collect()
        assert [t["text"] for t in toks] == [c for c in text.replace(".", " . ").split()]
        assert all(text[t["start"]:t["end"]] == t["text"] for t in toks)


def test_ids_of_huge_sentences_do_not_meet():
    assert S.SENTENCE_ID_STEP >= 1 << 32 and inputs.LEAF_IDS < inputs.RUN_IDS < S.SENTENCE_ID_STEP


def test_trees_of_any_shape(spark):
    """Bushy trees and long chains by brute force; nodes of finished rounds are not looked up again."""
    bushy = [(1, n, (n - 1) // 3 if n else None) for n in range(200)]
    chain = [(2, n, n - 1 if n else None) for n in range(150)]
    edges = spark.createDataFrame([(d, n, p, f"l{n}") for d, n, p in bushy + chain], "doc_id bigint, node_id bigint, parent_id bigint, label string")
    low = [(1, n) for n in range(67, 200)] + [(2, 149), (2, 70)]
    leaves = spark.createDataFrame([(d, 1000 + n, n, "w", 10 * n, 10 * n + 5) for d, n in low],
                                   "doc_id bigint, node_id bigint, parent_id bigint, label string, start bigint, `end` bigint")
    up, want = {(d, n): p for d, n, p in bushy + chain}, {}
    for d, n in low:
        at = n
        while at is not None:
            a, z = want.get((d, at), (10 ** 9, -1))
            want[d, at] = (min(a, 10 * n), max(z, 10 * n + 5))
            at = up[d, at]
    got = trees.tree_spans(edges, leaves)
    rows = got.collect()
    assert {(r["doc_id"], r["node_id"]): (r["start"], r["end"]) for r in rows} == want and len(rows) == len(want)
    assert all((r["parent_id"], r["label"]) == (up[r["doc_id"], r["node_id"]], f"l{r['node_id']}") for r in rows)
    flat = trees.tree_spans(edges.where("doc_id = 1"), leaves.where("doc_id = 1"))
    assert "Join" not in flat._jdf.queryExecution().executedPlan().toString()


def test_dependency_tables_write_no_text(spark, folder):
    toks, edges = inputs.dependency_tables(spark, folder)
    held = spark.read.parquet(*toks.inputFiles())
    assert held.columns == ["doc_id", "sent_no", "toks", "edges"] and "text" not in held.schema["toks"].simpleString()
