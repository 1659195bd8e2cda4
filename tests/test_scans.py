"""Scans over cells, sentence rows against tables, and the shape of their plans."""

import json
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marginalia.functions import durable, scans
from marginalia.operators import segmentation, tagging, trees
from marginalia.operators.spans import ordered_spans


def spans_of(seed, docs=5, count=60):
    rng = random.Random(seed)
    rows = []
    for d in range(docs):
        starts = sorted(rng.sample(range(400), count if d else 2))
        rows += [(d, s, s + rng.randint(1, 9), rng.choice([None, None, None, rng.randint(0, 50)])) for s in starts]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bits", [1, 4, 16])
def test_numbers_and_counts_go_through_cells(spark, bits):
    rows = spans_of(bits)
    df = spark.createDataFrame(rows, "doc_id bigint, start bigint, `end` bigint, sent_no bigint")
    got = {(r["doc_id"], r["start"]): (r["no"], r["all"]) for r in scans.numbered(df, "no", bits=bits, total="all").collect()}
    filled = {(r["doc_id"], r["start"]): r["filled"] for r in scans.counted_on(df, "sent_no", "filled", bits=bits).collect()}
    assert len(got) == len(filled) == len(rows)
    for d in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == d)
        last = 0
        for i, (_, start, _, number) in enumerate(mine, 1):
            last = last + 1 if number is None else number
            assert got[d, start] == (i, len(mine)) and filled[d, start] == last


@pytest.mark.parametrize("bits", [0, 2, 14])
@pytest.mark.parametrize("flush", [True, False])
def test_runs_go_through_cells(spark, monkeypatch, bits, flush):
    monkeypatch.setattr(scans.runs, "__defaults__", (bits,))
    rng = random.Random(bits)
    rows = [(d, s, t, 10 * t, 10 * t + 5, rng.choice(["A", "A", "B", "O"])) for d in range(3) for s in range(4) for t in range(1, 1 + 7 * s)]
    df = spark.createDataFrame(rows, "doc_id bigint, sent_no bigint, tok_no bigint, start bigint, `end` bigint, label string")
    want = []
    for d in range(3):
        for s in range(4):
            letters = "".join(r[5] for r in rows if r[:2] == (d, s))
            for m in re.finditer("A+|B+", letters):
                if flush or m.end() < len(letters):
                    want.append((d, m[0][0], 10 * (m.start() + 1), 10 * m.end() + 5))
    got = [tuple(r) for r in tagging.ne_from_labels(df, flush).collect()]
    assert sorted(got) == sorted(want)


def test_half_of_all_rows_in_one_document_are_shared_out(spark):
    """No window sees a document or a sentence, but for the rows that cells hand on."""
    df = spark.createDataFrame([(1, 70_000 * i, 70_000 * i + 5, None, i) for i in range(40)] + [(2, 0, 4, 7, 1)],
                               "doc_id bigint, start bigint, `end` bigint, sent_no bigint, tok_no bigint")
    frames = [segmentation.sentence_numbers(df.drop("sent_no")), segmentation.fill_sentence_numbers(df), ordered_spans(df),
              tagging.number_phrases(df.withColumns({c: F.lit("x") for c in ("text", "head")}).withColumn("head_no", F.lit(1)))]
    for frame in frames:
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if "Window [" in line and "_cell" not in line.split("],")[1]:
                # Over the document alone only sums of cells are scanned.
                assert "row_number" not in line and "start" not in line
        rows = scans.in_cells(df, "start", scans.CELL_BITS)
        assert rows.where("doc_id = 1").select("_cell").distinct().count() == 40


def made_sentences(seed, count=40):
    rng = random.Random(seed)
    out = []
    for s in range(count):
        n = rng.choice([0, 1, 2, 5, 30, 90])
        toks = [(10 * i, 10 * i + 4) for i in range(n)]
        edges = [(rng.randint(1, n), rng.choice([rng.randint(1, n), rng.randint(1, n), n + 3, None]),
                  rng.choice(["conj", "CONJ", "conj", "nsubj", "dobj"]), q) for q in range(rng.randint(0, 2 * n))] if n else []
        out.append((s % 3, s, toks, edges))
    return out


@pytest.mark.parametrize("limit", [1 << 14, 20, 0])
def test_sentence_rows_and_tables_agree(spark, monkeypatch, limit):
    monkeypatch.setattr(trees, "ROW_TOKENS", limit)
    rows = spark.createDataFrame(made_sentences(limit), (
        "doc_id bigint, sent_no bigint, toks array<struct<start:bigint,end:bigint>>,"
        " edges array<struct<dep_no:bigint,gov_no:bigint,relation:string,seq:bigint>>"))
    toks, edges = trees.tables_of(rows)
    found = lambda df: sorted(map(repr, (tuple(r) for r in df.collect())))
    deps = durable.durable(trees.dependency_spans(toks, edges), "deps")
    columns = deps.columns
    assert found(trees.sentence_dependencies(rows).select(*columns)) == found(deps)
    assert found(trees.sentence_dependencies(rows, resolve=True).select(*columns)) == found(trees.resolve_conjunctions(deps))


def test_lists_in_parts(spark):
    from marginalia.operators import coref, rollups, trees
    from marginalia.sources import codecs

    pairs = [(d, f"a{i % 7}", f"b{i:04d}", i / 100) for d in range(3) for i in range(1, 400 * d + 2)]
    links = spark.createDataFrame(pairs, "doc_id bigint, left_entity string, right_entity string, weight double")
    got = codecs.encode_links(links, 10).collect()
    lists = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["doc_id"], r["part"])):
        items = json.loads(r["data"])
        assert len(items) <= 10 and r["part"] == len(lists[r["doc_id"]]) / 10
        lists[r["doc_id"]] += [(r["doc_id"], i["leftEntity"], i["rightEntity"], i["weight"]) for i in items]
    assert [i for d in sorted(lists) for i in lists[d]] == sorted(pairs)

    ents = spark.createDataFrame([(d, "x", t) for d, t, *_ in [(p[0], p[2]) for p in pairs] * 2], "doc_id bigint, type string, text string")
    got = rollups.entities_by_type(ents, 7).orderBy("doc_id", "type", "part").collect()
    assert max(len(r["texts"]) for r in got) == 7
    assert [(r["doc_id"], t) for r in got for t in r["texts"]] == sorted({(p[0], p[2]) for p in pairs})

    edges = spark.createDataFrame([(0, i, 0 if i else None, -i) for i in range(100)], "doc_id bigint, node_id bigint, parent_id bigint, seq bigint")
    got = trees.child_ids(edges, 8).orderBy("part").collect()
    assert [c for r in got for c in r["child_ids"].split(",")] == [str(i) for i in range(99, 0, -1)] and len(got) == 13

    arcs = spark.createDataFrame([(0, 1, i) for i in range(2, 50)] + [(0, 2, 9), (0, 1, 2)], "doc_id bigint, src bigint, dst bigint")
    got = coref.coref_destinations(arcs, 5).orderBy("node_id", "part").collect()
    assert [d for r in got if r["node_id"] == 1 for d in r["dests"].split(",")] == [str(i) for i in range(2, 50)]
    assert {r["node_id"]: r["dests"] for r in got if r["node_id"] > 1} == {2: "9", **{i: "" for i in range(3, 50)}}


def test_a_key_with_most_rows_spreads_over_tasks(spark):
    rows = spark.range(20000).select(F.lit(1).cast("bigint").alias("doc_id"), F.col("id").alias("start"))
    with_parts = scans.in_parts(rows, ["doc_id"], ["start"], 100)
    assert with_parts.where("part <> start DIV 100").count() == 0
    held = [r["n"] for r in with_parts.groupBy("part").agg(F.count("*").alias("n")).collect()]
    assert held == [100] * 200


def test_short_lists_are_not_ranked(spark):
    """Keys with one part are counted and neither sorted nor joined; beside them a long list is parted as before."""
    rows = spark.range(0, 300).selectExpr("id % 100 AS doc_id", "id AS start")
    short = scans.in_parts(rows, ["doc_id"], ["start"], 3)
    assert "Join" not in short._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in short.collect()) == sorted((i % 100, i, 0) for i in range(300))
    both = scans.in_parts(rows.union(spark.range(0, 50).selectExpr("7L AS doc_id", "1000 + id AS start")), ["doc_id"], ["start"], 10)
    of = {}
    for r in both.orderBy("start").collect():
        of.setdefault(r["doc_id"], []).append(r["part"])
    assert of[7] == [i // 10 for i in range(53)] and all(of[d] == [0, 0, 0] for d in range(100) if d != 7)


def test_runs_of_short_keys_take_one_shuffle(spark):
    from marginalia.functions.scans import runs

    labels = "OAABBOA"
    rows = [(d, 0, i, labels[i % 7]) for d, n in ((1, 7), (2, 50)) for i in range(1, n)] + [(None, 0, 1, "A")]
    df = spark.createDataFrame(rows, "doc_id bigint, sent_no bigint, tok_no bigint, label string")
    counts = lambda found: sorted(map(tuple, found.groupBy("doc_id", "_run", "label", "_last").count().drop("_run").collect()))
    short = runs(df, "label", ["doc_id", "sent_no"], "tok_no")
    # With cells of 8 tokens one key is short and one is not; with cells of 4 both go through the cells.
    assert counts(short) == counts(runs(df, "label", ["doc_id", "sent_no"], "tok_no", 3)) == counts(runs(df, "label", ["doc_id", "sent_no"], "tok_no", 2))
    plan = short._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_sizes_of_cells_need_no_order_of_attributes(spark):
    from marginalia.operators import guards
    from marginalia.schema import ANNOTATIONS
    from marginalia.sources import codecs

    ann = spark.createDataFrame([(1, "T", 2, 0, 3, "é\"", {"b": "2", "a": None}), (1, "T", 1, 0, 3, None, None)], ANNOTATIONS)
    cell = codecs.encode_set(ann).first()
    sizes = guards.cell_sizes(ann)
    assert [r["bytes"] for r in sizes.collect()] == [len(cell[3].encode())]
    assert "array_sort" not in sizes._jdf.queryExecution().executedPlan().toString()
