"""Boundary cases with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from marginalia.operators import audit, coref, entities, guards, rollups, segmentation, spans
from marginalia.operators import tagging, terms, trees


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def span_rows(df, *columns):
    return sorted(tuple(r) for r in df.select("doc_id", "start", "end", *columns).collect())


def ann(spark, *rows):
    schema = "doc_id bigint, `set` string, ann_id bigint, start bigint, `end` bigint, type string"
    empty = F.array().cast("array<string>")
    listed = [(0, "TOKEN", k, s, e, "token") for k, (s, e) in enumerate(rows)]
    return spark.createDataFrame(listed, schema).withColumn("attrs", F.map_from_arrays(empty, empty))


@pytest.mark.parametrize("text, expected", [
    ("The cat's 2 CATS_9 éab ABC 123 a1b", ["the", "cat", "cats_9", "abc", "a1b"]),
    ("", []),
    (None, []),
])
def test_term_list(spark, text, expected):
    assert terms.term_list(docs(spark, text)).first()["terms"] == expected


@pytest.mark.parametrize("text, expected", [
    ("Hi there. Bye", [(0, 0, 10), (0, 10, 13)]),
    ("Hi. x", [(0, 0, 4), (0, 4, 5)]),
    ("no stop", [(0, 0, 7)]),
    ("x", [(0, 0, 1)]),
    ("a.\nb.", [(0, 0, 2), (0, 3, 5)]),
])
def test_sentences(spark, text, expected):
    d = docs(spark, text)
    assert span_rows(segmentation.sentences(d)) == expected
    assert span_rows(segmentation.sentences(d, segmentation.paragraphs(d).drop("text"))) == expected


def test_tails_go_on_demand_only(spark):
    d = docs(spark, "Hi. x")
    assert span_rows(segmentation.sentences(d, drop_tails=True)) == [(0, 0, 4)]
    none = segmentation.paragraphs(d).where("1 = 0")
    assert span_rows(segmentation.default_paragraph(d, none)) == [(0, 0, 5)]
    assert span_rows(segmentation.default_paragraph(d, none, less_one=True)) == [(0, 0, 4)]


def test_offsets_are_code_points_and_blanks_are_no_tokens(spark):
    d = docs(spark, "\t😀 né\u000b\f ok ,x  ")
    found = span_rows(segmentation.tokens(d), "text")
    assert found == [(0, 1, 2, "😀"), (0, 3, 5, "né"), (0, 8, 10, "ok"), (0, 11, 12, ","), (0, 12, 13, "x")]


def test_long_texts_cross_segment_blocks(spark):
    text = " ".join(f"w{i}" for i in range(3000)) + ". " + "é" * 5000
    d = docs(spark, text)
    sents = segmentation.sentences(d)
    toks = segmentation.tokens(d)
    for r in [*sents.collect(), *toks.collect()]:
        assert text[r["start"]:r["end"]] == r["text"]
    assert toks.count() == 3002
    covered = spans.covered_text(toks.drop("text"), d)
    assert sorted(r["text"] for r in covered.collect()) == sorted(r["text"] for r in toks.collect())


def test_covered_text_of_odd_spans(spark):
    d = docs(spark, "abc" * 2000)
    given = spark.createDataFrame([(0, 0, 6000), (0, 4095, 4097), (0, 4096, 4096), (0, 5, 3),
                                   (0, 5998, 9000), (0, 7000, 7001)], "doc_id bigint, start bigint, `end` bigint")
    found = {(r["start"], r["end"]): r["text"] for r in spans.covered_text(given, d).collect()}
    whole = "abc" * 2000
    assert found == {(s, e): whole[s:e] for s, e in found} and len(found) == 6


def test_fill_sentence_numbers(spark):
    rows = [(0, 0, 1, None), (0, 1, 2, None), (0, 2, 3, 7), (0, 3, 4, None)]
    given = spark.createDataFrame(rows, "doc_id bigint, start bigint, `end` bigint, sent_no bigint")
    filled = segmentation.fill_sentence_numbers(given).orderBy("start").collect()
    assert [r["filled"] for r in filled] == [1, 2, 7, 8]


def test_ne_from_labels(spark):
    rows = [(0, 0, k + 1, k, k + 1, label) for k, label in enumerate("OAAB")]
    given = spark.createDataFrame(
        rows, "doc_id bigint, sent_no bigint, tok_no bigint, start bigint, `end` bigint, label string")
    assert span_rows(tagging.ne_from_labels(given), "type") == [(0, 1, 3, "A"), (0, 3, 4, "B")]
    assert span_rows(tagging.ne_from_labels(given, False), "type") == [(0, 1, 3, "A")]


@pytest.mark.parametrize("text, loud", [("HE RAN", True), ("HE Ran", False), ("HELLO", False)])
def test_all_caps_lower(spark, text, loud):
    d = docs(spark, text)
    toks = segmentation.all_caps_lower(segmentation.sentences(d), segmentation.tokens(d))
    for r in toks.collect():
        assert r["text_norm"] == (r["text"].lower() if loud else r["text"])


@pytest.mark.parametrize("span, flags, failed", [
    ((0, 9), {"good"}, None),
    ((0, 10), set(), None),
    ((11, 12), {"bad start", "bad end"}, 1),
    ((5, 5), {"good", "invalid"}, 0),
    ((12, 11), {"bad start", "bad end", "invalid"}, 2),
])
def test_audit(spark, span, flags, failed):
    d, given = docs(spark, "x" * 10), ann(spark, span)
    assert {r["flag"] for r in audit.check_annotations(given, d).collect()} == flags
    report = audit.strip_report(given, d).collect()
    assert [r["failed_removals"] for r in report] == ([] if failed is None else [failed])
    left = audit.strip_bad_annotations(given, d)
    assert left.count() == (1 if failed is None else 0)
    assert {r["flag"] for r in audit.check_annotations(left, d).collect()} <= {"good"}


@pytest.mark.parametrize("n, kept", [(100, 1), (101, 0)])
def test_skip_long_sentences(spark, n, kept):
    d = docs(spark, "a " * n)
    assert guards.skip_long_sentences(d, segmentation.tokens(d), 100).count() == kept


@pytest.mark.parametrize("n, kept", [(999, 1), (1000, 0)])
def test_skip_many_nps(spark, n, kept):
    nps = spark.range(n).select(F.lit(0).cast("bigint").alias("doc_id"))
    assert guards.skip_many_nps(docs(spark, "x"), nps, 1000).count() == kept


def test_np_log10_histogram(spark):
    sizes = [9, 10, 99, 100, 1000]
    rows = [(doc,) for doc, n in enumerate(sizes) for _ in range(n)]
    found = rollups.np_log10_histogram(spark.createDataFrame(rows, "doc_id bigint"))
    assert {r["bucket"]: r["docs"] for r in found.collect()} == {0: 1, 1: 2, 2: 1, 3: 1}


def test_document_number_wraps(spark):
    d = spark.range(40000).select((F.col("id") * 3).alias("doc_id"), F.lit("ab").alias("text"))
    found = {r["doc_id"] // 3: r["doc_no"] for r in segmentation.document_number(d).collect()}
    assert all(found[k] == k % 32767 + 1 for k in range(40000))
    assert (found[32766], found[32767]) == (32767, 1)


@pytest.mark.parametrize("blank", ["", None, " \t\n\x00"])
def test_guard_no_text(spark, blank):
    d = docs(spark, "x", blank)
    assert guards.guard_no_text(d, "blank").count() == 1
    assert guards.guard_no_text(d).count() == (2 if blank else 1)


def test_gazetteer_and_patterns_at_the_edges(spark):
    d = docs(spark, "12:30 and 3.5%", "at 2024-01-31")
    found = entities.named_entities(d)
    assert span_rows(found, "type", "text") == [
        (0, 0, 5, "time", "12:30"), (0, 10, 14, "percentage", "3.5%"), (1, 3, 13, "date", "2024-01-31")]


def conj(spark, rows):
    schema = "doc_id bigint, sent_no bigint, tok_no bigint, type string, gov string, gov_id bigint"
    return trees.resolve_conjunctions(spark.createDataFrame([(0, 0, *r) for r in rows], schema))


def test_resolve_conjunctions(spark):
    found = conj(spark, [(1, "ROOT", None, None), (2, "nsubj", "g1", 1), (3, "conj", "g2", 2),
                         (4, "conj", "g3", 3), (5, "conj", "g6", 6), (6, "conj", "g5", 5),
                         (7, "conj", "g6", 6), (8, "conj", "g1", 1)])
    out = {r["tok_no"]: (r["type"], r["gov_id"]) for r in found.collect()}
    assert out == {1: ("ROOT", None), 2: ("nsubj", 1), 3: ("nsubj", 1), 4: ("nsubj", 1),
                   5: ("conj", 6), 6: ("conj", 5), 7: ("conj", 6), 8: ("ROOT", None)}


def test_resolve_long_chain(spark):
    rows = [(1, "dobj", "g0", 99)] + [(k, "conj", "g", k - 1) for k in range(2, 80)]
    assert {r["type"] for r in conj(spark, rows).collect()} == {"dobj"}


def test_coref_destinations(spark):
    links = spark.createDataFrame([(0, 1, 2), (0, 1, 3), (0, 2, 3)], "doc_id bigint, src bigint, dst bigint")
    found = {r["node_id"]: r["dests"] for r in coref.coref_destinations(links).collect()}
    assert found == {1: "2,3", 2: "3", 3: ""}


def test_clusters_of_paths_and_stars(spark):
    path = [(0, k, k + 1, 0.9) for k in range(1, 60)]
    star = [(1, 5, k, 0.5) for k in range(6, 40)]
    weak = [(1, 1, 5, 0.49)]
    scored = spark.createDataFrame(path + star + weak, "doc_id bigint, i bigint, j bigint, weight double")
    nps = spark.createDataFrame([(0, k) for k in range(1, 62)] + [(1, k) for k in range(1, 40)],
                                "doc_id bigint, ce_id bigint")
    found = {(r["doc_id"], r["ce_id"]): r["cluster_id"] for r in
             coref.coref_clusters(scored, nps).collect()}
    assert len(found) == 61 + 39
    assert all(found[0, k] == 1 for k in range(1, 61)) and found[0, 61] == 61
    assert all(found[1, k] == (5 if k >= 5 else k) for k in range(1, 40))


def test_no_pairs_no_clusters(spark):
    scored = spark.createDataFrame([(0, 1, 2, 0.1)], "doc_id bigint, i bigint, j bigint, weight double")
    nps = spark.createDataFrame([(0, 1), (0, 2)], "doc_id bigint, ce_id bigint")
    assert {r["cluster_id"] for r in coref.coref_clusters(scored, nps).collect()} == {1, 2}


def naive_cuts(n, places, ranks, limit, low=0):
    """One range after the other, by plain scanning to the left."""
    if n <= limit:
        return []
    here = {p - low: r for p, r in zip(places, ranks) if low <= p < low + n}
    for best in range(4):
        for at in range(n // 2, -1, -1):
            if here.get(at) == best:
                return (naive_cuts(at + 1, places, ranks, limit, low) + [low + at]
                        + naive_cuts(n - at - 1, places, ranks, limit, low + at + 1))
    return []


def test_cuts_of_long_sentences(spark):
    import random

    rng = random.Random(3)
    rows = []
    for k in range(150):
        n = rng.randint(1, 60)
        places = dict.fromkeys(sorted(rng.sample(range(n), rng.randint(0, n // 3))))
        rows.append((k, [rng.choice(";:,.") if i in places else f"w{i}" for i in range(n)]))
    rows += [(150, ["a"] * 9), (151, [";"] * 40), (152, list("ab;") + ["c"] * 60), (153, []),
             (154, [";:,."[i % 4] if i % 3 else "w" for i in range(5000)])]
    # One sentence a document; stops do not end it here.
    sents = spark.createDataFrame([(k, 0, 0, len(" ".join(w)), " ".join(w)) for k, w in rows],
                                  "doc_id bigint, sent_no bigint, start bigint, `end` bigint, text string")
    toks = segmentation.tokens(None, sents)
    want = set()
    for k, words in rows:
        text = " ".join(words)
        at = [0]
        for w in words:
            at.append(at[-1] + len(w) + 1)
        places = [i for i, w in enumerate(words) if w in ";:,."]
        cuts = naive_cuts(len(words), places, [";:,.".index(words[i]) for i in places], 8)
        starts = [0] + [at[c + 1] for c in cuts]
        ends = [at[c + 1] - 1 for c in cuts] + [len(text)]
        want |= {(k, no, s, e) for no, (s, e) in enumerate(zip(starts, ends))}
    for got in (segmentation.split_long_sentences(sents, limit=8), segmentation.split_long_sentences(sents, toks, 8)):
        out = [(r["doc_id"], r["part_no"], r["start"], r["end"]) for r in got.collect()]
        assert len(out) == len(want) and set(out) == want
    # A limit of one token ends too, and no Python runs.
    assert segmentation.split_long_sentences(sents.where("doc_id = 151"), limit=1).count() == 40
    plan = segmentation.split_long_sentences(sents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_range_joins_by_brute_force(spark):
    import random

    rng = random.Random(5)
    side = lambda size: [(rng.randint(0, 1), s, s + rng.randint(-3, 700)) for s in
                         (rng.randint(0, 3000) for _ in range(size))]
    a, b = side(120), side(120)
    schema = "doc_id bigint, start bigint, `end` bigint"
    da, db = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    rows = lambda df: sorted(tuple(r) for r in df.select(
        "doc_id", "a_start", "a_end", "b_start", "b_end").collect())
    pairs = [(d, s, e, s2, e2) for d, s, e in a for d2, s2, e2 in b if d == d2]
    assert rows(spans.overlap_join(da, db)) == sorted(p for p in pairs if p[1] < p[4] and p[2] > p[3])
    assert rows(spans.contained_join(da, db)) == sorted(
        p for p in pairs if p[1] <= p[2] and p[1] >= p[3] and p[2] <= p[4])
    own = [(d, s, e, s2, e2) for d, s, e in a for d2, s2, e2 in a if d == d2]
    assert rows(spans.crossing_spans(da)) == sorted(p for p in own if p[1] < p[3] < p[2] < p[4])
    with pytest.raises(ValueError):
        spans.require_no_crossing(da)
