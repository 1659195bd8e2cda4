"""Properties of the jobs, skewed inputs and the shape of plans."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from marginalia import schema as S
from marginalia.catalog import inputs
from marginalia.functions import durable, words
from marginalia.operators import coref, entities, guards, segmentation, spans, tagging
from marginalia.plans import annotate as plan
from marginalia.sources import codecs, documents, store


def explained(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def flat(ann):
    return ann.withColumn("attrs", F.to_json("attrs"))


def test_segments_give_back_the_text(spark, folder):
    d = inputs.docs(spark, folder)
    sents = segmentation.sentences(d)
    joined = sents.groupBy("doc_id", "par_no").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("start", "text")))["text"], "").alias("t"))
    pars = segmentation.paragraphs(d).join(joined, ["doc_id", "par_no"])
    # Only a dropped one-character tail may be missing.
    assert pars.where((F.col("text") != F.col("t"))
                      & (F.expr("left(text, length(text) - 1)") != F.col("t"))).isEmpty()


def test_tokens_lie_in_one_sentence_and_phrases_do_not_cross(spark, folder):
    d = inputs.docs(spark, folder)
    toks, sents = segmentation.tokens(d), segmentation.sentences(d)
    met = spans.overlap_join(toks.select("doc_id", "start", "end"), sents.select("doc_id", "start", "end"))
    assert met.count() == toks.count()
    assert spans.crossing_spans(tagging.base_noun_phrases(d)).isEmpty()


def test_no_shuffle_from_text_to_tags(spark, folder):
    scan = documents.scan_documents(spark, folder)
    for df in (segmentation.paragraphs(scan), segmentation.sentences(scan), segmentation.tokens(scan),
               tagging.pos_tags(segmentation.tokens(scan)), plan.multi_layer_annotate(scan)):
        assert "Exchange" not in explained(df)


def test_scans_prune_and_push_down(spark, folder, tmp_path):
    text = explained(documents.scan_from_key(
        documents.scan_documents(spark, folder, ("doc_id", "source")), 100))
    assert "GreaterThanOrEqual(doc_id,100)" in text and "text" not in text.split("ReadSchema")[1]
    path = str(tmp_path / "store")
    store.write_annotations(inputs.annotations(spark, folder), path)
    kept = explained(store.read_sets(spark, path, ["PAR"])).split("PartitionFilters: [")[1]
    assert "set#" in kept.split("]")[0]


def test_range_join_meets_by_cell(spark, folder):
    d = inputs.docs(spark, folder)
    text = explained(spans.overlap_join(segmentation.tokens(d).select("doc_id", "start", "end"),
                                        segmentation.sentences(d).select("doc_id", "start", "end")))
    assert "NestedLoop" not in text and "Cartesian" not in text and "_cell" in text


def test_codec_round_trip(spark, folder):
    ann = inputs.annotations(spark, folder)
    assert rows(flat(codecs.decode_set(codecs.encode_set(ann)))) == rows(flat(ann))


def test_cells_of_long_documents_are_cut(spark):
    d = spark.createDataFrame([(1, "ab. " * 200)], "doc_id bigint, text string")
    ann = plan.base_layers(d)
    cells = codecs.encode_set(ann, cell_chars=100)
    assert cells.groupBy("doc_id", "set").count().agg(F.max("count")).first()[0] == 8
    assert rows(flat(codecs.decode_set(cells))) == rows(flat(ann))


def unreadable(docs):
    """The same documents; whoever reads a text fails."""
    return docs.withColumn("text", F.raise_error(F.lit("a text was read")).cast("string"))


def test_second_run_reads_no_text_and_store_equals_one_run(spark, folder, tmp_path):
    d, path = inputs.docs(spark, folder), str(tmp_path / "store")
    counters = Observation("layers")
    added = plan.annotate_incremental(d, path, counters=counters)
    assert counters.get == {name: added.where(F.col("set") == name).count() for name in S.ALL_SETS}
    assert plan.annotate_incremental(unreadable(d), path).isEmpty()
    assert rows(flat(store.read_sets(spark, path))) == rows(flat(plan.annotate(d)[0]))
    one_more = d.unionByName(spark.createDataFrame([(10**9, "A new dog.")], "doc_id bigint, text string"))
    added = plan.annotate_incremental(one_more, path)
    assert {r["doc_id"] for r in added.collect()} == {10**9}


def test_store_with_gaps_is_completed(spark, folder, tmp_path):
    d, path = inputs.docs(spark, folder), str(tmp_path / "store")
    held = inputs.stored(spark, folder)
    store.write_annotations(held, path)
    plan.annotate_incremental(d, path)
    layers, links = plan.annotate(d, held)
    assert rows(flat(store.read_sets(spark, path))) == rows(flat(layers))
    base = layers.where(F.col("set").isin(*S.BASE_SETS))
    assert rows(flat(base)) == rows(flat(plan.base_layers(d, held)))
    assert plan.annotate_incremental(unreadable(d), path).isEmpty()


def test_links_over_stored_layers_are_those_of_one_run(spark, folder):
    d = inputs.docs(spark, folder)
    rules = plan.Rules(patterns=inputs.CHECK_PATTERNS, gazetteer=inputs.gazetteer(spark))
    layers, links = plan.annotate(d, config=rules)
    held = durable.durable(layers.where("doc_id % 3 <> 0 OR set NOT IN ('NE', 'NP', 'POS')"), "held")
    again, links_again = plan.annotate(d, held, rules)
    assert rows(flat(again)) == rows(flat(layers))
    assert rows(links_again) == rows(links)


def test_phrases_are_made_from_stored_layers(spark, tmp_path):
    d = spark.createDataFrame([(1, "He saw the old\nhouse today."), (2, ""), (3, None)], "doc_id bigint, text string")
    path = str(tmp_path / "store")
    whole = segmentation.default_paragraph(d.where("doc_id = 1"), segmentation.paragraphs(d).where("1 = 0"))
    store.write_annotations(plan.paragraph_layer(whole), path)
    plan.annotate_incremental(d, path)
    got = [(r["set"], r["start"], r["end"]) for r in store.read_sets(spark, path, ["SENT", "NP"]).collect()]
    assert sorted(got) == [("NP", 0, 2), ("NP", 3, 26), ("SENT", 0, 27)]
    # Documents without rows are finished too.
    assert store.read_cells(spark, path).count() == 3 * len(S.ALL_SETS)
    assert plan.annotate_incremental(unreadable(d), path).isEmpty()


def test_stored_entities_are_those_of_the_phrases(spark, tmp_path):
    d = spark.createDataFrame([(1, "It may of 77.")], "doc_id bigint, text string")
    path = str(tmp_path / "store")
    entity = spark.createDataFrame([(1, 3, 9, "x", "may of")], "doc_id bigint, start bigint, `end` bigint, type string, text string")
    store.write_annotations(plan.entity_layer(entity), path)
    plan.annotate_incremental(d, path)
    got = {(r["start"], r["end"]) for r in store.read_sets(spark, path, ["NP"]).collect()}
    assert got == {(0, 2), (3, 9)}


def test_entities_are_added_where_phrases_are_stored(spark, tmp_path):
    d = spark.createDataFrame([(1, "Mail bob@example.com on 2021-03-04 or visit http://example.org/a today."),
                               (2, "The old house stands here.")], "doc_id bigint, text string")
    path, part = str(tmp_path / "store"), str(tmp_path / "part")
    plan.annotate_incremental(d, path)
    whole = store.read_sets(spark, path)
    assert not whole.where("set = 'NE'").isEmpty()
    store.write_annotations(whole.where("set <> 'NE'"), part)
    added = plan.annotate_incremental(d, part)
    assert {r["set"] for r in added.select("set").distinct().collect()} == {"NE"}
    assert rows(flat(store.read_sets(spark, part))) == rows(flat(whole))


@pytest.mark.parametrize("partitions", ["1", "64"])
def test_results_do_not_depend_on_partitions(spark, folder, partitions):
    d = inputs.docs(spark, folder)

    def results():
        nps = tagging.base_noun_phrases(d)
        return [rows(nps), rows(coref.coref_links(coref.pair_scores(
            coref.candidate_features(nps)), nps))]

    before = results()
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert results() == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def test_one_document_with_most_of_the_text(spark, folder):
    """A hot document: joins on spans share it out and the results stay whole."""
    big = "The red fox, the dog and it ran. " * 4000
    d = spark.createDataFrame([(1, big), (2, "A cat sat."), (3, "It is.")], "doc_id bigint, text string")
    toks, sents = segmentation.tokens(d), segmentation.sentences(d)
    met = spans.overlap_join(toks.select("doc_id", "start", "end"),
                             sents.select("doc_id", "start", "end", "sent_no"))
    assert met.count() == toks.count()
    text = spans.covered_text(toks.drop("text"), d).groupBy("text").count().collect()
    assert {r["text"]: r["count"] for r in text}["fox"] == 4000
    nps = tagging.base_noun_phrases(d)
    assert guards.skip_many_nps(d, nps, 1000).count() == 2
    pairs = coref.mention_pairs(nps).where("doc_id = 1").count()
    assert 0 < pairs <= 3 * nps.where("doc_id = 1").count()


def test_pairs_by_brute_force(spark):
    d = spark.createDataFrame([(1, "The dog ran. A cat sat. The cow is big. It ate. The dog sat. The end. We go. The dog. The dog.")],
                              "doc_id bigint, text string")
    nps = tagging.base_noun_phrases(d).collect()
    wanted = set()
    for b in nps:
        before = [a for a in nps if a["ce_id"] < b["ce_id"]]
        for same in (lambda a: a["text"].lower() == b["text"].lower(), lambda a: a["head"].lower() == b["head"].lower(),
                     lambda a: a["ce_id"] == b["ce_id"] - 1):
            wanted |= {(max(a["ce_id"] for a in before if same(a)), b["ce_id"])} if any(map(same, before)) else set()
    found = [(r["i"], r["j"]) for r in coref.mention_pairs(tagging.base_noun_phrases(d)).collect()]
    assert sorted(found) == sorted(wanted)


def test_failing_documents_are_set_aside_and_tried_again(spark, tmp_path):
    d = spark.createDataFrame([(1, "A dog."), (2, "x" * 50), (3, "no number")], "doc_id bigint, text string")
    path = str(tmp_path / "store")
    rules = plan.Rules(checks={"long": F.length("text") < 20, "digits": F.expr("try_cast(text AS int)").isNull()})
    d = d.unionByName(spark.createDataFrame([(4, "12345"), (5, None)], d.schema))
    added = plan.annotate_incremental(d, path, rules)
    assert {r["doc_id"] for r in added.select("doc_id").distinct().collect()} == {1, 3}
    assert sorted(map(tuple, plan.stored_errors(spark, path).collect())) == [(2, "long"), (4, "digits"), (5, "long")]
    # The next run tries those three only, and takes the cells of those that pass away.
    added = plan.annotate_incremental(d, path, plan.Rules(checks={"long": F.length("text") < 60}))
    assert {r["doc_id"] for r in added.select("doc_id").distinct().collect()} == {2, 4}
    assert sorted(map(tuple, plan.stored_errors(spark, path).collect())) == [(5, "long")]


def test_phrases_of_the_word_list(spark, tmp_path):
    d = spark.createDataFrame([(1, "The New York City Hall of new york. York City, New\tYORK!"), (2, "old york city hall"), (3, "")],
                              "doc_id bigint, text string")
    listed = spark.createDataFrame([("new york", "location"), ("New York City", "location"), ("york", "person"), ("york city hall", "time"),
                                    ("city, new", "money"), ("hall", "time"), ("hall", "person"), ("", "date"), (None, "date")],
                                   "word string, type string")
    want = [(1, "location", "New York City"), (1, "location", "new york"), (1, "money", "City, New"), (1, "person", "Hall"),
            (1, "person", "YORK"), (1, "person", "York"), (1, "time", "Hall"), (2, "time", "york city hall")]
    rules = plan.Rules(gazetteer=listed)
    tagged = tagging.tagged_tokens(segmentation.sentences(d))
    found = entities.gazetteer_phrases(tagged, listed)
    assert sorted((r["doc_id"], r["type"], r["text"]) for r in found.collect()) == sorted(want)
    assert all(d.collect()[r["doc_id"] - 1]["text"][r["start"]:r["end"]] == r["text"] for r in found.collect())
    # The same from stored tokens.
    layers, _ = plan.annotate(d, config=rules)
    path = str(tmp_path / "store")
    store.write_annotations(layers.where("set IN ('PAR', 'SENT', 'TOKEN', 'POS')"), path)
    plan.annotate_incremental(d, path, rules)
    assert rows(flat(store.read_sets(spark, path))) == rows(flat(layers))
    assert entities.gazetteer_phrases(tagged, listed.where("word = ''")).isEmpty()


def test_entities_outside_phrases_become_phrases(spark):
    d = spark.createDataFrame([(1, "It cost 3.5% of $7.")], "doc_id bigint, text string")
    from marginalia.operators.entities import named_entities

    texts = [r["text"] for r in tagging.base_noun_phrases(
        d, ents=named_entities(d)).orderBy("ce_id").collect()]
    assert texts == ["It", "cost 3", "$7"]


def test_shared_folder_is_the_configured_one(spark):
    assert durable.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_segments_of_odd_texts(spark):
    """Null and empty texts, and a sentence of many tokens; no array grows by appending, which copies it every time."""
    assert "array_append" not in segmentation.token_spans("text")
    long = "ab é, " * 3000
    found = spark.createDataFrame([(0, None), (1, ""), (2, " x  y"), (3, long)], "doc_id bigint, text string").select(
        "doc_id", F.expr(segmentation.token_spans("text", "5L")).alias("s")).collect()
    spans_of = {r["doc_id"]: r["s"] and [tuple(s) for s in r["s"]] for r in found}
    assert (spans_of[0], spans_of[1], spans_of[2]) == (None, [], [(6, 7, "x"), (9, 10, "y")])
    assert len(spans_of[3]) == 9000 and all(long[a - 5:b - 5] == text for a, b, text in spans_of[3])


def test_candidates_carry_no_words(spark, folder):
    """Three shuffles, for the mention before, the same text and the same head; none of them has a list of words."""
    nps = spark.createDataFrame([], "doc_id bigint, ce_id bigint, sent_no bigint, start bigint, end bigint, text string, head string, head_no bigint")
    text = explained(coref.candidate_features(nps))
    assert text.count("Exchange hashpartitioning") == 3
    assert "Join" not in text


def test_the_mention_before_across_blocks(spark):
    n = 2 * (1 << 10) + 3
    nps = spark.range(1, n + 1).selectExpr("1L AS doc_id", "id AS ce_id", "0L AS sent_no", "concat('w', id) AS text", "concat('w', id) AS head")
    assert rows(coref.mention_pairs(nps)) == sorted(repr((1, i, i + 1)) for i in range(1, n))


def test_cells_shuffle_values_and_not_json(spark, folder):
    ann = spark.createDataFrame([(1, "T", 2, 0, 3, "é\"", {"b": "2", "a": None}), (1, "T", 1, 0, 3, None, None)], S.ANNOTATIONS)
    cells = codecs.encode_set(ann)
    assert [tuple(r) for r in cells.collect()] == [
        (1, "T", 0, '[{"ann_id":1,"start":0,"end":3},{"ann_id":2,"start":0,"end":3,"type":"é\\"","attrs":{"a":null,"b":"2"}}]')]
    behind = explained(cells).split("Exchange")[1]
    assert "to_json" not in behind and "structstojson" not in behind.lower()


ODD_TEXTS = [(1, None), (2, ""), (3, " \t x"), (4, "Ünï çödé. ΑΒΓ ʼn 中文字 x１２ ½ٱ١ 😀😀a😀 b‿c"), (5, "İ KELVINK K ſ  x\u0085y NEL The CAT Running. 12 12a ４ 4."),
             (6, "a . . . b?! c\n\n.d  . \ne"), (7, "He she. Its his Dog Ⅷ ǅ ǈings, New Words"), (8, "".join(map(chr, range(1, 0x3000))))]


def test_tokens_and_tags_by_arrays_are_those_of_the_rules(spark):
    sents = segmentation.sentences(spark.createDataFrame(ODD_TEXTS, "doc_id bigint, text string"))
    tagged = tagging.tagged_tokens(sents)
    span = "t.`start` AS `start`, t.`end` AS `end`, t.`text` AS `text`"
    tag = tagging.tag_of("t.`text`", "lower(t.`text`)", "i + 1")
    by_rules = sents.withColumn("toks", F.expr(f"transform({segmentation.token_spans('`text`', '`start`')}, (t, i) -> struct({span}, {tag} AS tag))"))
    assert rows(tagged) == rows(by_rules)
    held = durable.durable(sents, "sents")
    for df in (tagging.tagged_tokens(held), segmentation.tokens(None, held), plan.text_layers(tagging.tagged_tokens(held)),
               tagging.sentence_noun_phrases(tagging.tagged_tokens(held))):
        assert "lambda" not in explained(df)


def test_phrases_are_numbered_in_the_document(spark):
    """Without a shuffle of phrases; ids that come again are numbered over all their rows."""
    d = spark.createDataFrame([*ODD_TEXTS, (9, "The cat. A dog saw it."), (9, "My old house. Sam ran."), (None, "The cat.")], "doc_id bigint, text string")
    found = tagging.base_noun_phrases(d)
    assert rows(found) == rows(tagging.number_phrases(tagging.sentence_noun_phrases(tagging.tagged_tokens(segmentation.sentences(d)))))
    assert [r["ce_id"] for r in found.where("doc_id = 9").orderBy("ce_id").collect()] == [1, 2, 3, 4, 5]
    assert "Exchange" not in explained(tagging.base_noun_phrases(durable.durable(d.where("doc_id < 9"), "docs")))


def test_stored_tokens_are_spelled_once_a_row(spark):
    """A list looked up in stored tokens spelled all tokens of a sentence anew for each of them."""
    text = "é word, " * 50
    d = spark.createDataFrame([(1, text), (2, "x Word")], "doc_id bigint, text string")
    layers = durable.durable(plan.base_layers(d), "layers")
    stored = plan.stored_sentences(layers.where("set = 'TOKEN'"), d)
    assert rows(stored.select("doc_id", "sent_no", "toks")) == rows(segmentation.tokens(d).groupBy("doc_id", "sent_no").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "text"))).alias("toks")))
    listed = spark.createDataFrame([("word", "person")], "word string, type string")
    found = entities.gazetteer_phrases(stored, listed)
    assert found.count() == 51 and "lambdafunction(substring" not in explained(found) and "lambda i" not in explained(found)
    assert "lambda" not in explained(found).split("Generate explode")[1].split("Project")[0]


def test_spans_over_broken_and_missing_places(spark):
    from marginalia.functions.words import spelled_arrays

    df = spark.createDataFrame([("aébc", 10, [(10, 12), (11, 99), (13, 12), (None, 12)]), ("", 0, [(0, 3)]), (None, None, None)],
                               "text string, start bigint, places array<struct<start:bigint,end:bigint>>")
    got = df.select(spelled_arrays(spark)(F.col("text"), F.col("start"), F.col("places")).alias("s")).collect()
    assert [r["s"] and [t["text"] for t in r["s"]] for r in got] == [["aé", "ébc", "", None], [""], None]


def test_layers_of_texts_are_rows_at_once(spark, folder):
    text = explained(plan.base_layers(documents.scan_documents(spark, folder)))
    assert "MapInArrow" in text and "Generate" not in text and "Exchange" not in text


def test_layers_of_odd_texts(spark):
    texts = ["", None, " ", "\n\n", "a.", "  One two.  Three!\n\nfour\n.x. .\n", "Éa ß中 ½.\u2028b", "U.S. ones\t2.5", "no end\n \n"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    apart = plan.paragraph_layer(segmentation.paragraphs(d)).unionByName(
        plan.text_layers(tagging.tagged_tokens(segmentation.sentences(d))))
    assert rows(flat(plan.base_layers(d))) == rows(flat(apart))
    flags = d.withColumn("on", F.when(F.col("doc_id") == 5, True).when(F.col("doc_id") == 6, False))
    made = plan.flagged_layers(flags, sent=F.col("on"), pos=F.col("on"))
    assert rows(flat(made)) == rows(flat(apart.where("doc_id = 5 AND set IN ('SENT', 'POS')")))


def test_missing_layers_leave_stored_rows_in_place(spark, folder):
    held = durable.durable(inputs.stored(spark, folder), "stored")
    state = durable.durable(plan.with_state(inputs.docs(spark, folder), held), "state")
    assert "Exchange hashpartitioning" not in explained(plan.kept_rows(state, held))


def test_stored_sentences_are_made_once(spark, folder):
    d = inputs.docs(spark, folder)
    # The cut into sentences is not part of what reads their places.
    assert "[^.!?]" not in explained(segmentation.tokens(d, segmentation.sentences(d).drop("text")))


def test_ascii_tokens_are_tagged_together(monkeypatch):
    texts = [".", ",", "-", "_", "x", "7", "2024", "2nd", "The", "their", "Running", "ings", "classes", "Able", "notable", "Paris", "I", "É", "éclairs"]
    kinds = np.array([words.CAPITAL_WORD if t[0].isupper() else words.WORD if t[0].isalnum() or t[0] == "_" else words.OTHER for t in texts], np.uint8)
    one_by_one = [tagging.word_tag(t, k) for t, k in zip(texts, kinds.tolist())]
    asked = []
    alone = tagging.word_tag
    monkeypatch.setattr(tagging, "word_tag", lambda t, k: asked.append(t) or alone(t, k))
    names, codes = tagging.word_tags(pa.array(texts), kinds)
    assert [names[c] for c in codes] == one_by_one and asked == ["É", "éclairs"]
