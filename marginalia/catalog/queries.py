"""One query per operator, each over the whole table it reads."""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia import schema as S
from marginalia.catalog import inputs
from marginalia.functions.durable import durable, new_folder
from marginalia.operators import (
    audit,
    coref,
    guards,
    rollups,
    segmentation,
    spans,
    tagging,
    terms,
    trees,
)
from marginalia.plans import annotate as plan
from marginalia.session import measured
from marginalia.sources import codecs, documents, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPAN = ["doc_id", "start", "end"]


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(measured(spark), folder)

    QUERIES[fn.__name__] = run
    return run


def _flat(ann: DataFrame) -> DataFrame:
    """Annotations with their attributes as JSON, which compares where a map does not."""
    return ann.withColumn("attrs", F.when(F.size("attrs") == 0, F.lit("{}")).otherwise(F.to_json("attrs")))


def _sums(ann: DataFrame, *keys: str) -> DataFrame:
    return ann.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("start").alias("sum_start"),
                                  F.sum("end").alias("sum_end"))


def _no_nulls(df: DataFrame, **instead) -> DataFrame:
    """Results without nulls in number columns, which engines hand over differently."""
    return df.fillna(instead)


# Sources, sinks, codecs

@query
def scan_documents(spark, folder):
    return documents.scan_documents(spark, folder, ("doc_id", "text", "source"))


@query
def scan_from_key(spark, folder):
    return documents.scan_from_key(
        documents.scan_documents(spark, folder, ("doc_id", "source", "n_chars")), 100)


@query
def scan_source(spark, folder):
    return documents.scan_source(
        documents.scan_documents(spark, folder, ("doc_id", "source", "n_chars")), "src3")


@query
def scan_key_list(spark, folder):
    return documents.scan_key_list(
        documents.scan_documents(spark, folder, ("doc_id", "source", "n_chars")),
        inputs.labels(spark, folder))


@query
def scan_sets(spark, folder):
    path = new_folder(spark, "store")
    store.write_annotations(inputs.annotations(spark, folder), path)
    return _flat(store.read_sets(spark, path, [S.PAR, S.SENT]))


@query
def write_annotations(spark, folder):
    path = new_folder(spark, "store")
    store.write_annotations(inputs.annotations(spark, folder), path)
    return _sums(store.read_sets(spark, path), "set")


@query
def store_history(spark, folder):
    """A store before and after cells are put again and taken out, and brought into one commit."""
    path = new_folder(spark, "store")
    d = inputs.docs(spark, folder)
    store.write_annotations(inputs.annotations(spark, folder), path)
    labelled = documents.scan_key_list(d, inputs.labels(spark, folder))
    store.write_annotations(plan.paragraph_layer(segmentation.default_paragraph(
        labelled, segmentation.paragraphs(d).where(F.lit(False)))), path)
    gone = labelled.select("doc_id", F.lit(S.SENT).alias("set"))
    store.replace_sets(spark, path, store.read_sets(spark, path).where(F.lit(False)), gone)
    first = store.read_sets(spark, path, version=1).withColumn("state", F.lit("first"))
    store.compact(spark, path)
    now = store.read_sets(spark, path).withColumn("state", F.lit("now"))
    return _sums(first.unionByName(now), "state", "set")


@query
def upsert_annotations(spark, folder):
    d = inputs.docs(spark, folder)
    sents = segmentation.sentences(d)
    pars = segmentation.paragraphs(d)
    old = plan.paragraph_layer(pars).unionByName(plan.sentence_layer(sents))
    labelled = documents.scan_key_list(d, inputs.labels(spark, folder))
    new = plan.paragraph_layer(segmentation.default_paragraph(labelled, pars.where(F.lit(False))))
    return _flat(store.upsert_annotations(old, new))


@query
def encode_set(spark, folder):
    return codecs.encode_set(inputs.annotations(spark, folder))


@query
def decode_set(spark, folder):
    return _flat(codecs.decode_set(codecs.encode_set(inputs.annotations(spark, folder))))


@query
def encode_matches(spark, folder):
    return codecs.encode_matches(inputs.entity_rows(spark, folder))


@query
def encode_links(spark, folder):
    nps = inputs.phrases(spark, folder)
    scored = coref.pair_scores(coref.candidate_features(nps))
    return codecs.encode_links(coref.coref_links(scored, nps))


# Guards

@query
def guard_no_text(spark, folder):
    d = documents.scan_documents(spark, folder)
    return guards.guard_no_text(guards.guard_no_text(d), "blank").select("doc_id")


@query
def guard_text_too_long(spark, folder):
    return guards.guard_text_too_long(documents.scan_documents(spark, folder), 5000).select("doc_id")


@query
def guard_row_too_large(spark, folder):
    d = inputs.docs(spark, folder)
    return guards.guard_row_too_large(d, plan.base_layers(d), 100_000).select("doc_id")


@query
def require_sets(spark, folder):
    d = documents.scan_documents(spark, folder, ("doc_id",))
    return guards.require_sets(d, inputs.stored(spark, folder), [S.SENT, S.TOKEN])


@query
def skip_done(spark, folder):
    d = documents.scan_documents(spark, folder, ("doc_id",))
    return guards.skip_done(d, inputs.stored(spark, folder), S.POS)


@query
def skip_long_sentences(spark, folder):
    d = inputs.docs(spark, folder)
    return guards.skip_long_sentences(d.select("doc_id"), segmentation.tokens(d), 100)


@query
def skip_many_nps(spark, folder):
    d = inputs.docs(spark, folder)
    return guards.skip_many_nps(d.select("doc_id"), tagging.base_noun_phrases(d), 1000)


@query
def cap_sentences(spark, folder):
    sents = segmentation.sentences(inputs.docs(spark, folder))
    return guards.cap_sentences(sents.select("doc_id", "sent_no", "start", "end"), 200)


@query
def cap_pairs(spark, folder):
    return guards.first_pairs(coref.mention_pairs(inputs.phrases(spark, folder)), 1000)


@query
def guard_report(spark, folder):
    return guards.guard_report(documents.scan_documents(spark, folder), inputs.stored(spark, folder),
                               [S.PAR, S.SENT, S.TOKEN], 5000, S.POS)


@query
def drop_empty_spans(spark, folder):
    d = documents.scan_documents(spark, folder)
    return _flat(guards.drop_empty_spans(inputs.damaged(spark, folder), d))


# Annotators

@query
def paragraphs(spark, folder):
    return segmentation.paragraphs(inputs.docs(spark, folder)).drop("text")


@query
def sentences(spark, folder):
    return segmentation.sentences(inputs.docs(spark, folder)).drop("text")


@query
def sentences_without_tails(spark, folder):
    return segmentation.sentences(inputs.docs(spark, folder), drop_tails=True).drop("text")


@query
def sentences_of_stored_paragraphs(spark, folder):
    d = inputs.docs(spark, folder)
    pars = segmentation.paragraphs(d).drop("text")
    return segmentation.sentences(d, pars).drop("text")


@query
def sentence_numbers(spark, folder):
    sents = segmentation.sentences(inputs.docs(spark, folder))
    return segmentation.sentence_numbers(sents.select(*SPAN))


@query
def fill_sentence_numbers(spark, folder):
    d = inputs.docs(spark, folder)
    sents, pars = segmentation.sentences(d), segmentation.paragraphs(d)
    opens = pars.select("doc_id", "start", (F.col("par_no") * 10).alias("sent_no")).where(
        F.col("par_no") > 0)
    known = sents.select(*SPAN).join(opens, ["doc_id", "start"], "left")
    return segmentation.fill_sentence_numbers(known).select(*SPAN, "filled")


@query
def tokens(spark, folder):
    return segmentation.tokens(inputs.docs(spark, folder))


@query
def tokens_of_stored_sentences(spark, folder):
    d = inputs.docs(spark, folder)
    return segmentation.tokens(d, segmentation.sentences(d).drop("text"))


@query
def pos_tags(spark, folder):
    return tagging.pos_tags(segmentation.tokens(inputs.docs(spark, folder)))


@query
def pos_tags_by_lexicon(spark, folder):
    rows = [(word, tag) for tag, words in tagging.LEXICON.items() for word in words]
    lexicon = spark.createDataFrame(rows, "word string, tag string")
    return tagging.pos_tags(segmentation.tokens(inputs.docs(spark, folder)), lexicon)


@query
def base_layers(spark, folder):
    held = durable(inputs.stored(spark, folder), "stored")
    return _flat(plan.base_layers(inputs.docs(spark, folder), held))


@query
def named_entities(spark, folder):
    return inputs.entity_rows(spark, folder)


@query
def gazetteer_phrases(spark, folder):
    return inputs.phrase_entities(spark, folder)


@query
def ne_from_labels(spark, folder):
    return tagging.ne_from_labels(tagging.token_labels(inputs.pos(spark, folder)))


@query
def ne_from_labels_unflushed(spark, folder):
    return tagging.ne_from_labels(tagging.token_labels(inputs.pos(spark, folder)), False)


@query
def rebase_spans(spark, folder):
    sents = segmentation.sentences(inputs.docs(spark, folder))
    found = F.posexplode(F.expr(segmentation.token_spans("`text`"))).alias("no", "t")
    local = sents.select("doc_id", "sent_no", found).select(
        "doc_id", "sent_no", (F.col("no") + 1).cast("bigint").alias("tok_no"), "t.start", "t.end")
    return spans.rebase_spans(local, sents, ["doc_id", "sent_no"])


@query
def multi_layer_annotate(spark, folder):
    return _flat(plan.multi_layer_annotate(inputs.docs(spark, folder)))


@query
def base_noun_phrases(spark, folder):
    return tagging.base_noun_phrases(inputs.docs(spark, folder))


@query
def base_noun_phrases_with_entities(spark, folder):
    d = inputs.docs(spark, folder)
    nps = tagging.base_noun_phrases(d, ents=inputs.entity_rows(spark, folder))
    return _no_nulls(nps, head_no=0)


@query
def noun_phrases_of_tokens(spark, folder):
    return tagging.noun_phrases_of_tokens(inputs.pos(spark, folder))


@query
def split_long_sentences(spark, folder):
    d = inputs.docs(spark, folder)
    return segmentation.split_long_sentences(segmentation.sentences(d))


@query
def split_long_sentences_of_stored_tokens(spark, folder):
    d = inputs.docs(spark, folder)
    return segmentation.split_long_sentences(segmentation.sentences(d), segmentation.tokens(d))


@query
def all_caps_lower(spark, folder):
    d = inputs.docs(spark, folder)
    return segmentation.all_caps_lower(segmentation.sentences(d), segmentation.tokens(d))


@query
def document_number(spark, folder):
    return segmentation.document_number(documents.scan_documents(spark, folder))


@query
def default_paragraph(spark, folder):
    d = inputs.docs(spark, folder)
    held = documents.scan_key_list(d, inputs.labels(spark, folder))
    return segmentation.default_paragraph(d, segmentation.paragraphs(held))


@query
def default_paragraph_less_one(spark, folder):
    d = inputs.docs(spark, folder)
    held = documents.scan_key_list(d, inputs.labels(spark, folder))
    return segmentation.default_paragraph(d, segmentation.paragraphs(held), less_one=True)


# Spans

@query
def overlap_join(spark, folder):
    d = inputs.docs(spark, folder)
    return spans.overlap_join(segmentation.tokens(d).select(*SPAN),
                              segmentation.sentences(d).select(*SPAN, "sent_no"))


@query
def contained_join(spark, folder):
    d = inputs.docs(spark, folder)
    return spans.contained_join(segmentation.tokens(d).select(*SPAN),
                                tagging.base_noun_phrases(d).select(*SPAN, "ce_id"))


@query
def covered_text(spark, folder):
    d = inputs.docs(spark, folder)
    return spans.covered_text(segmentation.sentences(d).select(*SPAN), d)


def _bigrams(spark, folder):
    """Spans over two neighbouring tokens; each crosses the next one."""
    others = F.greatest(F.size("toks") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("toks.start", F.lit(1), others).alias("start"), F.slice("toks.end", F.lit(2), others).alias("end"))
    return inputs.tagged(spark, folder).select("doc_id", F.explode(pairs).alias("p")).select(
        "doc_id", "p.start", "p.end")


@query
def crossing_spans(spark, folder):
    return spans.crossing_spans(_bigrams(spark, folder))


@query
def ordered_spans(spark, folder):
    return spans.ordered_spans(segmentation.sentences(inputs.docs(spark, folder)).select(*SPAN))


@query
def merge_sets(spark, folder):
    d = inputs.docs(spark, folder)
    return spans.merge_sets(segmentation.paragraphs(d).select(*SPAN),
                            segmentation.sentences(d).select(*SPAN))


# Audit and repair

@query
def check_annotations(spark, folder):
    return audit.check_annotations(inputs.damaged(spark, folder),
                                   documents.scan_documents(spark, folder))


@query
def strip_bad_annotations(spark, folder):
    return _flat(audit.strip_bad_annotations(inputs.damaged(spark, folder),
                                             documents.scan_documents(spark, folder)))


@query
def strip_report(spark, folder):
    return audit.strip_report(inputs.damaged(spark, folder), documents.scan_documents(spark, folder))


@query
def repair_store(spark, folder):
    d = documents.scan_documents(spark, folder)
    path = new_folder(spark, "store")
    store.append_annotations(inputs.damaged(spark, folder), path)
    plan.repair_store(d, path)
    return _flat(store.read_sets(spark, path))


# Rollups

@query
def entities_by_type(spark, folder):
    found = rollups.entities_by_type(inputs.entity_rows(spark, folder))
    return found.withColumn("texts", F.array_join("texts", "|"))


@query
def set_size_histogram(spark, folder):
    return rollups.set_size_histogram(inputs.annotations(spark, folder))


@query
def np_log10_histogram(spark, folder):
    return rollups.np_log10_histogram(tagging.base_noun_phrases(inputs.docs(spark, folder)))


@query
def tag_counts(spark, folder):
    return rollups.tag_counts(inputs.annotations(spark, folder))


@query
def job_counters(spark, folder):
    return plan.layer_counters(inputs.docs(spark, folder), inputs.stored(spark, folder))


@query
def error_counts(spark, folder):
    d = documents.scan_documents(spark, folder)
    spans_of = inputs.damaged(spark, folder).join(
        d.select("doc_id", F.length("text").alias("n")), "doc_id")
    checked = rollups.with_error(spans_of, {
        "start behind text": F.col("start") <= F.col("n"),
        "end behind text": F.col("end") <= F.col("n"),
        "nothing covered": F.col("start") < F.col("end")})
    return rollups.error_counts(checked)


@query
def found_layers(spark, folder):
    return rollups.found_layers(inputs.stored(spark, folder))


# Terms

@query
def term_list(spark, folder):
    found = terms.term_list(inputs.docs(spark, folder))
    return found.withColumn("terms", F.array_join("terms", " "))


@query
def term_counts(spark, folder):
    return terms.term_counts(inputs.docs(spark, folder))


@query
def term_counts_conversations(spark, folder):
    turns = spark.read.parquet(f"{folder.rstrip('/')}/conversations.parquet")
    return terms.term_counts(turns, key=("conv_id", "turn"))


@query
def token_list(spark, folder):
    found = terms.token_list(inputs.docs(spark, folder))
    return found.withColumn("terms", F.array_join("terms", " "))


@query
def token_counts(spark, folder):
    return terms.token_counts(inputs.docs(spark, folder))


# Trees and dependencies

@query
def tree_spans(spark, folder):
    return _no_nulls(trees.tree_spans(*inputs.tree(spark, folder)), parent_id=-1)


@query
def tree_spans_with_leaves(spark, folder):
    return trees.tree_spans(*inputs.tree(spark, folder), include_leaves=True).groupBy(
        "doc_id", "label").agg(F.count("*").alias("n"), F.sum("start").alias("sum_start"),
                               F.sum("end").alias("sum_end"))


@query
def child_ids(spark, folder):
    # Trees are inserted from the last node to the first here, so that the order is not that of the ids.
    return trees.child_ids(inputs.tree_edges(spark, folder).withColumn("seq", -F.col("node_id")))


@query
def dependency_spans(spark, folder):
    return _no_nulls(inputs.dependencies(spark, folder), gov="", gov_id=-1)


@query
def relation_groups(spark, folder):
    grouped = trees.relation_groups(inputs.dependencies(spark, folder))
    return _no_nulls(grouped, gov="", gov_id=-1)


@query
def resolve_conjunctions(spark, folder):
    return _no_nulls(inputs.dependencies(spark, folder, resolve=True), gov="", gov_id=-1)


@query
def dependency_spans_of_tables(spark, folder):
    toks, edges = inputs.dependency_tables(spark, folder)
    return _no_nulls(trees.dependency_spans(toks, edges), gov="", gov_id=-1)


@query
def resolve_conjunctions_of_tables(spark, folder):
    toks, edges = inputs.dependency_tables(spark, folder)
    deps = durable(trees.dependency_spans(toks, edges), "dependencies")
    return _no_nulls(trees.resolve_conjunctions(deps), gov="", gov_id=-1)


# Coreference

@query
def mention_pairs(spark, folder):
    return coref.mention_pairs(inputs.phrases(spark, folder))


@query
def pair_features(spark, folder):
    nps = inputs.phrases(spark, folder)
    return coref.pair_features(coref.mention_pairs(nps), nps)


@query
def binarized_features(spark, folder):
    return coref.binarized_features(inputs.features(spark, folder))


@query
def pair_scores(spark, folder):
    return coref.pair_scores(inputs.features(spark, folder))


@query
def coref_links(spark, folder):
    nps = inputs.phrases(spark, folder)
    return coref.coref_links(coref.pair_scores(coref.candidate_features(nps)), nps)


@query
def coref_clusters(spark, folder):
    nps = inputs.phrases(spark, folder)
    scored = coref.pair_scores(coref.candidate_features(nps))
    return coref.coref_clusters(scored, nps)


@query
def coref_destinations(spark, folder):
    nps = inputs.phrases(spark, folder)
    scored = coref.pair_scores(coref.candidate_features(nps))
    place = nps.select("doc_id", "ce_id", coref.node_id("sent_no", "head_no").alias("node"))
    links = (scored.where(F.col("weight") >= coref.LINK_THRESHOLD)
             .join(place.select("doc_id", F.col("ce_id").alias("i"), F.col("node").alias("dst")),
                   ["doc_id", "i"])
             .join(place.select("doc_id", F.col("ce_id").alias("j"), F.col("node").alias("src")),
                   ["doc_id", "j"]))
    return coref.coref_destinations(links)


@query
def np_properties(spark, folder):
    return coref.np_properties(tagging.base_noun_phrases(inputs.docs(spark, folder)))


# Whole jobs

def _rules(spark) -> plan.Rules:
    return plan.Rules(patterns=inputs.CHECK_PATTERNS, gazetteer=inputs.gazetteer(spark))


@query
def annotate(spark, folder):
    layers, _ = plan.annotate(inputs.docs(spark, folder), config=_rules(spark))
    return _sums(layers, "set", "type")


@query
def annotate_links(spark, folder):
    return plan.annotate(inputs.docs(spark, folder), config=_rules(spark))[1]


@query
def annotate_existing(spark, folder):
    held = durable(inputs.stored(spark, folder), "stored")
    return _sums(plan.annotate(inputs.docs(spark, folder), held, _rules(spark))[0], "set", "type")


@query
def annotate_existing_links(spark, folder):
    held = durable(inputs.stored(spark, folder), "stored")
    return plan.annotate(inputs.docs(spark, folder), held, _rules(spark))[1]


@query
def annotate_incremental(spark, folder):
    path = new_folder(spark, "store")
    store.write_annotations(inputs.stored(spark, folder), path)
    first = plan.annotate_incremental(inputs.docs(spark, folder), path, _rules(spark))
    again = plan.annotate_incremental(inputs.docs(spark, folder), path, _rules(spark))
    runs = first.withColumn("run", F.lit(1).cast("bigint")).unionByName(
        again.withColumn("run", F.lit(2).cast("bigint")))
    return _sums(runs, "run", "doc_id", "set")


@query
def finished_cells(spark, folder):
    """The cells a store lists after a run: every layer of every document, also of those that came out empty."""
    path = new_folder(spark, "store")
    store.write_annotations(inputs.stored(spark, folder), path)
    plan.annotate_incremental(inputs.docs(spark, folder), path, _rules(spark))
    return store.read_cells(spark, path).groupBy("set").agg(F.count("*").alias("docs"))


@query
def set_aside(spark, folder):
    """Documents that a run set aside, and how many a later run with a milder check still does."""
    path, d = new_folder(spark, "store"), inputs.docs(spark, folder)
    counts = []
    for run, limit in ((1, 500), (2, 5000)):
        rules = plan.Rules(checks={"too long": F.length("text") <= limit, "no capital": F.col("text").rlike(r"\p{Lu}")})
        plan.annotate_incremental(d, path, rules)
        found = durable(rollups.error_counts(plan.stored_errors(spark, path)), "errors")
        counts.append(found.withColumn("run", F.lit(run).cast("bigint")))
    return counts[0].unionByName(counts[1])
