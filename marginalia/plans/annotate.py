"""The annotation jobs: which layers are made, from what, and for which documents."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marginalia import schema as S
from marginalia.functions.durable import discard, durable
from marginalia.functions.words import spelled_arrays
from marginalia.operators import audit, coref, entities, tagging
from marginalia.operators.rollups import split_errors, with_error
from marginalia.operators.segmentation import paragraphs, sentences, tokens
from marginalia.operators.spans import contained_join, covered_text, overlap_join, require_no_crossing
from marginalia.session import measured
from marginalia.sources.store import put, read_cells, read_sets, replace_sets, stored_layers


# Keys of documents that every executor may hold at once.
FEW_DOCUMENTS = 500_000
LAYERS = {"par": S.PAR, "sent": S.SENT, "token": S.TOKEN, "pos": S.POS}


def _attrs(**values: Column) -> Column:
    if not values:
        none = F.array().cast("array<string>")
        return F.map_from_arrays(none, none)
    return F.create_map(*[part for name, value in values.items()
                          for part in (F.lit(name), value.cast("string"))])


def _item(set_name: str, ann_id: Column, start: Column, end: Column, kind: Column,
          attrs: Column) -> Column:
    return F.struct(F.lit(set_name).alias("set"), ann_id.cast("bigint").alias("ann_id"),
                    start.alias("start"), end.alias("end"), kind.alias("type"),
                    attrs.alias("attrs"))


def _exploded(df: DataFrame, items: Column) -> DataFrame:
    return df.select("doc_id", F.explode(items).alias("a")).select(
        "doc_id", *[F.col(f"a.{name}").alias(name) for name in S.ANNOTATION_COLUMNS[1:]])


def paragraph_layer(pars: DataFrame) -> DataFrame:
    return _exploded(pars, F.array(_item(
        S.PAR, F.col("par_no"), F.col("start"), F.col("end"), F.lit("paragraph"), _attrs())))


def _sentence_item() -> Column:
    return _item(S.SENT, F.col("sent_no"), F.col("start"), F.col("end"),
                 F.lit("sentence_split"), _attrs(sent_no=F.col("sent_no")))


def _token_items(set_name: str, toks: Column, kind) -> Column:
    """Tokens are numbered by sentence, so their ids need no count over the document."""
    first = F.col("sent_no") * S.SENTENCE_ID_STEP + 1
    return F.transform(toks, lambda t, i: _item(
        set_name, first + i, t["start"], t["end"], kind(t), _attrs()))


def sentence_layer(sents: DataFrame) -> DataFrame:
    return _exploded(sents, F.array(_sentence_item()))


def _token_rows(tagged: DataFrame, toks: Column) -> DataFrame:
    """SENT rows of the places 0 in ``toks``, TOKEN and POS rows of the others.

    Sets are exploded by name and their columns made behind that, so a reader pays for the columns it reads only.
    """
    sets = F.when(F.col("no") == 0, F.array(F.lit(S.SENT))).otherwise(F.array(F.lit(S.TOKEN), F.lit(S.POS)))
    rows = tagged.select("doc_id", "sent_no", F.posexplode(toks).alias("no", "t")).select(
        "doc_id", "sent_no", "no", "t.start", "t.end", "t.tag", F.explode(sets).alias("set"))
    sent = F.col("set") == S.SENT
    return rows.select(
        "doc_id", "set", F.when(sent, F.col("sent_no")).otherwise(F.col("sent_no") * S.SENTENCE_ID_STEP + F.col("no"))
        .cast("bigint").alias("ann_id"), "start", "end",
        F.when(sent, F.lit("sentence_split")).when(F.col("set") == S.TOKEN, F.lit("token")).otherwise(F.col("tag")).alias("type"),
        F.when(sent, _attrs(sent_no=F.col("sent_no"))).otherwise(_attrs()).alias("attrs"))


def _sentence_first(toks: Column, sentence: bool) -> Column:
    """``toks`` behind a place for the sentence, which is null where only tokens are wanted."""
    none = F.lit(None).cast("string")
    whole = F.struct(F.col("start").alias("start"), F.col("end").alias("end"), none.alias("text"), none.alias("tag"))
    return F.concat(F.array(whole if sentence else F.lit(None).cast(
        "struct<start:bigint,end:bigint,text:string,tag:string>")), toks)


def token_layers(tagged: DataFrame) -> DataFrame:
    """TOKEN and POS of sentence rows with ``toks``."""
    return _token_rows(tagged, _sentence_first(F.col("toks"), False)).where(F.col("set") != S.SENT)


def text_layers(tagged: DataFrame) -> DataFrame:
    """SENT, TOKEN and POS of sentence rows with ``toks``, in one pass."""
    return _token_rows(tagged, _sentence_first(F.col("toks"), True))


def flagged_layers(df: DataFrame, **wanted: Column) -> DataFrame:
    """PAR, SENT, TOKEN and POS of documents, or SENT, TOKEN and POS of sentence rows with ``text``, in one pass.

    ``wanted`` has a condition on each row for ``par``, ``sent``, ``token`` and ``pos``; a layer that is left out is not made.
    """
    columns = ["sent_no", "start", "end"] if "sent_no" in df.columns else []
    flags = [F.coalesce(wanted.get(name, F.lit(False)), F.lit(False)).alias(name) for name in LAYERS]
    rows = tagging.layer_rows(df.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in columns], "text", *flags),
                              LAYERS, S.SENTENCE_ID_STEP)
    attrs = F.when(F.col("set") == S.SENT, _attrs(sent_no=F.col("ann_id"))).otherwise(_attrs())
    return rows.withColumn("attrs", attrs).select(*S.ANNOTATION_COLUMNS)


def multi_layer_annotate(docs: DataFrame) -> DataFrame:
    """SENT, TOKEN, POS and NE of documents in one pass over the text, without a shuffle."""
    tagged = tagging.tagged_tokens(sentences(docs))
    first = F.col("sent_no") * S.SENTENCE_ID_STEP + 1
    named = F.transform(F.expr(tagging.label_runs()), lambda r, i: _item(
        S.NE, first + i, r["start"], r["end"], r["type"], _attrs()))
    return _exploded(tagged, F.concat(
        F.array(_sentence_item()),
        _token_items(S.TOKEN, F.col("toks"), lambda t: F.lit("token")),
        _token_items(S.POS, F.col("toks"), lambda t: t["tag"]), named))


def with_state(docs: DataFrame, held: DataFrame, sets=S.BASE_SETS, text: bool = True) -> DataFrame:
    """``doc_id``, ``text`` unless left out, and a flag for each of ``sets`` the document holds.

    ``held`` are stored rows or listed cells.

    The store is reduced to one row per document first, so all later choices of
    documents are filters on flags: the text is shuffled once, by this join.
    """
    flags = [F.max(F.col("set") == name).alias(f"has_{name}") for name in sets]
    state = held.where(F.col("set").isin(*sets)).groupBy("doc_id").agg(*flags)
    columns = ["doc_id", "text"] if text else ["doc_id"]
    return docs.select(*columns).join(state, "doc_id", "left").select(*columns, *[
        F.coalesce(f"has_{name}", F.lit(False)).alias(f"has_{name}") for name in sets])


def layer_counters(docs: DataFrame, held: DataFrame, group: str = "base annotation") -> DataFrame:
    """``group, name, count``: documents seen, and those that hold or lack each base set.

    Counted from one row of flags a document, as the jobs see it.
    """
    counts = {"rows": F.count("*")}
    for name in S.BASE_SETS:
        counts[f"add {name}"] = F.count_if(~F.col(f"has_{name}"))
        counts[f"has {name}"] = F.count_if(F.col(f"has_{name}"))
    wide = with_state(docs, held).agg(*[count.alias(name) for name, count in counts.items()])
    listed = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).alias("count")) for name in counts]))
    return (wide.select(F.lit(group).alias("group"), listed.alias("c")).select("group", "c.name", "c.count")
            .where((F.col("count") > 0) | (F.col("name") == "rows")).orderBy("group", "name"))


def base_layers(docs: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """PAR, SENT, TOKEN and POS of ``docs``; every stored row is kept, missing layers are made.

    A missing layer is made from the stored layer below it where there is one.  TOKEN and POS
    are made anew together when either is missing; only then do stored rows give way, and only
    those of the document that is made anew.
    """
    if existing is None:
        return flagged_layers(docs, **{name: F.lit(True) for name in LAYERS})
    # Several steps read it; its text is shuffled once.
    state = durable(with_state(docs, existing), "state")
    return kept_rows(state, existing).unionByName(Gaps(state, existing).rows())


def _redone() -> Column:
    """Documents whose TOKEN and POS are made anew although one of them is stored."""
    return (F.length("text") > 0) & (F.col(f"has_{S.TOKEN}") != F.col(f"has_{S.POS}"))


def kept_rows(state: DataFrame, held: DataFrame) -> DataFrame:
    """Stored rows without those that give way."""
    redone = durable(state.where(_redone()).select("doc_id"), "redone")
    if redone.count() <= FEW_DOCUMENTS:
        # The stored rows are many times more than these keys, so they stay where they are.
        redone = F.broadcast(redone)
    redone = redone.withColumn("_redone", F.lit(True))
    return (held.join(redone, "doc_id", "left")
            .where(F.col("_redone").isNull() | ~F.col("set").isin(S.TOKEN, S.POS)).select(*S.ANNOTATION_COLUMNS))


class Gaps:
    """The layers that documents lack, each made from the nearest stored layer below it.

    ``state`` has ``doc_id, text`` and a flag per set, ``held`` the stored rows.  Layers made from the text alone need no
    join.  Only documents that hold a layer to build on fetch what it covers.
    """

    def __init__(self, state: DataFrame, held: DataFrame):
        self.state, self.held = state, held
        self.has = {name: F.col(f"has_{name}") for name in S.ALL_SETS}
        # A token layer that is whole but has no sentences under it is left alone.
        self.wants_tokens = ~(self.has[S.TOKEN] & self.has[S.POS])

    def lacking(self, name: str) -> DataFrame:
        return self.state.where(~self.has[name])

    def stored(self, name: str, docs: DataFrame) -> DataFrame:
        """Stored rows of a set, of some documents."""
        return self.held.where(F.col("set") == name).join(docs.select("doc_id"), "doc_id", "left_semi")

    def _spans(self, name: str, number: str, docs: DataFrame) -> DataFrame:
        return self.stored(name, docs).select("doc_id", F.col("ann_id").alias(number), "start", "end")

    def _new_sentences(self, docs: DataFrame) -> DataFrame:
        on_pars = docs.where(self.has[S.PAR])
        return sentences(docs.where(~self.has[S.PAR])).unionByName(
            sentences(on_pars, self._spans(S.PAR, "par_no", on_pars))).select("doc_id", "sent_no", "start", "end", "text")

    def untagged(self) -> DataFrame:
        """New sentences over token layers that are whole."""
        return self._new_sentences(self.lacking(S.SENT).where(~self.wants_tokens))

    def tagged(self) -> DataFrame:
        """Sentences whose tokens are made, with ``toks``; ``stored`` tells whether the sentence itself is."""
        on_sents = self.state.where(self.has[S.SENT] & self.wants_tokens)
        new = self._new_sentences(self.lacking(S.SENT).where(self.wants_tokens))
        old = covered_text(self._spans(S.SENT, "sent_no", on_sents), on_sents)
        return tagging.tagged_tokens(new.withColumn("stored", F.lit(False)).unionByName(old.withColumn("stored", F.lit(True))))

    def rows(self) -> DataFrame:
        """PAR, SENT, TOKEN and POS that documents lack, without a table of tagged sentences between."""
        of_text = ~self.has[S.PAR] & ~self.has[S.SENT]
        plain = flagged_layers(self.lacking(S.PAR), par=F.lit(True), sent=of_text,
                               token=of_text & self.wants_tokens, pos=of_text & self.wants_tokens)
        on_pars, wants = self.lacking(S.SENT).where(self.has[S.PAR]), self.wants_tokens
        on_sents = self.state.where(self.has[S.SENT] & wants)
        parts = [(self._new_sentences(on_pars.where(wants)), True, True), (self._new_sentences(on_pars.where(~wants)), True, False),
                 (covered_text(self._spans(S.SENT, "sent_no", on_sents), on_sents), False, True)]
        parts = [part.select("doc_id", "sent_no", "start", "end", "text", F.lit(sent).alias("_new"), F.lit(toks).alias("_wants"))
                 for part, sent, toks in parts]
        sents = parts[0].unionByName(parts[1]).unionByName(parts[2])
        return plain.unionByName(flagged_layers(sents, sent=F.col("_new"), token=F.col("_wants"), pos=F.col("_wants")))

    def base_layers(self, tagged: DataFrame) -> DataFrame:
        return (paragraph_layer(paragraphs(self.lacking(S.PAR)))
                .unionByName(text_layers(tagged.where(~F.col("stored"))))
                .unionByName(token_layers(tagged.where("stored")))
                .unionByName(sentence_layer(self.untagged())))

    def entities(self, tagged: DataFrame, rules: "Rules") -> DataFrame:
        """``doc_id, type, start, end, text`` for documents without entities; words are looked up in stored tokens."""
        docs = self.lacking(S.NE).select("doc_id", "text")
        if rules.gazetteer is None:
            return entities.named_entities(docs, None, rules.patterns)
        whole = self.lacking(S.NE).where(~self.wants_tokens)
        rows = tagged.join(docs.select("doc_id"), "doc_id", "left_semi").select(
            "doc_id", "sent_no", "start", "text", F.expr("transform(toks, t -> struct(t.`start`, t.`end`, t.`text`))").alias("toks"))
        rows = rows.unionByName(stored_sentences(self.stored(S.TOKEN, whole), whole))
        return entities.named_entities(docs, None, rules.patterns, rules.gazetteer, rows)

    def phrases(self, tagged: DataFrame, ents: DataFrame) -> DataFrame:
        """``doc_id, ce_id, start, end`` for documents without noun phrases, from their tags, entities and sentences."""
        docs = self.lacking(S.NP)
        whole = docs.where(~self.wants_tokens)
        of = lambda df: df.join(docs.select("doc_id"), "doc_id", "left_semi")
        mine = of(tagged)
        places = ["doc_id", "sent_no", "start", "end"]
        found = tagging.sentence_noun_phrases(mine).select(*places).unionByName(
            tagging.noun_phrases_of_tokens(stored_tags(self.stored(S.POS, whole))).select(*places))
        stored_ents = self.stored(S.NE, docs.where(self.has[S.NE]))
        spans = of(ents).select("doc_id", "start", "end").unionByName(stored_ents.select("doc_id", "start", "end"))
        sents = (mine.select(*places).unionByName(of(self.untagged()).select(*places))
                 .unionByName(self._spans(S.SENT, "sent_no", whole.where(self.has[S.SENT]))))
        # Layers hold places only; texts and heads are read where they are wanted.
        bare = lambda df: df.select(*df.columns, F.lit("").alias("text"))
        wide = bare(found).select(*places, "text", F.col("text").alias("head"), F.lit(None).cast("bigint").alias("head_no"))
        return tagging.number_phrases(tagging.add_entities(wide, bare(spans), sents=sents))


def stored_sentences(toks: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc_id, sent_no, start, text, toks`` of stored TOKEN rows, whose ids hold the sentence; its text is fetched once."""
    listed = F.array_sort(F.collect_list(F.struct("start", "end"))).alias("places")
    rows = toks.groupBy("doc_id", F.shiftright("ann_id", S.SENTENCE_ID_BITS).alias("sent_no")).agg(
        F.min("start").alias("start"), F.max("end").alias("end"), listed)
    spelled = spelled_arrays(docs.sparkSession)(F.col("text"), F.col("start"), F.col("places"))
    return covered_text(rows, docs).select("doc_id", "sent_no", "start", "text", spelled.alias("toks"))


def stored_tags(pos: DataFrame) -> DataFrame:
    """Token rows of POS annotations, whose ids hold sentence and token."""
    return pos.select("doc_id", F.shiftright("ann_id", S.SENTENCE_ID_BITS).alias("sent_no"),
                      F.col("ann_id").bitwiseAND(F.lit(S.SENTENCE_ID_STEP - 1)).alias("tok_no"), "start", "end",
                      F.lit("").alias("text"), F.col("type").alias("tag"))


def missing_layers(state: DataFrame, held: DataFrame, rules: "Rules") -> tuple[DataFrame, list[DataFrame]]:
    """All rows that documents lack, and the steps they are read from; see :class:`Gaps`.  ``state`` has a flag for every set."""
    gaps = Gaps(state, held)
    tagged = durable(gaps.tagged(), "tagged")
    ents = durable(gaps.entities(tagged, rules), "entities")
    nps = durable(gaps.phrases(tagged, ents), "phrases")
    if rules.check_crossing:
        require_no_crossing(nps)
    return gaps.base_layers(tagged).unionByName(entity_layer(ents)).unionByName(phrase_layer(nps)), [tagged, ents, nps]


def phrases_of_layers(layers: DataFrame, docs: DataFrame) -> DataFrame:
    """Noun phrases as coreference reads them, from stored NP, POS and SENT rows.

    The head is the last noun or pronoun inside a phrase; a phrase without one is its own head and stands in the first
    sentence it overlaps.
    """
    nps = layers.where(F.col("set") == S.NP).select("doc_id", F.col("ann_id").alias("ce_id"), "start", "end")
    nouns = stored_tags(layers.where((F.col("set") == S.POS) & F.col("type").isin(*tagging.NOUN_TAGS, "PRP"))).drop("text", "tag")
    inside = contained_join(nouns, nps).groupBy("doc_id", F.col("b_ce_id").alias("ce_id")).agg(
        F.max(F.struct("a_start", "a_end", "a_sent_no", "a_tok_no")).alias("h"))
    headed = nps.join(inside, ["doc_id", "ce_id"], "left")
    sents = layers.where(F.col("set") == S.SENT).select("doc_id", F.col("ann_id").alias("sent_no"), "start", "end")
    bare = headed.where(F.col("h").isNull()).select("doc_id", "ce_id", "start", "end")
    placed = overlap_join(bare, sents).groupBy("doc_id", "a_ce_id").agg(F.min("b_sent_no").alias("_sent"))
    placed = placed.select("doc_id", F.col("a_ce_id").alias("ce_id"), "_sent")
    whole = headed.join(placed, ["doc_id", "ce_id"], "left").select(
        "doc_id", "ce_id", F.coalesce("h.a_sent_no", "_sent").alias("sent_no"), "start", "end",
        F.coalesce("h.a_start", "start").alias("h_start"), F.coalesce("h.a_end", "end").alias("h_end"), F.col("h.a_tok_no").alias("head_no"))
    spelled = covered_text(whole, docs).withColumnsRenamed({"text": "np_text", "start": "np_start", "end": "np_end"})
    spelled = covered_text(spelled.withColumnsRenamed({"h_start": "start", "h_end": "end"}), docs)
    return spelled.select("doc_id", "ce_id", "sent_no", F.col("np_start").alias("start"), F.col("np_end").alias("end"),
                          F.col("np_text").alias("text"), F.col("text").alias("head"), "head_no")


def entity_layer(ents: DataFrame) -> DataFrame:
    """NE annotations; the id follows from place and type, so nothing is counted."""
    kinds = sorted(entities.ENTITY_TYPES)
    kind_no = F.coalesce(F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("type")), F.lit(0))
    ann_id = F.col("start") * (len(kinds) + 1) + kind_no
    return _exploded(ents.select("doc_id", "start", "end", "type"), F.array(_item(
        S.NE, ann_id, F.col("start"), F.col("end"), F.col("type"), _attrs())))


def phrase_layer(nps: DataFrame) -> DataFrame:
    return _exploded(nps, F.array(_item(
        S.NP, F.col("ce_id"), F.col("start"), F.col("end"), F.lit("np"),
        _attrs(CE_ID=F.col("ce_id")))))


@dataclass(frozen=True)
class Rules:
    """What the jobs may be told: entity patterns, list ``(word, type)`` of words and phrases, weights of links, whether crossing
    phrases are an error, and what must hold for a document, as columns over ``doc_id, text`` by message."""

    patterns: dict[str, str] = field(default_factory=lambda: dict(entities.PATTERNS))
    gazetteer: DataFrame | None = None
    weights: dict[str, float] = field(default_factory=lambda: dict(coref.WEIGHTS))
    check_crossing: bool = False
    checks: dict[str, Column] = field(default_factory=dict)


def annotate(docs: DataFrame, existing: DataFrame | None = None, config: Rules | None = None) -> tuple[DataFrame, DataFrame]:
    """All layers of ``docs`` in order, and the coreference links.

    Rows of ``existing`` are kept, and what a document lacks is made from its nearest stored layer.  Without
    ``existing`` sentences with their tagged tokens are written once; words, phrases and token layers read them.
    """
    rules = config or Rules()
    measured(docs.sparkSession)
    if existing is not None:
        state = durable(with_state(docs, existing, S.ALL_SETS), "state")
        missing, steps = missing_layers(state, existing, rules)
        layers = durable(kept_rows(state, existing).unionByName(missing), "layers")
        discard(state, *steps)
        return layers, coref.candidate_links(durable(phrases_of_layers(layers, docs), "phrases"), rules.weights)
    tagged = durable(tagging.tagged_tokens(sentences(docs)), "tagged")
    ents = durable(entities.named_entities(docs, None, rules.patterns, rules.gazetteer, tagged), "entities")
    found = tagging.add_entities(tagging.sentence_noun_phrases(tagged), ents,
                                 sents=tagged.select("doc_id", "sent_no", "start", "end"))
    nps = durable(tagging.number_phrases(found), "phrases")
    if rules.check_crossing:
        require_no_crossing(nps)
    layers = (paragraph_layer(paragraphs(docs)).unionByName(text_layers(tagged))
              .unionByName(entity_layer(ents)).unionByName(phrase_layer(nps)))
    return layers, coref.candidate_links(nps, rules.weights)


def annotate_incremental(docs: DataFrame, path: str, config: Rules | None = None,
                         counters: Observation | None = None) -> DataFrame:
    """Add the missing layers to the store at ``path``; returns only what was added.

    The store lists the cells it holds, also those that came out empty, so a document is finished when each of its sets is
    listed.  Texts are read for unfinished documents only, and a run without any ends before it.  All that
    was made becomes one commit: a run that dies before leaves the store as it was and is simply started again.
    ``counters`` gets the number of rows of each layer as they are written.

    A document that fails one of the rules' checks is set aside: it gets a cell ``ERROR`` with the message of the first check that
    fails, no layer, and another try in the next run, which takes the cell away if the document passes.
    """
    spark = measured(docs.sparkSession)
    cells = read_cells(spark, path, S.ALL_SETS)
    whole = F.lit(True)
    for name in S.ALL_SETS:
        whole = whole & F.col(f"has_{name}")
    unfinished = durable(with_state(docs, cells, S.ALL_SETS, text=False).where(~whole), "unfinished")
    if unfinished.isEmpty():
        return spark.createDataFrame([], S.ANNOTATIONS)
    rules = config or Rules()
    checked = durable(with_error(docs.select("doc_id", "text").join(unfinished, "doc_id"), rules.checks), "state")
    state, failed = split_errors(checked)
    held = stored_layers(spark, path).join(unfinished.select("doc_id"), "doc_id", "left_semi")
    new, steps = missing_layers(state, held, rules)
    gone = _redone()
    made = F.array(*[F.when(~F.col(f"has_{name}") | (gone if name in (S.TOKEN, S.POS) else F.lit(False)), F.lit(name))
                     for name in S.ALL_SETS])
    put_cells = state.select("doc_id", F.explode(F.filter(made, lambda name: name.isNotNull())).alias("set"))
    again = not state.where(gone).isEmpty()
    if rules.checks:
        zero = F.lit(0).cast("bigint")
        new = new.unionByName(_exploded(failed, F.array(_item(S.ERROR, zero, zero, zero, F.col("error"), _attrs()))))
        put_cells = put_cells.withColumn("kept", F.lit(True)).unionByName(
            checked.select("doc_id", F.lit(S.ERROR).alias("set"), F.col("error").isNotNull().alias("kept")))
    made = put(new, path, put_cells, again=again or bool(rules.checks), counters=counters)
    discard(unfinished, checked, *steps)
    return made.where(F.col("set") != S.ERROR)


def stored_errors(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, error`` of documents that the last runs set aside; see :func:`marginalia.operators.rollups.error_counts`."""
    return read_sets(spark, path, [S.ERROR]).select("doc_id", F.col("type").alias("error"))


def repair_store(docs: DataFrame, path: str) -> DataFrame:
    """Strip bad spans from the store at ``path``; returns the rewritten cells ``doc_id, set``.

    Only changed cells are written back, also those that nothing is left of.
    """
    spark = measured(docs.sparkSession)
    held = stored_layers(spark, path)
    cells = durable(audit.changed_sets(held, docs), "repair-cells")
    if not cells.isEmpty():
        of_cells = held.join(cells, ["doc_id", "set"], "left_semi")
        replace_sets(spark, path, audit.strip_bad_annotations(of_cells, docs), cells)
    return cells
