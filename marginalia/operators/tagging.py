"""Part-of-speech tags, entities from labels and base noun phrases.

The rules are column expressions on one token, so tagging needs neither a join
nor a shuffle; a caller's own lexicon is joined by word.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginalia.functions import words
from marginalia.functions.durable import durable
from marginalia.functions.scans import numbered, runs
from marginalia.functions.segments import let, quoted, segments
from marginalia.functions.words import CAPITAL, WORD_SIGN, document_phrase_arrays, phrase_arrays, tagged_arrays
from marginalia.operators.segmentation import sentences
from marginalia.operators.spans import overlap_join

# The tag of closed-class words.
LEXICON = {
    "DT": ["the", "a", "an", "this", "that", "these", "those"],
    "IN": ["of", "in", "on", "for", "with", "by", "as", "at", "from"],
    "CC": ["and", "or", "but"],
    "TO": ["to"],
    "PRP": ["he", "she", "it", "they", "we", "you", "i"],
    "PRP$": ["his", "her", "its", "their"],
    "MD": ["will", "would", "can", "could", "may"],
    "VBZ": ["is", "has"],
    "VBD": ["was", "were", "had"],
    "VB": ["be"],
    "VBP": ["are", "have"],
    "WDT": ["which"],
    "WP": ["who", "what"],
    "RB": ["not"],
}
_LISTED = {word: tag for tag, listed in LEXICON.items() for word in listed}
# The tag of a word ending, for words of more than four letters.
SUFFIXES = [("ing", "VBG"), ("ed", "VBD"), ("ly", "RB"), ("s", "NNS"),
            ("able", "JJ"), ("ible", "JJ"), ("ous", "JJ")]
# Tags a noun phrase is made of, and those it needs one of.
NP_TAGS = ("DT", "PRP$", "JJ", "CD", "NN", "NNS", "NNP")
NOUN_TAGS = ("NN", "NNS", "NNP")
# The label of a tag; all others are O.
LABELS = {"NNP": "NAME", "CD": "NUMBER"}


def _any(words) -> str:
    return "(" + ", ".join(quoted(w) for w in words) + ")"


def _built_in(low: str) -> str:
    words = [word for listed in LEXICON.values() for word in listed]
    tags = " ".join(f"WHEN {low} IN {_any(listed)} THEN {quoted(tag)}"
                    for tag, listed in LEXICON.items())
    # One look into a hash set settles it for all words that are not listed.
    return f"IF({low} IN {_any(words)}, CASE {tags} END, NULL)"


def tag_of(text: str, low: str, tok_no: str, suffixes=SUFFIXES, listed: str | None = None) -> str:
    """The tag of a token, as SQL; ``low`` is its lower case, ``listed`` its lexicon tag.

    Cheap tests on length and first character stand before each regex.
    """
    listed = _built_in(low) if listed is None else listed
    endings = " ".join(f"WHEN endswith({low}, {quoted(end)}) THEN {quoted(tag)}"
                       for end, tag in suffixes)
    return (f"coalesce(IF(length({text}) = 1, CASE WHEN {text} IN ('.', '!', '?') THEN '.'"
            f" WHEN {text} IN (',', ':', ';') THEN {text}"
            f" WHEN NOT {text} RLIKE {quoted(WORD_SIGN)} THEN 'SYM' END, NULL),"
            f" IF(ascii({text}) BETWEEN 48 AND 57 AND {text} RLIKE '^[0-9]+$', 'CD', NULL),"
            f" {listed}, IF(length({text}) > 4, CASE {endings} END, NULL),"
            f" IF({tok_no} > 1 AND NOT ascii({text}) BETWEEN 97 AND 122"
            f" AND {text} RLIKE {quoted(CAPITAL)}, 'NNP', 'NN'))")


def word_tag(text: str, kind: int) -> str:
    """The tag of :func:`tag_of` for a token that is not the first of its sentence, by the built-in rules."""
    if len(text) == 1:
        if text in ".!?":
            return "."
        if text in ",:;":
            return text
        if kind == words.OTHER:
            return "SYM"
    if text.isascii() and text.isdigit():
        return "CD"
    low = text.lower()
    if low in _LISTED:
        return _LISTED[low]
    if len(text) > 4:
        for end, tag in SUFFIXES:
            if low.endswith(end):
                return tag
    return "NNP" if kind == words.CAPITAL_WORD else "NN"


def word_tags(texts: pa.Array, kinds: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Names of tags, and the number of the one that :func:`word_tag` gives each of ``texts``.

    Those of ASCII are told at once: every rule takes back what a weaker one has said.
    """
    names = sorted({*_LISTED.values(), *(tag for _, tag in SUFFIXES), ".", *",:;", "SYM", "CD", "NN", "NNP"})
    number = {tag: i for i, tag in enumerate(names)}
    holds = lambda flags: pc.fill_null(flags, False).to_numpy(zero_copy_only=False)
    low, size = pc.ascii_lower(texts), pc.binary_length(texts).to_numpy(zero_copy_only=False)
    codes = np.where(kinds == words.CAPITAL_WORD, number["NNP"], number["NN"]).astype(np.int32)
    for end, tag in reversed(SUFFIXES):
        codes[holds(pc.ends_with(low, end)) & (size > 4)] = number[tag]
    listed = pc.index_in(low, pa.array(list(_LISTED), texts.type))
    known = holds(listed.is_valid())
    codes[known] = np.array([number[tag] for tag in _LISTED.values()])[listed.drop_null().to_numpy()]
    codes[holds(pc.ascii_is_decimal(texts))] = number["CD"]
    single = np.flatnonzero(size == 1)
    codes[single[kinds[single] == words.OTHER]] = number["SYM"]
    for signs, tag in ((".!?", "."), *((sign, sign) for sign in ",:;")):
        codes[holds(pc.is_in(texts, pa.array(list(signs), texts.type)))] = number[tag]
    other = np.flatnonzero(~holds(pc.string_is_ascii(texts)))
    codes[other] = [number[word_tag(text, kind)] for text, kind in zip(texts.take(pa.array(other)).to_pylist(), kinds[other].tolist())]
    return names, codes


def pos_tags(toks: DataFrame, lexicon: DataFrame | None = None, suffixes=SUFFIXES) -> DataFrame:
    """Add ``tag``.  ``lexicon`` is ``(word, tag)``; the exact word goes before its lower case.

    A lexicon of any size will do: Spark broadcasts a small one, and splits the
    partitions of frequent words when it has to shuffle.
    """
    if lexicon is None:
        return toks.withColumn("tag", F.expr(tag_of("`text`", "lower(`text`)", "tok_no", suffixes)))
    listed = lexicon.groupBy("word").agg(F.min("tag").alias("tag"))
    exact = listed.select(F.col("word").alias("text"), F.col("tag").alias("_exact"))
    lower = listed.select(F.col("word").alias("_lower"), F.col("tag").alias("_folded"))
    return (toks.join(exact, "text", "left")
            .withColumn("_lower", F.lower("text")).join(lower, "_lower", "left")
            .withColumn("tag", F.expr(tag_of("`text`", "_lower", "tok_no", suffixes,
                                                "coalesce(_exact, _folded)")))
            .select(*toks.columns, "tag"))


def tagged_tokens(sents: DataFrame) -> DataFrame:
    """Sentences with ``toks``, an array of ``{start,end,text,tag}``: one row per sentence."""
    tags = tagged_arrays(sents.sparkSession, word_tags, "NNP", "NN")
    return sents.withColumn("toks", tags(F.col("text"), F.col("start")))


def layer_rows(df: DataFrame, sets: dict[str, str], step: int) -> DataFrame:
    """Rows of the layers that flags of documents or sentences ask for; see :func:`marginalia.functions.words.layer_rows`."""
    return words.layer_rows(df, sets, step, word_tags, "NNP", "NN")


def label_of(tag: Column) -> Column:
    return F.coalesce(*[F.when(tag == t, F.lit(label)) for t, label in LABELS.items()], F.lit("O"))


def token_labels(pos: DataFrame) -> DataFrame:
    """Add ``label``: NAME for proper nouns, NUMBER for numbers, else O."""
    return pos.withColumn("label", label_of(F.col("tag")))


def ne_from_labels(labelled: DataFrame, flush_last: bool = True) -> DataFrame:
    """``doc_id, type, start, end``: runs of one label inside a sentence, without O.

    ``flush_last=False`` leaves out a run that ends its sentence.
    """
    labelled = labelled.select("doc_id", "sent_no", "tok_no", "start", "end", "label")
    found = runs(labelled, "label", ["doc_id", "sent_no"], "tok_no").groupBy("doc_id", "sent_no", "_run").agg(
        F.first("label").alias("type"), F.min("start").alias("start"), F.max("end").alias("end"),
        (F.max("tok_no") == F.max("_last")).alias("_ends"))
    kept = F.col("type") != "O"
    if not flush_last:
        kept = kept & ~F.col("_ends")
    return found.where(kept).select("doc_id", "type", "start", "end")


def label_runs(toks: str = "toks") -> str:
    """The same runs inside a sentence row: array of ``{type,start,end}``."""
    letters = {"NAME": "A", "NUMBER": "C"}
    cases = " ".join(f"WHEN {quoted(t)} THEN {quoted(letters[label])}" for t, label in LABELS.items())
    classes = f"array_join(transform({toks}, t -> CASE t.tag {cases} ELSE 'o' END), '')"
    found = let("classes", classes, segments("classes", "A+|C+|o+"))
    names = " ".join(f"WHEN {quoted(letter)} THEN {quoted(label)}" for label, letter in letters.items())
    return (f"transform(filter({found}, r -> NOT startswith(r.`text`, 'o')), r -> struct("
            f"CASE left(r.`text`, 1) {names} END AS type,"
            f" {toks}[CAST(r.`start` AS INT)].`start` AS `start`,"
            f" {toks}[CAST(r.`end` - 1 AS INT)].`end` AS `end`))")


def noun_phrase_spans(rows: DataFrame) -> Column:
    """Noun phrases of sentence rows with ``toks``: array of ``{start,end,head,head_no}``.

    A phrase is a run of phrase tags with a noun among them, the last of which is the head, or a single pronoun.
    """
    return phrase_arrays(rows.sparkSession, NOUN_TAGS, NP_TAGS, "PRP")(F.col("toks"))


def sentence_noun_phrases(tagged: DataFrame) -> DataFrame:
    """``doc_id, sent_no, start, end, text, head, head_no`` of rows with ``text`` and ``toks``."""
    np = tagged.select("doc_id", "sent_no", F.col("start").alias("_base"), "text",
                       F.explode(noun_phrase_spans(tagged)).alias("np"))
    text = F.substring(F.col("text"), (F.col("np.start") - F.col("_base") + 1).cast("int"),
                       (F.col("np.end") - F.col("np.start")).cast("int"))
    return np.select("doc_id", "sent_no", "np.start", "np.end", text.alias("text"),
                     "np.head", "np.head_no")


def number_phrases(nps: DataFrame) -> DataFrame:
    """Add ``ce_id``, counted from 1 through the document."""
    return numbered(nps, "ce_id").select(
        "doc_id", "ce_id", "sent_no", "start", "end", "text", "head", "head_no")


def add_entities(nps: DataFrame, ents: DataFrame, docs: DataFrame | None = None,
                 sents: DataFrame | None = None) -> DataFrame:
    """Noun phrases and those entities that overlap none of them.

    An entity stands in the first of ``sents`` that it overlaps.  Where no sentences are given, only documents
    with such an entity are cut into sentences again, to place it.
    """
    places = ents.select("doc_id", "start", "end", "text").distinct()
    taken = overlap_join(places, nps.select("doc_id", "start", "end")).select(
        "doc_id", F.col("a_start").alias("start"), F.col("a_end").alias("end")).distinct()
    free = places.join(taken, ["doc_id", "start", "end"], "left_anti")
    # Of free entities that overlap one another the first, longest one stays.
    reach = F.max("end").over(W.partitionBy("doc_id").orderBy("start", F.desc("end"))
                              .rowsBetween(W.unboundedPreceding, -1))
    free = free.withColumn("_reach", reach).where(
        F.col("_reach").isNull() | (F.col("_reach") <= F.col("start"))).drop("_reach")
    if sents is None:
        sents = sentences(docs.join(free.select("doc_id"), "doc_id", "left_semi"))
    placed = overlap_join(free, sents.select("doc_id", "sent_no", "start", "end")).groupBy(
        "doc_id", "a_start", "a_end", "a_text").agg(F.min("b_sent_no").alias("sent_no"))
    extra = placed.select(
        "doc_id", "sent_no", F.col("a_start").alias("start"), F.col("a_end").alias("end"),
        F.col("a_text").alias("text"), F.col("a_text").alias("head"),
        F.lit(None).cast("bigint").alias("head_no"))
    return nps.unionByName(extra)


def base_noun_phrases(docs: DataFrame, sents: DataFrame | None = None,
                      ents: DataFrame | None = None) -> DataFrame:
    """``doc_id, ce_id, sent_no, start, end, text, head, head_no`` of documents."""
    if sents is None and ents is None:
        return _numbered_in_rows(docs)
    sents = sentences(docs) if sents is None else sents
    nps = sentence_noun_phrases(tagged_tokens(sents))
    if ents is not None:
        nps = add_entities(nps, ents, docs)
    return number_phrases(nps)


def _numbered_in_rows(docs: DataFrame) -> DataFrame:
    """Phrases of documents that come once are numbered in the document's row, without a shuffle; ids that come again, over all their rows."""
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    again = durable(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated")
    if again.isEmpty():
        return _phrases_of(docs)
    return _phrases_of(docs.join(again, "doc_id", "left_anti")).unionByName(
        number_phrases(_phrases_of(docs.join(again, "doc_id", "left_semi"))))


def _phrases_of(docs: DataFrame) -> DataFrame:
    found = document_phrase_arrays(docs.sparkSession, word_tags, "NNP", "NN", NOUN_TAGS, NP_TAGS, "PRP")(F.col("text"))
    return docs.select("doc_id", F.posexplode(found).alias("no", "np")).select(
        "doc_id", (F.col("no") + 1).cast("bigint").alias("ce_id"), "np.sent_no", "np.start", "np.end", "np.text", "np.head", "np.head_no")


def noun_phrases_of_tokens(pos: DataFrame) -> DataFrame:
    """Noun phrases of a stored POS layer: rows ``doc_id, sent_no, tok_no, start, end, text, tag``.

    The tokens of a sentence are brought back into one row.
    """
    listed = F.array_sort(F.collect_list(F.struct("tok_no", "start", "end", "text", "tag")))
    rows = pos.groupBy("doc_id", "sent_no").agg(listed.alias("toks"))
    np = rows.select("doc_id", "sent_no", F.explode(noun_phrase_spans(rows)).alias("np"))
    return np.select("doc_id", "sent_no", "np.start", "np.end", "np.head", "np.head_no")
