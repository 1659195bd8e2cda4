"""Paragraphs, sentences and tokens.

Given only documents, every layer is derived inside the document's row, without
a join or a shuffle.  Given a stored layer, its text is fetched first with
:func:`marginalia.operators.spans.covered_text`.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginalia.functions.durable import durable
from marginalia.functions.scans import counted_on, numbered
from marginalia.functions.segments import BLANK, segments, without_blanks_behind
from marginalia.functions.words import token_arrays, token_rows
from marginalia.operators.spans import covered_text
from marginalia.schema import MAX_DOCUMENT_NUMBER, MAX_SENTENCE_TOKENS

# The segment patterns; their alternatives cover every character.
PARAGRAPH_PATTERN = r"[^\n]+|\n+"
SENTENCE_PATTERN = rf"[^.!?]*[.!?]+{BLANK}*|[^.!?]+"
# A token takes the blanks behind it along, which halves the number of pieces.
TOKEN_PATTERN = rf"(?:[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_ \t\n\x0B\f\r]){BLANK}*|{BLANK}+"

# Tokens to cut a long sentence at, best first.
BREAKS = (";", ":", ",", ".")


def paragraph_spans(text: str) -> str:
    return segments(text, PARAGRAPH_PATTERN, drop="ascii(piece) = 10")


def sentence_spans(text: str, base: str = "0L", drop_tails: bool = False) -> str:
    """Sentences of one paragraph; they cover all of it.

    With ``drop_tails`` a last character without a stop is left out, as some annotators do.
    """
    found = segments(text, SENTENCE_PATTERN, base=base)
    if not drop_tails:
        return found
    return (f"filter({found}, s -> s.`start` = {base} OR length(s.`text`) > 1"
            f" OR s.`text` RLIKE '[.!?]')")


def token_spans(text: str, base: str = "0L") -> str:
    blank = "ascii(piece) IN (9, 10, 11, 12, 13, 32)"
    return segments(text, TOKEN_PATTERN, drop=blank, base=base,
                    keep=without_blanks_behind("piece"))


def paragraphs(docs: DataFrame) -> DataFrame:
    """``doc_id, par_no, start, end, text``: the maximal runs without a newline."""
    return docs.select("doc_id", F.posexplode(F.expr(paragraph_spans("text"))).alias("no", "p")).select(
        "doc_id", F.col("no").cast("bigint").alias("par_no"), "p.start", "p.end", "p.text")


def default_paragraph(docs: DataFrame, pars: DataFrame, less_one: bool = False) -> DataFrame:
    """Add a paragraph over the whole text to each document that has none.

    With ``less_one`` it ends one character early, as some annotators have it.
    """
    bare = docs.join(pars.select("doc_id").distinct(), "doc_id", "left_anti")
    end = F.coalesce(F.length("text").cast("bigint"), F.lit(0).cast("bigint"))
    covering = bare.select("doc_id", F.lit(0).cast("bigint").alias("par_no"),
                           F.lit(0).cast("bigint").alias("start"),
                           (end - 1 if less_one else end).alias("end"))
    return pars.select("doc_id", "par_no", "start", "end").unionByName(covering)


def sentences(docs: DataFrame, pars: DataFrame | None = None, drop_tails: bool = False) -> DataFrame:
    """``doc_id, par_no, sent_no, start, end, text``: abutting spans per paragraph."""
    if pars is None:
        return _sentences_of_documents(docs, drop_tails)
    if "text" not in pars.columns:
        pars = covered_text(pars.select("doc_id", "par_no", "start", "end"), docs)
    cut = pars.select("doc_id", "par_no", F.col("start").alias("par_start"),
                      F.expr(sentence_spans("`text`", "`start`", drop_tails)).alias("found"))
    # One row per paragraph: the window sorts paragraphs, not sentences.
    before = F.sum(F.size("found")).over(
        W.partitionBy("doc_id").orderBy("par_start", "par_no")) - F.size("found")
    return (cut.withColumn("before", before)
            .select("doc_id", "par_no", "before", F.posexplode("found").alias("no", "s"))
            .select("doc_id", "par_no", (F.col("before") + F.col("no")).alias("sent_no"),
                    "s.start", "s.end", "s.text"))


def _sentences_of_documents(docs: DataFrame, drop_tails: bool) -> DataFrame:
    found = (f"flatten(transform({paragraph_spans('`text`')}, (p, no) -> transform("
             f"{sentence_spans('p.`text`', 'p.`start`', drop_tails)}, s -> struct(CAST(no AS BIGINT) AS par_no,"
             f" s.`start` AS `start`, s.`end` AS `end`, s.`text` AS `text`))))")
    return docs.select("doc_id", F.posexplode(F.expr(found)).alias("no", "s")).select(
        "doc_id", "s.par_no", F.col("no").cast("bigint").alias("sent_no"),
        "s.start", "s.end", "s.text")


def sentence_numbers(spans: DataFrame) -> DataFrame:
    """Add ``sent_no``, counted from 0 through the document."""
    return numbered(spans, "sent_no").withColumn("sent_no", F.col("sent_no") - 1)


def fill_sentence_numbers(spans: DataFrame, col: str = "sent_no") -> DataFrame:
    """Add ``filled``: a missing number continues from the last one seen, from 1 on."""
    return counted_on(spans, col, "filled")


def tokens(docs: DataFrame, sents: DataFrame | None = None) -> DataFrame:
    """``doc_id, sent_no, tok_no, start, end, text``: words and single signs."""
    if sents is None:
        sents = sentences(docs)
    elif "text" not in sents.columns:
        # The places are read several times there.
        places = durable(sents.select("doc_id", "sent_no", "start", "end"), "sentence-places")
        sents = covered_text(places, docs)
    return token_rows(sents)


def all_caps_lower(sents: DataFrame, toks: DataFrame) -> DataFrame:
    """Add ``text_norm``: lower-cased in a sentence of several words without a small letter."""
    loud = sents.where(F.col("text").rlike(rf"\A[^a-z]+{BLANK}[^a-z]+\z")).select(
        "doc_id", "sent_no", F.lit(True).alias("_loud"))
    return (toks.join(loud, ["doc_id", "sent_no"], "left")
            .withColumn("text_norm", F.when(F.col("_loud"), F.lower("text")).otherwise(F.col("text")))
            .drop("_loud"))


def _last_at(rank: int) -> Column:
    """For each of ``toks`` the place of the last break of a rank at or before it, -1 where there is none.

    Every round looks twice as far back, so a long sentence takes a logarithm of rounds over its array.
    """
    return F.expr(f"""aggregate(sequence(0, CAST(ceil(log2(size(toks))) AS INT)),
        transform(toks, (t, i) -> IF(t.rank = {rank}, i, -1)),
        (seen, k) -> transform(seen, (at, i) -> greatest(at, coalesce(get(seen, i - shiftleft(1, k)), -1))))""")


def _halved(limit: int) -> Column:
    """Ranges ``low, high`` of ``toks`` in order, from the arrays ``last_0`` and so on.

    A range above ``limit`` tokens is cut behind the best-ranked break nearest to the left of its middle, and both
    halves go through the same.  Behind a break of some rank the next cut of that rank or a better one lies beyond the old
    middle, so five rounds halve what is left.
    """
    middle = "least(r.low + CAST((r.high - r.low) DIV 2 AS INT), r.high - 2)"
    best = ", ".join(f"IF(get(last_{k}, {middle}) >= r.low, get(last_{k}, {middle}), NULL)" for k in range(len(BREAKS)))
    return F.expr(f"""aggregate(sequence(1, 5 * (1 + CAST(ceil(log2(size(toks))) AS INT))),
        array(struct(0 AS low, size(toks) AS high)),
        (ranges, k) -> flatten(transform(
            transform(ranges, r -> struct(r.low AS low, r.high AS high,
                IF(r.high - r.low <= {limit}, NULL, coalesce({best})) AS cut)),
            r -> IF(r.cut IS NULL, array(struct(r.low AS low, r.high AS high)),
                    array(struct(r.low AS low, r.cut + 1 AS high), struct(r.cut + 1 AS low, r.high AS high))))))""")


def split_long_sentences(sents: DataFrame, toks: DataFrame | None = None,
                         limit: int = MAX_SENTENCE_TOKENS) -> DataFrame:
    """``doc_id, sent_no, part_no, start, end`` with at most ``limit`` tokens a part.

    A stretch without any break stays whole.  Sentences with ``text`` are cut up inside their
    rows, without a shuffle; given stored tokens, those of long sentences are brought together by sentence.
    """
    rows = _tokens_of_rows(sents, limit) if toks is None else _tokens_of_table(sents, toks, limit)
    long = F.col("toks").isNotNull()
    rows = rows.select("*", *[F.when(long, _last_at(k)).alias(f"last_{k}") for k in range(len(BREAKS))])
    rows = rows.withColumn("ranges", F.when(long, _halved(limit)))
    parts = F.expr("""coalesce(transform(ranges, r -> struct(
        IF(r.low = 0, `start`, toks[r.low].`start`) AS `start`,
        IF(r.high = size(toks), `end`, toks[r.high - 1].`end`) AS `end`)), array(struct(`start`, `end`)))""")
    return rows.select("doc_id", "sent_no", F.posexplode(parts).alias("no", "p")).select(
        "doc_id", "sent_no", F.col("no").cast("bigint").alias("part_no"), "p.start", "p.end")


def _rank(text: Column) -> Column:
    """Rank of a break token from 0 on, -1 for any other one."""
    return F.array_position(F.array(*[F.lit(b) for b in BREAKS]), text).cast("int") - 1


def _tokens_of_rows(sents: DataFrame, limit: int) -> DataFrame:
    """``doc_id, sent_no, start, end, toks`` with ``start, end, rank`` of tokens; null where nothing is to be cut."""
    found = token_arrays(sents.sparkSession)(F.col("text"), F.col("start"))
    rows = sents.select("doc_id", "sent_no", "start", "end", found.alias("found"))
    toks = F.transform("found", lambda t: F.struct(t["start"], t["end"], _rank(t["text"]).alias("rank")))
    return rows.select("doc_id", "sent_no", "start", "end", F.when(F.size("found") > limit, toks).alias("toks"))


def _tokens_of_table(sents: DataFrame, toks: DataFrame, limit: int) -> DataFrame:
    """The same from stored tokens; only those of long sentences are put in order."""
    sentence = ["doc_id", "sent_no"]
    sizes = toks.groupBy(*sentence).agg(F.count("*").alias("n")).where(F.col("n") > limit).select(*sentence)
    listed = F.array_sort(F.collect_list(F.struct("tok_no", "start", "end", _rank(F.col("text")).alias("rank"))))
    found = toks.join(sizes, sentence, "left_semi").groupBy(*sentence).agg(
        F.transform(listed, lambda t: F.struct(t["start"], t["end"], t["rank"])).alias("toks"))
    return sents.select(*sentence, "start", "end").join(found, sentence, "left")


def document_number(docs: DataFrame, numbered: DataFrame | None = None,
                    wrap: int = MAX_DOCUMENT_NUMBER) -> DataFrame:
    """``doc_id, start, end, doc_no``: a running number by ``doc_id`` that wraps.

    ``numbered`` holds documents that keep the number they have.  Only keys and
    lengths are sorted; what reaches the driver is one count per partition.
    """
    if numbered is not None:
        docs = docs.join(numbered.select("doc_id"), "doc_id", "left_anti")
    spark = docs.sparkSession
    keyed = docs.select("doc_id", F.length("text").cast("bigint").alias("end"))
    # The counts and the rows must come from one and the same sort.
    slots = durable(keyed.sort("doc_id").withColumn("slot", F.monotonically_increasing_id()),
                    "document-number")
    part = F.shiftright("slot", 33).alias("part")
    sizes = slots.groupBy(part).agg(F.count("*").alias("n")).collect()
    before, seen = [], 0
    for row in sorted(sizes, key=lambda r: r["part"]):
        before.append((row["part"], seen))
        seen += row["n"]
    offsets = spark.createDataFrame(before, "part bigint, before bigint")
    number = (F.col("before") + F.col("slot").bitwiseAND(F.lit((1 << 33) - 1))) % wrap + 1
    return slots.withColumn("part", part).join(offsets, "part").select(
        "doc_id", F.lit(0).cast("bigint").alias("start"), "end", number.alias("doc_no"))
