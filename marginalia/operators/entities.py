"""Named entities by pattern and by word list."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions.durable import durable
from marginalia.functions.segments import matches, quoted
from marginalia.functions.words import gram_arrays
from marginalia.operators.segmentation import token_spans

# Entity patterns; the entity types without one come from word lists.
PATTERNS = {
    "percentage": r"[0-9]+(?:\.[0-9]+)?%",
    "money": r"[$€£][0-9]+(?:\.[0-9]+)?",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "time": r"[0-9]{1,2}:[0-9]{2}",
}
ENTITY_TYPES = ("date", "location", "money", "organization", "percentage", "person", "time")


def pattern_entities(docs: DataFrame, patterns: dict[str, str] = PATTERNS) -> DataFrame:
    """``doc_id, type, start, end, text`` of all matches; one pass over the text."""
    any_hit = reduce(lambda a, b: a | b, [F.col("text").rlike(p) for p in patterns.values()])

    found = [f"transform({matches('`text`', pattern)}, m -> struct({quoted(name)} AS type,"
             f" m.`start` AS `start`, m.`end` AS `end`, m.`text` AS `text`))"
             for name, pattern in patterns.items()]
    listed = F.expr(f"concat({', '.join(found)})")
    return docs.where(any_hit).select("doc_id", F.explode(listed).alias("e")).select(
        "doc_id", "e.type", "e.start", "e.end", "e.text")


def gazetteer_entities(toks: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Tokens whose lower case is a listed ``word`` of a ``type``."""
    listed = gazetteer.select(F.col("word").alias("_word"), "type").distinct()
    return toks.withColumn("_word", F.lower("text")).join(listed, "_word").select(
        "doc_id", "type", "start", "end", "text")


def gazetteer_phrases(rows: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """``doc_id, type, start, end, text``: runs of tokens of one sentence that are listed, of one word or of several.

    ``rows`` are sentences with ``start``, ``text`` and ``toks``.  A ``word`` of the list is cut into tokens like the text, and both are
    compared token by token in lower case.  Of matches that overlap the leftmost one stays, of those that begin together the
    longest, with all of its types.  Tokens become n-grams inside the row, of just the lengths that are listed: those
    lengths are all that reaches the driver.  ``toks`` is read once a row, however it came about.
    """
    words = f"transform({token_spans('word')}, t -> lower(t.`text`))"
    listed = gazetteer.select(F.expr(words).alias("words"), "type").where(F.size("words") > 0).select(
        F.size("words").alias("n"), F.array_join("words", " ").alias("_key"), "type").distinct()
    listed = durable(listed, "gazetteer")
    lengths = sorted(r["n"] for r in listed.select("n").distinct().collect())
    if not lengths:
        return rows.where(F.lit(False)).select("doc_id", F.lit("").alias("type"), "start", F.col("start").alias("end"), "text")
    piece = F.substring("text", (F.col("g.start") - F.col("_base") + 1).cast("int"), (F.col("g.end") - F.col("g.start")).cast("int"))
    grams = gram_arrays(rows.sparkSession, lengths)(F.col("toks"))
    found = (rows.select("doc_id", "sent_no", F.col("start").alias("_base"), "text", F.explode(grams).alias("g"))
             .join(listed.withColumnRenamed("n", "_n"), F.col("g.key") == F.col("_key"))
             .select("doc_id", "sent_no", "g.i", "g.n", "type", "g.start", "g.end", piece.alias("text")))
    if lengths == [1]:
        return found.select("doc_id", "type", "start", "end", "text")
    found = durable(found, "phrase-matches")
    # Single tokens overlap each other nowhere: only sentences with a longer match have anything to settle.
    wide = found.where("n > 1").select("doc_id", "sent_no").distinct()
    alone = found.join(wide, ["doc_id", "sent_no"], "left_anti")
    hit = "struct(i, -n AS shorter, n, type, `start`, `end`, text)"
    settled = ("aggregate(hits, struct(-1 AS at, 0 AS n, 0 AS reach, filter(hits, h -> false) AS kept), (acc, h) -> CASE"
               " WHEN h.i >= acc.reach THEN struct(h.i AS at, h.n AS n, h.i + h.n AS reach, array_append(acc.kept, h) AS kept)"
               " WHEN h.i = acc.at AND h.n = acc.n THEN struct(acc.at AS at, acc.n AS n, acc.reach AS reach, array_append(acc.kept, h) AS kept)"
               " ELSE acc END, acc -> acc.kept)")
    kept = (found.join(wide, ["doc_id", "sent_no"], "left_semi").groupBy("doc_id", "sent_no")
            .agg(F.array_sort(F.collect_list(F.expr(hit))).alias("hits"))
            .select("doc_id", F.explode(F.expr(settled)).alias("h")).select("doc_id", "h.type", "h.start", "h.end", "h.text"))
    return alone.select("doc_id", "type", "start", "end", "text").unionByName(kept)


def named_entities(docs: DataFrame, toks: DataFrame | None = None,
                   patterns: dict[str, str] = PATTERNS,
                   gazetteer: DataFrame | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Entities of all types: pattern matches in the text, listed words among the tokens.

    Given sentences with their tokens as ``rows``, the list may hold phrases of several words; given
    ``toks`` it holds single tokens.
    """
    found = pattern_entities(docs, patterns)
    if gazetteer is None:
        return found
    listed = gazetteer_entities(toks, gazetteer) if rows is None else gazetteer_phrases(rows, gazetteer)
    return found.unionByName(listed)
