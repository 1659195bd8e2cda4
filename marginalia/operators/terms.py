"""Term lists and term vectors."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.operators.segmentation import (
    paragraph_spans,
    sentence_spans,
    token_spans,
    tokens,
)


def terms_of(text: Column) -> Column:
    """Lower-cased ASCII words of more than two letters with an a-z among them, in order."""
    words = F.transform(F.regexp_extract_all(text, F.lit(r"\w+"), F.lit(0)), F.lower)
    kept = F.filter(words, lambda w: (F.length(w) > 2) & w.rlike("[a-z]"))
    return F.coalesce(kept, F.array().cast("array<string>"))


def term_list(df: DataFrame, col: str = "text", key=("doc_id",)) -> DataFrame:
    """``key, terms``: in order, with duplicates; empty where there is no text."""
    return df.select(*key, terms_of(F.col(col)).alias("terms"))


def term_counts(df: DataFrame, col: str = "text", key=("doc_id",)) -> DataFrame:
    """``key, term, n``; equal terms of a document are added up before the shuffle."""
    return df.select(*key, F.explode(terms_of(F.col(col))).alias("term")).groupBy(
        *key, "term").agg(F.count("*").alias("n"))


def token_list(docs: DataFrame) -> DataFrame:
    """``doc_id, terms``: sentence-aware tokens in order, case kept, nothing filtered."""
    of_sentence = f"transform({token_spans('s.`text`')}, t -> t.`text`)"
    of_paragraph = f"flatten(transform({sentence_spans('p.`text`')}, s -> {of_sentence}))"
    found = F.expr(f"flatten(transform({paragraph_spans('`text`')}, p -> {of_paragraph}))")
    return docs.select("doc_id", F.coalesce(found, F.array().cast("array<string>")).alias("terms"))


def token_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, term, n`` over the tokens."""
    return tokens(docs).groupBy("doc_id", F.col("text").alias("term")).agg(F.count("*").alias("n"))
