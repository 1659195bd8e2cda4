"""Layers of the document table that the registered queries run on."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia import schema as S
from marginalia.functions.durable import durable
from marginalia.functions.segments import let, segments
from marginalia.operators import coref, entities, segmentation, tagging, trees
from marginalia.plans import annotate as plan
from marginalia.sources.documents import scan_documents, spread

# Caller rules of the checks; the word types are arbitrary.
CHECK_PATTERNS = {**entities.PATTERNS, "ip": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"}
CHECK_GAZETTEER = [
    ("apache", "organization"), ("license", "organization"), ("version", "organization"),
    ("idiot", "person"), ("scum", "person"),
    ("trash", "location"), ("stupid", "location"),
]


# Entries of one to four tokens that overlap each other.
CHECK_PHRASES = [
    ("apache license", "organization"), ("Apache License", "person"), ("license, version", "location"),
    ("apache license, version", "organization"), ("version", "time"), ("idiot", "person"),
]

# Node ids of a tree: a sentence has room for so many tags, leaves and runs.
LEAF_IDS, RUN_IDS = 1 << 30, 1 << 31


def docs(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, whatever their length."""
    return spread(scan_documents(spark, folder))


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")


def gazetteer(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CHECK_GAZETTEER, "word string, type string")


def tagged(spark: SparkSession, folder: str) -> DataFrame:
    return tagging.tagged_tokens(segmentation.sentences(docs(spark, folder)))


def pos(spark: SparkSession, folder: str) -> DataFrame:
    """Token rows with tags."""
    rows = tagged(spark, folder).select("doc_id", "sent_no", F.posexplode("toks").alias("no", "t"))
    return rows.select("doc_id", "sent_no", (F.col("no") + 1).cast("bigint").alias("tok_no"),
                       "t.start", "t.end", "t.text", "t.tag")


def entity_rows(spark: SparkSession, folder: str) -> DataFrame:
    d = docs(spark, folder)
    return entities.named_entities(d, segmentation.tokens(d), CHECK_PATTERNS, gazetteer(spark))


def phrase_entities(spark: SparkSession, folder: str) -> DataFrame:
    listed = spark.createDataFrame(CHECK_PHRASES, "word string, type string")
    return entities.gazetteer_phrases(tagged(spark, folder), listed)


def phrases(spark: SparkSession, folder: str) -> DataFrame:
    """Noun phrases, written once since several steps of a query read them."""
    return durable(tagging.base_noun_phrases(docs(spark, folder)), "phrases")


def features(spark: SparkSession, folder: str) -> DataFrame:
    return coref.candidate_features(phrases(spark, folder))


def annotations(spark: SparkSession, folder: str) -> DataFrame:
    return plan.base_layers(docs(spark, folder))


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """A store with gaps: which layers a document holds follows from its labels.

    The stored paragraph covers the whole text, so it shows whether sentences
    are made from it or from the text.
    """
    d = docs(spark, folder)
    holds = lambda rule: F.coalesce(F.max(rule), F.lit(False))
    marks = labels(spark, folder).groupBy("doc_id").agg(
        holds(F.col("quality") == 1).alias("good"), holds(F.col("toxic") == 0).alias("clean"))
    marked = d.join(marks, "doc_id")
    no_pars = segmentation.paragraphs(d).where(F.lit(False))
    pars = segmentation.default_paragraph(d.join(marks.select("doc_id"), "doc_id", "left_semi"), no_pars)
    # The text of a document is read once for all layers that it holds.
    return plan.paragraph_layer(pars).unionByName(plan.flagged_layers(
        marked, sent=F.col("good"), token=F.col("clean"), pos=F.col("clean") & F.col("good")))


def damaged(spark: SparkSession, folder: str) -> DataFrame:
    """All tokens as annotations; words of 11 letters and more get a wrong span."""
    d = docs(spark, folder)
    sizes = d.select("doc_id", F.length("text").cast("bigint").alias("n"))
    toks = segmentation.tokens(d).join(sizes, "doc_id")
    size, n = F.length("text"), F.col("n")
    zero = F.lit(0).cast("bigint")
    start = (F.when(size == 12, F.col("start") + n).when(size >= 14, zero)
             .otherwise(F.col("start")))
    end = (F.when(size.isin(11, 12), F.col("end") + n).when(size == 13, F.col("start"))
           .when(size >= 14, n).otherwise(F.col("end")))
    empty = F.array().cast("array<string>")
    return toks.select(
        "doc_id", F.lit(S.TOKEN).alias("set"),
        (F.col("sent_no") * S.SENTENCE_ID_STEP + F.col("tok_no")).alias("ann_id"),
        start.alias("start"), end.alias("end"), F.lit("token").alias("type"),
        F.map_from_arrays(empty, empty).alias("attrs"))


def _tree_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Sentences ``doc_id, s, toks`` with ``runs`` of tokens of a class."""
    rows = tagged(spark, folder)
    nominal = ", ".join(f"'{tag}'" for tag in tagging.NP_TAGS)
    classes = (f"array_join(transform(toks, t -> CASE WHEN t.tag IN ({nominal}) THEN 'n'"
               f" WHEN startswith(t.tag, 'VB') THEN 'v' ELSE 'o' END), '')")
    return rows.where(F.size("toks") > 0).select(
        "doc_id", (F.col("sent_no") * S.SENTENCE_ID_STEP).alias("s"), "toks",
        F.expr(let("classes", classes, segments("classes", "n+|v+|o+"))).alias("runs"))


def _tree_edges(rows: DataFrame) -> DataFrame:
    name = lambda r: (F.when(r["text"].startswith("n"), F.lit("NP"))
                      .when(r["text"].startswith("v"), F.lit("VP")).otherwise(F.lit("X")))
    root = F.array(F.struct(F.col("s").alias("node_id"), F.lit(None).cast("bigint").alias("parent_id"),
                            F.lit("S").alias("label")))
    middle = F.transform("runs", lambda r: F.struct(
        (F.col("s") + RUN_IDS + r["start"] + 1).alias("node_id"), F.col("s").alias("parent_id"),
        name(r).alias("label")))
    low = F.flatten(F.transform("runs", lambda r: F.transform(
        F.sequence(r["start"], r["end"] - 1), lambda i: F.struct(
            (F.col("s") + i + 1).alias("node_id"),
            (F.col("s") + RUN_IDS + r["start"] + 1).alias("parent_id"),
            F.col("toks")[i.cast("int")]["tag"].alias("label")))))
    return rows.select("doc_id", F.explode(F.concat(root, middle, low)).alias("e")).select(
        "doc_id", "e.node_id", "e.parent_id", "e.label")


def tree_edges(spark: SparkSession, folder: str) -> DataFrame:
    """The edges of :func:`tree`."""
    return _tree_edges(_tree_rows(spark, folder))


def tree(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Edges and leaves of a three-level tree per sentence: S, runs of a class, tags.

    Both are read several times, so the sentences that they come from are written once.
    """
    rows = durable(_tree_rows(spark, folder), "tree-sentences")
    leaves = rows.select("doc_id", "s", F.posexplode("toks").alias("no", "t")).select(
        "doc_id", (F.col("s") + LEAF_IDS + 1 + F.col("no")).alias("node_id"),
        (F.col("s") + 1 + F.col("no")).alias("parent_id"), F.col("t.text").alias("label"),
        "t.start", "t.end")
    return _tree_edges(rows), leaves


def dependency_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Sentence rows with ``toks`` and ``edges`` ``dep_no, gov_no, relation, seq``, by simple rules on the tags."""
    nouns = ", ".join(f"'{tag}'" for tag in tagging.NOUN_TAGS)
    verb = "coalesce(nullif(array_position(transform(toks, t -> startswith(t.tag, 'VB')), true), 0), 1)"
    relation = (f"CASE WHEN t.tag = 'DT' THEN 'det' WHEN t.tag = 'JJ' THEN 'amod' WHEN t.tag = 'IN' THEN 'prep'"
                f" WHEN t.tag IN ({nouns}) AND i + 1 < verb THEN 'nsubj' WHEN t.tag IN ({nouns}) AND i + 1 > verb THEN 'dobj' END")
    edge = "struct(CAST(i + 1 AS BIGINT) AS dep_no, CAST({} AS BIGINT) AS gov_no, {} AS relation, CAST({} AS BIGINT) AS seq)"
    plain = f"IF(i + 1 <> verb, {edge.format('verb', relation, 1)}, NULL)"
    separated = "i + 1 > 2 AND (toks[i - 1].text = ',' OR toks[i - 1].tag = 'CC')"
    conj = f"IF({separated}, {edge.format('i - 1', repr('conj'), 2)}, NULL)"
    edges = let("verb", verb, f"flatten(transform(toks, (t, i) -> filter(array({plain}, {conj}), e -> e.relation IS NOT NULL)))")
    return tagged(spark, folder).withColumn("edges", F.expr(edges))


def dependency_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Tokens and edges as tables; of the sentences only places and edges are written."""
    rows = dependency_rows(spark, folder).select(
        "doc_id", "sent_no", F.expr("transform(toks, t -> struct(t.`start`, t.`end`))").alias("toks"), "edges")
    return trees.tables_of(durable(rows, "sentences"))


def dependencies(spark: SparkSession, folder: str, resolve: bool = False) -> DataFrame:
    return trees.sentence_dependencies(dependency_rows(spark, folder), resolve)
