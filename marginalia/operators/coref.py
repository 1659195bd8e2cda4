"""Coreference: candidate pairs, features, scores, links and clusters.

Candidates are found by key, as the last mention with the same text or head or the
one just before, so pairs grow with the mentions.  They carry the columns the
features need and are not joined back to their phrases.
"""

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginalia.functions.durable import discard, durable
from marginalia.functions.scans import in_parts
from marginalia.operators.tagging import LEXICON
from marginalia.schema import LIST_ITEMS, SENTENCE_ID_STEP

# Weight of each feature, in the order they are added up.
WEIGHTS = {
    "bias": -0.6,
    "exact": 1.0,
    "head_match": 0.5,
    "jaccard": 0.75,
    "sent_dist": -0.1,
    "both_pronoun": 0.2,
    "either_pronoun": -0.3,
    "number_agree": 0.1,
    "substring": 0.4,
}
LINK_THRESHOLD = 0.5
FEATURES = tuple(name for name in WEIGHTS if name != "bias")
# The highest sentence distance with a column of its own.
DISTANCE_STEPS = (0, 1, 2, 3)


def _rounded(value: Column, digits: int) -> Column:
    """Half up in plain double arithmetic, which every engine does alike."""
    scale = F.lit(float(10 ** digits))
    return F.floor(value * scale + 0.5).cast("double") / scale


def _words(text: Column) -> Column:
    return F.array_distinct(F.split(F.trim(text), " +"))


def _features(a: Mapping[str, Column], b: Mapping[str, Column]) -> dict[str, Column]:
    """The features of two mentions ``sent_no, text, head`` in lower case; words are cut out of them here, so that no shuffle carries them."""
    low_a, low_b, words_a, words_b = a["text"], b["text"], _words(a["text"]), _words(b["text"])
    common, either = F.size(F.array_intersect(words_a, words_b)), F.size(F.array_union(words_a, words_b))
    flag = lambda test: test.cast("bigint")
    pronoun = lambda text: text.isin(*LEXICON["PRP"])
    plural = lambda head: head.endswith("s")
    return {
        "exact": flag(low_a == low_b),
        "head_match": flag(a["head"] == b["head"]),
        "jaccard": F.when(low_a == low_b, F.lit(1.0)).otherwise(_rounded(common.cast("double") / either, 6)),
        "sent_dist": b["sent_no"] - a["sent_no"],
        "both_pronoun": flag(pronoun(low_a) & pronoun(low_b)),
        "either_pronoun": flag(pronoun(low_a) | pronoun(low_b)),
        "number_agree": flag(plural(a["head"]) == plural(b["head"])),
        "substring": flag(F.contains(low_a, low_b) | F.contains(low_b, low_a)),
    }


# Mentions of a document in a row that one window looks through for the one just before.
_BLOCK_BITS = 10


def _candidates(nps: DataFrame, made: Callable[[Column, Column], dict[str, Column]] = lambda a, b: {}) -> DataFrame:
    """``doc_id, i, j`` of earlier and later mention, and what ``made`` says of the two.

    The earlier mention is met in a window and ``made`` is asked there, so that a row carries only its
    own mention and the values of its pairs through the next shuffle.
    """
    held = ["doc_id", "ce_id", "sent_no", "text", F.lower("head").alias("head")]
    mention = F.struct("ce_id", "sent_no", "text", "head")
    order = lambda *keys: W.partitionBy("doc_id", *keys).orderBy("ce_id")
    pair = lambda met: F.when(met, F.struct(F.col("_a.ce_id").alias("i"), *[
        value.alias(name) for name, value in made(F.col("_a"), F.col("_b")).items()]))

    def found(df: DataFrame, name: str, window, met: Column) -> DataFrame:
        both = df.withColumn("_a", F.lag(mention).over(window)).withColumn("_b", mention)
        return both.withColumn(name, pair(F.col("_a").isNotNull() & met)).drop("_a", "_b")

    # Mentions are numbered without gaps; the last one of a block goes into the next block too.
    block, following = (F.shiftright(F.col("ce_id") + n, _BLOCK_BITS) for n in (0, 1))
    rows = nps.select(*held, F.explode(F.array_distinct(F.array(block, following))).alias("_block"))
    rows = found(rows, "before", order("_block"), F.col("doc_id").isNotNull() & (F.col("_a.ce_id") == F.col("ce_id") - 1))
    # Each window is written before the next one, so that the shuffle of one of them at a time lies on disk.
    near = durable(rows.where(F.col("_block") == block).drop("_block"), "mentions-before")
    rows = durable(found(near.withColumn("_low", F.lower("text")), "same_text", order("_low"), F.lit(True)).drop("_low"), "mentions-text")
    discard(near)
    rows = found(rows, "same_head", order("head"), F.col("head").isNotNull())
    # At most three rows a mention; of one number only one stays.
    number = lambda name: F.coalesce(F.col(f"{name}.i"), F.lit(-1).cast("bigint"))
    fresh_head = F.when(number("same_head") != number("same_text"), F.col("same_head"))
    fresh_before = F.when((number("before") != number("same_text")) & (number("before") != number("same_head")),
                          F.col("before"))
    several = F.array_compact(F.array("same_text", fresh_head, fresh_before))
    return rows.select("doc_id", F.col("ce_id").alias("j"), F.col("text").alias("_text"), F.explode(several).alias("p")).select(
        "doc_id", "p.i", "j", "_text", *[f"p.{name}" for name in made(F.col("_a"), F.col("_b"))])


def _lowered_features(a: Column, b: Column) -> dict[str, Column]:
    low = lambda m: {"sent_no": m["sent_no"], "text": F.lower(m["text"]), "head": m["head"]}
    return _features(low(a), low(b))


def mention_pairs(nps: DataFrame) -> DataFrame:
    """``doc_id, i, j`` with ``i`` before ``j``.

    A mention is paired with the last earlier one of the same text, the last earlier one of the
    same head, and the one just before it, wherever they stand: three pairs a mention at most.
    """
    return _candidates(nps).select("doc_id", "i", "j")


def pair_features(pairs: DataFrame, nps: DataFrame) -> DataFrame:
    """``doc_id, i, j`` and the features of given pairs."""
    mentions = nps.select("doc_id", "ce_id", F.struct("sent_no", F.lower("text").alias("text"), F.lower("head").alias("head")).alias("m"))
    a = mentions.select("doc_id", F.col("ce_id").alias("i"), F.col("m").alias("a"))
    b = mentions.select("doc_id", F.col("ce_id").alias("j"), F.col("m").alias("b"))
    joined = pairs.select("doc_id", "i", "j").join(a, ["doc_id", "i"]).join(b, ["doc_id", "j"])
    return joined.select("doc_id", "i", "j", *[value.alias(name) for name, value in _features(F.col("a"), F.col("b")).items()])


def candidate_features(nps: DataFrame) -> DataFrame:
    """:func:`mention_pairs` and :func:`pair_features` at once; no phrase is looked up again."""
    return _candidates(nps, _lowered_features).select("doc_id", "i", "j", *FEATURES)


def binarized_features(features: DataFrame) -> DataFrame:
    """``doc_id, i, j`` and 0/1 columns; distance and Jaccard become steps."""
    flag = lambda test: test.cast("bigint")
    plain = ["exact", "head_match", "both_pronoun", "either_pronoun", "number_agree", "substring"]
    top = DISTANCE_STEPS[-1]
    distance = [flag(F.col("sent_dist") == d).alias(f"sent_dist_{d}") for d in DISTANCE_STEPS]
    jaccard = F.col("jaccard")
    return features.select(
        "doc_id", "i", "j", *plain, *distance,
        flag(F.col("sent_dist") > top).alias("sent_dist_more"),
        flag(jaccard == 0).alias("jaccard_none"),
        flag((jaccard > 0) & (jaccard < 0.5)).alias("jaccard_low"),
        flag((jaccard >= 0.5) & (jaccard < 1)).alias("jaccard_high"),
        flag(jaccard == 1).alias("jaccard_full"))


def pair_scores(features: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """``doc_id, i, j, weight``: the sum of weighted features, added in a fixed order."""
    return features.select("doc_id", "i", "j", _score(weights).alias("weight"))


def _score(weights: dict[str, float], features: Mapping[str, Column] | None = None) -> Column:
    value, total = features or {name: F.col(name) for name in weights}, None
    for name, weight in weights.items():
        term = F.lit(weight) if name == "bias" else F.lit(weight) * value[name].cast("double")
        total = term if total is None else total + term
    return _rounded(total, 6)


def coref_links(scored: DataFrame, nps: DataFrame) -> DataFrame:
    """``doc_id, left_entity, right_entity, weight``: the texts of linked mentions, once each."""
    left = nps.select("doc_id", F.col("ce_id").alias("i"), F.col("text").alias("left_entity"))
    right = nps.select("doc_id", F.col("ce_id").alias("j"), F.col("text").alias("right_entity"))
    # Written between the lookups, so that their shuffles do not lie on disk together.
    half = durable(scored.join(left, ["doc_id", "i"]), "links-left")
    whole = durable(half.join(right, ["doc_id", "j"]), "links")
    discard(half)
    return (whole
            .select("doc_id", "left_entity", "right_entity", _rounded(F.col("weight"), 4).alias("weight"))
            .distinct())


def candidate_links(nps: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """The links of all candidates; pairs carry the earlier text and their weight, so no phrase is looked up again."""
    def made(a: Column, b: Column) -> dict[str, Column]:
        return {"left_entity": a["text"], "weight": _rounded(_score(weights, _lowered_features(a, b)), 4)}

    return _candidates(nps, made).select("doc_id", "left_entity", F.col("_text").alias("right_entity"), "weight").distinct()


def coref_clusters(scored: DataFrame, nps: DataFrame,
                   threshold: float = LINK_THRESHOLD) -> DataFrame:
    """``doc_id, ce_id, cluster_id``: mentions joined by pairs at or above ``threshold``.

    A cluster is named by its smallest mention.  Every round a mention takes the
    smallest name among itself and its partners and then that name's own name;
    documents without a change leave the loop.  A round writes one table, from which the next one
    reads names and which documents still change.
    """
    strong = scored.where(F.col("weight") >= threshold).select("doc_id", "i", "j")
    both = F.array(F.struct(F.col("i").alias("u"), F.col("j").alias("v")),
                   F.struct(F.col("j").alias("u"), F.col("i").alias("v")))
    edges = durable(strong.select("doc_id", F.explode(both).alias("e")).select(
        "doc_id", "e.u", "e.v"), "coref-edges")
    # Mentions without a partner name themselves and stay out of the loop.
    names = durable(edges.groupBy("doc_id", F.col("u").alias("ce_id")).agg(
        F.least("ce_id", F.min("v")).alias("name")), "coref-names")
    pairs, settled = edges, []
    while True:
        seen = names.select("doc_id", F.col("ce_id").alias("v"), F.col("name").alias("_name"))
        hooked = pairs.join(seen, ["doc_id", "v"]).groupBy(
            "doc_id", F.col("u").alias("ce_id")).agg(F.min("_name").alias("_low"))
        own = names.select("doc_id", F.col("ce_id").alias("name"), F.col("name").alias("_own"))
        moved = (names.join(hooked, ["doc_id", "ce_id"])
                 .join(own, ["doc_id", "name"], "left")
                 .select("doc_id", "ce_id", F.col("name").alias("old"),
                         F.least("name", "_low", "_own").alias("name")))
        moved = durable(moved, "coref-round")
        active = moved.where(F.col("old") != F.col("name")).select("doc_id").distinct()
        settled.append(moved.join(active, "doc_id", "left_anti").select("doc_id", "ce_id", "name"))
        if active.isEmpty():
            break
        names = moved.join(active, "doc_id", "left_semi").select("doc_id", "ce_id", "name")
        pairs = edges.join(active, "doc_id", "left_semi")
    named = settled[0]
    for part in settled[1:]:
        named = named.unionByName(part)
    return nps.select("doc_id", "ce_id").join(named, ["doc_id", "ce_id"], "left").select(
        "doc_id", "ce_id", F.coalesce("name", "ce_id").alias("cluster_id"))


def node_id(sent_no: str, tok_no: str) -> Column:
    """Number of a token in its document; sentences and tokens both count from 1."""
    return (F.col(sent_no) + 1) * SENTENCE_ID_STEP + F.col(tok_no)


def coref_destinations(links: DataFrame, items: int = LIST_ITEMS) -> DataFrame:
    """``doc_id, node_id, part, dests``: each end of a link ``(doc_id, src, dst)`` and where it leads.

    ``dests`` is the comma-joined list of all destinations, at most ``items`` in a part, and empty for a node
    that is only led to.
    """
    leads = links.select("doc_id", F.col("src").alias("node_id"), F.col("dst").alias("dest")).distinct()
    dests = F.array_sort(F.collect_list("dest")).cast("array<string>")
    lists = in_parts(leads, ["doc_id", "node_id"], ["dest"], items).groupBy("doc_id", "node_id", "part").agg(
        F.array_join(dests, ",").alias("dests"))
    ends = links.select("doc_id", F.col("dst").alias("node_id")).distinct()
    bare = ends.join(leads, ["doc_id", "node_id"], "left_anti")
    return lists.unionByName(bare.select("doc_id", "node_id", F.lit(0).cast("bigint").alias("part"), F.lit("").alias("dests")))


def np_properties(nps: DataFrame) -> DataFrame:
    """``doc_id, ce_id, start, end, props_json``: the properties of a phrase in key order."""
    low = F.lower("text")
    props = F.struct(
        F.col("ce_id").cast("string").alias("CE_ID"),
        F.when(F.lower("head").endswith("s"), F.lit("plural")).otherwise(
            F.lit("singular")).alias("Number"),
        F.when(low.isin(*LEXICON["PRP"]), F.lit("true")).otherwise(F.lit("false")).alias("Pronoun"),
        F.col("sent_no").cast("string").alias("SentNum"),
        F.col("text").alias("Text"),
        F.col("head").alias("head"))
    return nps.select("doc_id", "ce_id", "start", "end", F.to_json(props).alias("props_json"))
