"""Secret scans over a trigram inverted index, in DataFrame operations only.

Each rule's regex says which trigrams a text must hold for it to match, as an or of ands.  An
index lists the documents of each such trigram; the postings of a rule are intersected, and only
the documents that are left are read again and verified with the regex itself.  A rule without
mandatory trigrams is run over every text.
"""

import re._constants as kinds
import re._parser as regexes
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.segments import quoted
from marginalia.llm import common

# Ways through a pattern that are followed before it counts as one without mandatory trigrams.
MOST_WAYS = 64
# Matches that are counted on before their list is started anew, so that lists are not copied over and over.
BLOCK = 256


class Rule(NamedTuple):
    """``group`` of a match must have ``least`` characters, else the match is dropped."""
    kind: str
    pattern: str
    group: int
    least: int


# The base rules, in the order of their kinds.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"(AKIA[A-Z0-9]+)", 1, 18),
    # A run of the class is one match whatever its length, so shorter runs can be left out at once.
    Rule("hex", r"([0-9a-f]{16,})", 1, 16),
)


def _ways(parsed) -> list[tuple[str, ...]]:
    """All ways through a parsed regex, each as the runs of fixed characters that it passes."""
    ways: list[tuple[str, ...]] = [("",)]
    for kind, value in parsed:
        if kind is kinds.LITERAL:
            steps = [(chr(value),)]
        elif kind is kinds.SUBPATTERN:
            steps = _ways(value[-1])
        elif kind is kinds.BRANCH:
            steps = [way for branch in value[1] for way in _ways(branch)]
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and value[:2] == (0, 1):
            steps = [("",), *_ways(value[2])]
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and value[0] > 0:
            # What comes at least once stands somewhere, next to nothing known.
            steps = [("", *way, "") for way in _ways(value[2])]
        else:
            steps = [("", "")]
        ways = [(*way[:-1], way[-1] + step[0], *step[1:]) for way, step in product(ways, steps)]
        if len(ways) > MOST_WAYS:
            return [("", "")]
    return ways


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Sets of lower-case trigrams; a text that matches holds all of at least one set.

    Empty if some way through the pattern has no trigram.
    """
    sets = {frozenset(run[i:i + 3].lower() for run in way for i in range(len(run) - 2)) for way in _ways(regexes.parse(pattern))}
    if frozenset() in sets:
        return []
    return sorted((s for s in sets if not any(t < s for t in sets)), key=sorted)


def index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings ``(trigram, doc_id, text_key)`` of the given trigrams, over whole lower-cased texts.

    ``text_key`` tells texts that share an id apart.  One pass makes all postings of a document.
    """
    anywhere = "(?=(" + "|".join(_literal(t) for t in trigrams) + "))"
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(anywhere), F.lit(1)))
    return docs.select("doc_id", "text_key", F.explode(found).alias("trigram"))


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() else f"\\x{ord(c):02x}" if ord(c) < 256 else f"\\x{{{ord(c):x}}}" for c in text)


def candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """``(doc_id, text_key, kinds)``: rules whose Boolean query the postings of a document satisfy.

    A document has one posting for each trigram; they meet as bits, so that a group is a few numbers.
    """
    trigrams = sorted({t for sets in queries.values() for s in sets for t in s})
    words = -(-len(trigrams) // 60)

    def bit(w: int) -> Column:
        value = F.lit(0).cast("bigint")
        for i, trigram in enumerate(trigrams[60 * w:60 * w + 60]):
            value = F.when(F.col("trigram") == trigram, F.lit(1 << i).cast("bigint")).otherwise(value)
        return F.bit_or(value).alias(f"bits{w}")

    def holds(needed: frozenset[str]) -> Column:
        every = F.lit(True)
        for w in range(words):
            mask = sum(1 << (trigrams.index(t) % 60) for t in needed if trigrams.index(t) // 60 == w)
            every &= F.col(f"bits{w}").bitwiseAND(F.lit(mask)) == mask
        return every

    named = []
    for kind, sets in queries.items():
        some = F.lit(False)
        for needed in sets:
            some |= holds(needed)
        named.append(F.when(some, F.lit(kind)))
    return (postings.groupBy("doc_id", "text_key").agg(*[bit(w) for w in range(words)])
            .select("doc_id", "text_key", F.array_compact(F.array(*named)).alias("kinds")).where("size(kinds) > 0"))


def spans(rule: Rule, place: int) -> str:
    """SQL: array of ``{start, place, end}`` of the rule's matches in ``text``, in code points.

    The text between matches gives the offsets; they are summed in blocks of ``BLOCK`` matches.
    """
    pattern = quoted(rule.pattern)
    none = "CAST(array() AS array<struct<start:bigint,place:int,end:bigint>>)"
    grown = (f"IF(hit.hit IS NULL OR length(hit.part) < {rule.least}, acc.spans, array_append(acc.spans, struct("
             f"acc.at + length(hit.gap) AS `start`, {place} AS `place`, acc.at + length(hit.gap) + length(hit.hit) AS `end`)))")
    one = (f"aggregate(block, struct(parts.at AS at, {none} AS spans), (acc, hit) -> struct("
           f"acc.at + length(hit.gap) + coalesce(length(hit.hit), 0) AS at, {grown} AS spans))")
    # The gap behind the last match has no hit.
    hits = (f"transform(arrays_zip(split(text, {pattern}, -1), regexp_extract_all(text, {pattern}, 0),"
            f" regexp_extract_all(text, {pattern}, {rule.group})), z -> struct(z.`0` AS gap, z.`1` AS hit, z.`2` AS part))")
    blocks = (f"transform(array({hits}), all -> transform(sequence(0, cast((size(all) - 1) div {BLOCK} as int)),"
              f" i -> slice(all, i * {BLOCK} + 1, {BLOCK})))[0]")
    return (f"aggregate({blocks}, struct(0L AS at, array({none}) AS found), (parts, block) ->"
            f" transform(array({one}), done -> struct(done.at AS at, array_append(parts.found, done.spans) AS found))[0],"
            f" parts -> flatten(parts.found))")


def secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, found)``: the spans ``{start, place, end}`` of all rules in each row, ``place`` numbering the rules.

    Spans are half-open, count code points and come by start, then rule.  Null texts are empty
    and have none.  Repeated rows have equal results, null ids keep their row, an empty table
    gives none.  Other columns are not read.

    Rules with mandatory trigrams read only the documents that their postings leave; the join
    that fetches those texts takes ids, not links, and Spark sends the ids to the scan where
    they are few.  The other rules run over every text, where it is scanned.
    """
    steps = common.Steps(docs.sparkSession, "secrets")
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: sets for kind, sets in queries.items() if sets}
    none = F.expr("CAST(array() AS array<struct<start:bigint,place:int,end:bigint>>)")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    full = [F.expr(spans(rule, i)) for i, rule in enumerate(rules) if rule.kind not in indexed]
    scanned = rows.select("doc_id", "text_key", F.concat(none, *full).alias("full"))
    if not indexed:
        return scanned.select("doc_id", F.array_sort("full").alias("found"))
    postings = steps.keep(index(rows, sorted({t for sets in indexed.values() for s in sets for t in s})), "index")
    chosen = steps.keep(candidates(postings, indexed), "candidates")
    wanted = chosen.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "kinds")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    parts = [F.when(F.array_contains("kinds", rule.kind), F.expr(spans(rule, i))).otherwise(none)
             for i, rule in enumerate(rules) if rule.kind in indexed]
    # Rows that repeat id and text are verified once each and taken up once.
    verified = (rows.join(wanted, same).select("doc_id", "text_key", F.concat(none, *parts).alias("spans"))
                .where("size(spans) > 0").groupBy("doc_id", "text_key").agg(F.first("spans").alias("spans")))
    verified = steps.keep(verified.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"}), "verified")
    return (scanned.join(verified, same, "left")
            .select("doc_id", F.array_sort(F.concat("full", F.coalesce("spans", none))).alias("found")))


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, n_<kind>..., base_sha256, spans)``: counts, and spans as ``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(rule.kind) for rule in rules])
    text = F.array_join(F.transform("found", lambda s: F.concat_ws(
        ":", F.get(names, s["place"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.expr(f"cast(size(filter(found, s -> s.place = {i})) as bigint)").alias(f"n_{rule.kind}")
              for i, rule in enumerate(rules)]
    return (secrets(docs, rules).select("doc_id", *counts, text.alias("spans"))
            .withColumn("base_sha256", F.sha2("spans", 256)))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return report(common.table(spark, folder, "documents"))


def _sql_spans(place: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Offsets as running sums over what stands between the matches."""
    return f"""
  SELECT r, {place} AS place, '{kind}' AS kind, end_at - length(hit) AS start_at, end_at FROM (
    SELECT r, hit, part, sum(length(gap) + length(hit)) OVER (PARTITION BY r ORDER BY i) AS end_at FROM (
      SELECT r, unnest(range(len(hits))) AS i, unnest(hits) AS hit, unnest(parts) AS part,
             unnest(gaps[1:len(hits)]) AS gap FROM (
        SELECT r, regexp_extract_all(text, '{pattern}') AS hits, regexp_extract_all(text, '{pattern}', {group}) AS parts,
               string_split_regex(text, '{pattern}') AS gaps FROM d) WHERE len(hits) > 0))
  WHERE length(part) >= {least}"""


# Keywords letter by letter: elsewhere "either case" may take in more than A to Z.
_ANY_CASE = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
                     for word in ("password", "passwd", "secret", "token", "api_?key"))
_SQL_ASSIGN = "(" + _ANY_CASE + r""")["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({_sql_spans(0, "assign", _SQL_ASSIGN, 2, 12)}
  UNION ALL {_sql_spans(1, "access", "AKIA[A-Z0-9]+", 0, 18)}
  UNION ALL {_sql_spans(2, "hex", "[0-9a-f]+", 0, 16)}),
j AS (SELECT r, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k,
             count(*) FILTER (kind = 'hex') AS h,
             string_agg(kind || ':' || start_at || ':' || end_at, ',' ORDER BY start_at, place) AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
       coalesce(spans, '') AS spans, sha256(coalesce(spans, '')) AS base_sha256
FROM d LEFT JOIN j USING (r)
"""
