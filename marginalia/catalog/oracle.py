"""The same results in plain SQL, for a second engine to check.

``PARTS`` are named subqueries that build on each other; ``_sql`` puts those a
query needs in front of it.  Rule tables come from the operators, so they cannot
drift apart; the ways to the result are written anew.
"""

import re

from marginalia.catalog.inputs import CHECK_GAZETTEER, CHECK_PATTERNS, CHECK_PHRASES
from marginalia.operators.coref import DISTANCE_STEPS, LINK_THRESHOLD, WEIGHTS
from marginalia.operators.entities import ENTITY_TYPES
from marginalia.operators.tagging import LABELS, LEXICON, NOUN_TAGS, NP_TAGS, SUFFIXES
from marginalia.operators.trees import RELATION_GROUPS

BLANKS = r"[ \t\n\x0B\f\r]"
SENTENCE = rf"[^.!?]*[.!?]+{BLANKS}*|[^.!?]+"
TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_ \t\n\x0B\f\r]|{BLANKS}+"


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


def _cut(source: str, keys: str, text: str, pattern: str, base: str = "0") -> str:
    """Segments of ``text`` with their number and offsets."""
    return f"""
    SELECT {keys}, pos, seg, CAST({base} + e - length(seg) AS BIGINT) AS start,
           CAST({base} + e AS BIGINT) AS "end"
    FROM (SELECT *, sum(length(seg)) OVER (PARTITION BY {keys} ORDER BY pos) AS e
          FROM (SELECT *, unnest(l) AS seg, generate_subscripts(l, 1) AS pos
                FROM (SELECT *, regexp_extract_all({text}, '{pattern}') AS l FROM {source})))"""


def _sentences(pars: str, cut: str, rule: str = "true") -> str:
    return f"""
    SELECT c.doc_id, c.par_no,
           row_number() OVER (PARTITION BY c.doc_id ORDER BY c.par_no, c.pos) - 1 AS sent_no,
           c.start, c."end", c.seg AS text
    FROM {cut} c WHERE {rule}"""


def _cut_sentences(pars: str) -> str:
    return _cut(pars, "doc_id, par_no, start0", "text", SENTENCE, "start0").replace(
        "start0, pos", "pos", 1)


def _tokens(cut: str) -> str:
    return f"""
    SELECT doc_id, sent_no,
           row_number() OVER (PARTITION BY doc_id, sent_no ORDER BY pos) AS tok_no,
           start, "end", seg AS text
    FROM {cut} WHERE NOT regexp_matches(seg, '^{BLANKS}')"""


def _cut_tokens(sents: str) -> str:
    return _cut(f"(SELECT *, start AS start0 FROM {sents})", "doc_id, sent_no, start0", "text",
                TOKEN, "start0").replace("start0, pos", "pos", 1)


def _tags(tokens: str) -> str:
    words = "\n".join(f"WHEN lower(text) IN {_in(listed)} THEN '{tag}'"
                      for tag, listed in LEXICON.items())
    ends = "\n".join(f"WHEN length(text) > 4 AND ends_with(lower(text), '{end}') THEN '{tag}'"
                     for end, tag in SUFFIXES)
    return f"""
    SELECT *, CASE
        WHEN text IN ('.', '!', '?') THEN '.'
        WHEN text IN (',', ':', ';') THEN text
        WHEN NOT regexp_matches(text, '[\\p{{L}}\\p{{N}}_]') THEN 'SYM'
        WHEN regexp_full_match(text, '[0-9]+') THEN 'CD'
        {words}
        {ends}
        WHEN tok_no > 1 AND regexp_matches(text, '^\\p{{Lu}}') THEN 'NNP'
        ELSE 'NN' END AS tag
    FROM {tokens}"""


def _layers(pars: str, sents: str, pos: str) -> dict[str, str]:
    no = "'{}'"
    return {
        "PAR": f"""SELECT doc_id, 'PAR' AS "set", par_no AS ann_id, start, "end",
                   'paragraph' AS type, {no} AS attrs FROM {pars}""",
        "SENT": f"""SELECT doc_id, 'SENT' AS "set", sent_no AS ann_id, start, "end",
                    'sentence_split' AS type, '{{"sent_no":"' || sent_no || '"}}' AS attrs
                    FROM {sents}""",
        "TOKEN": f"""SELECT doc_id, 'TOKEN' AS "set", sent_no * 4294967296 + tok_no AS ann_id, start,
                     "end", 'token' AS type, {no} AS attrs FROM {pos}""",
        "POS": f"""SELECT doc_id, 'POS' AS "set", sent_no * 4294967296 + tok_no AS ann_id, start,
                   "end", tag AS type, {no} AS attrs FROM {pos}""",
    }


_ALL = _layers("pars", "sents", "pos")
_KINDS = sorted(ENTITY_TYPES)

_PATTERN_PARTS = {
    f"ent_{name}": _cut(f"(SELECT doc_id, text FROM docs WHERE regexp_matches(text, '{p}'))",
                        "doc_id", "text", p + r"|[^0-9$€£]+|[\s\S]")
    for name, p in CHECK_PATTERNS.items()}

_WORDS = "list_distinct(string_split_regex(trim(lower({0}.text)), ' +'))"

PARTS: dict[str, str] = {
    "docs": "SELECT * FROM documents",
    "par_cut": _cut("docs", "doc_id", "text", r"[^\n]+|\n+"),
    "pars": r"""
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS par_no,
           start, "end", seg AS text FROM par_cut WHERE NOT starts_with(seg, chr(10))""",
    "sent_cut": _cut_sentences("(SELECT *, start AS start0 FROM pars)"),
    "sents": _sentences("pars", "sent_cut"),
    "short_sents": _sentences("pars", "sent_cut", "c.pos = 1 OR length(c.seg) > 1 OR regexp_matches(c.seg, '[.!?]')"),
    "tok_cut": _cut_tokens("sents"),
    "toks": _tokens("tok_cut"),
    "pos": _tags("toks"),
    # Runs of phrase tags and single pronouns.
    "np_class": f"""
    SELECT *, CASE WHEN tag IN {_in(NOUN_TAGS)} THEN 'N' WHEN tag IN {_in(NP_TAGS)} THEN 'd'
                   WHEN tag = 'PRP' THEN 'P' ELSE 'o' END AS c FROM pos""",
    "np_new": """
    SELECT *, CASE WHEN c IN ('N', 'd') AND lag(c) OVER w IN ('N', 'd') THEN 0 ELSE 1 END AS new
    FROM np_class WINDOW w AS (PARTITION BY doc_id, sent_no ORDER BY tok_no)""",
    "np_run": """
    SELECT *, sum(new) OVER (PARTITION BY doc_id, sent_no ORDER BY tok_no) AS run FROM np_new""",
    "np_span": """
    SELECT doc_id, sent_no, min(start) AS start, max("end") AS "end",
           arg_max(text, tok_no) FILTER (WHERE c IN ('N', 'P')) AS head,
           max(tok_no) FILTER (WHERE c IN ('N', 'P')) AS head_no
    FROM np_run GROUP BY doc_id, sent_no, run HAVING bool_or(c IN ('N', 'P'))""",
    "np_text": """
    SELECT n.doc_id, n.sent_no, n.start, n."end",
           substring(s.text, n.start - s.start + 1, n."end" - n.start) AS text, n.head, n.head_no
    FROM np_span n JOIN sents s USING (doc_id, sent_no)""",
    "nps": """
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY start, "end") AS ce_id,
           sent_no, start, "end", text, head, head_no FROM np_text""",
    **_PATTERN_PARTS,
    "gazetteer": f"SELECT * FROM (VALUES {_values(CHECK_GAZETTEER)}) AS t(word, type)",
    "ents": " UNION ALL ".join(
        f"""SELECT doc_id, '{name}' AS type, start, "end", seg AS text FROM ent_{name}
        WHERE regexp_full_match(seg, '{p}')""" for name, p in CHECK_PATTERNS.items()) + """
    UNION ALL SELECT t.doc_id, g.type, t.start, t."end", t.text
    FROM toks t JOIN gazetteer g ON lower(t.text) = g.word""",
    "ent_free": """
    SELECT DISTINCT doc_id, start, "end", text FROM ents e WHERE NOT EXISTS (
        SELECT 1 FROM np_text n WHERE n.doc_id = e.doc_id AND e.start < n."end" AND e."end" > n.start)""",
    "ent_first": """
    SELECT * FROM (SELECT *, max("end") OVER (PARTITION BY doc_id ORDER BY start, "end" DESC
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ent_free)
    WHERE reach IS NULL OR reach <= start""",
    "np_ents": """
    SELECT e.doc_id, min(s.sent_no) AS sent_no, e.start, e."end", e.text, e.text AS head,
           CAST(NULL AS BIGINT) AS head_no
    FROM ent_first e JOIN sents s ON s.doc_id = e.doc_id AND e.start < s."end" AND e."end" > s.start
    GROUP BY e.doc_id, e.start, e."end", e.text""",
    "nps_ne": """
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY start, "end") AS ce_id,
           sent_no, start, "end", text, head, head_no
    FROM (SELECT * FROM np_text UNION ALL BY NAME SELECT * FROM np_ents)""",
    # Layers as annotations.
    "ann": " UNION ALL ".join(_ALL.values()),
    "ann_ne": f"""SELECT doc_id, 'NE' AS "set", start * {len(_KINDS) + 1} + coalesce(list_position(
        [{', '.join(f"'{k}'" for k in _KINDS)}], type), 0) AS ann_id, start, "end", type,
        '{{}}' AS attrs FROM ents""",
    "ann_np": """SELECT doc_id, 'NP' AS "set", ce_id AS ann_id, start, "end", 'np' AS type,
        '{"CE_ID":"' || ce_id || '"}' AS attrs FROM nps_ne""",
    # A store with gaps.
    "st_pars": """SELECT d.doc_id, CAST(0 AS BIGINT) AS par_no, CAST(0 AS BIGINT) AS start,
        length(d.text) AS "end" FROM docs d SEMI JOIN labels l USING (doc_id)""",
    "st_sents": "SELECT s.* FROM sents s SEMI JOIN (SELECT * FROM labels WHERE quality = 1) l USING (doc_id)",
    "st_toks": "SELECT s.* FROM pos s SEMI JOIN (SELECT * FROM labels WHERE toxic = 0) l USING (doc_id)",
    "st_pos": """SELECT s.* FROM pos s SEMI JOIN
        (SELECT * FROM labels WHERE toxic = 0 AND quality = 1) l USING (doc_id)""",
    "stored": " UNION ALL ".join([
        _layers("st_pars", "", "")["PAR"], _layers("", "st_sents", "")["SENT"],
        _layers("", "", "st_toks")["TOKEN"], _layers("", "", "st_pos")["POS"]]),
    "held": 'SELECT DISTINCT doc_id, "set" FROM stored',
    # What the gaps are filled with: sentences follow from the stored paragraph.
    "fill_pars": """SELECT p.* FROM pars p ANTI JOIN (SELECT * FROM held WHERE "set" = 'PAR') h USING (doc_id)""",
    "fill_src": """
    SELECT doc_id, par_no, start, "end", text FROM fill_pars
    UNION ALL SELECT p.doc_id, p.par_no, p.start, p."end", substring(d.text, p.start + 1, p."end" - p.start)
    FROM st_pars p JOIN docs d USING (doc_id)""",
    "fill_open": """SELECT p.* FROM fill_src p ANTI JOIN (SELECT * FROM held WHERE "set" = 'SENT') h USING (doc_id)""",
    "fill_cut": _cut_sentences("(SELECT *, start AS start0 FROM fill_open)"),
    "fill_sents": _sentences("fill_open", "fill_cut"),
    "fill_all": """
    SELECT doc_id, sent_no, start, "end", text FROM fill_sents
    UNION ALL SELECT doc_id, sent_no, start, "end", text FROM st_sents""",
    "fill_want": """
    SELECT s.* FROM fill_all s ANTI JOIN (SELECT doc_id FROM held WHERE "set" IN ('TOKEN', 'POS')
        GROUP BY doc_id HAVING count(*) = 2) h USING (doc_id)""",
    "fill_tcut": _cut_tokens("fill_want"),
    "fill_toks": _tokens("fill_tcut"),
    "fill_pos": _tags("fill_toks"),
    "fill": " UNION ALL ".join(_layers("fill_pars", "fill_sents", "fill_pos").values()),
    # Damaged tokens.
    "damaged": """
    SELECT t.doc_id, 'TOKEN' AS "set", t.sent_no * 4294967296 + t.tok_no AS ann_id,
           CASE WHEN length(t.text) = 12 THEN t.start + length(d.text)
                WHEN length(t.text) >= 14 THEN 0 ELSE t.start END AS start,
           CASE WHEN length(t.text) IN (11, 12) THEN t."end" + length(d.text)
                WHEN length(t.text) = 13 THEN t.start
                WHEN length(t.text) >= 14 THEN length(d.text) ELSE t."end" END AS "end",
           'token' AS type, '{}' AS attrs, length(d.text) AS n
    FROM toks t JOIN docs d USING (doc_id)""",
    # Two neighbouring tokens.
    "bigrams": """
    SELECT * FROM (SELECT doc_id, start, lead("end") OVER (PARTITION BY doc_id, sent_no ORDER BY tok_no) AS "end"
                   FROM toks) WHERE "end" IS NOT NULL""",
    # Listed phrases: leftmost, then longest, one after the other.
    "phrase_list": f"""SELECT DISTINCT array_to_string([w FOR w IN regexp_extract_all(lower(word), '[a-z]+|,')], ' ') AS key, type
        FROM (VALUES {_values(CHECK_PHRASES)}) AS t(word, type)""",
    "phrase_grams": """
    SELECT a.doc_id, a.sent_no, a.tok_no, n, string_agg(lower(b.text), ' ' ORDER BY b.tok_no) AS key,
           min(b.start) AS start, max(b."end") AS "end", count(*) AS held
    FROM (SELECT *, unnest([1, 2, 3, 4]) AS n FROM toks WHERE lower(text) IN ('apache', 'license', 'version', 'idiot')) a
    JOIN toks b ON b.doc_id = a.doc_id AND b.sent_no = a.sent_no AND b.tok_no BETWEEN a.tok_no AND a.tok_no + a.n - 1
    GROUP BY a.doc_id, a.sent_no, a.tok_no, n""",
    "phrase_hits": "SELECT g.*, p.type FROM phrase_grams g JOIN phrase_list p USING (key) WHERE g.held = g.n",
    "phrase_best": "SELECT doc_id, sent_no, tok_no, max(n) AS n FROM phrase_hits GROUP BY doc_id, sent_no, tok_no",
    "phrase_walk": """
    SELECT doc_id, sent_no, min(tok_no) AS tok_no, arg_min(n, tok_no) AS n FROM phrase_best GROUP BY doc_id, sent_no
    UNION ALL SELECT b.doc_id, b.sent_no, min(b.tok_no), arg_min(b.n, b.tok_no) FROM phrase_walk w JOIN phrase_best b
    ON b.doc_id = w.doc_id AND b.sent_no = w.sent_no AND b.tok_no >= w.tok_no + w.n GROUP BY b.doc_id, b.sent_no, w.tok_no""",
    # Stretches of a hundred characters that a span reaches into, to join by equality.
    "np_stretch": """SELECT doc_id, ce_id, start, "end", unnest(range(start // 100, "end" // 100 + 1)) AS stretch FROM nps""",
    "bigram_stretch": """SELECT doc_id, start, "end", unnest(range(start // 100, "end" // 100 + 1)) AS stretch FROM bigrams""",
    # Labels.
    "labelled": "SELECT *, CASE " + " ".join(
        f"WHEN tag = '{t}' THEN '{l}'" for t, l in LABELS.items()) + " ELSE 'O' END AS label FROM pos",
    "lab_new": """
    SELECT *, CASE WHEN label = lag(label) OVER w THEN 0 ELSE 1 END AS new FROM labelled
    WINDOW w AS (PARTITION BY doc_id, sent_no ORDER BY tok_no)""",
    "lab_run": """
    SELECT *, sum(new) OVER (PARTITION BY doc_id, sent_no ORDER BY tok_no) AS run,
           max(tok_no) OVER (PARTITION BY doc_id, sent_no) AS last_no FROM lab_new""",
    "lab_ne": """
    SELECT doc_id, sent_no, min(label) AS type, min(start) AS start, max("end") AS "end",
           max(tok_no) = max(last_no) AS ends, min(tok_no) AS first_no
    FROM lab_run WHERE label <> 'O' GROUP BY doc_id, sent_no, run""",
    # Trees.
    "tree_class": f"""
    SELECT *, sent_no * 4294967296 AS s, CASE WHEN tag IN {_in(NP_TAGS)} THEN 'NP'
        WHEN starts_with(tag, 'VB') THEN 'VP' ELSE 'X' END AS c FROM pos""",
    "tree_new": """
    SELECT *, CASE WHEN c = lag(c) OVER w THEN 0 ELSE 1 END AS new FROM tree_class
    WINDOW w AS (PARTITION BY doc_id, sent_no ORDER BY tok_no)""",
    "tree_run": """
    SELECT *, max(CASE WHEN new = 1 THEN tok_no END) OVER (
        PARTITION BY doc_id, sent_no ORDER BY tok_no) AS first_no FROM tree_new""",
    "edges": """
    SELECT DISTINCT doc_id, s AS node_id, CAST(NULL AS BIGINT) AS parent_id, 'S' AS label FROM tree_run
    UNION ALL SELECT doc_id, s + 2147483648 + tok_no, s, c FROM tree_run WHERE new = 1
    UNION ALL SELECT doc_id, s + tok_no, s + 2147483648 + first_no, tag FROM tree_run""",
    "leaves": """
    SELECT doc_id, s + 1073741824 + tok_no AS node_id, s + tok_no AS parent_id, text AS label, start, "end"
    FROM tree_run""",
    "climb": """
    SELECT doc_id, parent_id AS node_id, start, "end" FROM leaves
    UNION ALL SELECT c.doc_id, e.parent_id, c.start, c."end" FROM climb c
    JOIN edges e USING (doc_id, node_id) WHERE e.parent_id IS NOT NULL""",
    "inner_nodes": """
    SELECT e.doc_id, e.node_id, e.parent_id, e.label, c.start, c."end" FROM edges e JOIN (
        SELECT doc_id, node_id, min(start) AS start, max("end") AS "end" FROM climb GROUP BY ALL) c
    USING (doc_id, node_id)""",
    # Dependencies.
    "dep_mark": """
    SELECT *, coalesce(min(CASE WHEN starts_with(tag, 'VB') THEN tok_no END) OVER (
               PARTITION BY doc_id, sent_no), 1) AS verb,
           lag(text) OVER w = ',' OR lag(tag) OVER w = 'CC' AS separated
    FROM pos WINDOW w AS (PARTITION BY doc_id, sent_no ORDER BY tok_no)""",
    "dep_rel": f"""
    SELECT *, CASE WHEN separated AND tok_no > 2 THEN 'conj'
        WHEN tok_no = verb THEN NULL WHEN tag = 'DT' THEN 'det' WHEN tag = 'JJ' THEN 'amod'
        WHEN tag = 'IN' THEN 'prep' WHEN tag IN {_in(NOUN_TAGS)} AND tok_no < verb THEN 'nsubj'
        WHEN tag IN {_in(NOUN_TAGS)} THEN 'dobj' END AS rel FROM dep_mark""",
    "dep_gov": """
    SELECT *, CASE WHEN rel = 'conj' THEN tok_no - 2 WHEN rel IS NOT NULL THEN verb END AS gov_id
    FROM dep_rel""",
    "deps": """
    SELECT d.doc_id, d.sent_no, d.tok_no, d.start, d."end", coalesce(d.rel, 'ROOT') AS type,
           g.start || ',' || g."end" AS gov, d.gov_id
    FROM dep_gov d LEFT JOIN pos g
    ON g.doc_id = d.doc_id AND g.sent_no = d.sent_no AND g.tok_no = d.gov_id""",
    "chain": """
    SELECT doc_id, sent_no, tok_no, type, gov, gov_id, 0 AS depth, tok_no AS origin FROM deps
    WHERE type = 'conj'
    UNION ALL SELECT d.doc_id, d.sent_no, d.tok_no, d.type, d.gov, d.gov_id, c.depth + 1, c.origin
    FROM chain c JOIN deps d ON d.doc_id = c.doc_id AND d.sent_no = c.sent_no AND d.tok_no = c.gov_id
    WHERE c.type = 'conj'""",
    # Coreference.
    "mention": f"""
    SELECT n.doc_id, n.ce_id, n.sent_no, n.text, lower(n.text) AS low, lower(n.head) AS head,
           {_WORDS.format('n')} AS words, lower(n.text) IN {_in(LEXICON['PRP'])} AS pronoun,
           ends_with(lower(n.head), 's') AS plural
    FROM nps n""",
    "pairs": """
    SELECT doc_id, i, j FROM (SELECT doc_id, lag(ce_id) OVER (PARTITION BY doc_id, low ORDER BY ce_id) AS i,
                                     ce_id AS j FROM mention) WHERE i IS NOT NULL
    UNION SELECT doc_id, i, j FROM (SELECT doc_id, lag(ce_id) OVER (PARTITION BY doc_id, head ORDER BY ce_id) AS i,
                                           ce_id AS j FROM mention WHERE head IS NOT NULL) WHERE i IS NOT NULL
    UNION SELECT doc_id, i, j FROM (SELECT doc_id, lag(ce_id) OVER (PARTITION BY doc_id ORDER BY ce_id) AS i,
                                           ce_id AS j FROM mention) WHERE i IS NOT NULL""",
    "feats": """
    SELECT p.doc_id, p.i, p.j, CAST(a.low = b.low AS BIGINT) AS exact,
           CAST(a.head = b.head AS BIGINT) AS head_match,
           floor(CAST(len(list_intersect(a.words, b.words)) AS DOUBLE)
                 / len(list_distinct(list_concat(a.words, b.words))) * 1000000.0::DOUBLE + 0.5::DOUBLE)
               / 1000000.0::DOUBLE AS jaccard,
           b.sent_no - a.sent_no AS sent_dist,
           CAST(a.pronoun AND b.pronoun AS BIGINT) AS both_pronoun,
           CAST(a.pronoun OR b.pronoun AS BIGINT) AS either_pronoun,
           CAST(a.plural = b.plural AS BIGINT) AS number_agree,
           CAST(contains(a.low, b.low) OR contains(b.low, a.low) AS BIGINT) AS substring
    FROM pairs p JOIN mention a ON a.doc_id = p.doc_id AND a.ce_id = p.i
    JOIN mention b ON b.doc_id = p.doc_id AND b.ce_id = p.j""",
    "scored": "SELECT doc_id, i, j, floor((" + " + ".join(
        f"CAST({w} AS DOUBLE)" + ("" if f == "bias" else f" * CAST({f} AS DOUBLE)")
        for f, w in WEIGHTS.items()) + ") * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS weight FROM feats",
    "links": """
    SELECT DISTINCT s.doc_id, a.text AS left_entity, b.text AS right_entity, 
           floor(s.weight * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE AS weight
    FROM scored s JOIN nps a ON a.doc_id = s.doc_id AND a.ce_id = s.i
    JOIN nps b ON b.doc_id = s.doc_id AND b.ce_id = s.j""",
    "strong": f"SELECT doc_id, i, j FROM scored WHERE weight >= {LINK_THRESHOLD}",
    "arcs": """
    SELECT DISTINCT s.doc_id, (b.sent_no + 1) * 4294967296 + b.head_no AS src,
           (a.sent_no + 1) * 4294967296 + a.head_no AS dst
    FROM strong s JOIN nps a ON a.doc_id = s.doc_id AND a.ce_id = s.i
    JOIN nps b ON b.doc_id = s.doc_id AND b.ce_id = s.j""",
    "edge2": "SELECT doc_id, i AS u, j AS v FROM strong UNION ALL SELECT doc_id, j, i FROM strong",
    # A name travels only to mentions above it; the smallest one reaches all.
    "spread": """
    SELECT DISTINCT doc_id, u AS node, u AS name FROM edge2
    UNION SELECT e.doc_id, e.v, s.name FROM spread s JOIN edge2 e
    ON e.doc_id = s.doc_id AND e.u = s.node WHERE s.name < e.v""",
}
# The whole job links entities as well: the same steps from the wider phrases.
_STEPS = ("nps", "mention", "pairs", "feats", "scored", "links")
for _step in _STEPS[1:]:
    PARTS[f"{_step}_ne"] = re.sub(rf"\b(FROM|JOIN) ({'|'.join(_STEPS)})\b", r"\1 \2_ne", PARTS[_step])
# Over a store with gaps: the same steps again, from stored layers where there are such and from filled ones elsewhere.
PARTS["full_pos"] = """
    SELECT doc_id, sent_no, tok_no, start, "end", text, tag FROM fill_pos
    UNION ALL SELECT doc_id, sent_no, tok_no, start, "end", text, tag FROM st_pos"""
_BELOW = {"pos": "full_pos", "toks": "full_pos", "sents": "fill_all"}
_AGAIN = ("np_class", "np_new", "np_run", "np_span", "np_text", "ents", "ent_free", "ent_first", "np_ents", "nps_ne", "ann_ne",
          "ann_np", *(f"{_step}_ne" for _step in _STEPS[1:]))
for _step in _AGAIN:
    PARTS[f"{_step}_full"] = re.sub(rf"\b(FROM|JOIN) ({'|'.join([*_BELOW, *_AGAIN])})\b",
                                    lambda m: f"{m[1]} {_BELOW.get(m[2], m[2] + '_full')}", PARTS[_step])
_RECURSIVE = {"climb", "chain", "spread", "parts", "phrase_walk"}

# Cuts of long sentences: the best-ranked break left of the middle, again and again.
PARTS["long_toks"] = """
    SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, sent_no) AS n FROM toks) WHERE n > 100"""
PARTS["brk"] = """
    SELECT doc_id, sent_no, tok_no - 1 AS idx,
           CASE text WHEN ';' THEN 0 WHEN ':' THEN 1 WHEN ',' THEN 2 ELSE 3 END AS rank
    FROM long_toks WHERE text IN (';', ':', ',', '.')"""
PARTS["parts"] = """
    SELECT DISTINCT doc_id, sent_no, CAST(0 AS BIGINT) AS low, n AS high, false AS split FROM long_toks
    UNION ALL SELECT doc_id, sent_no, unnest([low, best + 1]) AS low, unnest([best + 1, high]) AS high,
                     unnest([true, true]) AS split
    FROM (SELECT p.doc_id, p.sent_no, p.low, p.high, arg_min(b.idx, b.rank * 1000000 - b.idx) AS best
          FROM parts p JOIN brk b ON b.doc_id = p.doc_id AND b.sent_no = p.sent_no
          AND b.idx BETWEEN p.low AND p.low + (p.high - p.low) // 2
          WHERE p.high - p.low > 100 GROUP BY p.doc_id, p.sent_no, p.low, p.high)"""
# A range that was cut is no part: its start is also the start of a shorter one.
PARTS["part_ends"] = """
    SELECT doc_id, sent_no, low, min(high) AS high FROM parts GROUP BY doc_id, sent_no, low"""


def _needs(sql: str, found: list[str], trail: tuple[str, ...] = ()) -> list[str]:
    for name in PARTS:
        if name not in found and name not in trail and re.search(rf"\b(FROM|JOIN) \(?{name}\b|\b(FROM|JOIN) {name}\b", sql):
            _needs(PARTS[name], found, (*trail, name))
            found.append(name)
    return found


def _sql(body: str) -> str:
    names = _needs(body, [])
    if not names:
        return body.strip()
    word = "WITH RECURSIVE" if _RECURSIVE & set(names) else "WITH"
    parts = ",\n".join(
        f"{n} AS {'' if n in _RECURSIVE else 'MATERIALIZED '}({PARTS[n].strip()})" for n in names)
    return f"{word} {parts}\n{body.strip()}"


_ANN = 'doc_id, "set", ann_id, start, "end", type, attrs'
_SUMS = """count(*) AS n, CAST(sum(start) AS BIGINT) AS sum_start, CAST(sum("end") AS BIGINT) AS sum_end"""
_CELL = """'[' || string_agg('{"ann_id":' || ann_id || ',"start":' || start || ',"end":' || "end"
    || ',"type":"' || type || '","attrs":' || attrs || '}', ',' ORDER BY start, "end", ann_id) || ']'"""
_ROW = f"""SELECT doc_id, "set", {_CELL} AS data FROM ann GROUP BY doc_id, "set" """
_FAULTS = {"bad start": "start > n", "bad end": '"end" > n', "invalid": 'start >= "end"'}
_BAD = " OR ".join(_FAULTS.values())
_FLAGS = {"good": 'start < n AND "end" < n', **_FAULTS}
_TERMS = """[lower(x) for x in regexp_extract_all(text, '[0-9A-Za-z_]+')
    if length(x) > 2 AND regexp_matches(lower(x), '[a-z]')]"""
_FILLED = f"""SELECT {_ANN} FROM stored WHERE "set" IN ('PAR', 'SENT')
    UNION ALL SELECT s.* FROM stored s SEMI JOIN (SELECT doc_id FROM held WHERE "set" IN ('TOKEN', 'POS')
        GROUP BY doc_id HAVING count(*) = 2) h USING (doc_id) WHERE s."set" IN ('TOKEN', 'POS')
    UNION ALL SELECT {_ANN} FROM fill"""
_BINARY = ", ".join(
    [f"CAST(sent_dist = {d} AS BIGINT) AS sent_dist_{d}" for d in DISTANCE_STEPS]
    + [f"CAST(sent_dist > {DISTANCE_STEPS[-1]} AS BIGINT) AS sent_dist_more"]
    + ["CAST(jaccard = 0 AS BIGINT) AS jaccard_none",
       "CAST(jaccard > 0 AND jaccard < 0.5 AS BIGINT) AS jaccard_low",
       "CAST(jaccard >= 0.5 AND jaccard < 1 AS BIGINT) AS jaccard_high",
       "CAST(jaccard = 1 AS BIGINT) AS jaccard_full"])
_GROUPED = "CASE " + " ".join(f"WHEN type IN {_in(kinds)} THEN '{name}'"
                              for name, kinds in RELATION_GROUPS.items()) + " ELSE type END"
_GOV = "coalesce(gov, '') AS gov, coalesce(gov_id, -1) AS gov_id"
_ROWSIZE = f"""SELECT doc_id, sum(bytes) AS bytes FROM (
    SELECT doc_id, strlen(text) AS bytes FROM docs
    UNION ALL SELECT doc_id, strlen(data) AS bytes FROM ({_ROW})) GROUP BY doc_id"""

SQL: dict[str, str] = {name: _sql(body) for name, body in {
    "scan_documents": "SELECT doc_id, text, source FROM documents",
    "scan_from_key": "SELECT doc_id, source, n_chars FROM documents WHERE doc_id >= 100",
    "scan_source": "SELECT doc_id, source, n_chars FROM documents WHERE source = 'src3'",
    "scan_key_list": """SELECT doc_id, source, n_chars FROM documents
        WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "scan_sets": f"""SELECT {_ANN} FROM ann WHERE "set" IN ('PAR', 'SENT')""",
    "write_annotations": f"""SELECT "set", {_SUMS} FROM ann GROUP BY "set" """,
    "upsert_annotations": f"""SELECT {_ANN} FROM ann WHERE "set" = 'SENT'
        UNION ALL SELECT {_ANN} FROM ann WHERE "set" = 'PAR' AND doc_id NOT IN (SELECT doc_id FROM labels)
        UNION ALL SELECT {_ANN} FROM stored WHERE "set" = 'PAR'""",
    "encode_set": f"""SELECT doc_id, "set", CAST(start // 1048576 AS BIGINT) AS part, {_CELL} AS data
        FROM ann GROUP BY ALL""",
    "decode_set": f"SELECT {_ANN} FROM ann",
    "encode_matches": """SELECT doc_id, 'openNLP_' || lower(trim(type)) AS key,
        CAST(start // 1048576 AS BIGINT) AS part, '[' || string_agg('{"value":' || to_json(text)
        || ',"start":' || start || ',"end":' || "end" || '}', ',' ORDER BY start, "end") || ']' AS matches
        FROM ents GROUP BY ALL""",
    "encode_links": """SELECT doc_id, part, '[' || string_agg('{"leftEntity":' || to_json(left_entity)
        || ',"rightEntity":' || to_json(right_entity) || ',"weight":' || to_json(weight) || '}', ','
        ORDER BY left_entity, right_entity, weight) || ']' AS data FROM (SELECT *, (row_number() OVER (
        PARTITION BY doc_id ORDER BY left_entity, right_entity, weight) - 1) // 1024 AS part FROM links) GROUP BY doc_id, part""",
    "guard_no_text": r"""SELECT doc_id FROM documents
        WHERE length(text) > 0 AND regexp_matches(text, '[^\x00-\x20]')""",
    "guard_text_too_long": "SELECT doc_id FROM documents WHERE length(text) <= 5000",
    "guard_row_too_large": f"SELECT doc_id FROM ({_ROWSIZE}) WHERE bytes <= 100000",
    "require_sets": """SELECT doc_id FROM held WHERE "set" IN ('SENT', 'TOKEN')
        GROUP BY doc_id HAVING count(*) = 2""",
    "skip_done": """SELECT doc_id FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM held WHERE "set" = 'POS')""",
    "skip_long_sentences": """SELECT doc_id FROM docs WHERE doc_id NOT IN (
        SELECT doc_id FROM toks GROUP BY doc_id, sent_no HAVING count(*) > 100)""",
    "skip_many_nps": """SELECT doc_id FROM docs WHERE doc_id NOT IN (
        SELECT doc_id FROM nps GROUP BY doc_id HAVING count(*) >= 1000)""",
    "cap_sentences": 'SELECT doc_id, sent_no, start, "end" FROM sents WHERE sent_no < 200',
    "cap_pairs": """SELECT doc_id, i, j FROM pairs
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY j, i DESC) <= 1000""",
    "guard_report": """SELECT CASE WHEN text IS NULL OR text = '' THEN 'no text'
            WHEN length(text) > 5000 THEN 'text too long'
            WHEN NOT list_contains(sets, 'PAR') THEN 'no PAR' WHEN NOT list_contains(sets, 'SENT') THEN 'no SENT'
            WHEN NOT list_contains(sets, 'TOKEN') THEN 'no TOKEN'
            WHEN list_contains(sets, 'POS') THEN 'has POS' ELSE 'ok' END AS reason, count(*) AS docs
        FROM (SELECT d.text, coalesce(list(h."set") FILTER (WHERE h."set" IS NOT NULL), []) AS sets
              FROM docs d LEFT JOIN held h USING (doc_id) GROUP BY d.doc_id, d.text) GROUP BY reason""",
    "drop_empty_spans": """SELECT doc_id, "set", ann_id, start, least("end", n) AS "end", type, attrs
        FROM damaged WHERE start < least("end", n)""",
    "paragraphs": 'SELECT doc_id, par_no, start, "end" FROM pars',
    "sentences": 'SELECT doc_id, par_no, sent_no, start, "end" FROM sents',
    "sentences_without_tails": 'SELECT doc_id, par_no, sent_no, start, "end" FROM short_sents',
    "sentences_of_stored_paragraphs": 'SELECT doc_id, par_no, sent_no, start, "end" FROM sents',
    "sentence_numbers": 'SELECT doc_id, start, "end", sent_no FROM sents',
    "fill_sentence_numbers": """SELECT doc_id, start, "end", CASE WHEN par_no = 0 THEN sent_no + 1
            ELSE par_no * 10 + row_number() OVER (PARTITION BY doc_id, par_no ORDER BY start) - 1 END AS filled
        FROM sents""",
    "tokens": 'SELECT doc_id, sent_no, tok_no, start, "end", text FROM toks',
    "tokens_of_stored_sentences": 'SELECT doc_id, sent_no, tok_no, start, "end", text FROM toks',
    "pos_tags": 'SELECT doc_id, sent_no, tok_no, start, "end", text, tag FROM pos',
    "pos_tags_by_lexicon": 'SELECT doc_id, sent_no, tok_no, start, "end", text, tag FROM pos',
    "base_layers": _FILLED,
    "named_entities": 'SELECT doc_id, type, start, "end", text FROM ents',
    "gazetteer_phrases": """SELECT h.doc_id, h.type, h.start, h."end", substring(d.text, h.start + 1, h."end" - h.start) AS text
        FROM phrase_hits h JOIN phrase_walk w USING (doc_id, sent_no, tok_no, n) JOIN docs d USING (doc_id)""",
    "ne_from_labels": 'SELECT doc_id, type, start, "end" FROM lab_ne',
    "ne_from_labels_unflushed": 'SELECT doc_id, type, start, "end" FROM lab_ne WHERE NOT ends',
    "rebase_spans": 'SELECT doc_id, sent_no, tok_no, start, "end" FROM toks',
    "multi_layer_annotate": " UNION ALL ".join(
        f"SELECT {_ANN} FROM ({_ALL[s]})" for s in ("SENT", "TOKEN", "POS")) + """
        UNION ALL SELECT doc_id, 'NE', sent_no * 4294967296 + row_number() OVER (
            PARTITION BY doc_id, sent_no ORDER BY first_no), start, "end", type, '{}' FROM lab_ne""",
    "base_noun_phrases": 'SELECT doc_id, ce_id, sent_no, start, "end", text, head, head_no FROM nps',
    "base_noun_phrases_with_entities": """SELECT doc_id, ce_id, sent_no, start, "end", text, head,
        coalesce(head_no, 0) AS head_no FROM nps_ne""",
    "noun_phrases_of_tokens": 'SELECT doc_id, sent_no, start, "end", head, head_no FROM np_span',
    **{name: """
        SELECT p.doc_id, p.sent_no, row_number() OVER (PARTITION BY p.doc_id, p.sent_no ORDER BY p.low) - 1 AS part_no,
               CASE WHEN p.low = 0 THEN s.start ELSE a.start END AS start,
               CASE WHEN p.high = z.n THEN s."end" ELSE z."end" END AS "end"
        FROM part_ends p JOIN sents s USING (doc_id, sent_no)
        JOIN long_toks a ON a.doc_id = p.doc_id AND a.sent_no = p.sent_no AND a.tok_no = p.low + 1
        JOIN long_toks z ON z.doc_id = p.doc_id AND z.sent_no = p.sent_no AND z.tok_no = p.high
        UNION ALL SELECT s.doc_id, s.sent_no, 0, s.start, s."end"
        FROM sents s ANTI JOIN part_ends p USING (doc_id, sent_no)"""
       for name in ("split_long_sentences", "split_long_sentences_of_stored_tokens")},
    "all_caps_lower": rf"""SELECT t.doc_id, t.sent_no, t.tok_no, t.start, t."end", t.text,
            CASE WHEN regexp_full_match(s.text, '[^a-z]+{BLANKS}[^a-z]+') THEN lower(t.text)
                 ELSE t.text END AS text_norm
        FROM toks t JOIN sents s USING (doc_id, sent_no)""",
    "document_number": """SELECT doc_id, CAST(0 AS BIGINT) AS start, length(text) AS "end",
        (row_number() OVER (ORDER BY doc_id) - 1) % 32767 + 1 AS doc_no FROM documents""",
    **{name: f"""SELECT p.doc_id, p.par_no, p.start, p."end" FROM pars p SEMI JOIN labels l USING (doc_id)
        UNION ALL SELECT d.doc_id, 0, 0, length(d.text){less} FROM docs d ANTI JOIN labels l USING (doc_id)"""
       for name, less in (("default_paragraph", ""), ("default_paragraph_less_one", " - 1"))},
    "overlap_join": """SELECT t.doc_id, t.start AS a_start, t."end" AS a_end, s.start AS b_start, s."end" AS b_end,
            s.sent_no AS b_sent_no
        FROM toks t JOIN sents s ON s.doc_id = t.doc_id AND t.start < s."end" AND t."end" > s.start""",
    "contained_join": """SELECT t.doc_id, t.start AS a_start, t."end" AS a_end, s.start AS b_start, s."end" AS b_end,
            s.ce_id AS b_ce_id
        FROM toks t JOIN np_stretch s ON s.doc_id = t.doc_id AND s.stretch = t.start // 100
            AND t.start >= s.start AND t."end" <= s."end" """,
    "covered_text": """SELECT s.doc_id, s.start, s."end", substring(d.text, s.start + 1, s."end" - s.start) AS text
        FROM sents s JOIN docs d USING (doc_id)""",
    "crossing_spans": """SELECT a.doc_id, a.start AS a_start, a."end" AS a_end, b.start AS b_start, b."end" AS b_end
        FROM bigram_stretch a JOIN bigrams b
        ON b.doc_id = a.doc_id AND a.stretch = b.start // 100 AND a.start < b.start AND b.start < a."end" AND a."end" < b."end" """,
    "ordered_spans": """SELECT doc_id, start, "end",
            row_number() OVER (PARTITION BY doc_id ORDER BY start, "end") - 1 AS idx,
            count(*) OVER (PARTITION BY doc_id) AS n, count(*) OVER (PARTITION BY doc_id) // 2 AS mid FROM sents""",
    "merge_sets": 'SELECT doc_id, start, "end" FROM pars UNION SELECT doc_id, start, "end" FROM sents',
    "check_annotations": " UNION ALL ".join(
        f"""SELECT "set", '{flag}' AS flag, count(*) AS n FROM damaged d WHERE {test} GROUP BY "set" """
        for flag, test in ((f, t.replace(" n", " d.n")) for f, t in _FLAGS.items())),
    "strip_bad_annotations": f"SELECT {_ANN} FROM damaged WHERE NOT ({_BAD})",
    "repair_store": f"SELECT {_ANN} FROM damaged WHERE NOT ({_BAD})",
    "strip_report": f"""SELECT "set", count(*) AS removed, CAST(sum({" + ".join(
        f"CAST({t} AS BIGINT)" for t in _FAULTS.values())} - 1) AS BIGINT) AS failed_removals,
        count(DISTINCT doc_id) AS changed_docs FROM damaged WHERE {_BAD} GROUP BY "set" """,
    "entities_by_type": """SELECT doc_id, type, part, string_agg(text, '|' ORDER BY text) AS texts FROM (
        SELECT *, (row_number() OVER (PARTITION BY doc_id, type ORDER BY text) - 1) // 1024 AS part
        FROM (SELECT DISTINCT doc_id, type, text FROM ents)) GROUP BY doc_id, type, part""",
    "set_size_histogram": """SELECT "set", size, count(*) AS docs FROM (
        SELECT doc_id, "set", count(*) AS size FROM ann GROUP BY doc_id, "set") GROUP BY "set", size""",
    "np_log10_histogram": """SELECT CASE WHEN n >= 1000 THEN 3 WHEN n >= 100 THEN 2 WHEN n >= 10 THEN 1 ELSE 0 END::BIGINT
        AS bucket, count(*) AS docs FROM (SELECT count(*) AS n FROM nps GROUP BY doc_id) GROUP BY bucket""",
    "tag_counts": 'SELECT "set", type, count(*) AS n FROM ann GROUP BY "set", type',
    "job_counters": """SELECT 'base annotation' AS "group", 'rows' AS name, count(*) AS count FROM docs
        UNION ALL SELECT 'base annotation', 'has ' || "set", count(*) FROM held GROUP BY "set"
        UNION ALL SELECT 'base annotation', 'add ' || s, count(*) FROM docs d
        CROSS JOIN (VALUES ('PAR'), ('SENT'), ('TOKEN'), ('POS')) AS t(s)
        WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.doc_id = d.doc_id AND h."set" = s) GROUP BY s""",
    "error_counts": """SELECT error, count(*) AS docs FROM (SELECT doc_id, min(CASE WHEN start > n THEN 'start behind text'
            WHEN "end" > n THEN 'end behind text' WHEN start >= "end" THEN 'nothing covered' END) AS error
        FROM damaged GROUP BY doc_id) WHERE error IS NOT NULL GROUP BY error""",
    "found_layers": 'SELECT "set", count(*) AS docs FROM held GROUP BY "set"',
    "term_list": f"SELECT doc_id, array_to_string({_TERMS}, ' ') AS terms FROM docs",
    "term_counts": f"""SELECT doc_id, term, count(*) AS n FROM (
        SELECT doc_id, unnest({_TERMS}) AS term FROM docs) GROUP BY doc_id, term""",
    "term_counts_conversations": f"""SELECT conv_id, turn, term, count(*) AS n FROM (
        SELECT conv_id, turn, unnest({_TERMS}) AS term FROM conversations) GROUP BY conv_id, turn, term""",
    "token_list": """SELECT d.doc_id, coalesce(string_agg(t.text, ' ' ORDER BY t.start), '') AS terms
        FROM docs d LEFT JOIN toks t USING (doc_id) GROUP BY d.doc_id""",
    "token_counts": "SELECT doc_id, text AS term, count(*) AS n FROM toks GROUP BY doc_id, text",
    "tree_spans": 'SELECT doc_id, node_id, coalesce(parent_id, -1) AS parent_id, label, start, "end" FROM inner_nodes',
    "tree_spans_with_leaves": f"""SELECT doc_id, label, {_SUMS} FROM (SELECT doc_id, label, start, "end" FROM inner_nodes
        UNION ALL SELECT doc_id, label, start, "end" FROM leaves) GROUP BY doc_id, label""",
    "child_ids": """SELECT doc_id, parent_id AS node_id, part, string_agg(node_id, ',' ORDER BY node_id DESC) AS child_ids
        FROM (SELECT *, (row_number() OVER (PARTITION BY doc_id, parent_id ORDER BY node_id DESC) - 1) // 1024 AS part
              FROM edges WHERE parent_id IS NOT NULL) GROUP BY doc_id, parent_id, part""",
    **{name: f'SELECT doc_id, sent_no, tok_no, start, "end", type, {_GOV} FROM deps'
       for name in ("dependency_spans", "dependency_spans_of_tables")},
    "relation_groups": f"""SELECT doc_id, sent_no, tok_no, start, "end", {_GROUPED} AS type, {_GOV} FROM deps""",
    **{name: """SELECT d.doc_id, d.sent_no, d.tok_no, d.start, d."end",
            CASE WHEN c.origin IS NULL THEN d.type ELSE c.type END AS type,
            coalesce(CASE WHEN c.origin IS NULL THEN d.gov ELSE c.gov END, '') AS gov,
            coalesce(CASE WHEN c.origin IS NULL THEN d.gov_id ELSE c.gov_id END, -1) AS gov_id
        FROM deps d LEFT JOIN (SELECT * FROM chain WHERE type <> 'conj') c
        ON c.doc_id = d.doc_id AND c.sent_no = d.sent_no AND c.origin = d.tok_no"""
       for name in ("resolve_conjunctions", "resolve_conjunctions_of_tables")},
    "mention_pairs": "SELECT doc_id, i, j FROM pairs",
    "pair_features": "SELECT * FROM feats",
    "binarized_features": f"""SELECT doc_id, i, j, exact, head_match, both_pronoun, either_pronoun, number_agree,
        substring, {_BINARY} FROM feats""",
    "pair_scores": "SELECT doc_id, i, j, weight FROM scored",
    "coref_links": "SELECT doc_id, left_entity, right_entity, weight FROM links",
    "coref_clusters": """SELECT n.doc_id, n.ce_id, coalesce(c.name, n.ce_id) AS cluster_id FROM nps n LEFT JOIN (
        SELECT doc_id, node, min(name) AS name FROM spread GROUP BY doc_id, node) c
        ON c.doc_id = n.doc_id AND c.node = n.ce_id""",
    "coref_destinations": """SELECT n.doc_id, n.node_id, coalesce(l.part, 0) AS part,
            coalesce(string_agg(l.dst, ',' ORDER BY l.dst), '') AS dests
        FROM (SELECT doc_id, src AS node_id FROM arcs UNION SELECT doc_id, dst FROM arcs) n
        LEFT JOIN (SELECT *, (row_number() OVER (PARTITION BY doc_id, src ORDER BY dst) - 1) // 1024 AS part FROM arcs) l
        ON l.doc_id = n.doc_id AND l.src = n.node_id GROUP BY ALL""",
    "np_properties": f"""SELECT doc_id, ce_id, start, "end", '{{"CE_ID":"' || ce_id || '","Number":"'
        || CASE WHEN ends_with(lower(head), 's') THEN 'plural' ELSE 'singular' END || '","Pronoun":"'
        || CASE WHEN lower(text) IN {_in(LEXICON['PRP'])} THEN 'true' ELSE 'false' END || '","SentNum":"'
        || sent_no || '","Text":' || to_json(text) || ',"head":' || to_json(head) || '}}' AS props_json FROM nps""",
    "annotate": f"""SELECT "set", type, {_SUMS} FROM (SELECT {_ANN} FROM ann
        UNION ALL SELECT {_ANN} FROM ann_ne UNION ALL SELECT {_ANN} FROM ann_np) GROUP BY "set", type""",
    "annotate_links": "SELECT doc_id, left_entity, right_entity, weight FROM links_ne",
    "annotate_incremental": f"""SELECT CAST(1 AS BIGINT) AS run, doc_id, "set", {_SUMS} FROM (
        SELECT {_ANN} FROM fill UNION ALL SELECT {_ANN} FROM ann_ne_full UNION ALL SELECT {_ANN} FROM ann_np_full)
        GROUP BY doc_id, "set" """,
    "annotate_existing": f"""SELECT "set", type, {_SUMS} FROM ({_FILLED} UNION ALL SELECT {_ANN} FROM ann_ne_full
        UNION ALL SELECT {_ANN} FROM ann_np_full) GROUP BY "set", type""",
    "annotate_existing_links": "SELECT doc_id, left_entity, right_entity, weight FROM links_ne_full",
    "store_history": f"""SELECT 'first' AS state, "set", {_SUMS} FROM ann GROUP BY "set"
        UNION ALL SELECT 'now', "set", {_SUMS} FROM (SELECT {_ANN} FROM ann WHERE "set" IN ('TOKEN', 'POS')
            UNION ALL SELECT {_ANN} FROM ann WHERE "set" = 'SENT' AND doc_id NOT IN (SELECT doc_id FROM labels)
            UNION ALL SELECT {_ANN} FROM ann WHERE "set" = 'PAR' AND doc_id NOT IN (SELECT doc_id FROM labels)
            UNION ALL SELECT {_ANN} FROM stored WHERE "set" = 'PAR') GROUP BY "set" """,
    "set_aside": r"""SELECT run, CASE WHEN length(text) > most THEN 'too long' ELSE 'no capital' END AS error, count(*) AS docs
        FROM documents, (VALUES (1::BIGINT, 500), (2::BIGINT, 5000)) AS runs(run, most)
        WHERE length(text) > most OR NOT regexp_matches(text, '\p{Lu}') GROUP BY ALL""",
    "finished_cells": """SELECT "set", count(*) AS docs FROM documents,
        (SELECT unnest(['PAR', 'SENT', 'TOKEN', 'POS', 'NE', 'NP']) AS "set") AS sets GROUP BY "set" """,
}.items()}
