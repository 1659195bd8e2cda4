"""Operators on texts against brute force, and on rows that are odd."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from marginalia.llm import (common, exact_dedup, jaccard_join, lm_score, mixing, packing, quality, repeated_passages,
                            secret_scan, toxicity)
from marginalia.llm.queries import QUERIES, SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def made_words(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{i:x}" for i in rng.integers(0, 1 << 40, n))


def split(text):
    return WORD.findall(text or "")


def found(df, *by):
    return df.toPandas().sort_values(list(by), ignore_index=True)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, db, folder, name):
    ours, theirs = QUERIES[name](spark, folder).toPandas(), db.execute(SQL[name]).df()
    columns = sorted(theirs.columns)
    assert sorted(ours.columns) == columns
    pd.testing.assert_frame_equal(ours[columns].sort_values(columns, ignore_index=True),
                                  theirs[columns].sort_values(columns, ignore_index=True), check_dtype=False)


# --- exact dedup -----------------------------------------------------------------------------

def test_exact_groups_of_odd_rows(odd):
    got = found(exact_dedup.exact_groups(odd), "text_sha256", "doc_id")
    assert len(got) == odd.count()
    plain = got[got["group_size"] == 3]
    assert plain["keep_id"].tolist() == [1, 1, 1]
    assert plain["kept"].tolist() == [True, False, False]
    empty = got[got["text_sha256"] == hashlib.sha256(b"").hexdigest()]
    assert empty["doc_id"].tolist() == [4, 5] and empty["keep_id"].tolist() == [4, 4]
    twice = got[got["doc_id"] == 10]
    assert twice["kept"].tolist().count(True) == 1 and twice["group_size"].tolist() == [2, 2]


def test_hot_text_is_salted(spark):
    rows = [(i, "same  text" if i % 3 else f"own {i}") for i in range(2000)]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).toPandas()
    hot = got[got["group_size"] > 1]
    assert set(hot["keep_id"]) == {1} and set(hot["group_size"]) == {len(hot)}
    assert hot.loc[hot["kept"], "doc_id"].tolist() == [1]
    assert got["kept"].sum() == len(got) - len(hot) + 1


def test_without_copies_keeps_columns(odd, nothing):
    got = exact_dedup.without_copies(odd)
    assert got.columns == odd.columns and got.count() == 13
    assert exact_dedup.without_copies(nothing).count() == 0


# --- packing ---------------------------------------------------------------------------------

def test_pieces_are_the_tokenizers_ids(odd, documents):
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    whole = Tokenizer.from_file(path)
    for docs in (odd, documents):
        texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        want = []
        for key, text in texts:
            ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
            want += [(-1 if key is None else key, i // 4096, i, len(ids[i:i + 4096]), zlib.crc32(ids[i:i + 4096].tobytes()))
                     for i in range(0, len(ids), 4096)]
        got = packing.pack(docs).toPandas().fillna({"doc_id": -1})
        columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
        assert sorted(map(tuple, got[columns].astype(int).to_numpy().tolist())) == sorted(want)
        got = got.sort_values(["sequence_id", "offset"])
        each = got.groupby("sequence_id")["length"]
        assert (got["offset"] == each.cumsum() - got["length"]).all() and each.sum().max() <= 4096


def test_other_tokenizers_take_whole_texts():
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    text = "  two  blanks, and\nlines"
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing._ids(path)(text), "<u4").tolist() == want


def test_exchange_reaches_the_bound(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES", 50)
    rng = np.random.default_rng(2)
    rows = [(i, 0, int(n), i) for i, n in enumerate(rng.integers(1, 60, 2000))]
    where = packing.placed(spark.createDataFrame(rows, "doc_id bigint, piece int, length bigint, copy bigint"), 100)
    proof = packing.certificate(where, 100).first()
    assert where.count() == 2000 and proof["sequences"] <= proof["bound"] * 1.02
    used = where.groupBy("sequence_id").sum("length").toPandas()["sum(length)"]
    assert used.max() <= 100


def test_no_partition_grows_where_the_bound_is_out_of_reach(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES", 500)
    monkeypatch.setattr(packing, "MEET", 4)
    lengths = np.random.default_rng(3).integers(700, 1301, 20_000)
    rows = [(i, 0, int(n), i) for i, n in enumerate(lengths)]
    where = packing.placed(spark.createDataFrame(rows, "doc_id bigint, piece int, length bigint, copy bigint")).toPandas()
    assert sorted(where["copy"]) == list(range(20_000))
    where = where.sort_values(["sequence_id", "offset"])
    each = where.groupby("sequence_id")["length"]
    assert (where["offset"] == each.cumsum() - where["length"]).all() and each.sum().max() <= 4096
    # Dealt by a hash, partitions of 2,000 pieces differ by some of them.
    assert where.groupby(where["sequence_id"] // 2**32).size().max() <= 2400
    alone = sum(len(packing.best_fit(-np.sort(-part), 4096)[2]) for part in np.array_split(lengths, 40))
    assert each.ngroups <= alone


def test_lower_bound_sees_pieces_that_cannot_pair():
    counts = np.zeros(101, int)
    counts[60] = 10
    counts[30] = 4
    assert packing.lower_bound(counts, 100) == 10


def test_sequences_hold_the_ids(documents):
    small = documents.where("doc_id < 20")
    result = packing.pack(small)
    total = result.agg({"length": "sum"}).first()[0]
    assert sum(len(r["ids"]) for r in packing.sequences(small, result).collect()) == 4 * total


def test_packing_nothing(nothing):
    assert packing.pack(nothing).count() == 0


# --- secrets ---------------------------------------------------------------------------------

def test_trigram_queries():
    assert secret_scan.trigram_query("(?i:token|api_?key)x") == [
        frozenset({"api", "pi_", "i_k", "_ke", "key", "eyx"}), frozenset({"api", "pik", "ike", "key", "eyx"}),
        frozenset({"tok", "oke", "ken", "enx"})]
    assert secret_scan.trigram_query("[0-9a-f]{16,}") == []
    assert secret_scan.trigram_query("abc*d") == []
    assert secret_scan.trigram_query("(?:abc)+") == [frozenset({"abc"})]


def brute_spans(text):
    rules = [("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
             ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16)]
    out = [(m.start(), i, m.end(), kind) for i, (kind, p, g, least) in enumerate(rules)
           for m in re.finditer(p, text, re.ASCII) if len(m.group(g)) >= least]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_secrets_of_odd_rows(odd, nothing):
    got = secret_scan.report(odd).collect()
    want = Counter((r["doc_id"], brute_spans(r["text"] or "")) for r in odd.collect())
    assert Counter((r["doc_id"], r["spans"]) for r in got) == want
    assert sum(r["n_assign"] for r in got) == 3
    assert secret_scan.report(nothing).count() == 0


def test_many_matches_in_one_text(spark):
    text = "token=token:abcdefghijklmn secret = 'short' " * 700 + "deadbeefdeadbeef " * 3000
    got = secret_scan.report(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert got["spans"] == brute_spans(text)


def test_a_rule_of_the_caller(odd):
    rules = (*secret_scan.RULES, secret_scan.Rule("mail", "([a-z]+@[a-z]+[.]com)", 1, 1))
    assert "n_mail" in secret_scan.report(odd, rules).columns


# --- mixing ----------------------------------------------------------------------------------

def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    goal, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while open_:
        share = left / sum(weight[n] for n in open_)
        over = [n for n in open_ if share * weight[n] > 2 * sizes[n]]
        if not over:
            goal.update({n: share * weight[n] for n in open_})
            break
        for n in over:
            goal[n] = 2.0 * sizes[n]
            left -= goal[n]
        open_ -= set(over)
    return goal


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_mix_meets_its_targets(request, table):
    docs = request.getfixturevalue(table)
    lined, pieces = mixing.mix(docs, block=64)
    rows = docs.select("source", "text").collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(split(r["text"]))
    goal = brute_targets(sizes)
    lined, pieces = lined.toPandas(), pieces.toPandas()
    assert len(lined) == len(rows)
    by_source = lined.groupby("source_no").agg(source=("source", "first"), target=("target", "first"))
    given = pieces.groupby("source_no")["n_words"].sum()
    for number, row in by_source.iterrows():
        name = None if pd.isna(row["source"]) else row["source"]
        assert row["target"] == pytest.approx(goal[name])
        assert given.get(number, 0) == round(goal[name]) or abs(given.get(number, 0) - goal[name]) <= 0.5
    # No word of a document is taken more than twice.
    for (_, at), piece in pieces.groupby(["source_no", "at"]):
        times = np.zeros(piece["size"].iloc[0], int)
        for a, n in zip(piece["start_word"], piece["n_words"]):
            times[a:a + n] += 1
        assert times.max() <= 2


def test_mix_is_the_same_again_and_its_texts_fit(documents, nothing):
    a, b = (found(mixing.taken(documents), "doc_id") for _ in range(2))
    pd.testing.assert_frame_equal(a, b)
    assert (a["taken"] <= 2 * a["size"]).all()
    texts = mixing.mixed_documents(documents)
    assert texts.columns == documents.columns
    assert sum(len(split(r["text"])) for r in texts.collect()) == a["taken"].sum()
    assert mixing.taken(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


def test_the_splitting_tree_parts_quotas_exactly():
    quota = np.array([5, 0, 1000, 37])
    left = mixing._left_part(quota, 400, (1, 2, 3))
    assert left.sum() == 400 and (left <= quota).all()
    large = mixing._left_part(quota * 10 ** 9, 400 * 10 ** 9, (1, 2, 3))
    assert large.sum() == 400 * 10 ** 9 and (large <= quota * 10 ** 9).all()
    assert sorted(mixing._permuted(np.arange(1000), 1000, (1,))) == list(range(1000))


def test_draws_of_any_size_are_drawn(monkeypatch):
    quota = np.array([3, 0, 500, 37, 7]) * 10 ** 10 + np.array([1, 0, 5, 9, 10 ** 6])
    total = int(quota.sum())
    for left in (0, 1, 12345, total // 3, total - 1, total):
        drawn = mixing._left_part(quota, left, (1, left))
        assert drawn.sum() == left and (drawn >= 0).all() and (drawn <= quota).all()
    # Drawn, not rounded: draws differ from seed to seed, about as much as runs of copies make them.
    draws = np.array([mixing._left_part(quota, total // 2, (seed,))[2] for seed in range(40)])
    assert len(set(draws.tolist())) > 30
    # The same rule with small numbers has the spread of single copies and of runs of them.
    quota = np.array([600, 400])
    single = np.array([mixing._left_part(quota, 500, (seed,))[0] for seed in range(300)])
    monkeypatch.setattr(mixing, "_DRAWABLE", 300)
    runs = np.array([mixing._left_part(quota, 500, (seed,))[0] for seed in range(300)])
    assert abs(single.mean() - 300) < 3 and abs(runs.mean() - 300) < 3
    assert single.std() < runs.std() < 3 * single.std()


def test_the_mix_stands_in_the_order_of_its_shards(documents):
    _, pieces = mixing.mix(documents)
    want = [(r["doc_id"], r["n_words"]) for r in sorted(pieces.collect(), key=lambda r: (
        r["shard"], r["position"], r["key"], r["start_word"]))]
    mixed = mixing.mixed_documents(documents).withColumn("place", F.monotonically_increasing_id())
    rows = sorted(mixed.collect(), key=lambda r: r["place"])
    assert [(r["doc_id"], len(split(r["text"]))) for r in rows] == want
    ids = [r["doc_id"] for r in rows]
    assert ids != sorted(ids)


def test_many_sources_have_trees_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 7)
    docs = spark.createDataFrame([(i, f"s{i % 30:02d}", "w " * (1 + i % 50)) for i in range(400)], "doc_id bigint, source string, text string")
    got = mixing.taken(docs).toPandas()
    assert (got["taken"] <= 2 * got["size"]).all()
    by_target = got.groupby("target")["taken"].sum()
    sources = got.drop_duplicates(["source_size", "target"]).shape[0]
    assert sources > 7 and abs(got["taken"].sum() - 1.5 * got["size"].sum()) <= 30 and len(by_target) > 1


# --- near duplicates -------------------------------------------------------------------------

def brute_groups(rows, n, least):
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets, by_id = [], defaultdict(list)
    for key, text in rows:
        w = split((text or "").translate(fold))
        s = frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) or frozenset([tuple(w)] if w else [])
        sets.append((key, s))
    parent = {k: k for k, _ in sets if k is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(k, s) for k, s in sets if k is not None and s]
    for i, (a, s) in enumerate(known):
        for b, t in known[:i]:
            both = len(s & t)
            if both and least.denominator * both >= least.numerator * (len(s) + len(t) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sets, root


@pytest.mark.parametrize("n, least", [(3, Fraction(9, 10)), (5, Fraction(4, 5))])
def test_near_groups(documents, n, least):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    sets, root = brute_groups(rows, n, least)
    got = {r["doc_id"]: r for r in jaccard_join.near_groups(documents, n, least).collect()}
    for key, s in sets:
        assert got[key]["n_shingles"] == len(s) and got[key]["component_id"] == root(key)


def test_large_blocks_are_joined_piece_by_piece(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TRIE", 4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        # Chains: each text changes a little more, so that the first and the last do not link.
        for j in range(i // 6):
            w[(j * 11) % 120] = f"x{j}"
        w[(i * 7) % 120] = f"own{i}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    _, root = brute_groups(rows, 3, Fraction(9, 10))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_groups(docs, 3, Fraction(9, 10)).collect()}
    assert got == {k: root(k) for k, _ in rows}


def test_near_groups_of_odd_rows(odd, nothing):
    got = jaccard_join.near_groups(odd, 3, Fraction(9, 10)).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got}
    assert [by_id[i]["component_id"] for i in (1, 2, 3)] == [1, 1, 1]
    assert [by_id[i]["n_shingles"] for i in (4, 5, 6, 7)] == [0, 0, 0, 1]
    assert by_id[8]["component_id"] == 7
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {1, None}
    left = jaccard_join.without_near_copies(odd)
    assert left.columns == odd.columns and left.where("doc_id IN (2, 3)").count() == 0
    assert jaccard_join.near_groups(nothing).count() == 0


def test_the_trie_finds_every_link():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(80):
        base = rng.choice(60, rng.integers(1, 40), replace=False)
        sets += [np.unique(base).astype(np.uint64), np.unique(np.append(base, rng.choice(60, 2))).astype(np.uint64)]
    sets = [np.frombuffer(b, np.uint64) for b in {s.tobytes() for s in sets}]
    least, trie = Fraction(7, 10), None
    trie = jaccard_join.Trie(sets)
    for i, a in enumerate(sets):
        want = [j for j, b in enumerate(sets) if len(np.intersect1d(a, b)) * 10 >= 7 * len(np.union1d(a, b))]
        assert sorted(trie.links(i, least).tolist()) == want


# --- repeated passages -----------------------------------------------------------------------

def brute_passages(rows, least):
    owners = defaultdict(set)
    texts = [(k, split(t)) for k, t in rows if k is not None]
    for k, w in texts:
        for i in range(len(w) - least + 1):
            owners[tuple(w[i:i + least])].add(k)
    hit = defaultdict(set)
    for k, w in texts:
        for i in range(len(w) - least + 1):
            if len(owners[tuple(w[i:i + least])]) > 1:
                hit[k].add((i, i + least))
    out = set()
    for k, spans in hit.items():
        low, high = None, None
        for a, b in sorted(spans):
            if low is None or a > high:
                if low is not None:
                    out.add((k, low, high))
                low, high = a, b
            high = max(high, b)
        out.add((k, low, high))
    return out


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_repeated_passages(request, table):
    docs = request.getfixturevalue(table)
    got = repeated_passages.repeated_passages(docs).toPandas()
    want = brute_passages([(r["doc_id"], r["text"]) for r in docs.collect()], 50)
    assert set(zip(got["doc_id"], got["start_word"], got["end_word"])) == want and len(got) == len(want)
    assert (got["other_doc"] != got["doc_id"]).all()


def test_passages_in_many_surroundings(spark):
    from tests.llm.conftest import words
    shared = words(55, 99)
    rows = [(i, f"{words(30 + i, i + 1)} {shared} {words(20, i + 1000)}") for i in range(40)]
    rows += [(100, " ".join(shared.split()[:52])), (101, " ".join(shared.split()[:49])), (102, "a " * 300), (103, "a " * 60)]
    got = repeated_passages.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).toPandas()
    assert set(zip(got["doc_id"], got["start_word"], got["end_word"])) == brute_passages(rows, 50)


def test_no_passages(nothing):
    assert repeated_passages.repeated_passages(nothing).count() == 0


# --- classifiers and language models ---------------------------------------------------------

@pytest.mark.parametrize("operator, label, least", [(quality.quality, "quality", 0.9), (toxicity.toxicity, "toxic", 0.8)])
def test_held_out_accuracy(documents, labels, operator, label, least):
    got = operator(documents, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = got[got["held_out"]]
    assert len(held) and (held["predicted"] == held[label]).mean() >= least
    assert got["score"].between(0, 1).all()


@pytest.mark.parametrize("operator", [quality.quality, toxicity.toxicity])
def test_classifiers_on_odd_rows(odd, nothing, labels, operator):
    got = operator(odd, labels).toPandas()
    assert len(got) == odd.count() and got["score"].notna().all() and got["held_out"].notna().all()
    one = got[got["doc_id"] == 10]
    assert one["score"].nunique() == 1
    assert operator(nothing, labels).count() == 0
    # Without labels everything scores the same.
    assert operator(odd, labels.where("1 = 0")).toPandas()["score"].nunique() == 1


def test_held_out_labels_teach_nothing(documents, labels):
    from marginalia.llm import labelled
    taken = labelled.sample(documents, labels, "quality", 4, 2, 50).toPandas()
    assert len(taken) and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in taken["doc_id"])
    assert taken.groupby("y")["doc_id"].nunique().max() <= 50


def test_attention_slopes():
    rng = np.random.default_rng(1)
    model, begin = quality.Model(), np.array([0, 3, 4])
    x, y, weigh = rng.normal(size=(4, quality.FEATURES)), np.array([1.0, 0.0]), np.array([0.5, 0.5])

    def loss():
        logit = model.forward(x, begin)[0]
        return float((weigh * (np.logaddexp(0, logit) - y * logit)).sum())

    for name, slope in model.slopes(x, begin, y, weigh).items():
        at = tuple(0 for _ in slope.shape)
        model.w[name][at] += 1e-5
        up = loss()
        model.w[name][at] -= 2e-5
        down = loss()
        model.w[name][at] += 1e-5
        assert slope[at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def plain_losses(texts, every, text):
    """Mean loss of a text under the counts of ``texts``; the vocabulary is that of ``every``."""
    single = Counter(w for t in texts for w in t)
    both = Counter(p for t in texts for p in zip(["^"] + t, t))
    ahead = Counter(w for t in texts for w in ["^"] + t[:-1] if t)
    total, size = sum(single.values()), len({w for t in every for w in t})
    return np.mean([-np.log((both[p, w] + 50 * (single[w] + 1) / (total + size + 1)) / (ahead[p] + 50))
                    for p, w in zip(["^"] + text, text)])


def plain_passages(text):
    """Features of the passages of a text, one character and one word after the other."""
    data, found = text.encode(), [m.span() for m in re.finditer(WORD.pattern.encode(), text.encode())]
    count = max(1, -(-len(found) // quality.PASSAGE_WORDS))
    out = [[0.0] * quality.FEATURES for _ in range(count)]
    chars = [0] * count
    for i, byte in enumerate(data):
        before = sum(1 for a, _ in found if a <= i)
        owner = (before - 1) // quality.PASSAGE_WORDS if before else 0
        chars[owner] += 1
        out[owner][int(quality._CLASS[byte])] += 1
        if i + 1 < len(data):
            out[owner][quality.CLASSES + ((byte * 31 + data[i + 1]) * 0x9E37 >> 7) % quality.PAIRS] += 1
    at = quality.CLASSES + quality.PAIRS
    words = [data[a:b] for a, b in found]
    for p in range(count):
        here = range(p * quality.PASSAGE_WORDS, min(len(words), (p + 1) * quality.PASSAGE_WORDS))
        out[p][:at] = [v / max(chars[p], 1) for v in out[p][:at]]
        for i in here:
            out[p][at + min(len(words[i]), quality.LENGTHS) - 1] += 1 / len(here)
        for k, n in enumerate((1, 2, 3)):
            grams = [tuple(words[i:i + n]) for i in here if i + n <= len(words)]
            out[p][at + quality.LENGTHS + k] = len(set(grams)) / max(len(grams), 1)
        out[p][-1] = np.log1p(len(here))
    return out


def plain_attention(model, passages):
    """The score of a bag, neuron by neuron."""
    w, dot = model.w, lambda a, b: sum(float(x) * float(y) for x, y in zip(a, b))
    hidden, raw = [], []
    for x in passages:
        x = [min(8.0, max(-8.0, (v - m) / s)) for v, m, s in zip(x, model.mean, model.spread)]
        h = [np.tanh(dot(x, w["enc"][:, j]) + w["enc0"][j]) for j in range(quality.HIDDEN)]
        gated = [np.tanh(dot(h, w["v"][:, g])) / (1 + np.exp(-dot(h, w["u"][:, g]))) for g in range(quality.GATE)]
        hidden.append(h)
        raw.append(dot(gated, w["att"]))
    share = [np.exp(r - max(raw)) for r in raw]
    mean = [dot([h[j] for h in hidden], share) / sum(share) for j in range(quality.HIDDEN)]
    return 1 / (1 + np.exp(-dot(mean, w["out"]) - w["out0"][0]))


def test_quality_against_plain_python(spark):
    rows = [(i, made_words(n, i)) for i, n in enumerate([3, 130, 300, 128, 1, 2])]
    rows += [(10, ""), (11, None), (12, " \t Ünï cödé -- 12 !  "), (13, "a b a b a b"), (14, rows[1][1]), (15, "a b a b a b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    bags = [plain_passages(t or "") for _, t in rows]
    model = quality.Model(9)
    flat = np.array([p for b in bags for p in b])
    model.mean, model.spread = flat.mean(0), flat.std(0) + 1e-2
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", quality.score(model, F.col("text")).alias("s")).collect()}
    for (k, _), bag in zip(rows, bags):
        assert got[k] == pytest.approx(plain_attention(model, bag), abs=1e-9)
    # Neighbours in a batch do not touch a score.
    assert got[1] == pytest.approx(got[14], abs=1e-12) and got[13] == pytest.approx(got[15], abs=1e-12)


def plain_places(text):
    out = set()
    text = text.lower()
    for size in toxicity.SIZES:
        for i in range(len(text) - size + 1):
            gram = size
            for c in text[i:i + size]:
                gram = (gram * 0xD6E8FEB86659FD93 + ord(c)) % (1 << 64)
            out.add(((gram ^ gram >> 32) * 0x9E3779B97F4A7C15) % (1 << 64) >> 64 - toxicity.BITS)
    return out


def test_toxicity_against_plain_python(spark):
    rng = np.random.default_rng(2)
    usual, bad = [f"word{i}" for i in range(40)], ["awful!!", "Ünkind", "nastyone"]
    rows, marks = [], []
    for i in range(120):
        marks.append(i % 3 == 0)
        said = list(rng.choice(usual, 6)) + (list(rng.choice(bad, 2)) if marks[-1] else [])
        rows.append((i, " ".join(said)))
    docs = spark.createDataFrame(rows + [(500, ""), (501, None), (502, "abc")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(m)) for i, m in enumerate(marks)], "doc_id bigint, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}

    known = [i for i in range(120) if zlib.crc32(str(i).encode()) % 5 != 0]
    held = {i: plain_places(t) for i, t in rows}
    toxic = [i for i in known if marks[i]]
    fine = [i for i in known if not marks[i]]
    seen = {c: Counter(p for i in ids for p in held[i]) for c, ids in (("toxic", toxic), ("fine", fine))}
    ratio = {}
    for p in set().union(*(held[i] for i in known)):
        a, b = seen["toxic"][p], seen["fine"][p]
        r = np.log((a + 1) / (len(toxic) + 2) / ((b + 1) / (len(fine) + 2)))
        if a + b >= toxicity.SEEN and abs(r) >= toxicity.LEAST_RATIO:
            ratio[p] = r / 2
    assert ratio
    # Logistic regression by Adam on the scaled features, weight by weight.
    w, m, v = ({k: 0.0 for k in [*ratio, "bias"]} for _ in range(3))
    for step in range(1, toxicity.ROUNDS + 1):
        slope = {k: 1e-4 * w[k] if k != "bias" else 0.0 for k in w}
        for i in known:
            z = w["bias"] + sum(w[p] * ratio[p] for p in held[i] if p in ratio)
            error = (1 / (1 + np.exp(-z)) - marks[i]) * 0.5 / (len(toxic) if marks[i] else len(fine))
            slope["bias"] += error
            for p in held[i]:
                if p in ratio:
                    slope[p] += error * ratio[p]
        for k, g in slope.items():
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
            w[k] -= 0.05 * m[k] / (1 - 0.9 ** step) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-9)
    for i, text in [*rows, (500, ""), (501, ""), (502, "abc")]:
        z = w["bias"] + sum(w[p] * ratio[p] for p in plain_places(text) if p in ratio)
        assert got[i] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


def test_lm_scores_against_plain_counts(spark):
    # Rows are told apart by their text: the two rows of document 2 are equal.
    rows = [(1, "a b a b c"), (2, "a b"), (3, None), (4, "c c"), (None, "b a"), (2, "a b"), (5, "c a b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = lm_score.lm_scores(docs, spark.createDataFrame([(1,), (2,), (None,)], "doc_id bigint")).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(k) for k, _ in rows)
    every = [split(t) for _, t in rows]
    for row in got:
        at = next(i for i, (k, _) in enumerate(rows) if k == row["doc_id"])
        if not every[at]:
            assert row["n_tokens"] == 0 and row["score"] == 0
            continue
        others = [i for i in range(len(rows)) if i != at]
        known = [every[i] for i in others if rows[i][0] in (1, 2)]
        assert row["target_loss"] == pytest.approx(plain_losses(known, every, every[at]))
        assert row["background_loss"] == pytest.approx(plain_losses([every[i] for i in others], every, every[at]))
        assert row["score"] == pytest.approx(row["target_loss"] - row["background_loss"])


def test_lm_does_not_know_the_text_it_scores(spark):
    text, other = made_words(200, 1), made_words(200, 2)
    rows = [(1, text), (2, other), (3, other), *((k, made_words(200, k)) for k in range(4, 30))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    scored = lambda *ids: lm_score.lm_scores(docs, spark.createDataFrame([(i,) for i in ids], "doc_id bigint")).toPandas().set_index("doc_id")
    got, without = scored(1, 5), scored(5)
    # Being a target changes nothing for the target itself; a copy elsewhere does.
    assert got["target_loss"][1] == without["target_loss"][1] and got["target_loss"][7] != without["target_loss"][7]
    assert got["background_loss"][2] == got["background_loss"][3] < got["background_loss"].drop([2, 3]).min() - 0.01


def test_lm_counts_every_word_and_bigram(spark):
    # More words than 65,536, more bigrams than 2^21, several chunks and buckets.
    rng = np.random.default_rng(4)
    texts = [[f"w{n:x}" for n in rng.integers(0, 90_000, 2300)] for _ in range(1000)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = lm_score.lm_scores(docs, spark.range(0, 1000, 7).toDF("doc_id")).toPandas().set_index("doc_id").sort_index()
    size = len({w for t in texts for w in t})
    assert size > 1 << 16 and len({p for t in texts for p in zip(t, t[1:])}) > 1 << 21
    for column, known in (("background_loss", range(1000)), ("target_loss", range(0, 1000, 7))):
        single = Counter(w for i in known for w in texts[i])
        both = Counter(p for i in known for p in zip(["^"] + texts[i], texts[i]))
        ahead = Counter(w for i in known for w in ["^"] + texts[i][:-1])
        for k in range(0, 1000, 50):
            t, off = texts[k], k in known
            mine = Counter(t), Counter(zip(["^"] + t, t)), Counter(["^"] + t[:-1])
            total = sum(single.values()) - off * len(t)
            want = np.mean([-np.log((both[p, w] - off * mine[1][p, w]
                                     + 50 * (single[w] - off * mine[0][w] + 1) / (total + size + 1))
                                    / (ahead[p] - off * mine[2][p] + 50)) for p, w in zip(["^"] + t, t)])
            assert got[column][k] == pytest.approx(want)


def test_lm_tells_bigrams_with_one_key_apart():
    key, check = np.array([5, 5, 5, 9], np.uint64), np.array([1, 2, 1, 1], np.uint16)
    sums, different = lm_score.summed(key, check, np.array([[1, 2, 3, 4]]))
    assert sums.tolist() == [[4, 2, 4, 4]] and different == 3


def test_lm_scores_of_odd_rows(odd, nothing, labels):
    got = lm_score.lm_scores(odd, labels).toPandas()
    assert len(got) == odd.count() and np.isfinite(got["score"]).all()
    assert lm_score.lm_scores(nothing, labels).count() == 0


def test_word_hashes_know_borders():
    column = common.pa.array(["ab c", None, "c", " ab\tc ", ""])
    (row, offsets, data), = list(common.slices(column))
    hashes, starts, ends, first = common.words(offsets, data)
    assert row == 0 and first.tolist() == [0, 2, 2, 3, 5, 5]
    assert hashes[0] == hashes[3] and hashes[1] == hashes[2] == hashes[4] and hashes[0] != hashes[1]


def test_texts_that_share_an_id_are_told_apart(spark):
    base = made_words(60, 5)
    near = base.replace(base.split()[30], "changed", 1)
    alone = made_words(60, 77)
    like = alone.replace(alone.split()[10], "changed", 1)
    rows = [(1, base), (5, near), (5, alone), (8, like), (9, made_words(50, 9)), (5, near), (None, base)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("gone_id", F.lit("x")).withColumn("Sig", F.lit(2))
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in jaccard_join.near_groups(docs).collect())
    # The two texts of id 5 lie in different groups: that of row 1, and one of their own with row 8.
    assert got == [(0, 1), (1, 1), (5, 1), (5, 1), (5, 5), (8, 5), (9, 9)]
    left = jaccard_join.without_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left.collect()) == sorted([(0, base), (1, base), (5, alone), (9, made_words(50, 9))])


def test_one_text_of_a_shared_id_stays(spark):
    base = made_words(60, 5)
    near = base.replace(base.split()[30], "changed", 1)
    docs = spark.createDataFrame([(5, base), (5, near), (7, near.replace(near.split()[2], "other", 1))], "doc_id bigint, text string")
    left = jaccard_join.without_near_copies(docs).collect()
    assert [r["doc_id"] for r in left] == [5]


def test_an_id_on_very_many_texts_meets_each_once(spark):
    rows = [(3, made_words(12, i)) for i in range(300)] + [(4, made_words(12, i) + " tail") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = jaccard_join.near_groups(docs, 3, Fraction(9, 10)).groupBy("doc_id", "component_id").count().collect()
    assert sorted(map(tuple, got)) == [(3, 3, 300), (4, 3, 300)]


def test_a_mix_looks_for_repeated_rows_by_their_keys(spark):
    """Texts go through an aggregate only where rows stand several times; the words of the mix are those that it takes either way."""
    docs = spark.createDataFrame([(i, f"w{i} " * (40 + i), f"s{i % 3}") for i in range(60)], "doc_id bigint, text string, source string")
    words = lambda df: df.agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    for df, repeated in ((docs, False), (docs.union(docs.where("doc_id < 7")), True)):
        mixed = mixing.mixed_documents(df)
        assert ("Aggregate" in mixed._jdf.queryExecution().executedPlan().toString()) == repeated
        assert words(mixed) == mixing.taken(df).agg(F.sum("taken")).first()[0]


def test_links_of_many_units_are_written_together(spark, tmp_path):
    members = np.arange(50, dtype="<u8").tobytes()
    units = spark.createDataFrame([(2 * i + j, members, i) for i in range(64) for j in range(2)], "node bigint, members binary, unit bigint")
    path = str(tmp_path / "links")
    jaccard_join._links(units, Fraction(4, 5), 48).write.parquet(path)
    assert len(list((tmp_path / "links").glob("*.parquet"))) == 1
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(2 * i + 1, 2 * i) for i in range(64)]


def test_keys_of_a_long_task_are_tied_in_pieces(spark, monkeypatch):
    docs = spark.createDataFrame([(i, made_words(200, i // 2) + f" w{i}") for i in range(40)], "doc_id bigint, text string").coalesce(1)
    whole = rows_of(jaccard_join.near_groups(docs))
    monkeypatch.setattr(jaccard_join, "HELD", 50)
    assert rows_of(jaccard_join.near_groups(docs)) == whole
    assert {r[2] for r in whole} == set(range(0, 40, 2))


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()))
