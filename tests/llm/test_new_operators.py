"""Vector codes, token records and collocations against plain Python."""

import hashlib
import re
import zlib
from collections import Counter
from math import floor

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marginalia.llm import collocations, common, token_records, vector_codes

PATH = public_tokenizers.path("word_bpe_49k.json")


# --- vector codes ----------------------------------------------------------------------------

def brute_codes(rows, entries=64, rounds=2):
    kept = [(k, l, [floor(256 * x) for x in v]) for k, l, v in rows
            if v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    size = vector_codes.part_size(max((len(v) for _, _, v in kept), default=1))
    kept = [(k, l, v + [0] * (16 * size - len(v))) for k, l, v in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[2]))
    books = [[v[p * size:(p + 1) * size] for _, _, v in kept[:entries]] for p in range(16)]

    def nearest(p, x):
        return min(range(len(books[p])), key=lambda e: (sum((a - b) ** 2 for a, b in zip(x, books[p][e])), e))

    def assigned():
        return [[nearest(p, v[p * size:(p + 1) * size]) for p in range(16)] for _, _, v in kept]

    for _ in range(rounds):
        codes = assigned()
        for p in range(16):
            for e in range(len(books[p])):
                mine = [v[p * size:(p + 1) * size] for (_, _, v), c in zip(kept, codes) if c[p] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out, by_label = [], Counter()
    for (k, l, v), code in zip(kept, assigned()):
        error = sum((a - b) ** 2 for p in range(16) for a, b in zip(v[p * size:(p + 1) * size], books[p][code[p]]))
        by_label[l] += error
        out.append((k, l, "".join(f"{c:02x}" for c in code), error))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((k, c, e, by_label[l]) for k, l, c, e in out), key=repr), digest


def coded(spark, rows, **how):
    table = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").withColumn("code", F.lit("x"))
    codes, books = vector_codes.vector_codes(table.withColumn("error", F.lit(None)), **how)
    got = vector_codes.with_label_errors(codes).collect()
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), key=repr), vector_codes.books_digest(books)


@pytest.mark.parametrize("leaf, chunk", [(48, 4096), (1, 100), (3, 17)])
def test_codes_are_those_of_brute_force(spark, monkeypatch, leaf, chunk):
    monkeypatch.setattr(vector_codes, "CHUNK", chunk)
    monkeypatch.setattr(vector_codes, "LEAF", leaf)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 32)) / 6
    rows = [(i, int(i % 5) if i % 7 else None, (centres[i % 12] + rng.normal(size=32) / 40).astype("f4").tolist()) for i in range(260)]
    # Copies, ties, repeated ids, null ids and vectors that are left out.
    rows += [(300 + i, 1, rows[5][2]) for i in range(40)] + [(3, 2, rows[9][2]), (None, 2, rows[8][2]), (None, None, rows[8][2])]
    rows += [(400, 1, None), (401, 1, [float("nan")] * 32), (402, 1, [None] * 32), (403, 1, [float("inf")] * 32), (404, 1, [0.0] * 32)]
    assert coded(spark, rows) == brute_codes(rows)


def test_codes_of_few_short_and_no_vectors(spark):
    rows = [(1, 1, [0.5, -0.25, 1.0]), (2, 1, [0.5]), (3, 2, []), (4, 2, [-1.0] * 20)]
    assert coded(spark, rows) == brute_codes(rows)
    assert coded(spark, [(1, 1, None)]) == ([], hashlib.sha256(b"").hexdigest())
    assert coded(spark, []) == ([], hashlib.sha256(b"").hexdigest())


def test_codes_of_large_components_are_exact(spark):
    rng = np.random.default_rng(4)
    # Too large for doubles to add up squares exactly, within the bound.
    rows = [(i, 1, rng.integers(-130000, 130000, 16).astype("f4").tolist()) for i in range(90)]
    assert max(abs(floor(256 * x)) for _, _, v in rows for x in v) <= vector_codes.bound(16)
    assert coded(spark, rows) == brute_codes(rows)


def test_cover_trees_keep_their_promises():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.integers(-100, 100, (700, 3)), rng.integers(-3, 3, (300, 3)), np.zeros((50, 3), int)])
    first = np.array([0, 700, 1050])
    place, nodes, radius = vector_codes.cover_forest(points, first, 5)
    assert sorted(place) == list(range(1050))
    x = points[place].astype(float)
    for i, (begin, end, child, children) in enumerate(nodes.T):
        gap = ((x[begin:end] - x[begin]) ** 2).sum(1)
        assert gap.max() == radius[i]
        if not children:
            assert end - begin <= 5 or radius[i] == 0
            continue
        below = nodes[:, child:child + children]
        assert below[0, 0] == begin and below[1, -1] == end and (below[0, 1:] == below[1, :-1]).all()
        centres = x[below[0]]
        apart = ((centres[:, None] - centres[None]) ** 2).sum(2) + np.eye(children) * 1e9
        assert apart.min() > radius[i] / 4
        assert all(radius[child + j] <= radius[i] / 4 for j in range(children))


def test_subtrees_go_as_a_whole(spark):
    """Well parted groups: the trees compare far fewer points than there are."""
    rng = np.random.default_rng(6)
    rows = [(rng.integers(0, 40) * 10 + rng.normal(size=16) / 50).tolist() for _ in range(2000)]
    points = vector_codes._quantised(rows, 1).reshape(-1, 1)
    place, nodes, radius = vector_codes.cover_forest(points, np.arange(17) * 2000, vector_codes.LEAF)
    row = dict(n=2000, points=points[place].astype("<i4").tobytes(), place=place.astype("<i4").tobytes(),
               nodes=nodes.astype("<i4").tobytes(), radius=radius.astype("<f8").tobytes())
    seen = []
    real = vector_codes._distances
    try:
        vector_codes._distances = lambda p, *a: seen.append(len(p)) or real(p, *a)
        books = np.tile(np.arange(40)[None, :, None] * 2560, (16, 1, 1))
        vector_codes._Trees(row, 1).assigned(books)
    finally:
        vector_codes._distances = real
    assert sum(seen) < 16 * 2000 / 4


# --- token records ---------------------------------------------------------------------------

def plain_crc(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    crc ^= 0xFFFFFFFF
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def test_checksums():
    rng = np.random.default_rng(7)
    parts = [b"123456789", b"", b"\0" * 5, *(rng.bytes(n) for n in (1, 8, 63, 64, 65, 127, 128, 1000, 5000))]
    assert token_records.masked_crc(parts).tolist() == [plain_crc(p) for p in parts]
    assert token_records.masked_crc([]).tolist() == []


def wanted_records(docs):
    tokenizer = Tokenizer.from_file(PATH)
    rows = []
    for r in docs.collect():
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        rows.append((r["doc_id"], ids))
    return rows


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_records_come_back_in_both_orders(request, spark, tmp_path, table):
    docs = request.getfixturevalue(table)
    folder = str(tmp_path / "records")
    manifest = token_records.write_records(docs, folder, PATH)
    got = token_records.read_records(spark, folder).collect()
    want = wanted_records(docs)
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in got), key=repr) == sorted(want, key=repr)
    # Starts follow each other without a gap, ids ascend and null ids come last.
    got.sort(key=lambda r: r["start"])
    keys = [r["doc_id"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is None, k))
    at = 0
    for r in got:
        assert r["start"] == at
        at += len(r["ids"]) // 4
    assert manifest.agg(F.sum("tokens")).first()[0] == at and manifest.agg(F.sum("records")).first()[0] == len(want)
    index = {(r["start"], r["length"]) for r in token_records.read_index(spark, folder).collect()}
    assert len(index) == len(want)
    orders = [[(r["start"], r["doc_id"], bytes(r["ids"])) for r in token_records.read_shuffled(spark, folder, seed).collect()]
              for seed in (1, 1, 2)]
    assert orders[0] == orders[1] != orders[2]
    assert sorted(orders[0]) == sorted(orders[2]) == [(r["start"], r["doc_id"], bytes(r["ids"])) for r in got]


def test_files_have_the_frames_of_record_readers(spark, tmp_path):
    docs = spark.createDataFrame([(5, "one two"), (3, None), (4, "x" * 3000)], "doc_id bigint, text string")
    folder = str(tmp_path / "records")
    names = sorted(r["file"] for r in token_records.write_records(docs, folder, PATH).collect())
    seen = []
    for name in names:
        data = (tmp_path / "records" / f"{name}.rec").read_bytes()
        places = np.frombuffer((tmp_path / "records" / f"{name}.idx").read_bytes(), "<u8").reshape(-1, 3)
        at, listed = 0, []
        while at < len(data):
            size = int.from_bytes(data[at:at + 8], "little")
            payload = data[at + 12:at + 12 + size]
            assert int.from_bytes(data[at + 8:at + 12], "little") == plain_crc(data[at:at + 8])
            assert int.from_bytes(data[at + 12 + size:at + 16 + size], "little") == plain_crc(payload)
            listed.append((at, size))
            seen.append(int.from_bytes(payload[:8], "little"))
            at += size + 16
        assert listed == [tuple(p) for p in places[:, :2].tolist()]
    assert seen == [3, 4, 5]


def test_damage_is_found_and_leftovers_are_not_read(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(50)], "doc_id bigint, text string")
    folder = tmp_path / "records"
    token_records.write_records(docs, str(folder), PATH)
    (folder / "part-000000-of-a-lost-attempt.rec").write_bytes(b"half a record")
    assert token_records.read_records(spark, str(folder)).count() == 50
    name = next(f for f in sorted(folder.glob("part-*.rec")) if "lost" not in f.name)
    data = bytearray(name.read_bytes())
    data[30] ^= 1
    name.write_bytes(data)
    with pytest.raises(Exception, match="damaged record"):
        token_records.read_records(spark, str(folder)).count()


def test_ids_beyond_sixteen_bits_and_long_records(monkeypatch):
    monkeypatch.setattr(token_records, "BLOCK_BYTES", 100)
    ids = [np.arange(n, dtype="<u4").tobytes() for n in (0, 3, 70, 1)]
    frames = token_records._framed([1, None, 3, -4], [4] * 4, ids)
    import io
    back = [p for block in token_records._frames(io.BytesIO(b"".join(frames)), "x") for p in token_records._payloads(block, "x")]
    rows = token_records._rows(back, [0] * 4).to_pydict()
    assert rows["doc_id"] == [1, None, 3, -4] and rows["ids"] == ids
    with pytest.raises(ValueError, match="within a record"):
        list(token_records._frames(io.BytesIO(b"".join(frames)[:-1]), "x"))


def test_no_records(spark, tmp_path, nothing):
    folder = str(tmp_path / "records")
    assert token_records.write_records(nothing, folder, PATH).count() == 0
    assert token_records.read_records(spark, folder).count() == 0 == token_records.read_shuffled(spark, folder).count()


# --- collocations ----------------------------------------------------------------------------

def brute_phrases(rows, least, most=2000):
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(fold)):
            words = tuple(w for w in re.split("[ \t]+", piece) if w)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, words[i:i + k]] += 1
    found = {}
    for (lang, g), a in f.items():
        if len(g) > 1 and a >= least:
            cuts = [(2_000_000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            found[lang, g] = (a, f[lang, g[:k]], f[lang, g[k:]], score)
    longest = Counter()
    for (lang, g), (a, *_) in found.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                longest[lang, g[i:i + k]] = max(longest[lang, g[i:i + k]], a)
    out = []
    for lang in n:
        mine = [(-s, -a, " ".join(g).encode(), l, r) for (x, g), (a, l, r, s) in found.items()
                if x == lang and 100 * longest[x, g] < 80 * a]
        for rank, (s, a, phrase, l, r) in enumerate(sorted(mine)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def phrases(docs, least, most=2000):
    return sorted(tuple(r) for r in collocations.collocations(docs, least, most=most).collect())


def made_texts(seed=9, count=300):
    """Texts with frequent phrases, runs of one word, hot nodes, odd blanks and letters beyond ASCII."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "ÀB", "naïve", "日本", "🙂x", "a b", "A", "the"]
    rows = []
    for i in range(count):
        chosen = [words[j] for j in np.minimum(rng.geometric(0.12, 60) - 1, len(words) - 1)]
        text = " ".join(chosen[:20]) + rng.choice([". ", ",", "\n", "\t", " \x0b", " "]) + " ".join(chosen[20:])
        text += " the big red fox" + ("; the big red" if i % 3 else " of the big red fox") + " na" * (i % 6) + f" hot node here x{i}"
        rows.append((i, text, [None, "de", "en", "und", "en", "en"][i % 6]))
    return rows + [(1000, None, "en"), (1001, "", None), (1002, " \t\n..", "fr"), (1003, "x" * 5000, "en")] + [rows[0]] * 3


@pytest.mark.parametrize("least, hot, chunk", [(5, 64, 1 << 19), (5, 3, 200), (2, 2, 1000), (30, 64, 5000)])
def test_phrases_are_those_of_brute_force(spark, monkeypatch, least, hot, chunk):
    monkeypatch.setattr(collocations, "HOT", hot)
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    rows = made_texts()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("f", F.lit("x")).withColumn("w1", F.lit(1))
    got = phrases(docs.repartition(3), least)
    assert got == brute_phrases([(lang, text) for _, text, lang in rows], least)
    assert len(got) > 5


def test_best_phrases_with_ties(spark):
    rows = [(i, f"a{i % 7} b{i % 7}. c{i % 5} d", "en") for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert phrases(docs, 5, most=4) == brute_phrases([(l, t) for _, t, l in rows], 5, most=4)


def test_a_long_text_is_worked_on_in_windows(spark, monkeypatch):
    text = "the big red fox ran home, it was late. " * 70_000 + "one two " * 200_000
    docs = spark.createDataFrame([(1, text, "en"), (2, "the big red", "en")], "doc_id bigint, text string, lang string")
    offsets, data = np.array([0, len(text)]), np.frombuffer(text.encode(), np.uint8)
    windows = list(collocations._split(offsets, data))
    assert len(windows) == 3 and b"".join(d.tobytes() for _, d in windows) == text.encode()
    assert phrases(docs, 30) == brute_phrases([("en", text), ("en", "the big red")], 30)


def test_a_full_map_of_pairs_takes_nothing(spark, monkeypatch):
    """With few bits nearly every pair shares one with a frequent pair; nothing is cut and nothing changes."""
    monkeypatch.setattr(collocations, "MAP_BITS", 8)
    rows = made_texts(count=120)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert phrases(docs, 3) == brute_phrases([(lang, text) for _, text, lang in rows], 3)


def test_no_phrases(spark, nothing, odd):
    assert phrases(nothing, 30) == []
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    assert phrases(odd, 2) == brute_phrases(rows, 2)
