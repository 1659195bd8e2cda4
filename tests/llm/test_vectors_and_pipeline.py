import numpy as np
import pytest

import corpus_pipeline
from marginalia.llm import common, near_vectors, quality


def brute(rows):
    usable = [(k, np.array(v, float)) for k, v in rows
              if k is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = {k: 0 for k, _ in rows}
    parent = {k: k for k, _ in usable}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, v) in enumerate(usable):
        for b, w in usable[:i]:
            if len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.9:
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return links, {k: root(k) if k in parent else k for k, _ in rows}


@pytest.mark.parametrize("piece", [1024, 7])
def test_near_vectors(spark, monkeypatch, piece):
    monkeypatch.setattr(near_vectors, "PIECE", piece)
    rng = np.random.default_rng(8)
    rows = []
    for group in range(12):
        centre = rng.normal(size=16)
        rows += [(len(rows) + i, (centre + 0.05 * rng.normal(size=16)).astype("f4").tolist()) for i in range(group + 1)]
    rows += [(500 + i, rows[3][1]) for i in range(30)]
    rows += [(600, None), (601, []), (602, [0.0] * 16), (603, [float("nan")] * 16), (604, [1.0, None]), (None, rows[3][1]),
             (605, [1.0, 2.0]), (606, [2.0, 4.0]), (607, [float("inf")] * 16)]
    docs = spark.createDataFrame([(k, v, 1, "x") for k, v in rows], "vec_id bigint, embedding array<float>, label int, node string")
    got = near_vectors.near_vectors(docs).collect()
    assert len(got) == len(rows)
    links, component = brute(rows)
    for r in got:
        if r["vec_id"] is None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, None, False)
            continue
        assert r["n_links"] == links[r["vec_id"]]
        assert r["component_id"] == component[r["vec_id"]]
        assert r["kept"] == (r["vec_id"] == r["component_id"])


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert near_vectors.near_vectors(none).count() == 0


def test_recall_on_the_table(spark, folder):
    table = common.table(spark, folder, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    links, _ = brute(rows)
    got = near_vectors.near_vectors(table).collect()
    assert all(r["n_links"] <= links[r["vec_id"]] for r in got)
    assert sum(r["n_links"] for r in got) >= 0.9 * sum(links.values())


def test_recall_on_the_larger_table(spark):
    table = common.table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    v = np.array([x for _, x in rows], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    links = (v @ v.T >= 0.9).sum(1) - 1
    got = {r["vec_id"]: r["n_links"] for r in near_vectors.near_vectors(table).collect()}
    assert all(got[k] <= n for (k, _), n in zip(rows, links))
    assert sum(got.values()) >= 0.9 * links.sum()


def test_doubles_are_compared_as_doubles(spark):
    # Their cosine passes the bar as doubles and fails it as floats, or the other way round.
    def at(cosine):
        return [cosine, float(np.sqrt(1 - cosine * cosine)), 0.0]

    near, far = at(0.9 + 1e-12), at(0.9 - 1e-12)
    rows = [(1, [1.0, 0.0, 0.0]), (2, near), (11, [1e300, 0.0, 1e300]), (12, [2e300, 0.0, 2e300]), (13, [1e-310, 0.0, 1e-310])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in near_vectors.near_vectors(table, recall=0.999999).collect()}
    assert got[1] == got[2] == 1 and got[11] == got[12] == 2
    table = spark.createDataFrame([rows[0], (2, far)], "vec_id bigint, embedding array<double>")
    assert [r["n_links"] for r in near_vectors.near_vectors(table).collect()] == [0, 0]


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in common.components(edges, common.Steps(spark, "test"), "path").collect()}
    assert got == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


def test_stages(spark, folder, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    docs, seen = documents, {}
    steps = common.Steps(spark, "stages")
    for name, stage in corpus_pipeline.STAGES:
        docs = steps.keep(stage(spark, docs, folder), name)
        seen[name] = docs
    assert all(seen[n].columns == documents.columns for n in list(seen)[:-1])
    ids = {n: [r["doc_id"] for r in d.select("doc_id").collect()] for n, d in seen.items()}
    scores = quality.quality(documents, common.table(spark, folder, "labels")).where("predicted = 1")
    assert sorted(ids["quality"]) == sorted(r["doc_id"] for r in scores.collect())
    texts = [" ".join((r["text"] or "").split()) for r in seen["exact_dedup"].collect()]
    assert len(set(texts)) == len(texts)
    assert set(texts) == {" ".join((r["text"] or "").split()) for r in seen["quality"].collect()}
    assert set(ids["near_dedup"]) <= set(ids["exact_dedup"]) and len(ids["near_dedup"]) > 0
    taken = seen["packing"].groupBy("sequence_id").sum("length").toPandas()["sum(length)"]
    assert taken.max() <= 4096 and len(ids["packing"]) >= len(ids["mixing"])
    again = corpus_pipeline.run(spark, folder).toPandas()
    assert again["length"].sum() == taken.sum()


def test_the_rest_does_not_need_the_subpackage():
    from pathlib import Path
    root = Path(__file__).resolve().parents[2]
    for file in (root / "marginalia").rglob("*.py"):
        if "llm" not in file.parts:
            assert "llm" not in file.read_text(), file


def test_links_without_a_smaller_end_in_common(spark):
    """Of three vectors only the middle one links with both others, whichever number each of them gets."""
    turn = lambda t, degrees: [0.0] * 2 * t + [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))] + [0.0] * (38 - 2 * t)
    rows = [(3 * t + i, turn(t, degrees)) for t in range(20) for i, degrees in enumerate((0, 40, 20))]
    got = near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    for r in got:
        assert r["component_id"] == r["vec_id"] // 3 * 3
        assert r["n_links"] == (2 if r["vec_id"] % 3 == 2 else 1)


def test_components_of_a_unit():
    a, b = np.array([3, 3, 5, 6]), np.array([1, 2, 6, 4])
    assert near_vectors._smallest(8, a, b).tolist() == [0, 1, 1, 1, 4, 4, 4, 7]
    chain = np.random.default_rng(3).permutation(500)
    assert (near_vectors._smallest(500, chain[:-1], chain[1:]) == 0).all()
