import zlib

import numpy as np

from stayput.llm import language, quality
from stayput.llm.common import read
from tests.conftest import SF01
from tests.llm.edge import rows, stored


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 1


def walk(trees, x):
    out = trees.base
    for root in trees.roots:
        at = root
        while trees.left[at] != at:
            at = trees.left[at] + (x[trees.feature[at]] > trees.cut[at])
        out += trees.value[at]
    return out


def test_flat_trees_equal_plain_walk_and_learn():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.fit(x[:400], y[:400], trees=40)
    assert np.allclose(model.margin(x), [walk(model, r) for r in x])
    assert ((model.score(x) >= 0.5) == y)[400:].mean() > 0.9
    one = quality.fit(x, np.ones(600))
    assert (one.score(x) > 0.99).all()
    assert quality.fit(np.empty((0, 5)), np.empty(0)).score(x)[0] == 0.5


def test_quality_held_out(spark):
    docs, labels = read(spark, SF01, "documents"), read(spark, SF01, "labels")
    got = {r.id: r for r in quality.score(docs, quality.train(docs, labels)).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(got) == docs.count() and all(r.held_out == held(i) for i, r in got.items())
    right = [(got[i].predicted == q) for i, q in truth.items() if held(i) and i in got]
    assert np.mean(right) >= 0.97
    kept = quality.accepted(docs, quality.train(docs, labels))
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got.values())


def test_quality_edges(spark, tmp_path):
    docs = stored(spark, tmp_path / "d")
    labels = spark.createDataFrame([(0, 1), (3, 0), (4, None), (None, 1), (6, 1), (6, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    out = quality.accepted(docs, model)
    assert out.columns == docs.columns and out.where("_uid != 'mine'").count() == 0
    empty = stored(spark, tmp_path / "e", [])
    assert quality.score(empty, quality.train(empty, labels.limit(0))).count() == 0


def test_language_held_out(spark):
    docs = read(spark, SF01, "documents")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language.identify(docs, language.train(docs)).collect()
    assert len(got) == len(truth) and all(r.held_out == held(r.id) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == truth[r.id] for r in got if r.held_out]) >= 0.95


def test_language_edges(spark, tmp_path):
    docs = stored(spark, tmp_path / "d")
    got = language.identify(docs, language.train(docs)).collect()
    assert len(got) == len(rows())
    text = {i: t for i, t, *_ in rows() if i is not None}
    for r in got:
        if r.id is not None:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text[r.id] or "")), text[r.id]
    empty = stored(spark, tmp_path / "e", [])
    assert language.identify(empty, language.train(empty)).count() == 0
    assert {r.lang_pred for r in language.identify(docs, language.train(empty)).collect()} == {"und"}


def test_presence_is_set_of_hashed_grams():
    a, b = language.presences(["abab", "ab ab"])
    assert set(a) <= {0.0, 1.0} and a.sum() > 5 and not (a == b).all()


def test_top_word_is_the_most_frequent_one_at_any_size():
    at = quality.FEATURES.index("top_word")
    few = " ".join(["spam"] * 5000 + [f"longerword{i}" for i in range(9)])
    assert quality.statistics(few)[at] == 5000 / 5009
    assert quality.statistics("a a a b longest")[at] == 3 / 5


def test_every_language_is_learned(spark, tmp_path):
    data = [(i, "".join(chr(0x4E00 + 8 * (i % 230) + k % 8) for k in range(20)), f"l{i % 230:03}", "s", 20) for i in range(230 * 6)]
    docs = stored(spark, tmp_path / "d", data, clash=False)
    model = language.train(docs)
    learned = {r[2] for r in data if not held(r[0])}
    assert len(learned) > 200 and set(model.names) == learned
    names, _ = model.decide([r[1] for r in data[:230]])
    assert np.mean([a == r[2] for a, r in zip(names, data)]) > 0.9


def test_distributed_sums_equal_one_dense_regression(spark, tmp_path):
    rng = np.random.default_rng(3)
    words = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["foo", "bar", "bazqux"], "cc": ["xyzzy", "plugh", "lorem"]}
    data = [(i, " ".join(rng.choice(words[x], 6)), x, "s", 0) for i, x in enumerate(rng.choice(["aa", "aa", "bb", "cc"], 300))]
    docs = stored(spark, tmp_path / "d", data)
    model = language.train(docs.repartition(5))
    learned = [d for d in data if not held(d[0])]
    assert model.names == ["aa", "bb", "cc"] and len(model.flags) <= 3 * language.LANDMARKS
    x = language.presences([d[1] for d in learned])
    phi = (x / np.sqrt(x.sum(axis=1, keepdims=True))) @ model.landmarks.T @ language.nystrom(model.landmarks)
    y = np.array([model.names.index(d[2]) for d in learned])
    weight = (len(y) / (3 * np.bincount(y)))[y][:, None]
    target = np.where(y[:, None] == np.arange(3), 1.0, -1.0)
    mean, goal = (weight * phi).sum(0) / weight.sum(), (weight * target).sum(0) / weight.sum()
    p = phi - mean
    w = np.linalg.solve((weight * p).T @ p + 0.1 * np.eye(phi.shape[1]), (weight * p).T @ (target - goal))
    want = phi @ w + goal - mean @ w
    got = (x / np.sqrt(x.sum(axis=1, keepdims=True))) @ model.landmarks.T @ model.weights + model.bias
    assert np.allclose(got, want, atol=1e-3) and (want.argmax(axis=1) == y).mean() > 0.95


def test_two_hundred_languages_stay_small_on_the_driver(spark, tmp_path):
    import tracemalloc

    rng = np.random.default_rng(4)
    data = [(i, "".join(map(chr, 0x4E00 + 8 * (i % 200) + rng.integers(0, 8, 60))), f"l{i % 200:03}", "s", 60) for i in range(200 * 40)]
    docs = stored(spark, tmp_path / "d", data, clash=False)
    tracemalloc.start()
    model = language.train(docs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.names) == 200 and len(model.flags) <= language.ALL_LANDMARKS and peak < 1 << 30, peak
    names, _ = model.decide([r[1] for r in data[:200]])
    assert np.mean([a == r[2] for a, r in zip(names, data)]) > 0.9
