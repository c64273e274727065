import re
from collections import defaultdict

import pytest

from stayput.llm import mixing
from tests.llm.edge import rows, stored


def targets(sizes, weights=(5.0, 2.0, 1.0), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        unit = left / sum(w[s] for s in open_)
        full = {s for s in open_ if unit * w[s] > most * sizes[s]}
        if not full:
            out.update({s: unit * w[s] for s in open_})
            break
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def check(spark, docs, data):
    got = mixing.mix(docs).collect()
    assert len(got) == len(data)
    by = {(d[0], d[1], d[3]): d for d in data}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for _, t, _, s, _ in data:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for d in data:
        assert d[0] is None or (d[0], d[1], d[3]) in by
    for r in got:
        s = next(d[3] for d in data if d[0] == r.id and (d[0] is not None or len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or "")) == r.size))
        taken[s] += r.taken
        target[s] = r.target
        assert r.source_size == sizes[s] and 0 <= r.taken <= 2 * r.size
    want = targets(dict(sizes))
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 1
    return got


def test_edges(spark, tmp_path):
    docs = stored(spark, tmp_path / "d")
    check(spark, docs, rows())
    assert mixing.mix(stored(spark, tmp_path / "e", [])).count() == 0


def test_sources_and_reruns(spark, tmp_path):
    data = [(i, "w " * (1 + i * i % 37), "en", f"s{i % 7 if i % 3 else 0}", 0) for i in range(900)]
    docs = stored(spark, tmp_path / "d", data, clash=False)
    a = sorted((r.id, r.taken) for r in check(spark, docs, data))
    again = stored(spark, tmp_path / "f", data[::-1], clash=False)
    assert a == sorted((r.id, r.taken) for r in mixing.mix(again).collect())
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    words = defaultdict(int)
    for r in out.collect():
        n = len(r.text.split())
        words[r.doc_id] += n
        assert r.n_chars in (0, len(r.text))
    assert sorted(words.items()) == [x for x in a if x[1]]


def test_word_count(spark):
    texts = [None, "", " ", "a", " a  b\x0b\x0cc d ", "\n\n", "x y"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.word_count().alias("n"), "text")
    for r in df.collect():
        assert r.n == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
