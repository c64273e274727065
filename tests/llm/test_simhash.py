import re

import numpy as np
import pytest
import xxhash

from stayput.llm import simhash
from stayput.llm.components import connected_components
from tests.llm.edge import TEXTS, components, rows, stored


def slow(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_matches_definition():
    for t in TEXTS:
        assert simhash.fingerprint(t) == slow(t)


@pytest.mark.parametrize("layout", [(3, 4), (2, 5), (4, 4)])
def test_anchors_meet_every_near_pair(layout):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 300, dtype=np.int64)
    y = x.copy()
    for k in range(len(x)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            y[k] ^= np.int64(np.uint64(1 << int(bit)).astype(np.int64))
    homes, reach = [set() for _ in x], [set() for _ in x]
    for key, row, home in simhash.anchors(x, 4, *layout):
        for k, r, h in zip(key.tolist(), row.tolist(), home.tolist()):
            if h:
                homes[r].add(k)
    for key, row, _ in simhash.anchors(y, 4, *layout):
        for k, r in zip(key.tolist(), row.tolist()):
            reach[r].add(k)
    assert all(len(h) == layout[0] for h in homes)
    assert all(h & r for h, r in zip(homes, reach))


@pytest.mark.parametrize("home_rows", [4096, 3])
def test_links_match_brute_force(spark, home_rows, monkeypatch):
    monkeypatch.setattr(simhash, "HOME_ROWS", home_rows)
    rng = np.random.default_rng(5)
    centers = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = {0}
    for c in centers.tolist():
        for _ in range(rng.integers(1, 30)):
            x = c
            for bit in rng.choice(64, rng.integers(0, 6), replace=False):
                x ^= 1 << int(bit)
            fps.add(x)
    fps = sorted(np.array(sorted(fps), np.uint64).view(np.int64).tolist())
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j] & (2**64 - 1)).bit_count() <= 4
             or ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 4]
    want = {fps[i]: fps[r] for i, r in enumerate(components(len(fps), links)) if any(i in p for p in links)}
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {r.node: r.root for r in connected_components(simhash.fingerprint_links(df)).collect()}
    assert got == want


def test_documents_with_edges(spark, tmp_path):
    docs = stored(spark, tmp_path / "d")
    got = simhash.near_duplicates(docs).collect()
    data = rows()
    fps = [slow(t) for _, t, *_ in data]
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    root = components(len(fps), links)
    least = {}
    for i, r in enumerate(root):
        if data[i][0] is not None:
            least[r] = min(least.get(r, 1 << 60), data[i][0])
    want = sorted(((d[0], least.get(root[i])) for i, d in enumerate(data)), key=str)
    assert sorted(((r.id, r.component_id) for r in got), key=str) == want
    out = simhash.deduplicate(docs)
    assert out.columns == docs.columns and out.count() == len(set(root)) == sum(r.kept for r in got)
    assert simhash.near_duplicates(stored(spark, tmp_path / "e", [])).count() == 0


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3), (500, 400)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(60)}, 500: 400, 400: 400}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
