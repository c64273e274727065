import numpy as np
import pytest

from stayput.llm import embeddings
from tests.llm.edge import components

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(data):
    links = []
    for i, (_, a, _) in enumerate(data):
        for j, (_, b, _) in enumerate(data[:i]):
            if a is None or b is None or len(a) != len(b) or not a or None in a or None in b:
                continue
            x, y = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
            if not (np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any()):
                continue
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                links.append((i, j))
    root = components(len(data), links)
    n = np.bincount(np.array(links, int).ravel(), minlength=len(data)) if links else np.zeros(len(data), int)
    least = {}
    for i, r in enumerate(root):
        least[r] = min(least.get(r, 1 << 60), data[i][0])
    return sorted((d[0], int(n[i]), least[root[i]]) for i, d in enumerate(data))


@pytest.mark.parametrize("block_rows", [4096, 40])
def test_matches_brute_force(spark, tmp_path, block_rows):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(25, 12))
    data = []
    for c in centers:
        for _ in range(rng.integers(1, 15)):
            data.append((c + rng.normal(size=12) * rng.choice([0.0, 0.05, 0.25])).tolist())
    data += [[0.0] * 12, None, [], [float("nan")] * 12, [float("inf")] + [1.0] * 11, [1.0] * 11 + [None], [1.0, 2.0], [2.0, 4.0], [3.0]]
    order = rng.permutation(len(data))
    rows = [(int(i), data[k], int(i) % 3) for i, k in enumerate(order)]
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(str(tmp_path / "v"))
    got = embeddings.near_duplicates(spark.read.parquet(str(tmp_path / "v")), block_rows=block_rows).collect()
    assert sorted((r.id, r.n_links, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.id == r.component_id) for r in got)


def test_edges(spark, tmp_path):
    for name, rows in (("a", []), ("b", [(1, None, 0), (None, [0.0], 0)]), ("c", [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [2.0, 0.0], None)])):
        spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / name))
        got = sorted((r.id or -1, r.n_links, r.component_id or -1) for r in embeddings.near_duplicates(spark.read.parquet(str(tmp_path / name))).collect())
        assert got == {"a": [], "b": [(-1, 0, -1), (1, 0, 1)], "c": [(1, 2, 1), (1, 2, 1), (2, 2, 1)]}[name]


def test_tree_levels_nest_and_cover():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(10, 6)).repeat(12, axis=0) + rng.normal(size=(120, 6)) * 0.1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    t = embeddings.Tree.from_bytes(embeddings.Tree.build(x, np.ones(120, int), np.arange(120)).to_bytes())
    for (s, e, r), bound in zip(t.levels, embeddings.RADII):
        assert (r <= bound + 1e-9).all() and s[0] == 0 and e[-1] == 120 and (s[1:] == e[:-1]).all()
    for (s, _, _), (u, _, _) in zip(t.levels, t.levels[1:]):
        assert set(s.tolist()) <= set(u.tolist())
