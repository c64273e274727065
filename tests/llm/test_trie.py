import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from stayput.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(data):
    own = defaultdict(list)
    for c, turn, role, text in data:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        full[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, seq in full.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    sum(len(n) == len(node) + 1 for n in below),
                    sum(not any(m[:len(n)] == n and len(m) > len(n) for m in below) for n in below),
                    sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                    hashlib.sha256(",".join(map(str, sorted(c for c in convs if len(full[c]) == len(node)))).encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, path, data):
    df = spark.createDataFrame(data, SCHEMA)
    for name in ("c", "d", "kind", "i", "part", "digest", "cp", "base", "h"):
        df = df.withColumn(name, F.lit("mine"))
    df.write.parquet(str(path))
    got = trie.prefix_trie(spark.read.parquet(str(path)))
    return sorted([(r.conv_id, r.d, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved, r.sha) for r in got.collect()], key=str)


def made(seed):
    rng = random.Random(seed)
    data = []
    for c in [*range(0, 60), *range(200, 230), 100, 305, 307, -3, -100, -250, None]:
        for turn in range(rng.randint(1, 7)):
            data.append((c, rng.choice([turn, turn, turn, None]) if c != 100 else turn, rng.choice(["user", "assistant", None]) if turn > 1 else "system",
                         rng.choice(["a", "bb", None, "", "é" * 5, "x" * 2000]) if turn else rng.choice(["p", "q"])))
    return data


def test_nodes_match_brute_force(spark, tmp_path):
    data = made(3)
    # ties of turn and role are ordered by digest, so the brute force gets none
    data = sorted({(c, t, r): (c, t, r, x) for c, t, r, x in data}.values(), key=str)
    data = [d for k, d in enumerate(data) if d[1] is not None or not any(e[0] == d[0] and e[1] is None and e[2] in (d[2], None, "") and e is not d for e in data[:k])]
    data = list({(c, t, r or ""): (c, t, r, x) for c, t, r, x in data}.values())
    assert found(spark, tmp_path / "a", data) == brute(data)


def test_one_long_conversation_over_many_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trie, "RANGE_ROWS", 40)
    data = [(c, t, "user", f"{t % 5} {c % 2 if t > 250 else 0}") for c in (7, 8, 9, 107) for t in range(300 if c < 100 else 3)]
    data += [(c, t, "user", "same") for c in range(400, 460) for t in range(6)]
    assert found(spark, tmp_path / "a", data) == brute(data)


def test_repeated_rows_pieces_and_crowded_nodes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 10)
    monkeypatch.setattr(trie, "MANY_CHILDREN", 2)
    data = [(c, t, "user", "hello") for c in range(600, 650) for t in (1, 1, 2)]
    data += [(c, 0, "user", f"{c % 7}") for c in range(800, 850)] + [(c, 9, "user", f"last {c}") for c in range(800, 850) for _ in range(8)]
    assert found(spark, tmp_path / "a", data) == brute(data)


def test_empty_and_turnless(spark, tmp_path):
    assert found(spark, tmp_path / "a", []) == [] and found(spark, tmp_path / "b", [(None, 1, "user", "x")]) == []
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 3)
    assert found(spark, tmp_path / "c", [(c, 0, "user", "x")]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
