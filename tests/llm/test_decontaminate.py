import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from stayput.llm import decontaminate, words
from tests.llm.edge import LONG, rows, stored

ITEM = "item_id long, text string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def cut(text):
    return WORD.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def brute(data, items):
    spans = {}
    for item, text in items:
        w = cut(text)
        m = min(len(w), 10)
        for a in range(len(w) - m + 1) if w else ():
            spans.setdefault(tuple(w[a:a + m]), set()).add("" if item is None else str(item))
    out = []
    for i, text, *_ in data:
        w, hit, found = cut(text), set(), set()
        for m in {len(s) for s in spans}:
            for a in range(len(w) - m + 1):
                if tuple(w[a:a + m]) in spans:
                    hit |= set(range(a, a + m))
                    found |= spans[tuple(w[a:a + m])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, path, data, items):
    docs = stored(spark, path / "d", data)
    table = spark.createDataFrame(items, ITEM)
    for c in ("item", "m", "body", "size", "tokens", "w"):
        table = table.withColumn(c, F.lit("mine"))
    table.write.parquet(str(path / "i"))
    got = decontaminate.contamination(docs, spark.read.parquet(str(path / "i")))
    return sorted([(r.id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got.collect()], key=str)


def made(seed):
    rng = random.Random(seed)
    letters = [*"abcde", "É", "ß9", "Zz", "x" * 90, "x" * 89 + "y"]
    items = [(k, " ".join(rng.choices(letters, k=rng.choice([1, 2, 3, 4, 5, 7, 9, 10, 11, 14, 30])))) for k in range(25)]
    items = [x for x in items if len(x[1].split()) > 4 or x[0] < 3]
    items += [(50, None), (51, ""), (52, " .,"), (None, "of a null id " * 3), (3, "Copy, of: THE same-words a b"), (99, "copy of the same words a b"), (99, "twice")]
    data = []
    for k in range(60):
        parts = [rng.choice([" ".join(rng.choices(letters, k=rng.randint(1, 30))), rng.choice(items)[1] or "", "of a null id of a null id of a"]) for _ in range(rng.randint(0, 4))]
        data.append((k, rng.choice([", ", "\n", " "]).join(parts).upper() if k % 3 else "  ".join(parts), "en", "s", 0))
    return data, items


@pytest.mark.parametrize("limit", [100_000, 0])
def test_matches_brute_force(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    data, items = made(5)
    assert any(b[2] for b in brute(data, items)) and not all(b[2] for b in brute(data, items))
    assert found(spark, tmp_path, data, items) == brute(data, items)


def test_edges(spark, tmp_path):
    items = [(1, "quick brown fox jumps"), (2, LONG[5000:9000]), (3, "nothing of this stands in any document at all"), (4, "a bc")]
    assert found(spark, tmp_path, rows(), items) == brute(rows(), items)


def test_no_items_and_no_documents(spark, tmp_path):
    assert found(spark, tmp_path, [], [(1, "a")]) == []
    (tmp_path / "x").mkdir()
    got = found(spark, tmp_path / "x", rows(), [])
    assert got == brute(rows(), []) and all(r[2] == r[3] == 0 for r in got)


def test_words_of_texts_do_not_run_together():
    import numpy as np

    texts = ["ab", "cd e", "", "É1", "f" * 200, "f" * 199 + "g"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    got = words.Words(data, offsets)
    assert [got.joined(k, k + 1) for k in range(len(got.start))] == ["ab", "cd", "e", "É1", "f" * 200, "f" * 199 + "g"]
    assert got.count.tolist() == [1, 2, 0, 1, 1, 1] and len(set(got.hashes().tolist())) == 6
    assert got.shingles(got.hashes(), 2)[0].tolist() == [1]
