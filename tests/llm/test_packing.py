import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stayput.llm import packing
from tests.llm.edge import TEXTS, rows, stored

ENCODER = packing.Encoder(packing.default_tokenizer())


def plain(text):
    ids = ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u2").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=20), st.sampled_from(["don't", " \x1c", " ", "<|endoftext|>", "İ̇", "Café,", "é", "​", "12a!"])), max_size=8))
def test_encoder_equals_tokenizer(parts):
    text = "".join(parts).encode("utf-8", "replace").decode()
    assert ENCODER.encode(text) == plain(text)


def test_encoder_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 40)
    monkeypatch.setattr(packing, "PIECES", 30)
    monkeypatch.setattr(packing, "RECENT", 10)
    monkeypatch.setattr(packing, "CHUNK", 30)
    e = packing.Encoder(packing.default_tokenizer())
    texts = [*TEXTS, " ".join(f"Ab{i}, cd{i % 13}" for i in range(200))]
    for _ in range(2):
        assert e.encode_all(texts) == [plain(t) for t in texts]
    spaced = ["x\u00a0y\u2003z\u3000w\u2014v\u1680 end\x85", "q" * 100, "one " + "r" * 90 + " two"]
    assert [b for t in spaced for b in e.encode_all([t])] == [plain(t) for t in spaced]


def test_hilbert_neighbours():
    g = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = packing.hilbert_key(g, 3)
    assert sorted(key) == list(range(512))
    assert (np.abs(np.diff(g[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def check(pieces, data):
    want = defaultdict(int)
    for i, t, *_ in data:
        want[i, len(plain(t)) // 2 + 1] += 1
    ids = {i: np.append(np.frombuffer(plain(t), "<u2"), packing.END_ID).astype("<u4") for i, t, *_ in data if i is not None}
    covered, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        covered[p.id, p.doc_tokens].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
        if p.id is not None:
            assert p.ids_crc32 == zlib.crc32(ids[p.id][p.start:p.start + p.length].tobytes())
    assert set(covered) == set(want)
    for k, parts in covered.items():
        assert sum(n for _, n in parts) == k[1] * want[k]
        if want[k] == 1:
            at = 0
            for start, n in sorted(parts):
                assert start == at
                at += n
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= packing.LENGTH
    if sequences:
        assert sorted(sequences) == list(range(len(sequences)))
        assert all(sum(n for _, n in s) == packing.LENGTH for q, s in sequences.items() if q + 1 < len(sequences))


def test_pieces(spark, tmp_path):
    check(packing.pack(stored(spark, tmp_path / "d")).collect(), rows())
    assert packing.pack(stored(spark, tmp_path / "e", [])).count() == 0
    data = [(i, f"word{i} " * (i * 31 % 700), "en", "s", 0) for i in range(200)]
    check(packing.pack(stored(spark, tmp_path / "f", data, clash=False)).collect(), data)
