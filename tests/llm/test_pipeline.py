import re
from collections import defaultdict

import corpus_pipeline
from stayput.llm import quality, simhash
from stayput.llm.common import read
from tests.conftest import SF001
from tests.llm import test_mixing, test_packing
from tests.llm.edge import components, rows, stored


def stages(spark, docs, sf, base):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        out.append(docs)
    return out


def one_of_each(data, root):
    """Of each group of (id, text) rows, the one that exact dedup or SimHash keeps; ids are distinct here."""
    best = {}
    for i, r in enumerate(root):
        best[r] = min(best.get(r, (1, 1 << 60)), data[i])
    return {x[-1] for x in best.values()}


def test_stages_match_brute_force(spark, tmp_path):
    docs = read(spark, SF001, "documents")
    good, exact, near, mixed, packed = stages(spark, docs, SF001, tmp_path)
    scores = quality.score(docs, quality.train(docs, read(spark, SF001, "labels"))).where("predicted = 1")
    assert {r.doc_id for r in good.collect()} == {r.id for r in scores.collect()}
    assert good.columns == exact.columns == near.columns == mixed.columns == docs.columns

    data = [(r.doc_id, r.text) for r in good.collect()]
    groups = defaultdict(list)
    for i, t in data:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i))
    assert {r.doc_id for r in exact.collect()} == {min(g)[1] for g in groups.values()}

    data = [(r.doc_id, r.text) for r in exact.collect()]
    fps = [simhash.fingerprint(t) for _, t in data]
    root = components(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    assert {r.doc_id for r in near.collect()} == one_of_each([(0, i) for i, _ in data], root)

    sizes, taken, source = defaultdict(int), defaultdict(int), {}
    for r in near.collect():
        source[r.doc_id] = r.source
        sizes[r.source] += len(r.text.split())
    for r in mixed.collect():
        taken[r.source] += len(r.text.split())
        assert source[r.doc_id] == r.source
    for s, want in test_mixing.targets(dict(sizes)).items():
        assert abs(taken[s] - want) <= 1

    pieces = defaultdict(int)
    for r in packed.collect():
        pieces[r.doc_id] += r.length
    want = defaultdict(int)
    for r in mixed.collect():
        want[r.doc_id] += len(test_packing.plain(r.text)) // 2 + 1
    assert pieces == want


def test_edges(spark, tmp_path):
    labels = spark.createDataFrame([(0, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "sf" / "labels.parquet"))
    for name, data in (("some", rows()), ("none", [])):
        out = stages(spark, stored(spark, tmp_path / name, data), str(tmp_path / "sf"), tmp_path / f"out-{name}")
        assert (out[-1].count() > 0) == bool(data)
