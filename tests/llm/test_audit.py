import itertools
import re
from collections import Counter

from stayput.llm import audit
from tests.llm.edge import LONG, rows, stored

CAPITALS = "ABC def " * 150
LABELS = "doc_id long, quality int, toxic int"


def brute(data, labels):
    least = {}
    for i, t, *_ in data:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    docs = []
    for i, t, lang, *_ in data:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and least[t] < i}
        docs.append((lang or "", {f for f in fails if fails[f]}, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        steps, shapley = [], Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            every = list(left)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                steps.append((part, order, step, len(left), len(gone), sum(f in d[1] for d in every) - len(gone),
                              sum(d[1] == {f} for d in every), sum(d[2] for d in gone), sum(d[3] for d in gone), f))
        out += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return sorted(out)


def test_report_equals_applying_the_filters_in_every_order(spark, tmp_path):
    data = rows() + [(100 + i, t, part, None, 1) for i, (t, part) in enumerate(itertools.product(
        [CAPITALS, CAPITALS + "#", LONG + " ABC" * 9000, "a | b", " ".join(f"w{k}" for k in range(300)), None], ["en", None, "", "fr"]))]
    labels = [(d[0], k % 2, k % 3 % 2) for k, d in enumerate(data)] + [(3, 1, 1), (3, 0, None), (None, 1, 1), (999, 1, 0)]
    docs = stored(spark, tmp_path / "d", data)
    cells = audit.contingency(docs, spark.createDataFrame(labels, LABELS))
    got = sorted(tuple(r) for r in audit.interactions(cells).collect())
    assert got == brute(data, labels)


def test_cells_are_few_and_empty_tables_have_no_parts(spark, tmp_path):
    docs = stored(spark, tmp_path / "d", rows() * 20)
    cells = audit.contingency(docs, spark.createDataFrame([], LABELS))
    assert cells.groupBy("part").count().where("count > 32").count() == 0
    assert cells.selectExpr("sum(n)").first()[0] == len(rows()) * 20 and cells.selectExpr("sum(good + toxic)").first()[0] == 0
    none = audit.contingency(stored(spark, tmp_path / "e", []), spark.createDataFrame([], LABELS))
    assert audit.interactions(none).count() == 0
