import hashlib
import re

import pytest
from pyspark.sql import functions as F

from stayput.llm import exact_dedup
from tests.llm.edge import rows, stored


def brute(data):
    groups = {}
    for at, (i, t, *_) in enumerate(data):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, at))
    out = []
    for norm, members in groups.items():
        keep = min(members)
        for m in members:
            out.append((data[m[3]][0], data[keep[3]][0], len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hash_of", [exact_dedup.content_hash, lambda n: F.substring(F.md5(n), 1, 1)])
def test_groups_match_brute_force(spark, tmp_path, hash_of):
    docs = stored(spark, tmp_path / "d")
    got = exact_dedup.exact_groups(docs, hash_of=hash_of).collect()
    assert sorted([(r.id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute(rows())
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})


def test_deduplicate_keeps_whole_rows(spark, tmp_path):
    docs = stored(spark, tmp_path / "d")
    out = exact_dedup.deduplicate(docs)
    assert out.columns == docs.columns and out.count() == len({b[3] for b in brute(rows())})
    assert out.where("_uid != 'mine' or id != 'mine'").count() == 0
    assert exact_dedup.deduplicate(stored(spark, tmp_path / "e", [])).count() == 0
