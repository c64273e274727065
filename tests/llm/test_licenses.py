import re

from pyspark.sql import functions as F

from stayput.llm import licenses
from stayput.llm.common import read
from tests.conftest import SF001
from tests.llm.edge import rows, stored


def base(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def compare(docs, data):
    got = licenses.licenses(docs).collect()
    want = sorted([(i, *base(t)) for i, t in data], key=str)
    assert sorted([(r.id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], key=str) == want
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))
    return got


def test_base_matches_brute_force(spark, tmp_path):
    docs = read(spark, SF001, "documents")
    compare(docs, [(r.doc_id, r.text) for r in docs.collect()])
    compare(stored(spark, tmp_path / "d"), [(r[0], r[1]) for r in rows()])
    assert licenses.licenses(stored(spark, tmp_path / "e", [])).count() == 0


def test_detections(spark, tmp_path):
    texts = ["mit license MIT License, mit-license", "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.", "licensed under CC BY-NC 4.0", "All rights reserved.",
             "submit license summit licenses", "a mit license, then the apache license and the mit license", "mit license " * 500]
    docs = stored(spark, tmp_path / "d", [(i, t, "en", "s", 0) for i, t in enumerate(texts)], clash=False)
    got = {r.id: r for r in compare(docs, list(enumerate(texts)))}
    assert got[0].n_base == 3 and got[0].labels == "mit"
    assert got[1].labels == "apache,apache-2.0" and got[1].score == 0.95
    assert got[2].score == 1.0
    assert got[3].labels == "gpl,gpl-3.0" and got[4].labels == "cc-by-nc" and got[5].labels == "proprietary"
    assert got[6].labels == "" and got[6].score == 0
    assert got[8].n_base == 500 and got[8].last_word == 998
    spans = [(r.id, r.start, r.stop, r.label) for r in licenses.scan(docs).where(F.col("label").isNotNull()).collect()]
    assert sorted(s for s in spans if s[0] == 7) == [(7, 1, 3, "mit"), (7, 5, 7, "apache"), (7, 9, 11, "mit")]
    assert sorted(s for s in spans if s[0] == 1) == [(1, 0, 8, "apache-2.0")]
    assert len([s for s in spans if s[0] == 8]) == 500


def test_hundreds_of_rules_in_order():
    made = licenses.rules()
    assert len(made) >= 200 and [r[0] for r in made] == list(range(len(made)))
    for r in made:
        re.compile(r[5])


def labels_of(spark, path, texts):
    docs = stored(spark, path, [(i, t, "en", "s", 0) for i, t in enumerate(texts)], clash=False)
    got = {r.id: (r.labels, r.score) for r in licenses.licenses(docs).collect()}
    return [got[i] for i in range(len(texts))]


def test_short_notices_need_no_other_word(spark, tmp_path):
    want = {"Available under GPL v3.": "gpl-3.0", "GPL 2.0 or later": "gpl-2.0", "Released under CC BY-SA 4.0.": "cc-by-sa", "CC0 1.0": "cc0-1.0",
            "WTFPL version 2": "wtfpl", "BSD 3-Clause": "bsd-3-clause", "simplified BSD": "bsd-2-clause", "MIT-0": "mit-0", "All rights\nreserved": "proprietary",
            "public\ndomain": "public-domain", "Creative-Commons Attribution": "cc-by",
            "Permission is hereby granted, free of charge, to any person obtaining a copy": "mit", "no such words": ""}
    got = labels_of(spark, tmp_path / "d", list(want))
    assert [label for label, _ in got] == list(want.values())
    assert all((score > 0) == bool(label) for label, score in got)


def test_spdx_ids(spark, tmp_path):
    tags = {"0BSD": "bsd-0-clause", "AFL-3.0": "afl", "AGPL-1.0-only": "agpl-1.0", "AGPL-3.0-only": "agpl-3.0", "Apache-1.0": "apache-1.0", "Apache-1.1": "apache-1.1",
            "Apache-2.0": "apache-2.0", "Artistic-1.0-Perl": "artistic", "Artistic-2.0": "artistic-2.0", "BlueOak-1.0.0": "blueoak-1.0.0", "BSL-1.0": "boost-1.0",
            "BSD-1-Clause": "bsd-1-clause", "BSD-2-Clause-Patent": "bsd-2-clause", "BSD-3-Clause": "bsd-3-clause", "BSD-4-Clause-UC": "bsd-4-clause", "BUSL-1.1": "busl-1.1",
            "CC-BY-4.0": "cc-by", "CC-BY-NC-3.0": "cc-by-nc", "CC-BY-NC-ND-4.0": "cc-by-nc-nd", "CC-BY-NC-SA-2.5": "cc-by-nc-sa", "CC-BY-ND-4.0": "cc-by-nd",
            "CC-BY-SA-4.0": "cc-by-sa", "CC0-1.0": "cc0-1.0", "CDDL-1.0": "cddl", "CECILL-2.1": "cecill", "CPL-1.0": "cpl-1.0", "ECL-2.0": "ecl", "EPL-1.0": "epl-1.0",
            "EPL-2.0": "epl-2.0", "EUPL-1.2": "eupl", "GFDL-1.3-or-later": "gfdl", "GPL-1.0-or-later": "gpl-1.0", "GPL-2.0-only": "gpl-2.0", "GPL-2.0+": "gpl-2.0",
            "GPL-3.0-or-later": "gpl-3.0", "HPND": "hpnd", "ISC": "isc", "LGPL-2.0-only": "lgpl-2.0", "LGPL-2.1-only": "lgpl-2.1", "LGPL-3.0-or-later": "lgpl-3.0",
            "libpng-2.0": "libpng", "MIT": "mit", "MIT-0": "mit-0", "MPL-1.0": "mpl", "MPL-1.1": "mpl-1.1", "MPL-2.0": "mpl-2.0", "MS-PL": "ms-pl", "MS-RL": "ms-rl",
            "NCSA": "ncsa", "ODbL-1.0": "odbl", "OFL-1.1": "ofl-1.1", "OpenSSL": "openssl", "PHP-3.01": "php-3", "PostgreSQL": "postgresql", "PSF-2.0": "python-2.0",
            "Python-2.0.1": "python-2.0", "Unlicense": "unlicense", "UPL-1.0": "upl-1.0", "WTFPL": "wtfpl", "X11": "x11", "Zlib": "zlib"}
    assert {label for label, _ in licenses.SPDX_IDS} == set(tags.values())
    assert labels_of(spark, tmp_path / "d", [f"// SPDX-License-Identifier: {tag}\nint x;" for tag in tags]) == [(label, 1.0) for label in tags.values()]


def examples(parsed):
    """Texts that a pattern matches: every alternative, options with and without, character classes at their first member."""
    import itertools

    parts = []
    for kind, value in parsed:
        kind = str(kind)
        if kind == "LITERAL":
            parts.append([chr(value)])
        elif kind == "IN":
            parts.append([chr(value[0][1][0] if str(value[0][0]) == "RANGE" else value[0][1])])
        elif kind == "ANY":
            parts.append(["x"])
        elif kind == "BRANCH":
            parts.append([x for b in value[1] for x in examples(b)])
        elif kind == "SUBPATTERN":
            parts.append(examples(value[-1]))
        elif kind == "MAX_REPEAT":
            parts.append(["", *examples(value[2])])
        else:
            assert kind in ("ASSERT", "ASSERT_NOT"), kind
    return ["".join(x) for x in itertools.product(*parts)]


def test_every_match_holds_its_keyword():
    from re import _parser

    for i, _, _, _, word, pattern in licenses.rules():
        if i < len(licenses.FAMILIES) * 3 and "spdx license" not in pattern:
            continue  # the same names behind other words
        for text in examples(_parser.parse(pattern)):
            assert re.search(pattern, text + " "), text
            assert word in {licenses.ALIASES.get(w, w) for w in text.split()}, (word, text)


def test_keywords_written_as_one_word(spark, tmp_path):
    want = {"Licensed under GPLv2": "gpl-2.0", "GPLv3 or later": "gpl-3.0", "gpl2": "gpl-2.0", "GPL3 only": "gpl-3.0", "the FreeBSD license": "bsd-2-clause",
            "the Expat License": "mit", "GPLv2, GPL v2 and GPL 2": "gpl-2.0"}
    assert [label for label, _ in labels_of(spark, tmp_path / "d", list(want))] == list(want.values())
    docs = stored(spark, tmp_path / "e", [(1, "GPLv2, GPL v2 and GPL 2", "en", "s", 0)], clash=False)
    assert sorted((r.start, r.stop) for r in licenses.scan(docs).where("start is not null").collect()) == [(0, 1), (1, 3), (4, 6)]


def test_forms_that_people_write(spark, tmp_path):
    want = {"Licensed under the GNU GPL version 2 or later": "gpl-2.0", "released under the GPL": "gpl", "MIT licensed": "mit", "Apache 2.0": "apache-2.0",
            "License: Apache-2.0": "apache-2.0", "LGPLv2.1": "lgpl-2.1", "AGPLv3": "agpl-3.0", "MPL 2.0": "mpl-2.0", "licensed under MPL-2.0": "mpl-2.0",
            "EPL-2.0": "epl-2.0", "License: BSD": "bsd", "MIT licence": "mit", "Microsoft Public License": "ms-pl", "SIL OFL 1.1": "ofl-1.1",
            "Creative Commons Attribution-NonCommercial-ShareAlike 4.0": "cc-by-nc-sa", "Creative Commons Attribution-NoDerivs 3.0": "cc-by-nd",
            "modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License":
                "gpl,gpl-2.0",
            "the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1": "gpl,lgpl-2.1",
            "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2.0",
            "In no event will the authors be held liable for any damages arising from the use of this software.": "zlib",
            "The Software shall be used for Good, not Evil.": "json"}
    assert [label for label, _ in labels_of(spark, tmp_path / "d", list(want))] == list(want.values())
    assert len(licenses.NOTICES) >= 50 and len({label for _, _, label, _, _ in licenses.NOTICES}) >= 30


def test_spdx_expressions_name_every_id(spark, tmp_path):
    want = {"SPDX-License-Identifier: MIT OR Apache-2.0": "apache-2.0,mit", "SPDX-License-Identifier: (MIT AND BSD-3-Clause) OR ISC": "bsd-3-clause,isc,mit",
            "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0": "gpl-2.0", "SPDX-License-Identifier: GPL-2.0-or-later OR MIT\nor isc": "gpl-2.0,isc,mit",
            "SPDX-License-Identifier: MIT\nint x or isc": "mit", "SPDX-License-Identifier: Zlib AND (MPL-2.0 OR EPL-2.0 WITH LLVM-exception)": "epl-2.0,mpl-2.0,zlib"}
    got = labels_of(spark, tmp_path / "d", list(want))
    assert [label for label, _ in got] == list(want.values()) and {score for _, score in got} == {1.0}


def test_containment_equals_a_slow_version(spark, tmp_path):
    texts = ["Licensed under the Apache License, Version 2.0 (the License); GPLv3 or later. All rights reserved. Copyright (c) 2020 without any warranty",
             "GNU Lesser General Public License version 3, subject to the MIT X11 license; proprietary and confidential", "cc by nc nd 4.0 / CC BY 4.0",
             "SPDX-License-Identifier: MIT mit license MIT licensed under the terms of the BSD 2-Clause license", "no license at all", None,
             "permission is hereby granted, free of charge, to any person obtaining a copy of the Boost Software License"]
    docs = stored(spark, tmp_path / "d", [(i, t, "en", "s", 0) for i, t in enumerate(texts)], clash=False)
    got = sorted((r.id, r.start, r.stop, r.rule) for r in licenses.scan(docs).where("start is not null").collect())
    want = []
    for i, t in enumerate(texts):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = " " + " ".join(re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)) + " "
        found = [(len(w[:m.start()].split()), len(w[:m.end()].split()), p, k) for k, p, _, _, _, pattern in licenses.rules() for m in re.finditer(pattern, w)]
        for a, b, p, k in found:
            if not any(c <= a and b <= d and (q < p or q == p and (d - c > b - a or (c, d) == (a, b) and j < k)) for c, d, q, j in found):
                want.append((i, a, b, k))
    assert got == sorted(want)
