"""License scans: ordered signature rules, each behind its keyword; priority and interval containment resolve overlaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayput.llm.common import UID, ascii_lower, text_or_empty, with_uid

#: Base phrases (words that stand consecutively) and their labels, from the contract.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: What separates words, once A-Z is lower case.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Label, keyword (every match holds it or a word of ALIASES for it) and the name's pattern over words joined by one blank.
FAMILIES = (
    ("apache-1.0", "apache", r"apache(?: software)? licen[cs]e(?: version)? 1 0"),
    ("apache-1.1", "apache", r"apache(?: software)? licen[cs]e(?: version)? 1 1"),
    ("apache-2.0", "apache", r"apache(?: software)? licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("apache", "apache", r"apache(?: software)? licen[cs]e"),
    ("mit", "mit", r"(?:mit|expat) licen[cs]e"),
    ("mit-0", "mit", r"mit (?:no attribution|0)(?: licen[cs]e)?"),
    ("x11", "x11", r"(?:mit )?x11 licen[cs]e"),
    ("isc", "isc", r"isc licen[cs]e"),
    ("bsd-0-clause", "bsd", r"(?:0|zero) clause bsd(?: licen[cs]e)?"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|(?:2|two) clause bsd|simplified bsd|freebsd)(?: licen[cs]e)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|(?:3|three) clause bsd|(?:new|revised|modified) bsd)(?: licen[cs]e)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|(?:4|four) clause bsd|original bsd)(?: licen[cs]e)?"),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e"),
    ("gpl-1.0", "general", r"(?:gnu )?general public licen[cs]e(?: gpl)?(?: version| v) ?1(?: 0)?"),
    ("gpl-2.0", "general", r"(?:gnu )?general public licen[cs]e(?: gpl)?(?: version| v) ?2(?: 0)?"),
    ("gpl-3.0", "general", r"(?:gnu )?general public licen[cs]e(?: gpl)?(?: version| v) ?3(?: 0)?"),
    ("gpl", "general", r"(?:gnu )?general public licen[cs]e"),
    ("gpl-1.0", "gpl", r"(?:gnu )?gpl(?: version| v)? 1(?: 0)?"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl(?: version)? ?v?2(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl(?: version)? ?v?3(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("lgpl-2.0", "lgpl", r"(?:gnu )?lgpl(?: version)? ?v?2(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl(?: version)? ?v?2 1(?: only| or (?:any )?later(?: version)?)?"),
    ("lgpl-3.0", "lgpl", r"(?:gnu )?lgpl(?: version)? ?v?3(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl"),
    ("agpl-3.0", "agpl", r"(?:gnu )?agpl(?: version)? ?v?3(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("agpl", "agpl", r"(?:gnu )?agpl"),
    ("apache-2.0", "apache", r"apache(?: version)? ?v?2 0"),
    ("mit", "mit", r"mit licensed"),
    ("mpl-1.1", "mpl", r"mpl(?: version| v)? 1 1"),
    ("mpl-2.0", "mpl", r"mpl(?: version)? ?v?2(?: 0)?"),
    ("epl-1.0", "epl", r"epl(?: version)? ?v?1(?: 0)?"),
    ("epl-2.0", "epl", r"epl(?: version)? ?v?2(?: 0)?"),
    ("ofl-1.1", "ofl", r"(?:sil )?ofl(?: version| v)? 1 1"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e"),
    ("busl-1.1", "business", r"business source licen[cs]e(?: version)?(?: 1 1)?"),
    ("sspl-1.0", "server", r"server side public licen[cs]e(?: version)?(?: 1)?"),
    ("elastic-2.0", "elastic", r"elastic licen[cs]e(?: version)?(?: 2(?: 0)?)?"),
    ("upl-1.0", "permissive", r"universal permissive licen[cs]e(?: version)?(?: 1 0)?"),
    ("ecl", "educational", r"educational community licen[cs]e(?: version)?(?: [12] 0)?"),
    ("afl", "academic", r"academic free licen[cs]e(?: version)?(?: [123] [0-2])?"),
    ("lppl", "latex", r"latex project public licen[cs]e(?: version)?(?: 1 [0-3][ac]?)?"),
    ("cecill", "cecill", r"cecill(?: [bc])? licen[cs]e"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[cs]e"),
    ("blueoak-1.0.0", "oak", r"blue oak model licen[cs]e(?: 1 0 0)?"),
    ("lgpl-2.0", "library", r"(?:gnu )?library general public licen[cs]e(?: version| v)? ?2?(?: 0)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public licen[cs]e(?: version| v) ?2 1"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public licen[cs]e(?: version| v) ?3(?: 0)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[cs]e"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[cs]e(?: version| v) ?3(?: 0)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation licen[cs]e(?: version)?(?: 1 [0-3])?"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e(?: version| v)? ?1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e(?: version| v)? ?1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("eupl", "european", r"european union public licen[cs]e(?: version| v)?(?: 1 [0-2])?"),
    ("cddl", "distribution", r"common development and distribution licen[cs]e(?: version)?(?: 1 [01])?"),
    ("cpl-1.0", "common", r"common public licen[cs]e(?: version)?(?: 1 0)?"),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e(?: version)? 2 0"),
    ("artistic", "artistic", r"artistic licen[cs]e"),
    ("boost-1.0", "boost", r"boost software licen[cs]e(?: version)?(?: 1 0)?"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl(?: version 2)?"),
    ("python-2.0", "python", r"python(?: software foundation)? licen[cs]e(?: version)?(?: 2(?: 0)?)?"),
    ("php-3", "php", r"php licen[cs]e(?: version)?(?: 3 0?1?)?"),
    ("ofl-1.1", "font", r"(?:sil )?open font licen[cs]e(?: version)?(?: 1 1)?"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("openssl", "openssl", r"openssl licen[cs]e"),
    ("odbl", "database", r"open database licen[cs]e(?: odbl)?(?: version| v)?(?: 1 0)?"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "attribution", r"creative commons attribution non ?commercial no ?deriv(?:ative work|ative|)s(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "attribution", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc", "attribution", r"creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-nd", "attribution", r"creative commons attribution no ?deriv(?:ative work|ative|)s(?: [1-4] [05])?"),
    ("cc-by-sa", "attribution", r"creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by", "attribution", r"creative commons attribution(?: [1-4] [05])?"),
    ("public-domain", "domain", r"public domain"),
    ("proprietary", "rights", r"all rights reserved"),
    ("proprietary", "proprietary", r"proprietary(?: and confidential)? licen[cs]e"),
)
#: Whole words that stand for a keyword in some of its rules' matches.
ALIASES = {
    "gplv2": "gpl", "gpl2": "gpl", "gplv3": "gpl", "gpl3": "gpl", "lgplv2": "lgpl", "lgpl2": "lgpl", "lgplv3": "lgpl", "lgpl3": "lgpl",
    "agplv3": "agpl", "agpl3": "agpl", "mplv2": "mpl", "mpl2": "mpl", "eplv1": "epl", "epl1": "epl", "eplv2": "epl", "epl2": "epl",
    "apachev2": "apache", "apache2": "apache", "freebsd": "bsd", "expat": "mit", "licence": "license", "licensed": "license", "licenced": "license",
    "noncommercial": "commercial",
}
#: Label and pattern of SPDX license ids, as words: "Apache-2.0" is read as "apache 2 0".
SPDX_IDS = (
    ("bsd-0-clause", r"0bsd"),
    ("afl", r"afl [123] [0-2]"),
    ("agpl-1.0", r"agpl 1 0(?: only| or later)?"),
    ("agpl-3.0", r"agpl 3 0(?: only| or later)?"),
    ("apache-1.0", r"apache 1 0"),
    ("apache-1.1", r"apache 1 1"),
    ("apache-2.0", r"apache 2 0"),
    ("artistic", r"artistic 1 0(?: perl| cl8)?"),
    ("artistic-2.0", r"artistic 2 0"),
    ("blueoak-1.0.0", r"blueoak 1 0 0"),
    ("boost-1.0", r"bsl 1 0"),
    ("bsd-1-clause", r"bsd 1 clause"),
    ("bsd-2-clause", r"bsd 2 clause(?: patent| views| freebsd)?"),
    ("bsd-3-clause", r"bsd 3 clause(?: clear| lbnl| attribution)?"),
    ("bsd-4-clause", r"bsd 4 clause(?: uc)?"),
    ("busl-1.1", r"busl 1 1"),
    ("cc-by", r"cc by [1-4] [05]"),
    ("cc-by-nc", r"cc by nc [1-4] [05]"),
    ("cc-by-nc-nd", r"cc by nc nd [1-4] [05]"),
    ("cc-by-nc-sa", r"cc by nc sa [1-4] [05]"),
    ("cc-by-nd", r"cc by nd [1-4] [05]"),
    ("cc-by-sa", r"cc by sa [1-4] [05]"),
    ("cc0-1.0", r"cc0 1 0"),
    ("cddl", r"cddl 1 [01]"),
    ("cecill", r"cecill(?: [bc]| [12] [01])?"),
    ("cpl-1.0", r"cpl 1 0"),
    ("ecl", r"ecl [12] 0"),
    ("epl-1.0", r"epl 1 0"),
    ("epl-2.0", r"epl 2 0"),
    ("eupl", r"eupl 1 [0-2]"),
    ("gfdl", r"gfdl 1 [1-3](?: invariants| no invariants)?(?: only| or later)?"),
    ("gpl-1.0", r"gpl 1 0(?: only| or later)?"),
    ("gpl-2.0", r"gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", r"gpl 3 0(?: only| or later)?"),
    ("hpnd", r"hpnd"),
    ("isc", r"isc"),
    ("lgpl-2.0", r"lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", r"lgpl 3 0(?: only| or later)?"),
    ("libpng", r"libpng(?: 2 0)?"),
    ("mit", r"mit"),
    ("mit-0", r"mit 0"),
    ("mpl", r"mpl 1 0"),
    ("mpl-1.1", r"mpl 1 1"),
    ("mpl-2.0", r"mpl 2 0(?: no copyleft exception)?"),
    ("ms-pl", r"ms pl"),
    ("ms-rl", r"ms rl"),
    ("ncsa", r"ncsa"),
    ("odbl", r"odbl 1 0"),
    ("ofl-1.1", r"ofl 1 1(?: rfn| no rfn)?"),
    ("openssl", r"openssl"),
    ("php-3", r"php 3 01?"),
    ("postgresql", r"postgresql"),
    ("python-2.0", r"(?:psf|python) 2 0(?: 1)?"),
    ("unlicense", r"unlicense"),
    ("upl-1.0", r"upl 1 0"),
    ("wtfpl", r"wtfpl"),
    ("x11", r"x11"),
    ("zlib", r"zlib(?: acknowledgement)?"),
)
#: Priority (1 is heard first), confidence, and the words around a family's name.
FORMS = (
    (1, 1.00, r"spdx license identifier {}"),
    (2, 0.95, r"(?:this (?:work|file|program|software|project) is )?(?:licensed|released|distributed|published|made available|available) (?:under|by) (?:the )?(?:terms of )?(?:the )?{}"),
    (3, 0.85, r"(?:subject to|under|governed by|see) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{}"),
    (4, 0.70, r"{}"),
)
#: Rules with no family name in them: priority, confidence, label, keyword, pattern. Most are the sentence that opens a license or its header.
NOTICES = (
    (2, 0.9, "mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    (2, 0.9, "isc", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    (2, 0.9, "bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    (2, 0.9, "unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    (2, 0.9, "cc0-1.0", "waived", r"(?:has|have) waived all copyright and related or neighboring rights"),
    (3, 0.6, "no-redistribution", "redistribution", r"(?:no redistribution|redistribution (?:is )?(?:prohibited|not permitted|not allowed))"),
    (4, 0.4, "copyleft", "copyleft", r"copyleft"),
    (4, 0.3, "copyright", "copyright", r"copyright(?: c)? (?:19|20)[0-9][0-9]"),
    (4, 0.3, "warranty-disclaimer", "warranty", r"without (?:any )?warranty(?: of any kind)?"),
    (2, 0.9, "gpl-1.0", "foundation", r"(?:gnu )?general public licen[cs]e as published by the free software foundation either version 1"),
    (2, 0.9, "gpl-2.0", "foundation", r"(?:gnu )?general public licen[cs]e(?: version 2)? as published by the free software foundation(?: either)?(?: version 2)?"),
    (2, 0.95, "gpl-3.0", "foundation", r"(?:gnu )?general public licen[cs]e as published by the free software foundation(?: either)? version 3"),
    (2, 0.9, "lgpl-2.0", "foundation", r"(?:gnu )?(?:library|lesser) general public licen[cs]e as published by the free software foundation(?: either)? version 2"),
    (2, 0.9, "lgpl-2.1", "foundation", r"(?:gnu )?lesser general public licen[cs]e as published by the free software foundation(?: either)? version 2 1"),
    (2, 0.9, "lgpl-3.0", "foundation", r"(?:gnu )?lesser general public licen[cs]e as published by the free software foundation(?: either)? version 3"),
    (2, 0.9, "agpl-3.0", "foundation", r"(?:gnu )?affero general public licen[cs]e as published by the free software foundation(?: either)? version 3"),
    (2, 0.9, "gfdl", "document", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e"),
    (2, 0.9, "apache-2.0", "contributor", r"licensed to the apache software foundation asf under one or more contributor licen[cs]e agreements"),
    (2, 0.9, "mpl-1.1", "contents", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1"),
    (2, 0.95, "mpl-2.0", "form", r"this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0"),
    (2, 0.9, "epl-1.0", "accompanying", r"accompanying materials are made available under the terms of the eclipse public licen[cs]e v ?1 0"),
    (2, 0.9, "epl-2.0", "accompanying", r"accompanying materials are made available under the terms of the eclipse public licen[cs]e(?: v)? ?2 0"),
    (2, 0.9, "cpl-1.0", "accompanying", r"accompanying materials are made available under the terms of the common public licen[cs]e v ?1 0"),
    (2, 0.9, "cddl", "contents", r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    (2, 0.9, "eupl", "eupl", r"licensed under the eupl(?: version)?(?: 1 [0-2])?"),
    (2, 0.9, "zlib", "liable", r"in no event will the authors be held liable for any damages arising from the use of this software"),
    (2, 0.9, "boost-1.0", "accompanying", r"use modification and distribution (?:is|are) subject to the boost software licen[cs]e version 1 0 see accompanying file"),
    (2, 0.9, "bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from this software"),
    (2, 0.9, "bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    (2, 0.9, "x11", "consortium", r"the name of the x consortium shall not be used in advertising"),
    (2, 0.9, "ncsa", "deal", r"to deal with the software without restriction"),
    (2, 0.9, "postgresql", "agreement", r"without fee and without a written agreement is hereby granted"),
    (2, 0.9, "hpnd", "documentation", r"permission to use copy modify and distribute this software and its documentation for any purpose(?: and)? without fee is hereby granted"),
    (2, 0.9, "artistic", "perl", r"(?:same terms as|under the terms of) perl itself"),
    (2, 0.9, "python-2.0", "psf", r"psf is making python available to licensee on an as is basis"),
    (2, 0.9, "php-3", "php", r"this product includes php software freely available from"),
    (2, 0.9, "openssl", "openssl", r"this product includes software developed by the openssl project"),
    (2, 0.9, "ofl-1.1", "font", r"this font software is licensed under the sil open font licen[cs]e(?: version 1 1)?"),
    (2, 0.9, "wtfpl", "want", r"do what the fuck you want to public licen[cs]e"),
    (2, 0.9, "beerware", "beer", r"you can buy me a beer in return"),
    (2, 0.9, "json", "evil", r"the software shall be used for good not evil"),
    (2, 0.9, "odbl", "database", r"made available under the open database licen[cs]e"),
    (2, 0.9, "lppl", "latex", r"may be distributed and or modified under the conditions of the latex project public licen[cs]e"),
    (2, 0.9, "ms-pl", "contributor", r"each contributor grants you a non exclusive worldwide royalty free copyright licen[cs]e to reproduce its contribution"),
    (2, 0.9, "commons-clause", "commons", r"commons clause licen[cs]e condition v ?1 0"),
    (2, 0.9, "polyform", "polyform", r"polyform (?:noncommercial|small business|shield|perimeter|strict|free trial) licen[cs]e"),
    (2, 0.9, "blueoak-1.0.0", "contributor", r"each contributor licenses you to do everything with this software that would otherwise infringe"),
    (3, 0.7, "non-commercial", "commercial", r"(?:free )?for non ?commercial (?:use|purposes)(?: only)?"),
    (3, 0.7, "research-only", "research", r"for research(?: and| or)?(?: academic| educational)? (?:use|purposes) only"),
    (3, 0.7, "research-only", "academic", r"for academic(?: and| or)?(?: research| educational)? (?:use|purposes) only"),
    (3, 0.6, "proprietary", "confidential", r"(?:proprietary and confidential|confidential and proprietary)"),
    (3, 0.6, "proprietary", "terms", r"use is subject to licen[cs]e terms"),
    (3, 0.6, "proprietary", "unauthorized", r"unauthorized copying of this file(?: via any medium)? is strictly prohibited"),
)
#: Ids that follow WITH in an SPDX expression.
SPDX_EXCEPTIONS = (r"classpath exception 2 0", r"llvm exception", r"gcc exception [23] [01]", r"linux syscall note", r"bison exception 2 2", r"autoconf exception [23] 0",
                   r"font exception 2 0", r"openssl exception", r"swift exception", r"wxwindows exception 3 1")
LEVELS = 4


def rules() -> list[tuple[int, int, float, str, str, str]]:
    """(rule, priority, confidence, label, keyword, pattern), in order; every pattern matches whole words and its leading blank."""
    made = [(p, c, label, word, form.format(name)) for p, c, form in FORMS for label, word, name in FAMILIES]
    made += [(p, c, label, word, pattern) for p, c, label, word, pattern in NOTICES]
    made += [(1, 1.00, label, "spdx", f"spdx license identifier {name}") for label, name in SPDX_IDS]
    # "License: MIT", but not the words between two of "mit license mit license"
    made += [(2, 0.90, label, "license", (f"(?<! {name} )" if name.isalnum() else "") + f"licen[cs]ed? (?:is )?(?:under )?(?:the )?{name}")
             for label, name in (*SPDX_IDS, ("bsd", "bsd"), ("gpl", "gpl"))]
    return [(i, p, c, label, word, f" (?:{pattern})(?= )") for i, (p, c, label, word, pattern) in enumerate(made)]


def rule_table(spark: SparkSession) -> DataFrame:
    """One row per keyword with its rules, from literals: a table whose size does not depend on data."""
    by: dict[str, list] = {}
    for i, p, c, label, word, pattern in rules():
        by.setdefault(word, []).append(F.struct(F.lit(i).alias("rule"), F.lit(p).alias("priority"), F.lit(c).alias("confidence"),
                                                F.lit(label).alias("label"), F.lit(pattern).alias("pattern")))
    return spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(w).alias("keyword"), F.array(*r).alias("rules")) for w, r in by.items()])).alias("x")) \
        .select("x.keyword", "x.rules")


def spdx_labels(words):
    """Labels of all ids in the SPDX expressions (with OR, AND, WITH; parentheses are no words) among words joined by one blank."""
    some = "|".join([name for _, name in SPDX_IDS] + list(SPDX_EXCEPTIONS))
    pattern = f" spdx license identifier ((?:{some})(?: (?:or|and|with) (?:{some}))+)(?= )"
    found = F.flatten(F.transform(F.regexp_extract_all(words, F.lit(pattern), F.lit(1)), lambda x: F.split(x, " (?:or|and|with) (?!later)")))
    label = F.lit(None).cast("string")
    return F.when(words.contains(" spdx license identifier "), F.array_distinct(F.array_compact(F.transform(
        found, lambda x: F.coalesce(*[F.when(x.rlike(f"^(?:{name})$"), F.lit(named)) for named, name in SPDX_IDS], label))))) \
        .otherwise(F.array().cast("array<string>"))


def words_of(text):
    """Lower-cased words joined by one blank, with a blank at either end; no words give one blank."""
    joined = F.trim(F.regexp_replace(ascii_lower(text), GAPS, " "))
    return F.when(joined == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), joined, F.lit(" ")))


def blanks(col):
    return F.length(col) - F.length(F.replace(col, F.lit(" "), F.lit("")))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per detection that stays: _uid, id, start and stop (words), rule, priority, label, confidence; and one row of nulls for every document.

    A detection is dropped if it lies inside another one of a smaller priority number, of an equal one and a longer
    interval, or of the same interval and an earlier rule. Also carries the base columns: n_words, n_base, first_word, last_word, base_labels, and spdx_labels: those of all ids in
    SPDX expressions of several ids, of which the detection itself names the first. An empty table gives no rows.

    Texts are read once. A document is split at the rules of the keywords among its words only; the word positions of the parts are
    sums over windows of one document, and documents are dealt by row number, so no key is hot. Null and empty texts have no words; repeated rows
    are scanned each; only the id and the text are read.
    """
    spark = docs.sparkSession
    rows = with_uid(docs).select(UID, F.col(id_col).alias("id"), words_of(text_or_empty(text)).alias("w"))
    n_words = F.when(F.col("w") == " ", 0).otherwise(blanks(F.col("w")) - 1).cast("long")
    hits, firsts, lasts, labels = F.lit(0), [], [], []
    for phrase, label in PHRASES:
        inner = f" {phrase} "
        found = F.when(F.col("w").contains(inner), F.size(F.split("w", f" {phrase}(?= )", -1)) - 1).otherwise(0)
        hits = hits + found
        firsts.append(F.when(found > 0, blanks(F.substring_index("w", inner, 1))))
        lasts.append(F.when(found > 0, n_words - (blanks(F.substring_index("w", inner, -1))) - len(phrase.split())))
        labels.append(F.when(found > 0, F.lit(label)))
    base = [n_words.alias("n_words"), hits.cast("long").alias("n_base"), F.least(*firsts).cast("long").alias("first_word"),
            F.greatest(*lasts).cast("long").alias("last_word"), F.array_compact(F.array(*labels)).alias("base_labels"), spdx_labels(F.col("w")).alias("spdx_labels")]
    keywords = F.array(*[F.lit(x) for x in sorted({r[4] for r in rules()} | set(ALIASES))])
    alias = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    # the document's words against a set of keywords: no pattern is tried to find them
    present = F.array_distinct(F.transform(F.array_intersect(F.split("w", " "), keywords), lambda x: F.coalesce(F.try_element_at(alias, x), x)))
    rows = rows.select(UID, "id", *base, "w", F.explode(F.array_append(present, F.lit(None).cast("string"))).alias("keyword"))
    tried = rows.join(F.broadcast(rule_table(spark)), "keyword", "left")  # a fixed table
    kept = ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "spdx_labels"]
    tried = tried.select(UID, *kept, "w", F.explode_outer("rules").alias("r"))
    pieces = F.split(F.col("w"), F.col("r.pattern"), -1)
    matches = F.regexp_extract_all(F.col("w"), F.concat(F.lit("("), F.col("r.pattern"), F.lit(")")), F.lit(1))
    found = F.when(F.rlike(F.col("w"), F.col("r.pattern")), F.transform(
        F.arrays_zip(pieces.alias("p"), matches.alias("m")), lambda x: F.struct(blanks(x["p"]).alias("gap"), blanks(x["m"]).alias("long"))))
    tried = tried.select(UID, *kept, "r", found.alias("f")).select(UID, *kept, "r", F.posexplode_outer("f").alias("at", "x")) \
        .where("r is null or x.long is not null")
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = tried.repartition(width, UID)
    in_rule = Window.partitionBy(UID, "r.rule").orderBy("at")
    # a piece begins with the blank after the match before it, so the blanks up to a match count the words before it
    before = F.sum(F.col("x.gap") + F.col("x.long")).over(in_rule.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("x.long")
    spans = dealt.withColumn("start", before).withColumn("stop", F.col("start") + F.col("x.long")) \
        .withColumn("start", F.col("start").cast("long")).withColumn("stop", F.col("stop").cast("long"))
    inside = Window.partitionBy(UID).orderBy("start", F.desc("stop"), "r.priority", "r.rule").rowsBetween(Window.unboundedPreceding, -1)
    reach = [F.max(F.when(F.col("r.priority") <= p, F.col("stop"))).over(inside) for p in range(1, LEVELS + 1)]
    farthest = F.element_at(F.array(*reach), F.col("r.priority"))
    spans = spans.withColumn("hidden", F.coalesce(F.col("start").isNotNull() & (farthest >= F.col("stop")), F.lit(False)))
    return spans.where(~F.col("hidden")).select(UID, *kept, "start", "stop", "r.rule", "r.priority", "r.label", "r.confidence")


def licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: _uid, id, n_words, n_base, first_word, last_word, base_labels, labels, score (the best confidence that stays, else 0)."""
    found = scan(docs, id_col, text)
    out = found.groupBy(UID, "id", "n_words", "n_base", "first_word", "last_word", "base_labels", "spdx_labels").agg(
        F.collect_set("label").alias("own"), F.coalesce(F.max("confidence"), F.lit(0.0)).alias("score"))
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return out.select(UID, "id", "n_words", "n_base", "first_word", "last_word", joined(F.col("base_labels")).alias("base_labels"),
                      joined(F.array_union(F.array_union("base_labels", "own"), F.col("spdx_labels"))).alias("labels"), "score")


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    from stayput.llm.common import read

    return licenses(read(spark, sf_dir, "documents")).drop(UID).withColumnRenamed("id", "doc_id")
