"""License scans by sentence rules, in DataFrame operations only.

Comment leaders are taken off. A text is cut into sentences at blank lines and after . ; : ! ? that white space follows;
wrapped lines are joined first, unless a line is a known sentence or of copyright by itself. Sentences are lower-cased
and runs of anything but letters and digits become one space. Each sentence that is a known licence sentence gets its
identifier. A rule is an ordered sequence of identifiers; it matches where its identifiers follow one another with no
other known sentence between and at most ``max_gap`` unknown ones. Rules are tried in their order, and a sentence that a
rule has used counts for no later rule.

Known sentences and rules are the module's own small constants, so they are literals in the plan: no table is joined and
no text is exchanged. Sentences without any of the words that all known sentences share are passed over at once.

Null texts count as empty and match nothing; repeated rows are reported as often; other columns are ignored. Any number
of matches in any length of text is reported.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.tables import table, text_or_empty

#: Identifiers and the normalised forms of licence sentences.
SENTENCES = {
    "apache-2.0-ref": ("licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "this file is licensed under the apache license version 2 0"),
    "apache-2.0-url": ("you may obtain a copy of the license at", "http www apache org licenses license 2 0"),
    "apache-2.0-terms": ("you may not use this file except in compliance with the license",),
    "mit-ref": ("released under the mit license", "licensed under the mit license", "mit license", "the mit license", "the mit license mit"),
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    ),
    "gpl-3.0-ref": ("this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3"),
    "gpl-later": ("either version 3 of the license or at your option any later version",),
    "cc-by-nc-4.0-ref": ("licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0"),
    "cc-by-4.0-ref": ("licensed under cc by 4 0", "this work is licensed under cc by 4 0"),
    "cc-by-sa-4.0-ref": ("licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0"),
    "bsd-ref": (
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "use of this source code is governed by a bsd style license that can be found in the license file",
    ),
    "all-rights": ("all rights reserved",),
    "apache-2.0-holder": ("licensed to the apache software foundation asf under one or more contributor license agreements",),
    "apache-2.0-asf": ("the asf licenses this file to you under the apache license version 2 0 the license",),
    "isc-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
        "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "bsd-endorse": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "neither the name of the nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    ),
    "bsd-source": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    ),
    "bsd-advert": ("all advertising materials mentioning features or use of this software must display the following acknowledgement",),
    "zlib-ref": ("this software is provided as is without any express or implied warranty", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    "zlib-grant": ("permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",),
    "unlicense-ref": ("this is free and unencumbered software released into the public domain",),
    "boost-ref": ("boost software license version 1 0", "distributed under the boost software license version 1 0", "use modification and distribution are subject to the boost software license version 1 0"),
    "epl-2.0-ref": ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at", "this program and the accompanying materials are made available under the terms of the eclipse public license v2 0"),
    "cc0-ref": ("this work is dedicated to the public domain under cc0 1 0", "licensed under cc0 1 0", "released under cc0 1 0"),
    "mpl-2.0-ref": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
}
#: The GNU licences' names, short names and versions; their headers differ in these alone.
_GNU = (("gnu general public license", "GPL", ("1", "2", "3")), ("gnu lesser general public license", "LGPL", ("2.1", "3")), ("gnu library general public license", "LGPL", ("2",)), ("gnu affero general public license", "AGPL", ("3",)))
#: SPDX identifiers that an SPDX line may have.
SPDX = (
    "0BSD", "AFL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.1", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-3.0", "CC-BY-4.0",
    "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CDDL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GPL-1.0-only", "GPL-1.0-or-later", "GPL-2.0-only", "GPL-2.0-or-later",
    "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0",
    "MS-PL", "NCSA", "OFL-1.1", "PostgreSQL", "Python-2.0", "Unlicense", "WTFPL", "X11", "Zlib",
)
#: Rules in the order in which they are tried.
RULES = (
    ("Apache-2.0", ("apache-2.0-ref", "apache-2.0-terms", "apache-2.0-url")),
    ("Apache-2.0", ("apache-2.0-holder", "apache-2.0-asf", "apache-2.0-terms", "apache-2.0-url")),
    ("Apache-2.0", ("apache-2.0-asf",)),
    ("Apache-2.0", ("apache-2.0-ref",)),
    ("GPL-3.0-or-later", ("gpl-3.0-ref", "gpl-later")),
    ("GPL-3.0-only", ("gpl-3.0-ref",)),
    ("MIT", ("mit-ref", "mit-grant")),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-grant",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0-ref",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0-ref",)),
    ("CC-BY-4.0", ("cc-by-4.0-ref",)),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl-2.0-ref",)),
    ("BSD-4-Clause", ("all-rights", "bsd-ref", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse")),
    ("BSD-4-Clause", ("bsd-ref", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse")),
    ("BSD-3-Clause", ("all-rights", "bsd-ref", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-ref", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("all-rights", "bsd-ref", "bsd-source", "bsd-binary")),
    ("BSD-2-Clause", ("bsd-ref", "bsd-source", "bsd-binary")),
    ("Zlib", ("zlib-grant",)),
    ("Unlicense", ("unlicense-ref",)),
    ("BSL-1.0", ("boost-ref",)),
    ("EPL-2.0", ("epl-2.0-ref",)),
    ("CC0-1.0", ("cc0-ref",)),
    ("BSD", ("all-rights", "bsd-ref")),
    ("BSD", ("bsd-ref",)),
    ("BSD", ("bsd-endorse",)),
    ("Proprietary", ("all-rights",)),
)


def _normal(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip()


def _add(name: str, license_: str, *forms: str) -> None:
    global RULES
    if name not in SENTENCES:
        RULES = ((license_, (name,)), *RULES)
    SENTENCES[name] = (*SENTENCES.get(name, ()), *forms)


for _long, _short, _versions in _GNU:
    for _v in _versions:
        _n = _normal(_v)
        _full = _v if "." in _v else f"{_v}.0"
        for _start in ("you can redistribute it and or modify it under the terms of the", "you can redistribute it and or modify it under the terms of version"):
            _head = f"{_start} {_n} of the {_long}" if _start.endswith("version") else f"{_start} {_long}"
            if _head.endswith(f"the terms of the {_long}"):
                _fsf = f"{_head} as published by the free software foundation"
                _tails = ("or at your option any later version", "or at your option any later version of the license")
                _add(f"{_short.lower()}-{_full}-header-later", f"{_short}-{_full}-or-later", *(f"{_fsf} {e}version {_n} of the license {t}" for e in ("either ", "") for t in _tails))
                _add(f"{_short.lower()}-{_full}-header-only", f"{_short}-{_full}-only", f"{_fsf} version {_n} of the license", f"{_fsf} version {_n}", f"{_head} version {_n} as published by the free software foundation", f"{_head} version {_n} only as published by the free software foundation")
            else:
                _add(f"{_short.lower()}-{_full}-header-only", f"{_short}-{_full}-only", f"{_head} as published by the free software foundation")
for _x in SPDX:
    _old = {f"{_x[: -len(e)]}" for e in ("-only",) if _x.endswith(e)}
    _add(f"spdx-{_x.lower()}", _x, *(f"spdx license identifier {_normal(y)}" for y in (_x, *_old)))
#: Every known sentence has one of these.
HINT = "(?i)licen[sc]e|rights reserved|cc by|cc0|permission|redistribut|any later version|be used to endorse|provided.{1,4}as.is|advertising materials|public domain"
MAX_GAP = 3
#: What begins a comment's line or ends the comment: marks with white space or nothing after them, or a word.
_LEADER = r"(?m)^[ \t]*(?:[^\w\s(\[\"'@]+(?=\s|$)|(?:REM|dnl|C)(?=[ \t]|$))[ \t]*|[ \t\r]*(?:\*+/|--+>)?[ \t\r]*$"
#: Lines that do not go on in the next one, and that no line goes on in.
_ALONE = r"(?i)^\s*(?:copyright|\(c\)|©|spdx-)"
_SPDX = "SPDX-License-Identifier-"
_IDS = list(SENTENCES)


def _letter(name: str) -> str:
    at = _IDS.index(name)
    return chr(ord("A") + at) if at < 26 else chr(0x100 + at)


def _pattern(rule: tuple[str, ...], max_gap: int) -> str:
    return f"_{{0,{max_gap}}}".join(_letter(x) for x in rule)


def _blocks(text: Column) -> Column:
    """Texts between blank lines and ends of sentences, with the line breaks that they have; comment leaders are taken off."""
    plain = F.regexp_replace(text, "\r\n?", "\n")
    spdx = F.regexp_replace(plain, r"(?i)SPDX-License-Identifier:[ \t]*([^\n]*)", f"\n\n{_SPDX}$1\n\n")
    split = F.regexp_replace(spdx, rf"(?<={_SPDX}[^\n]{{0,300}}) (?:OR|AND|WITH|or|and|with) ", f"\n\n{_SPDX}")
    later = F.regexp_replace(split, rf"({_SPDX}\(?[A-Za-z0-9.-]+)\+", "$1-or-later")
    bare = F.regexp_replace(later, _LEADER, "")
    return F.split(bare, r"\n[ \t]*(?=\n)|(?<=[.;:!?])(?<!\b[vV]\.)\s+", -1)


def identified(text: Column) -> Column:
    """A string with a character for each sentence: a letter for a known one, _ for any other.

    The lines of a block are one sentence, as wrapped lines are, if that is known; else known lines and lines of
    copyright part it, and what is between them is joined.
    """
    known = F.create_map(*[F.lit(x) for name, forms in SENTENCES.items() for form in forms for x in (form, _letter(name))])
    normal = lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))
    letter = lambda s: F.when(s.rlike(HINT), F.try_element_at(known, normal(s)))
    alone = lambda line: line.rlike(_ALONE) | letter(line).isNotNull()
    parted = lambda b: F.split(F.array_join(F.transform(F.split(b, "\n", -1), lambda x: F.when(alone(x), F.concat(F.lit("\x00"), x, F.lit("\x00"))).otherwise(x)), "\n"), "\x00", -1)
    inner = lambda b: F.array_join(F.transform(F.filter(parted(b), lambda s: normal(s) != ""), lambda s: F.coalesce(letter(s), F.lit("_"))), "")
    several = lambda b: F.when(b.rlike(HINT) & F.contains(b, F.lit("\n")), inner(b)).otherwise(F.lit("_"))
    return F.array_join(F.transform(F.filter(_blocks(text), lambda b: F.trim(b) != ""), lambda b: F.coalesce(letter(b), several(b))), "")


def scan(docs: DataFrame, max_gap: int = MAX_GAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document row: doc_id, n_sentences (known ones), identifiers (their sequence), licenses (those found, sorted)."""
    text = text_or_empty(text_col)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.when(text.rlike(HINT), identified(text)).otherwise("").alias("left"))
    letters = F.regexp_replace("left", "_", "")
    out = slim.withColumn("identifiers", F.array_join(F.transform(F.split(letters, ""), lambda c: F.try_element_at(F.create_map(*[F.lit(x) for n in _IDS for x in (_letter(n), n)]), c)), ","))
    out = out.withColumn("n_sentences", F.length(letters).cast("bigint")).withColumn("found", F.array().cast("array<string>"))
    state = F.struct(F.col("left").alias("left"), F.array().cast("array<string>").alias("found"))
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(_pattern(rule, max_gap)).alias("pattern")) for name, rule in RULES])

    def step(so_far: Column, rule: Column) -> Column:
        hit = F.regexp_like(so_far["left"], rule["pattern"])
        return F.when(
            hit,
            F.struct(F.regexp_replace(so_far["left"], rule["pattern"], F.lit("#")).alias("left"), F.array_append(so_far["found"], rule["name"]).alias("found")),
        ).otherwise(F.struct(so_far["left"].alias("left"), so_far["found"].alias("found")))

    found = F.when(F.col("n_sentences") > 0, F.aggregate(rules, state, step, lambda x: F.array_sort(F.array_distinct(x["found"])))).otherwise(F.array().cast("array<string>"))
    return out.select("doc_id", "n_sentences", "identifiers", F.array_join(found, ",").alias("licenses"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
