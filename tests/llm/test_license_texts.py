"""Licence notices as they stand in source files: wrapped, commented, unmodified."""

import random

from siftwell.llm import licenses

MIT = '''MIT License

Copyright (c) 2020 Jo

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
'''
APACHE = '''Copyright 2020 Jo
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
'''
BSD = '''Copyright (c) 2020, Jo
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
'''


CLAUSES = """1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
"""


def gnu(name, version, later=True):
    tail = f"either version {version} of the License, or\n(at your option) any later version." if later else f"version {version}."
    return f"This program is free software: you can redistribute it and/or modify\nit under the terms of the {name} as published by\nthe Free Software Foundation, {tail}\n"


MPL = '''This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
'''
NOTICES = [
    (MIT, "MIT"),
    (MIT.split("\n\n", 2)[2], "MIT"),
    (MIT.replace("\n\n", "\n"), "MIT"),
    (APACHE, "Apache-2.0"),
    (BSD, "BSD"),
    (f"{BSD}\n{CLAUSES}", "BSD-2-Clause"),
    (f"{BSD}\n{CLAUSES}{ENDORSE}", "BSD-3-Clause"),
    (ZLIB, "Zlib"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    (gnu("GNU General Public License", 3), "GPL-3.0-or-later"),
    (gnu("GNU General Public License", 2), "GPL-2.0-or-later"),
    (gnu("GNU General Public License", 2, later=False), "GPL-2.0-only"),
    (gnu("GNU Lesser General Public License", 2.1), "LGPL-2.1-or-later"),
    (gnu("GNU Affero General Public License", 3), "AGPL-3.0-or-later"),
    (MPL, "MPL-2.0"),
    ("SPDX-License-Identifier: MIT OR GPL-2.0+", "GPL-2.0-or-later,MIT"),
    ("SPDX-License-Identifier: GPL-2.0", "GPL-2.0-only"),
    ("Some prose\nthat says nothing of a license,\nnot even at the end", ""),
]


def test_real_notices_in_any_comment(spark):
    shapes = [("", "", ""), ("# ", "", ""), ("// ", "", ""), (" * ", "/*\n", "\n */"), ("; ", "", ""), ("REM ", "", ""), ("-- ", "", "")]
    rows, expected = [], {}
    for text, name in NOTICES:
        for lead, before, after in shapes:
            body = "\n".join((lead + x).rstrip() for x in text.strip().split("\n"))
            expected[len(rows)] = name
            rows.append((len(rows), f"{before}{body}{after}\n"))
    rows.append((len(rows), "/* SPDX-License-Identifier: BSD-3-Clause */\r\nint x;\r\n"))
    expected[len(rows) - 1] = "BSD-3-Clause"
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(rows[i][1][:40], got[i]) for i in got if got[i] != expected[i]] == []


def plain_scan(ids, max_gap=licenses.MAX_GAP):
    """Licences of a sequence of sentence identifiers (None: unknown), rule by rule, by walking it."""
    ids, found = list(ids), set()
    for name, rule in licenses.RULES:
        at = 0
        while at < len(ids):
            places, k, gap = [], at, 0
            while k < len(ids) and len(places) < len(rule):
                if ids[k] == rule[len(places)]:
                    places.append(k)
                    gap = 0
                elif ids[k] is None and places and gap < max_gap:
                    gap += 1
                else:
                    break
                k += 1
            if len(places) == len(rule):
                found.add(name)
                ids[at:k] = ["used"]
            at += 1
    return ",".join(sorted(found))


def test_sequences_against_a_plain_walk(spark):
    rng, rows, expected = random.Random(12), [], {}
    names = sorted({x for _, rule in licenses.RULES for x in rule if not x.startswith(("spdx", "gpl-1", "lgpl"))})
    for i in range(400):
        ids = []
        for _ in range(rng.randrange(1, 5)):
            ids += list(rng.choice(licenses.RULES)[1]) if rng.random() < 0.6 else [rng.choice(names)]
            ids += [None] * rng.choice((0, 0, 1, 3, 4))
        if rng.random() < 0.5:
            ids = [x for x in ids for _ in range(1)]
            rng.shuffle(ids)
        text = "\n\n".join(licenses.SENTENCES[x][0].capitalize() if x else f"Nothing of note number {rng.randrange(99)}" for x in ids)
        rows.append((i, text))
        expected[i] = (",".join(x for x in ids if x), plain_scan(ids))
    got = {r["doc_id"]: (r["identifiers"], r["licenses"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(rows[i][1], got[i], expected[i]) for i in got if got[i] != expected[i]][:2] == [] and len({x for _, x in expected.values()}) > 30
