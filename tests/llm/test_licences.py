"""Licence rules on hand-made texts."""

import re

from tallyloom.llm import licences

MIT = """The MIT License (MIT)
Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""


def test_known_sentences_hold_a_cue_and_rules_known_identifiers():
    ids = {i for i, _ in licences.SENTENCES}
    assert [w for _, w in licences.SENTENCES if not re.search(licences.CUES, w)] == []
    assert {i for _, r in licences.RULES for i in r.split("|")} <= ids


def test_scan(spark):
    rows = [
        (1, MIT, "x"), (2, None, "x"), (3, "", "x"), (4, "no stop here\nLicensed under the Apache License, Version 2.0.\nmore", "x"),
        (5, "All rights reserved. Copyright 2020 A", "x"), (6, "# Copyright 2020 A B. All rights reserved.", "x"),
        (7, "word " * 100_000 + "Released under the MIT License.", "x"), (7, "word. " * 100 + "Released under the MIT License.", "x"),
        (None, "Licensed under CC BY-NC 4.0.", "x"), (8, "an unlicensed licence", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string")
    got = sorted(((r.doc_id, r.licences) for r in licences.scan(docs).collect()), key=repr)
    want = [(1, "MIT"), (2, ""), (3, ""), (4, "Apache-2.0"), (5, ""), (6, "proprietary"), (7, ""), (7, "MIT"), (None, "CC-BY-NC-4.0"), (8, "")]
    assert got == sorted(want, key=repr)
    assert licences.scan(docs.limit(0)).count() == 0


def test_no_python(spark, plan):
    text = plan(licences.scan(spark.createDataFrame([(1, "a")], "doc_id long, text string")))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
int x;
"""


def test_real_headers(spark):
    want = {
        MPL: "MPL-2.0", "x = 1\nThis software is released under the MIT License.\n": "MIT", "// SPDX-License-Identifier: MIT\nint x;": "MIT",
        "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0-or-later", "SPDX-License-Identifier:Apache-2.0": "Apache-2.0",
        "This work is licensed under the MIT License.": "MIT", "This work is licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0", "This library is distributed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0", "Released under CC BY 4.0.": "CC-BY-4.0",
        "The code is available under the BSD 3-Clause License.": "BSD-3-Clause", "Released under the ISC License.": "ISC", "Wir gehen mit. MIT is a school.": "",
    }
    docs = spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")
    got = {r.doc_id: r.licences for r in licences.scan(docs).collect()}
    assert [got[i] for i in range(len(want))] == list(want.values())
    assert len({words for _, words in licences.SENTENCES}) == len(licences.SENTENCES)


def test_real_headers_as_in_sql(spark):
    import duckdb

    docs = [(i, t) for i, t in enumerate([MPL, MIT, "_MIT_", "Released under CC BY 4.0. cc-by-4.0", "SPDX-License-Identifier: MIT", "distributed under gplv3"])]
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    out = licences.scan(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, out.collect())) == sorted(db.execute(licences.SQL).fetchall())
