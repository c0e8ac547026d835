"""Licence scans by sentence rules, in DataFrame expressions only.

A text is cut into sentences twice: within lines (a licence line may follow a line without a full stop) and across
lines (licence texts are wrapped).  Sentences are normalised to lower-case words and joined to a table of known
licence sentences, which gives each an identifier; the sequence of a document's identifiers is then matched against
rules, each an ordered run of identifiers.  Both tables are fixed and small, so they may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licence sentences in normal form and their identifiers.
SENTENCES = [
    ("mit-name", "mit license"),
    ("mit-name", "the mit license"),
    ("mit-name", "the mit license mit"),
    ("mit-release", "released under the mit license"),
    ("mit-release", "licensed under the mit license"),
    ("mit-release", "this project is licensed under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-condition", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit-liability", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("apache-2-line", "licensed under the apache license version 2 0"),
    ("apache-2-line", "this project is licensed under the apache license version 2 0"),
    ("apache-2-line", "released under the apache license version 2 0"),
    ("apache-2-head", "licensed under the apache license version 2 0 the license"),
    ("apache-2-comply", "you may not use this file except in compliance with the license"),
    ("apache-2-obtain", "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-2-law", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-2-see", "see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-3-line", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3-line", "licensed under the gnu general public license version 3"),
    ("gpl-2-line", "this work is licensed under the gnu general public license version 2"),
    ("gpl-2-line", "licensed under the gnu general public license version 2"),
    ("gpl-3-terms", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2-terms", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-free", "this program is free software"),
    ("gpl-3-redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2-redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("lgpl-3-line", "licensed under the gnu lesser general public license version 3"),
    ("agpl-3-line", "licensed under the gnu affero general public license version 3"),
    ("bsd-redistribution", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-2-line", "licensed under the bsd 2 clause license"),
    ("bsd-3-line", "licensed under the bsd 3 clause license"),
    ("mpl-2-terms", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2-terms", "this source code form is subject to the terms of the mozilla public license v"),  # a sentence ends after "v."
    ("cc0-line", "licensed under cc0 1 0"),
    ("cc-by-line", "licensed under cc by 4 0"),
    ("cc-by-sa-line", "licensed under cc by sa 4 0"),
    ("cc-by-nc-line", "licensed under cc by nc 4 0"),
    ("cc-by-nc-sa-line", "licensed under cc by nc sa 4 0"),
    ("cc-by-nd-line", "licensed under cc by nd 4 0"),
    ("copyright", "copyright notice"),
    ("all-rights", "all rights reserved"),
]

#: Licences and the ordered identifiers that show them.
RULES = [
    ("MIT", "mit-release"),
    ("MIT", "mit-name|copyright"),
    ("MIT", "mit-grant|mit-condition"),
    ("MIT", "mit-grant|mit-condition|mit-warranty|mit-liability"),
    ("ISC", "isc-grant"),
    ("Apache-2.0", "apache-2-line"),
    ("Apache-2.0", "apache-2-head|apache-2-comply"),
    ("Apache-2.0", "apache-2-law|apache-2-see"),
    ("Apache-2.0", "apache-2-obtain|apache-2-see"),
    ("GPL-3.0", "gpl-3-line"),
    ("GPL-2.0", "gpl-2-line"),
    ("GPL-3.0-or-later", "gpl-3-terms"),
    ("GPL-3.0-or-later", "gpl-free|gpl-3-redistribute"),
    ("GPL-2.0-or-later", "gpl-2-terms"),
    ("GPL-2.0-or-later", "gpl-free|gpl-2-redistribute"),
    ("LGPL-3.0", "lgpl-3-line"),
    ("AGPL-3.0", "agpl-3-line"),
    ("BSD-2-Clause", "bsd-2-line"),
    ("BSD-3-Clause", "bsd-3-line"),
    ("BSD", "bsd-redistribution"),
    ("MPL-2.0", "mpl-2-terms"),
    ("CC0-1.0", "cc0-line"),
    ("CC-BY-4.0", "cc-by-line"),
    ("CC-BY-SA-4.0", "cc-by-sa-line"),
    ("CC-BY-NC-4.0", "cc-by-nc-line"),
    ("CC-BY-NC-SA-4.0", "cc-by-nc-sa-line"),
    ("CC-BY-ND-4.0", "cc-by-nd-line"),
    ("proprietary", "copyright|all-rights"),
]

#: The names of a licence in a line such as "This software is released under the MIT License".
NAMES = {
    "mit-release": ["mit license", "mit"],
    "isc-line": ["isc license"],
    "apache-2-line": ["apache license version 2 0", "apache license 2 0", "apache license v2 0", "apache 2 0 license", "apache 2 0"],
    "gpl-3-line": ["gnu general public license version 3", "gnu general public license version 3 0", "gnu general public license v3 0", "gnu general public license v3", "gnu gpl v3", "gpl v3", "gplv3", "gpl 3 0"],
    "gpl-2-line": ["gnu general public license version 2", "gnu general public license version 2 0", "gnu general public license v2 0", "gnu general public license v2", "gnu gpl v2", "gpl v2", "gplv2", "gpl 2 0"],
    "lgpl-3-line": ["gnu lesser general public license version 3", "gnu lesser general public license version 3 0", "gnu lesser general public license v3 0", "gnu lgpl v3", "lgpl v3", "lgplv3", "lgpl 3 0"],
    "agpl-3-line": ["gnu affero general public license version 3", "gnu affero general public license version 3 0", "gnu affero general public license v3 0", "gnu agpl v3", "agpl v3", "agplv3", "agpl 3 0"],
    "bsd-2-line": ["bsd 2 clause license", "2 clause bsd license", "bsd 2 clause"],
    "bsd-3-line": ["bsd 3 clause license", "3 clause bsd license", "bsd 3 clause"],
    "mpl-2-line": ["mozilla public license version 2 0", "mozilla public license 2 0", "mozilla public license v2 0", "mpl 2 0"],
    "cc0-line": ["cc0 1 0", "cc0 1 0 universal", "creative commons zero v1 0 universal license"],
} | {
    f"cc-{short.replace(' ', '-')}-line": [f"cc {short} 4 0", f"cc {short} 4 0 license", *(f"creative commons {long} 4 0 {end}" for end in ("license", "international license", "international"))]
    for short, long in [("by", "attribution"), ("by sa", "attribution sharealike"), ("by nc", "attribution noncommercial"), ("by nc sa", "attribution noncommercial sharealike"), ("by nd", "attribution noderivatives")]
}
_SUBJECTS = ["", *(f"{a} {b} is " for a in ("this", "the") for b in ("work", "project", "software", "program", "library", "package", "code", "source code", "file", "repository", "module", "document"))]
_VERBS = ("licensed under", "released under", "distributed under", "available under", "made available under", "licensed under the terms of", "released under the terms of", "distributed under the terms of")
_lines = [(sid, f"{subject}{verb} {article}{name}") for sid, names in NAMES.items() for name in names for subject in _SUBJECTS for verb in _VERBS for article in ("", "the ", "a ")]
_listed = {words for _, words in SENTENCES}
SENTENCES += [(sid, words) for sid, words in _lines if words not in _listed]
RULES += [("ISC", "isc-line"), ("MPL-2.0", "mpl-2-line")]

#: SPDX identifiers in normal form and their licences.
SPDX = {
    "mit": "MIT", "isc": "ISC", "apache 2 0": "Apache-2.0", "bsd 2 clause": "BSD-2-Clause", "bsd 3 clause": "BSD-3-Clause", "mpl 2 0": "MPL-2.0", "cc0 1 0": "CC0-1.0",
    "gpl 2 0": "GPL-2.0", "gpl 2 0 only": "GPL-2.0", "gpl 2 0 or later": "GPL-2.0-or-later", "gpl 3 0": "GPL-3.0", "gpl 3 0 only": "GPL-3.0", "gpl 3 0 or later": "GPL-3.0-or-later",
    "lgpl 3 0": "LGPL-3.0", "lgpl 3 0 only": "LGPL-3.0", "agpl 3 0": "AGPL-3.0", "agpl 3 0 only": "AGPL-3.0",
    "cc by 4 0": "CC-BY-4.0", "cc by sa 4 0": "CC-BY-SA-4.0", "cc by nc 4 0": "CC-BY-NC-4.0", "cc by nc sa 4 0": "CC-BY-NC-SA-4.0", "cc by nd 4 0": "CC-BY-ND-4.0",
}
#: A sentence ends after "SPDX-License-Identifier: ", so the identifier is one of its own.
SENTENCES += [("spdx", "spdx license identifier")]
for _id, _licence in SPDX.items():
    _sid = f"spdx-{_id.replace(' ', '-')}"
    SENTENCES += [(_sid, _id), (f"{_sid}-line", f"spdx license identifier {_id}")]
    RULES += [(_licence, f"spdx|{_sid}"), (_licence, f"{_sid}-line")]

#: Every known sentence holds one of these; a text without any of them needs no cutting.
CUES = "(?i)licen[cs]e|copyright|permission|warrant|liab|reserved|free software|redistribut|(?<![a-z0-9])(mit|isc|apache|bsd|mpl|[al]?gpl(v[23])?|cc0?)(?![a-z0-9])|creative commons"


def _normal(sentence: Column) -> Column:
    words = F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))
    return F.regexp_replace(words, "^copyright [a-z0-9 ]+$", "copyright notice")


def _sentences(text: Column, across_lines: bool) -> Column:
    if across_lines:
        text = F.regexp_replace(text, "[ \\t\\n\\f\\r]+", " ")
    return F.split(F.regexp_replace(text, "([.!?;:])[ \\t]+", "$1\n"), "[\\r\\n]+")


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, line_sentences, text_sentences, licences.

    The first two are the identifiers of the known sentences, in order, joined by ``|``, for either way of cutting;
    ``licences`` are the names whose rule is an unbroken run of one of them, sorted and joined by a comma.  All are
    empty texts if nothing is found, also for null and empty texts.  Repeated rows each get their row.
    """
    known = docs.sparkSession.sql(f"SELECT * FROM VALUES {_values(SENTENCES)} AS known(sid, words)")
    text = F.coalesce(F.col("text"), F.lit(""))

    def view(across: bool) -> Column:
        return F.transform(_sentences(text, across), lambda s, i: F.struct(F.lit(across).alias("across"), i.alias("at"), _normal(s).alias("words")))

    cut = F.when(text.rlike(CUES), F.concat(view(False), view(True)))
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))  # before any explosion
    rows = numbered.select("doc_id", "_row", F.explode_outer(cut).alias("s")).select("doc_id", "_row", "s.across", "s.at", "s.words")
    found = rows.join(F.broadcast(known), "words", "left")
    per_doc = found.groupBy("_row", "doc_id").agg(F.collect_list(F.when(F.col("sid").isNotNull(), F.struct("across", "at", "sid"))).alias("all"))

    def ids(across: bool) -> Column:
        mine = F.filter(F.col("all"), lambda x: x["across"] == F.lit(across))
        return F.concat_ws("|", F.transform(F.array_sort(mine), lambda x: x["sid"]))

    def licences() -> Column:
        line, whole = (F.concat(F.lit("|"), F.col(c), F.lit("|")) for c in ("line_sentences", "text_sentences"))
        names = [F.when(line.contains(f"|{r}|") | whole.contains(f"|{r}|"), F.lit(n)) for n, r in RULES]
        return F.when(F.size("all") > 0, F.concat_ws(",", F.array_sort(F.array_distinct(F.array_compact(F.array(*names)))))).otherwise("")

    out = per_doc.select("doc_id", "all", ids(False).alias("line_sentences"), ids(True).alias("text_sentences"))
    return out.select("doc_id", "line_sentences", "text_sentences", licences().alias("licences"))


def _values(pairs: list[tuple[str, str]]) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in pairs)


SQL = rf"""
WITH known(sid, words) AS (VALUES {_values(SENTENCES)}),
rules(licence, ids) AS (VALUES {_values(RULES)}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
v AS (
  SELECT r, false AS across, regexp_split_to_array(regexp_replace(text, '([.!?;:])[ \t]+', '\1' || chr(10), 'g'), '[\r\n]+') AS parts FROM d
  UNION ALL
  SELECT r, true, regexp_split_to_array(regexp_replace(regexp_replace(text, '[ \t\n\f\r]+', ' ', 'g'), '([.!?;:])[ \t]+', '\1' || chr(10), 'g'), '[\r\n]+') FROM d),
s AS (
  SELECT r, across, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM v),
n AS (
  SELECT r, across, place, regexp_replace(trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')), '^copyright [a-z0-9 ]+$', 'copyright notice') AS words FROM s),
q AS (
  SELECT r, coalesce(string_agg(sid, '|' ORDER BY place) FILTER (NOT across), '') AS line_sentences,
         coalesce(string_agg(sid, '|' ORDER BY place) FILTER (across), '') AS text_sentences
  FROM n JOIN known USING (words) GROUP BY r),
m AS (
  SELECT r, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences
  FROM q JOIN rules ON contains('|' || line_sentences || '|', '|' || ids || '|') OR contains('|' || text_sentences || '|', '|' || ids || '|')
  GROUP BY r)
SELECT doc_id, coalesce(line_sentences, '') AS line_sentences, coalesce(text_sentences, '') AS text_sentences, coalesce(licences, '') AS licences
FROM d LEFT JOIN q USING (r) LEFT JOIN m USING (r)
"""
