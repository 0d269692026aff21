"""Licences by sentence rules.

A text is cut into sentences, sentences are normalised and looked up among known
licence sentences, and the identifiers found, in their order and with unknown
sentences left out, are held against ordered licence rules: a rule fits where
its identifiers stand one after the other. A place where a rule fits is not named if it
lies within a place where a longer one does; the same words elsewhere are. Sentences
and rules are tables. They go to the tasks, where an index leads from the rarest
sentence of a rule to the rule, so a text meets only rules it may fit. No shuffle.

A sentence ends at ``.``, ``!``, ``?`` or ``:`` before white space, or at an
empty line; if a sentence over several lines is not known as a whole, its lines
are looked up one by one. The normal form is lower case with all but letters,
digits and characters beyond ASCII taken as blanks.

The tables may have ``MOST`` rows each, which bounds what is sent.

Defined results: NULL and empty texts have no sentences and no licence; repeated
rows are scanned each; NULL ids are carried; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.batches import measure

# Names of public licences as notices say them.
NAMES = {
    "mit": ["the MIT License", "the MIT license", "MIT"],
    "bsd-2": ["the BSD 2-Clause License", "the Simplified BSD License"],
    "bsd-3": ["the BSD 3-Clause License", "the New BSD License"],
    "apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "Apache-2.0"],
    "isc": ["the ISC License"],
    "zlib": ["the zlib License"],
    "bsl-1.0": ["the Boost Software License 1.0", "the Boost Software License, Version 1.0"],
    "unlicense": ["the Unlicense"],
    "mpl-2.0": ["the Mozilla Public License 2.0", "the Mozilla Public License, version 2.0"],
    "epl-2.0": ["the Eclipse Public License 2.0"],
    "gpl-2.0": ["the GNU General Public License, version 2", "the GNU GPL v2"],
    "gpl-3.0": ["the GNU General Public License, version 3", "the GNU GPL v3"],
    "lgpl-2.1": ["the GNU Lesser General Public License, version 2.1"],
    "lgpl-3.0": ["the GNU Lesser General Public License, version 3"],
    "agpl-3.0": ["the GNU Affero General Public License, version 3"],
    "cc0-1.0": ["CC0 1.0", "the Creative Commons Zero License"],
    "cc-by-4.0": ["CC BY 4.0", "the Creative Commons Attribution 4.0 International License"],
    "cc-by-sa-4.0": ["CC BY-SA 4.0", "the Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc-4.0": ["CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-nd-4.0": ["CC BY-ND 4.0", "the Creative Commons Attribution-NoDerivatives 4.0 International License"],
}
NOTICES = [
    "Released under {}.",
    "Licensed under {}.",
    "Distributed under {}.",
    "This work is licensed under {}.",
    "This project is licensed under {}.",
    "This software is licensed under {}.",
    "This program is licensed under {}.",
    "The source code is licensed under {}.",
]

# Sentences of public licences by their identifiers.
SENTENCES = {
    "all-rights-reserved": "All rights reserved.",
    "mit-title": "MIT License",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-keep-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "apache-2.0-terms": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "apache-2.0-copy": "You may obtain a copy of the License at",
    "apache-2.0-as-is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache-2.0-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl-3.0-free": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-copy": "You should have received a copy of the GNU General Public License along with this program.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-as-is": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "bsd-liability": "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "isc-as-is": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "isc-liability": "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-liability": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "bsl-grant": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "public-domain": "This work is in the public domain.",
    "gpl-2.0-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-2.0-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "lgpl-2.1-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "agpl-3.0-free": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-copy": "You should have received a copy of the GNU Affero General Public License along with this program.",
    "gpl-details": "See the GNU General Public License for more details.",
    "agpl-details": "See the GNU Affero General Public License for more details.",
    "lgpl-details": "See the GNU Lesser General Public License for more details.",
    "epl-2.0-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    "cc0-waiver": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "no-copy": "No part of this publication may be reproduced without the prior written permission of the publisher.",
    "confidential": "This document is confidential and may not be copied or distributed without permission.",
}

# (rule, licence, kind, identifiers in order).
RULES = [
    ("mit-text", "MIT", "permissive", ["mit-grant", "mit-keep-notice", "mit-as-is", "mit-liability"]),
    ("mit-grant", "MIT", "permissive", ["mit-grant"]),
    ("mit-title", "MIT", "permissive", ["mit-title"]),
    ("mit-notice", "MIT", "permissive", ["mit-notice"]),
    ("bsd-3-text", "BSD-3-Clause", "permissive", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is", "bsd-liability"]),
    ("bsd-2-text", "BSD-2-Clause", "permissive", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-liability"]),
    ("bsd-grant", "BSD", "permissive", ["bsd-grant"]),
    ("bsd-3-notice", "BSD-3-Clause", "permissive", ["bsd-3-notice"]),
    ("bsd-2-notice", "BSD-2-Clause", "permissive", ["bsd-2-notice"]),
    ("isc-text", "ISC", "permissive", ["isc-grant", "isc-as-is", "isc-liability"]),
    ("isc-grant", "ISC", "permissive", ["isc-grant"]),
    ("isc-notice", "ISC", "permissive", ["isc-notice"]),
    ("0bsd-text", "0BSD", "permissive", ["0bsd-grant", "isc-as-is", "isc-liability"]),
    ("0bsd-grant", "0BSD", "permissive", ["0bsd-grant"]),
    ("zlib-text", "Zlib", "permissive", ["zlib-as-is", "zlib-liability", "zlib-grant"]),
    ("zlib-grant", "Zlib", "permissive", ["zlib-grant"]),
    ("zlib-notice", "Zlib", "permissive", ["zlib-notice"]),
    ("bsl-grant", "BSL-1.0", "permissive", ["bsl-grant"]),
    ("bsl-notice", "BSL-1.0", "permissive", ["bsl-1.0-notice"]),
    ("apache-header", "Apache-2.0", "permissive", ["apache-2.0-terms", "apache-2.0-copy", "apache-2.0-as-is", "apache-2.0-see"]),
    ("apache-terms", "Apache-2.0", "permissive", ["apache-2.0-terms"]),
    ("apache-notice", "Apache-2.0", "permissive", ["apache-2.0-notice"]),
    ("gpl-header-full", "GPL-3.0-or-later", "copyleft", ["gpl-3.0-free", "gpl-hope", "gpl-details", "gpl-copy"]),
    ("gpl-header", "GPL-3.0-or-later", "copyleft", ["gpl-3.0-free", "gpl-hope", "gpl-copy"]),
    ("gpl-free", "GPL-3.0-or-later", "copyleft", ["gpl-3.0-free"]),
    ("gpl-notice", "GPL-3.0", "copyleft", ["gpl-3.0-notice"]),
    ("gpl-2-header", "GPL-2.0-or-later", "copyleft", ["gpl-2.0-free", "gpl-hope", "gpl-details"]),
    ("gpl-2-free", "GPL-2.0-or-later", "copyleft", ["gpl-2.0-free"]),
    ("gpl-2-only", "GPL-2.0", "copyleft", ["gpl-2.0-only"]),
    ("gpl-2-notice", "GPL-2.0", "copyleft", ["gpl-2.0-notice"]),
    ("lgpl-header", "LGPL-2.1-or-later", "copyleft", ["lgpl-2.1-free", "lgpl-hope", "lgpl-details"]),
    ("lgpl-free", "LGPL-2.1-or-later", "copyleft", ["lgpl-2.1-free"]),
    ("lgpl-2-notice", "LGPL-2.1", "copyleft", ["lgpl-2.1-notice"]),
    ("lgpl-3-notice", "LGPL-3.0", "copyleft", ["lgpl-3.0-notice"]),
    ("agpl-header", "AGPL-3.0-or-later", "copyleft", ["agpl-3.0-free", "gpl-hope", "agpl-details", "agpl-copy"]),
    ("agpl-free", "AGPL-3.0-or-later", "copyleft", ["agpl-3.0-free"]),
    ("agpl-notice", "AGPL-3.0", "copyleft", ["agpl-3.0-notice"]),
    ("mpl-notice", "MPL-2.0", "copyleft", ["mpl-2.0-notice"]),
    ("epl-terms", "EPL-2.0", "copyleft", ["epl-2.0-terms"]),
    ("epl-notice", "EPL-2.0", "copyleft", ["epl-2.0-notice"]),
    ("unlicense-free", "Unlicense", "public domain", ["unlicense-free"]),
    ("unlicense-notice", "Unlicense", "public domain", ["unlicense-notice"]),
    ("cc0-waiver", "CC0-1.0", "public domain", ["cc0-waiver"]),
    ("cc0-notice", "CC0-1.0", "public domain", ["cc0-1.0-notice"]),
    ("public-domain", "public domain", "public domain", ["public-domain"]),
    ("cc-by-notice", "CC-BY-4.0", "attribution", ["cc-by-4.0-notice"]),
    ("cc-by-sa-notice", "CC-BY-SA-4.0", "share alike", ["cc-by-sa-4.0-notice"]),
    ("cc-by-nc-notice", "CC-BY-NC-4.0", "noncommercial", ["cc-by-nc-4.0-notice"]),
    ("cc-by-nd-notice", "CC-BY-ND-4.0", "no derivatives", ["cc-by-nd-4.0-notice"]),
    ("reserved-no-copy", "proprietary", "reserved", ["all-rights-reserved", "no-copy"]),
    ("reserved", "proprietary", "reserved", ["all-rights-reserved"]),
    ("no-copy", "proprietary", "reserved", ["no-copy"]),
    ("confidential", "proprietary", "reserved", ["confidential"]),
]

# Each known sentence has one of these; texts without any are not cut at all.
ANCHORS = r"(?i)licen[cs]|permission|warrant|no\s+event|rights\s+reserved|redistribut|public\s+domain|copyright|under\s+(?:the\s+gnu|cc|mit|apache)"

#: Rows of either table; more are refused, as both go to every task.
MOST = 20_000

_SPACE = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256)).lower()
_ANCHORED = re.compile(ANCHORS.removeprefix("(?i)").encode())
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ENDS = re.compile(rb"(?<=[.!?:])[ \t\r\n]+|\n[ \t\r]*\n|\x1e")
MEASURED = "sentence_ids STRING, rules STRING, licences STRING, kinds STRING"


def normal(sentence: bytes) -> bytes:
    """Lower case, with all but letters, digits and characters beyond ASCII as blanks."""
    return b" ".join(sentence.translate(_SPACE).split())


def known_sentences() -> list[tuple[str, str]]:
    """(sentence, identifier) of this module."""
    said = [
        (form.format(name), f"{licence}-notice") for licence, names in NAMES.items() for name in names for form in NOTICES
    ]
    return [*((text, name) for name, text in SENTENCES.items()), *said]


def sentence_table(spark: SparkSession) -> DataFrame:
    """(text, sentence_id) of the sentences above."""
    return spark.createDataFrame(known_sentences(), "text STRING, sentence_id STRING")


def rule_table(spark: SparkSession) -> DataFrame:
    """(place, rule, licence, kind, sentence_ids) of the rules above."""
    rows = [(i, *r) for i, r in enumerate(RULES)]
    return spark.createDataFrame(rows, "place INT, rule STRING, licence STRING, kind STRING, sentence_ids ARRAY<STRING>")


class Scanner:
    """Identifiers of a text's sentences, and the rules they fit."""

    def __init__(self, known: Iterable[tuple[str, str]], rules: list[tuple[str, str, str, list[str]]]) -> None:
        self.known = {normal(text.encode()): name for text, name in known}
        self.rules = [(*rule[:3], tuple(rule[3])) for rule in rules]
        uses = Counter(name for *_, ids in self.rules for name in set(ids))
        # From the sentence that fewest rules have to the rules, and where it stands in them.
        self.index: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (*_, ids) in enumerate(self.rules):
            if ids:
                rarest = min(ids, key=uses.__getitem__)
                self.index[rarest].append((number, ids.index(rarest)))

    def ids(self, raw: bytes) -> list[str]:
        if not _ANCHORED.search(raw.translate(_LOWER)):
            return []
        found = []
        for sentence in _ENDS.split(raw):
            name = self.known.get(normal(sentence))
            if name is not None:
                found.append(name)
            elif b"\n" in sentence:
                found += [self.known[x] for x in map(normal, sentence.split(b"\n")) if x in self.known]
        return found

    def fits(self, ids: list[str]) -> list[int]:
        """Numbers of the rules that fit at a place not within that of a longer one, sorted."""
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        for at, name in enumerate(ids):
            for number, offset in self.index.get(name, ()):
                rule, start = self.rules[number][3], at - offset
                if start >= 0 and tuple(ids[start : start + len(rule)]) == rule:
                    places[start, -(start + len(rule))].append(number)
        named: set[int] = set()
        reached = 0
        for start, end in sorted(places):
            if -end > reached:
                named.update(places[start, end])
                reached = -end
        return sorted(named)

    def __call__(self, texts: list[bytes | None]) -> dict[str, list]:
        out: dict[str, list] = {"sentence_ids": [], "rules": [], "licences": [], "kinds": []}
        for raw in texts:
            ids = self.ids(raw) if raw else []
            rules = [self.rules[n] for n in self.fits(ids)]
            out["sentence_ids"].append(",".join(ids))
            for place, name in enumerate(("rules", "licences", "kinds")):
                out[name].append(",".join(dict.fromkeys(r[place] for r in rules)))
        return out


def scan_licences(docs: DataFrame, sentences: DataFrame | None = None, rules: DataFrame | None = None) -> DataFrame:
    """(doc_id, sentence_ids, rules, licences, kinds) of every row, each a text
    joined by commas; rules in the order of their ``place``, the others distinct.

    ``sentences`` and ``rules`` are tables as those of ``sentence_table`` and
    ``rule_table``, which are used where none are given.
    """
    spark = docs.sparkSession
    known = (sentence_table(spark) if sentences is None else sentences).select("text", "sentence_id")
    said = (rule_table(spark) if rules is None else rules).orderBy("place").select("rule", "licence", "kind", "sentence_ids")
    tables = [[tuple(r) for r in table.limit(MOST + 1).collect()] for table in (known, said)]
    if max(map(len, tables)) > MOST:
        raise ValueError(f"more than {MOST} sentences or rules")
    sent = spark.sparkContext.broadcast(tables)
    return measure(docs, ["doc_id"], "text", lambda: Scanner(*sent.value), MEASURED)


def _sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(normal(s.encode()).decode())}, {quoted(n)})" for s, n in dict(known_sentences()).items())
    rules = ", ".join(f"({i}, {quoted(r)}, {quoted(x)}, {quoted(k)}, {ids})" for i, (r, x, k, ids) in enumerate(RULES))
    form = (
        "trim(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[^0-9a-z\x{{80}}-\x{{10ffff}}]+', ' ', 'g'))"
    )
    distinct = "array_to_string([x FOR x, i IN {0} IF list_position({0}, x) = i], ',')"
    return f"""
WITH known(form, id) AS (SELECT DISTINCT * FROM (VALUES {known})),
rule(place, rule, licence, kind, ids) AS (VALUES {rules}),
doc AS (SELECT row_number() OVER () AS d, doc_id, text FROM documents),
cut AS (
  SELECT d, unnest(range(len(s))) AS i, unnest(s) AS s FROM (
    SELECT d, string_split(regexp_replace(regexp_replace(text, '([.!?:])[ \\t\\r\\n]+', '\\1' || chr(30), 'g'), '\\n[ \\t\\r]*\\n', chr(30), 'g'), chr(30)) AS s
    FROM doc)),
whole AS (SELECT d, i, 0 AS j, id FROM cut JOIN known ON form = {form.format('s')}),
line AS (
  SELECT d, i, unnest(range(len(l))) AS j, unnest(l) AS l FROM (
    SELECT d, i, string_split(s, chr(10)) AS l FROM cut ANTI JOIN whole USING (d, i))),
met AS (SELECT * FROM whole UNION ALL SELECT d, i, j, id FROM line JOIN known ON form = {form.format('l')}),
chain AS (SELECT d, list(id ORDER BY i, j) AS c FROM met GROUP BY d),
fit AS (
  SELECT d, place, rule, licence, kind, start, start + len(ids) AS stop
  FROM (SELECT d, c, unnest(range(1, len(c) + 1)) AS start FROM chain) JOIN rule
    ON c[start:start + len(ids) - 1] = ids),
named AS (
  SELECT * FROM fit f WHERE NOT EXISTS (
    SELECT 1 FROM fit g WHERE g.d = f.d AND g.start <= f.start AND f.stop <= g.stop AND g.stop - g.start > f.stop - f.start)),
listed AS (
  SELECT d, list(rule ORDER BY place) AS r, list(licence ORDER BY place) AS l, list(kind ORDER BY place) AS k
  FROM named GROUP BY d)
SELECT doc_id, coalesce(array_to_string(c, ','), '') AS sentence_ids, coalesce({distinct.format('r')}, '') AS rules,
       coalesce({distinct.format('l')}, '') AS licences, coalesce({distinct.format('k')}, '') AS kinds
FROM doc LEFT JOIN chain USING (d) LEFT JOIN listed USING (d)"""


SQL = _sql()
