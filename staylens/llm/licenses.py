"""License scans by ordered signature rules.

Each rule is a regular expression with a label, a priority, a confidence and a
literal gate that any of its matches contains. Both are held against the
lower-cased text with runs of blanks, line ends and comment marks folded to one
space: one Aho-Corasick pass finds which gates occur; only their rules run. Detections are
then taken by priority (longer, then earlier first), and one whose interval
lies inside an accepted detection's is suppressed, so "GNU Lesser General
Public License" is not also reported as the shorter name inside it.

Beside the rules, plain phrases are counted as consecutive words. Their labels
are always reported.

One pass, no shuffle; whole texts of any length. Null or empty text: no words,
no labels, score 0. Repeated rows are each answered.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm import words

#: Phrases whose consecutive words give a base label.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    gate: str
    priority: int
    confidence: float


# One line per licence: label; gate; its names as written in prose; its short
# identifiers; its address, if it has one of its own. All in lower case.
_NAMES = """
gpl-1.0 ; gnu ; gnu general public license,? (?:version|v\\.?) ?1(?:\\.0)?\\b ; gpl-?v?1(?:\\.0)? ; gnu\\.org/licenses/gpl-1\\.0
gpl-2.0 ; gnu ; gnu general public license,? (?:version|v\\.?) ?2(?:\\.0)?\\b ; gpl-?v?2(?:\\.0)? ; gnu\\.org/licenses/(?:old-licenses/)?gpl-2\\.0
gpl-3.0 ; gnu ; gnu general public license,? (?:version|v\\.?) ?3(?:\\.0)?\\b ; gpl-?v?3(?:\\.0)? ; gnu\\.org/licenses/gpl-3\\.0
lgpl-2.0 ; gnu ; gnu library general public license ; lgpl-?v?2(?:\\.0)? ; gnu\\.org/licenses/(?:old-licenses/)?lgpl-2\\.0
lgpl-2.1 ; gnu ; gnu lesser general public license,? (?:version|v\\.?) ?2\\.1\\b ; lgpl-?v?2\\.1 ; gnu\\.org/licenses/(?:old-licenses/)?lgpl-2\\.1
lgpl-3.0 ; gnu ; gnu lesser general public license,? (?:version|v\\.?) ?3(?:\\.0)?\\b ; lgpl-?v?3(?:\\.0)? ; gnu\\.org/licenses/lgpl-3\\.0
agpl-3.0 ; gnu ; gnu affero general public license,? (?:version|v\\.?) ?3(?:\\.0)?\\b ; agpl-?v?3(?:\\.0)? ; gnu\\.org/licenses/agpl-3\\.0
gfdl-1.3 ; gnu ; gnu free documentation license ; gfdl-?v?1\\.[123] ; gnu\\.org/licenses/fdl
lgpl ; gnu ; gnu lesser general public license ; lgpl ; gnu\\.org/licenses/lgpl
agpl ; gnu ; gnu affero general public license ; agpl ; gnu\\.org/licenses/agpl
gpl ; gnu ; gnu general public license ; gpl ; gnu\\.org/licenses/gpl
apache-1.0 ; apache ; apache(?: software)? license,? (?:version|v\\.?) ?1\\.0\\b ; apache-1\\.0 ; apache\\.org/licenses/license-1\\.0
apache-1.1 ; apache ; apache(?: software)? license,? (?:version|v\\.?) ?1\\.1\\b ; apache-1\\.1 ; apache\\.org/licenses/license-1\\.1
apache-2.0 ; apache ; apache(?: software)? license,? (?:\\(?(?:version|v\\.?) ?)?2(?:\\.0)?\\b ; apache-?2(?:\\.0)? ; apache\\.org/licenses/license-2\\.0
apache ; apache ; apache(?: software)? license ; asl ; apache\\.org/licenses
mit ; mit ; (?:the )?mit(?:/expat)? licen[sc]e ; mit ; opensource\\.org/licenses/mit\\b
mit-0 ; mit ; mit no attribution license ; mit-0 ; opensource\\.org/licenses/mit-0
x11 ; x11 ; x11 licen[sc]e ; x11 ; x\\.org/terms
expat ; expat ; expat licen[sc]e ; expat ; jclark\\.com/xml/copying
bsd-2-clause ; bsd ; (?:2|two)[- ]clause bsd(?: licen[sc]e)?|simplified bsd licen[sc]e|freebsd licen[sc]e ; bsd-2-clause ; opensource\\.org/licenses/bsd-2-clause
bsd-3-clause ; bsd ; (?:3|three)[- ]clause bsd(?: licen[sc]e)?|(?:new|modified|revised) bsd licen[sc]e ; bsd-3-clause ; opensource\\.org/licenses/bsd-3-clause
bsd-4-clause ; bsd ; (?:4|four)[- ]clause bsd(?: licen[sc]e)?|original bsd licen[sc]e ; bsd-4-clause ; opensource\\.org/licenses/bsd-4-clause
0bsd ; bsd ; zero[- ]clause bsd(?: licen[sc]e)? ; 0bsd ; opensource\\.org/licenses/0bsd
bsd ; bsd ; bsd[- ](?:style )?licen[sc]e ; bsd ; opensource\\.org/licenses/bsd-license
isc ; isc ; (?:the )?isc licen[sc]e ; isc ; opensource\\.org/licenses/isc
mpl-1.0 ; mozilla ; mozilla public license,? (?:version|v\\.?) ?1\\.0\\b ; mpl-?1\\.0 ; mozilla\\.org/mpl/1\\.0
mpl-1.1 ; mozilla ; mozilla public license,? (?:version|v\\.?) ?1\\.1\\b ; mpl-?1\\.1 ; mozilla\\.org/mpl/1\\.1
mpl-2.0 ; mozilla ; mozilla public license,? (?:(?:version|v\\.?) ?)?2\\.0\\b ; mpl-?2\\.0 ; mozilla\\.org/(?:en-us/)?mpl/2\\.0
mpl ; mozilla ; mozilla public license ; mpl ; mozilla\\.org/mpl
epl-1.0 ; eclipse ; eclipse public license,? (?:-? ?(?:version|v\\.?) ?)?1\\.0\\b ; epl-?1\\.0 ; eclipse\\.org/legal/epl-v10
epl-2.0 ; eclipse ; eclipse public license,? (?:-? ?(?:version|v\\.?) ?)?2\\.0\\b ; epl-?2\\.0 ; eclipse\\.org/legal/epl-(?:v20|2\\.0)
edl-1.0 ; eclipse ; eclipse distribution license ; edl-?1\\.0 ; eclipse\\.org/org/documents/edl-v10
cddl-1.0 ; common development ; common development and distribution license ; cddl-?1\\.[01] ; opensource\\.org/licenses/cddl
cpl-1.0 ; common public ; common public license ; cpl-?1\\.0 ; opensource\\.org/licenses/cpl
ipl-1.0 ; ibm ; ibm public license ; ipl-?1\\.0 ; opensource\\.org/licenses/ibmpl
artistic-1.0 ; artistic ; artistic license,? (?:(?:version|v\\.?) ?)?1\\.0\\b ; artistic-?1\\.0 ; opensource\\.org/licenses/artistic-license-1\\.0
artistic-2.0 ; artistic ; artistic license,? (?:(?:version|v\\.?) ?)?2\\.0\\b ; artistic-?2\\.0 ; opensource\\.org/licenses/artistic-license-2\\.0
artistic ; artistic ; artistic licen[sc]e ; artistic ; perlfoundation\\.org/artistic
bsl-1.0 ; boost ; boost software license ; bsl-1\\.0 ; boost\\.org/license_1_0
busl-1.1 ; business source ; business source license ; busl-?1\\.1 ; mariadb\\.com/bsl
sspl-1.0 ; server side public ; server side public license ; sspl-?(?:v?1(?:\\.0)?)? ; mongodb\\.com/licensing/server-side
elastic-2.0 ; elastic ; elastic license(?: 2\\.0)? ; elastic-2\\.0 ; elastic\\.co/licensing
zlib ; zlib ; zlib(?:/libpng)? licen[sc]e ; zlib ; opensource\\.org/licenses/zlib
libpng ; libpng ; libpng licen[sc]e ; libpng(?:-2\\.0)? ; libpng\\.org/pub/png/src/libpng-license
unlicense ; unlicense ; (?:the )?unlicense ; unlicense ; unlicense\\.org
wtfpl ; what the f ; do what the f\\S+ you want to public license ; wtfpl ; wtfpl\\.net
cc0-1.0 ; cc0 ; cc0(?: 1\\.0)?(?: universal)? ; cc0-?1\\.0 ; creativecommons\\.org/publicdomain/zero
cc-by-nc-nd ; creative commons ; creative commons attribution[- ]non-?commercial[- ]no-?deriv\\w* ; cc[- ]by-nc-nd(?:[- ][1-4]\\.0)? ; creativecommons\\.org/licenses/by-nc-nd
cc-by-nc-sa ; creative commons ; creative commons attribution[- ]non-?commercial[- ]share-?alike ; cc[- ]by-nc-sa(?:[- ][1-4]\\.0)? ; creativecommons\\.org/licenses/by-nc-sa
cc-by-nc ; creative commons ; creative commons attribution[- ]non-?commercial ; cc[- ]by-nc(?:[- ][1-4]\\.0)? ; creativecommons\\.org/licenses/by-nc
cc-by-nd ; creative commons ; creative commons attribution[- ]no-?deriv\\w* ; cc[- ]by-nd(?:[- ][1-4]\\.0)? ; creativecommons\\.org/licenses/by-nd
cc-by-sa ; creative commons ; creative commons attribution[- ]share-?alike ; cc[- ]by-sa(?:[- ][1-4]\\.0)? ; creativecommons\\.org/licenses/by-sa
cc-by-4.0 ; creative commons ; creative commons attribution 4\\.0 ; cc[- ]by[- ]4\\.0 ; creativecommons\\.org/licenses/by/4\\.0
cc-by ; creative commons ; creative commons attribution ; cc[- ]by ; creativecommons\\.org/licenses/by/
odbl-1.0 ; open database ; open (?:data commons )?open database license|open database license ; odbl(?:-?1\\.0)? ; opendatacommons\\.org/licenses/odbl
odc-by-1.0 ; open data commons ; open data commons attribution license ; odc-by(?:-1\\.0)? ; opendatacommons\\.org/licenses/by
pddl-1.0 ; public domain ; (?:open data commons )?public domain dedication (?:and|&) licen[sc]e ; pddl(?:-1\\.0)? ; opendatacommons\\.org/licenses/pddl
cdla ; community data ; community data license agreement ; cdla-(?:permissive|sharing)-[12]\\.0 ; cdla\\.(?:io|dev)
psf-2.0 ; python ; python software foundation license ; psf-2\\.0 ; python\\.org/psf/license
php-3.01 ; php ; php license ; php-3\\.01? ; php\\.net/license
ruby ; ruby ; ruby licen[sc]e ; ruby ; ruby-lang\\.org/en/about/license
postgresql ; postgresql ; postgresql licen[sc]e ; postgresql ; postgresql\\.org/about/licence
openssl ; openssl ; openssl licen[sc]e ; openssl ; openssl\\.org/source/license
ncsa ; ncsa ; (?:university of illinois/)?ncsa open source license ; ncsa ; opensource\\.org/licenses/ncsa
afl-3.0 ; academic free ; academic free license ; afl-?[123]\\.[0-2] ; opensource\\.org/licenses/afl
osl-3.0 ; open software ; open software license ; osl-?[123]\\.[0-1] ; opensource\\.org/licenses/osl
ofl-1.1 ; open font ; (?:sil )?open font license ; ofl-?1\\.[01] ; scripts\\.sil\\.org/ofl
eupl-1.2 ; european union ; european union public licen[sc]e ; eupl-?1\\.[012] ; joinup\\.ec\\.europa\\.eu
ms-pl ; microsoft ; microsoft public license ; ms-pl ; opensource\\.org/licenses/ms-pl
ms-rl ; microsoft ; microsoft reciprocal license ; ms-rl ; opensource\\.org/licenses/ms-rl
qpl-1.0 ; q public ; q public license ; qpl-?1\\.0 ; opensource\\.org/licenses/qtpl
sleepycat ; sleepycat ; sleepycat licen[sc]e ; sleepycat ; opensource\\.org/licenses/sleepycat
vim ; vim ; vim licen[sc]e ; vim ; vimhelp\\.org/uganda
upl-1.0 ; universal permissive ; universal permissive license ; upl-?1\\.0 ; opensource\\.org/licenses/upl
mulan-psl-2.0 ; mulan ; mulan (?:permissive software|psl) ?licen[sc]e ; mulanpsl-2\\.0 ; license\\.coscl\\.org\\.cn/mulanpsl2
""".strip()

#: Sentences of licence texts and notices: label, pattern, gate, confidence.
_NOTICES = [
    ("mit", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software", "permission is hereby granted", 0.99),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies", "permission notice shall be", 0.9),
    ("isc", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee", "permission to use, copy", 0.97),
    ("bsd", r"redistribution and use in source and binary forms, with or without modification, are permitted", "redistribution and use", 0.95),
    ("bsd-3-clause", r"neither the name of .{1,120}? nor the names of its contributors may be used to endorse", "neither the name of", 0.9),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", "all advertising materials", 0.95),
    ("gpl-2.0", r"either version 2 of the license,? or \(at your option\) any later version", "either version 2 of", 0.95),
    ("gpl-3.0", r"either version 3 of the license,? or \(at your option\) any later version", "either version 3 of", 0.95),
    ("gpl", r"this program is free software[:;,] you can redistribute it and/or modify it under the terms of the gnu general public license", "this program is free software", 0.98),
    ("lgpl", r"this library is free software[:;,] you can redistribute it and/or modify it", "this library is free software", 0.95),
    ("apache-2.0", r"licensed under the apache license,? version 2\.0", "licensed under the apache", 0.99),
    ("apache-2.0", r"you may not use this file except in compliance with the license", "except in compliance with the license", 0.85),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license", "source code form is subject", 0.98),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license", "contents of this file are subject", 0.95),
    ("cddl-1.0", r"the contents of this file are subject to the terms of the common development", "contents of this file are subject", 0.95),
    ("bsl-1.0", r"boost software license - version 1\.0", "boost software license", 0.98),
    ("zlib", r"this software is provided 'as-is', without any express or implied warranty", "provided 'as-is'", 0.9),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "free and unencumbered", 0.99),
    ("public-domain", r"(?:placed|released|dedicated) (?:in|into|to) the public domain", "public domain", 0.8),
    ("proprietary", r"all rights reserved", "all rights reserved", 0.5),
    ("proprietary", r"proprietary and confidential", "proprietary and confidential", 0.8),
]


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, in order: notices, "licensed under" forms, identifiers, addresses, bare names."""
    out = [Rule(label, p, gate, 50, c) for label, p, gate, c in _NOTICES]
    for line in _NAMES.splitlines():
        label, gate, names, ids, url = (x.strip() for x in line.split(" ; "))
        granted = r"(?:licensed|released|distributed|available|published|provided|shared) under (?:the )?(?:terms of )?(?:the )?"
        out += [
            Rule(label, rf"{granted}(?:{names})", gate, 40, 0.95),
            Rule(label, rf"{granted}(?:{ids})\b(?![-.]?\d)", "under", 38, 0.9),
            Rule(label, rf"spdx-license-identifier: ?(?:{ids})(?:-only|-or-later|\+)?(?![\w.-])", "spdx-license-identifier", 45, 1.0),
            Rule(label, rf"\blicen[sc]e ?[:=] ?[\"']?(?:{ids})(?![\w.-])", "licen", 35, 0.85),
            Rule(label, rf"https?://(?:www\.)?{url}", "http", 30, 0.9),
            Rule(label, rf"\b(?:{names})", gate, 20, 0.8),
        ]
    return tuple(out)


@lru_cache(maxsize=1)
def _machine():
    by_gate = defaultdict(list)
    for i, rule in enumerate(rules()):
        by_gate[rule.gate].append((i, re.compile(rule.pattern)))
    finder = ahocorasick.Automaton()
    for gate in by_gate:
        finder.add_word(gate, gate)
    finder.make_automaton()
    return finder, by_gate


#: Line ends with the comment marks of the next line, marks that close a line, other blanks than one space.
_FOLDED = re.compile(r"[\r\n][\s*#/;%>|!-]*|(?<=[ \t])[*#|]+(?=[^\S\r\n]{0,4}[\r\n])|[^\S\r\n]{2,}|[^\S\r\n ]")


def fold(text: str) -> tuple[str, list[int], list[int]]:
    """The text with one space for each run of blanks, line ends and comment marks at line
    borders; where its unchanged parts begin, in it and in the text."""
    parts, at, origin, size, last = [], [0], [0], 0, 0
    for m in _FOLDED.finditer(text):
        a, b = m.span()
        if a > last:
            parts.append(text[last:a])
            size += a - last
        if parts and not parts[-1].endswith(" "):
            parts.append(" ")
            at.append(size)
            origin.append(a)
            size += 1
        at.append(size)
        origin.append(b)
        last = b
    return "".join(parts) + text[last:], at, origin


class _Reach:
    """Largest end of the accepted intervals that begin at or before a place: an interval lies in
    one of them if that end is not before its own. A tree of maxima over the sorted starts."""

    def __init__(self, starts: list[int]) -> None:
        self.starts = sorted(set(starts))
        self.ends = [-1] * (len(self.starts) + 1)

    def add(self, start: int, end: int) -> None:
        i = bisect_right(self.starts, start)
        while i < len(self.ends):
            self.ends[i] = max(self.ends[i], end)
            i += i & -i

    def upto(self, start: int) -> int:
        i, most = bisect_right(self.starts, start), -1
        while i:
            most = max(most, self.ends[i])
            i -= i & -i
        return most


def detect(lowered: str, every_rule: bool = False) -> list[tuple[int, int, int]]:
    """Accepted detections (start, end, rule) of a lower-cased text, in order of start.

    The rules run on the folded text, so that wrapped and commented lines match.
    ``every_rule`` runs all rules without the gates (for tests).
    """
    finder, by_gate = _machine()
    lowered, at, origin = fold(lowered)
    gates = by_gate if every_rule else {g for _, g in finder.iter(lowered)}
    place = lambda x: origin[k := bisect_right(at, x) - 1] + x - at[k]
    found = [(place(m.start()), place(m.end() - 1) + 1, i) for g in gates for i, p in by_gate[g] for m in p.finditer(lowered)]
    if not found:
        return []
    order, kept = rules(), []
    found.sort(key=lambda d: (-order[d[2]].priority, -(d[1] - d[0]), d[0], d[2]))
    reach = _Reach([d[0] for d in found])
    for d in found:
        if reach.upto(d[0]) < d[1]:
            kept.append(d)
            reach.add(d[0], d[1])
    return sorted(kept)


def phrase_places(found: list[bytes], phrase: list[bytes]) -> list[int]:
    """Word places where the phrase's words stand consecutively."""
    return [i for i, w in enumerate(found) if w == phrase[0] and found[i : i + len(phrase)] == phrase]


_TO_SPACE = bytes(i if words.ALNUM[i] else 32 for i in range(256))
_OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "detections array<struct<start:long,end:long,label:string,confidence:double>>")
_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("confidence", pa.float64())]))


def _scan(phrases: dict[str, str]):
    split = [(p.encode().split(), label) for p, label in phrases.items()]

    def run(batches):
        order = rules()
        for batch in batches:
            for texts in words.slices(batch.column(1), lower=True):
                n_words = words.scan(texts, words.ALNUM).counts
                out = [[] for _ in range(7)]
                for i in range(len(texts)):
                    raw = texts.bytes_of(i)
                    places, base = [], set()
                    near = [x for x in split if all(w in raw for w in x[0])]
                    if near:
                        listed = raw.translate(_TO_SPACE).split()
                        for phrase, label in near:
                            if at := phrase_places(listed, phrase):
                                places += at
                                base.add(label)
                    kept = detect(raw.decode())
                    labels = base | {order[d[2]].label for d in kept}
                    score = max([0.0, *(order[d[2]].confidence for d in kept), *([0.8] if base else [])])
                    spans = [{"start": a, "end": b, "label": order[r].label, "confidence": order[r].confidence} for a, b, r in kept]
                    for column, x in zip(out, (len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, spans)):
                        column.append(x)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), _FOUND)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(texts.rows.start, len(texts)), pa.array(n_words), *(pa.array(c, k) for c, k in zip(out, kinds))],
                                                 ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"])

    return run


def license_scan(docs: DataFrame, phrases: dict[str, str] | None = None) -> DataFrame:
    """Words, phrase places, labels and detections (character spans) of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(PHRASES if phrases is None else phrases), _OUT)
