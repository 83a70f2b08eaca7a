"""License scans with ordered signature rules.

Texts become lower-case words set apart by one blank, so the rules needn't mind punctuation or line
ends.  Each rule has a keyword; only the rules whose keyword the text holds are run.  Detections
that lie within one of a higher priority, or within a longer one of the same, are suppressed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .decontaminate import words

#: The phrases that are always counted, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Rules by hand: label, keyword, pattern over blank-separated lower-case words.
#: Notices (whole sentences of a license) come before names with versions, these before bare names.
NOTICES = r"""
mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy
mit | without restriction including | without restriction including without limitation the rights to use copy modify merge publish distribute sublicense
isc | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
0bsd | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?! provided)
bsd | redistribution and use in source | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | neither the name | neither the name of (?:the )?(?:\S+ ){1,8}nor the names of its contributors may be used to endorse
bsd-4-clause | all advertising materials | all advertising materials mentioning features or use of this software must display
gpl-2.0-or-later | redistribute it and or modify | under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or
gpl-3.0-or-later | redistribute it and or modify | under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or
lgpl-2.1-or-later | redistribute it and or modify | under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or
lgpl-3.0-or-later | redistribute it and or modify | under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or
agpl-3.0-or-later | redistribute it and or modify | under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or
gpl-warranty | without even the implied warranty | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license
apache-2.0 | except in compliance | you may not use this file except in compliance with the license
apache-2.0 | unless required by applicable law | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
mpl-2.0 | source code form is subject | this source code form is subject to the terms of the mozilla public license v 2 0
epl-2.0 | accompanying materials are made | this program and the accompanying materials are made available under the terms of the eclipse public license 2 0
unlicense | unencumbered software | this is free and unencumbered software released into the public domain
cc0-1.0 | waived all copyright | (?:has )?waived all copyright and related or neighboring rights
zlib | altered source versions | altered source versions must be plainly marked as such
boost-1.0 | boost software license | distributed under the boost software license version 1 0
wtfpl | what the | (?:do )?what the \S+ you want to public license
ofl-1.1 | sil open font license | licensed under the sil open font license version 1 1
artistic | artistic license | same terms as perl itself
public-domain | public domain | (?:released|placed|dedicated|dedicate this \S+) (?:in)?to the public domain
proprietary | all rights reserved | all rights reserved
proprietary | confidential and proprietary | confidential and proprietary
proprietary | strictly prohibited | unauthorized (?:copying|use|reproduction|distribution) (?:\S+ ){0,8}(?:is )?strictly prohibited
no-redistribution | may not be | may not be (?:reproduced|redistributed|copied) (?:\S+ ){0,6}without (?:the )?(?:prior )?(?:written |express )+(?:permission|consent)
noncommercial | noncommercial | (?:for )?noncommercial (?:use|purposes) only
noncommercial | non commercial | (?:for )?non commercial (?:use|purposes) only
evaluation | evaluation | for evaluation (?:use|purposes) only
as-is | provided as is | provided as is without warranty of any kind
"""

#: Names: label, keyword, name, the versions that it is published in.
NAMES = r"""
gpl | gpl | (?:gnu )?gpl | 1 2 3
gpl | general public license | gnu general public license | 1 2 3
lgpl | lgpl | (?:gnu )?lgpl | 2 2.1 3
lgpl | lesser general public license | gnu lesser general public license | 2.1 3
lgpl | library general public license | gnu library general public license | 2
agpl | agpl | (?:gnu )?agpl | 1 3
agpl | affero general public license | (?:gnu )?affero general public license | 1 3
gfdl | free documentation license | gnu free documentation license | 1.1 1.2 1.3
apache | apache license | apache license | 1.0 1.1 2.0
apache | apache software license | apache software license | 1.1 2.0
mpl | mozilla public license | mozilla public license | 1.0 1.1 2.0
epl | eclipse public license | eclipse public license | 1.0 2.0
cpl | common public license | common public license | 1.0
cddl | common development and distribution license | common development and distribution license | 1.0 1.1
eupl | european union public licence | european union public licence | 1.0 1.1 1.2
ofl | open font license | (?:sil )?open font license | 1.0 1.1
boost | boost software license | boost software license | 1.0
artistic | artistic license | (?:perl )?artistic license | 1.0 2.0
afl | academic free license | academic free license | 1.1 1.2 2.0 2.1 3.0
osl | open software license | open software license | 1.0 1.1 2.0 2.1 3.0
ecl | educational community license | educational community license | 1.0 2.0
upl | universal permissive license | universal permissive license | 1.0
mulan-psl | mulan psl | mulan psl | 1 2
zpl | zope public license | zope public license | 1.1 2.0 2.1
lppl | latex project public license | latex project public license | 1.0 1.1 1.2 1.3
php | php license | php license | 3.0 3.01
python | python software foundation license | python software foundation license | 2
qpl | q public license | q public license | 1.0
ms-pl | microsoft public license | microsoft public license |
ms-rl | microsoft reciprocal license | microsoft reciprocal license |
apsl | apple public source license | apple public source license | 1.0 1.1 1.2 2.0
cecill | cecill | cecill(?: license)? | 1.0 1.1 2.0 2.1
odbl | open database license | (?:open data commons )?open database license | 1.0
odc-by | open data commons attribution | open data commons attribution license | 1.0
pddl | public domain dedication and license | public domain dedication and license | 1.0
busl | business source license | business source license | 1.0 1.1
sspl | server side public license | server side public license | 1
elastic | elastic license | elastic license | 1.0 2.0
mit | mit license | (?:the )?mit license |
mit | expat license | expat license |
bsd | bsd license | bsd license |
bsd-2-clause | bsd | (?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: license)? |
bsd-3-clause | bsd | (?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: license)? |
isc | isc license | isc license |
zlib | zlib license | (?:zlib|zlib libpng) license |
unlicense | unlicense | (?:the )?unlicense(?: license)? |
wtfpl | wtfpl | wtfpl |
beerware | beer | beer ?ware(?: license)? |
openssl | openssl license | openssl license |
ncsa | ncsa | (?:university of illinois )?ncsa open source license |
json | json license | json license |
vim | vim license | vim license |
curl | curl license | curl license |
postgresql | postgresql license | postgresql license |
unicode | unicode license | unicode license |
x11 | x11 license | x11 license |
w3c | w3c | w3c software (?:notice and )?license |
oracle-bcl | binary code license | oracle binary code license |
cc0 | cc0 | cc0 | 1.0
"""

#: Creative Commons: element codes and the long names.
CC = {"by": "attribution", "by sa": "attribution sharealike", "by nd": "attribution noderivatives", "by nc": "attribution noncommercial", "by nc sa": "attribution noncommercial sharealike", "by nc nd": "attribution noncommercial noderivatives"}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


#: Names that stand for a license only with a version, as in SPDX ids.
SHORT = "apache mpl epl cddl eupl ofl artistic afl osl ecl upl zpl lppl php"


def identifiers() -> dict[str, str]:
    """SPDX ids as words, and their labels: a name with each of its versions, and those that have none."""
    out = {}
    for line in NAMES.strip().splitlines():
        label, _, _, *rest = line.rstrip(" |").split(" | ")
        bare = label.replace("-", " ")
        for v in rest[0].split() if rest else []:
            words = bare + " " + (v if "." in v else f"{v}.0").replace(".", " ")
            out |= {words: f"{label}-{v}", f"{words} only": f"{label}-{v}", f"{words} or later": f"{label}-{v}-or-later"}
        if not rest:
            out[bare] = label
    for code in CC:
        out |= {f"cc {code} {v.replace('.', ' ')}": f"cc-{code.replace(' ', '-')}-{v}" for v in CC_VERSIONS}
    return out


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: bytes
    pattern: re.Pattern[bytes]
    priority: int
    weight: float


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, from high priority to low: notices, names with versions, names."""
    made = lambda label, key, body, priority, weight: Rule(label, key.encode(), re.compile(rf"(?<= )(?:{body})(?= )".encode()), priority, weight)
    out = [made(*line.split(" | "), 3, 0.95) for line in NOTICES.strip().splitlines()]
    dotted = lambda v: v.replace(".0", r"(?: 0)?").replace(".", " ") + ("" if "." in v else r"(?: 0)?")
    # "gpl 2", "gplv2", "gpl v2", "gpl version 2", "gpl 2.0": punctuation is gone by now.
    version = lambda v: rf"(?: version)?(?: v ?|v| ){dotted(v)}"
    later = r"(?: only)? (?:or|and) (?:at your option )?(?:any )?later(?: version)?"
    for line in NAMES.strip().splitlines():
        label, key, name, *rest = (x.strip() for x in line.split("|") if "(?:" not in line) if "(?:" not in line else (x.strip() for x in line.split(" | "))
        versions = (rest[0].rstrip("|").split() if rest else [])
        name = name.removesuffix(" |")
        for v in versions:
            if label in ("gpl", "lgpl", "agpl", "gfdl"):
                out.append(made(f"{label}-{v}-or-later", key, f"{name}{version(v)}{later}", 2, 0.9))
            out.append(made(f"{label}-{v}", key, name + version(v), 2, 0.85))
        out.append(made(label, key, name, 1, 0.6))
    for code, long in CC.items():
        label = "cc-" + code.replace(" ", "-")
        names = (("cc " + code, "cc " + code), ("creative commons", rf"creative commons {long}"))
        for key, name in names:
            out += [made(f"{label}-{v}", key, rf"{name}(?: license)?{version(v)}(?: international| unported)?", 2, 0.85) for v in CC_VERSIONS]
            out.append(made(label, key, name, 1, 0.6))
    for label in SHORT.split():
        for v in next(x.split(" | ")[3].split() for x in NAMES.strip().splitlines() if x.startswith(f"{label} | ")):
            out.append(made(f"{label}-{v}", f"{label} {v[0]}", f"{label} {v.replace('.', ' ')}", 2, 0.85))
    for spdx, label in identifiers().items():
        out.append(made(label, "spdx license identifier", f"spdx license identifier {spdx}", 3, 0.95))
    out.append(made("spdx", "spdx license identifier", r"spdx license identifier \S+(?: \d+)*", 0, 0.5))
    out.append(made("licensed", "licensed under", r"licensed under (?:the )?(?:terms of )?(?:\S+ ){1,6}licen[cs]e", 0, 0.4))
    return tuple(sorted(out, key=lambda r: -r.priority))


@dataclass(frozen=True)
class Detection:
    start: int
    end: int
    label: str
    priority: int
    weight: float


def line_of(text: bytes | None) -> tuple[bytes, int]:
    """The words between blanks, and their number."""
    w = words(text)
    return b" " + b" ".join(w) + b" ", len(w)


def word_numbers(line: bytes, offsets: list[int]) -> dict[int, int]:
    """The number of the word that begins at each offset, or that would after the blank there."""
    out, at, n = {}, 0, -1
    for o in sorted(set(offsets)):
        n += line.count(b" ", at, o)
        at = o
        out[o] = n
    return out


def unsuppressed(found: list[Detection]) -> list[Detection]:
    """Those that lie in none of higher priority and in no longer one (or an equal one before it) of the same.

    A sweep for each priority, from high to low, over what was kept before and its own detections.
    """
    kept: list[Detection] = []
    for priority in sorted({d.priority for d in found}, reverse=True):
        own = [d for d in found if d.priority == priority]
        reach, now = -1, []
        for d in sorted(kept + own, key=lambda d: (d.start, -d.end, -d.priority, d.label)):
            if d.priority == priority and d.end > reach:
                now.append(d)
            reach = max(reach, d.end)
        kept += now
    return kept


def detections(line: bytes) -> list[Detection]:
    """What the rules find and nothing suppresses, in words."""
    found = [Detection(m.start(), m.end(), r.label, r.priority, r.weight) for r in rules() if r.keyword in line for m in r.pattern.finditer(line)]
    kept = unsuppressed(found)
    at = word_numbers(line, [x for d in kept for x in (d.start, d.end)])
    return sorted((Detection(at[d.start], at[d.end] + 1, d.label, d.priority, d.weight) for d in kept), key=lambda d: (d.start, d.end, d.label))


def bases(line: bytes) -> list[tuple[int, str]]:
    """(start, label) of each place of each base phrase; places may overlap."""
    out = []
    for phrase, label in BASE.items():
        p, at = f" {phrase} ".encode(), -1
        while (at := line.find(p, at + 1)) >= 0:
            out.append((at + 1, label))
    number = word_numbers(line, [x for x, _ in out])
    return sorted((number[x], label) for x, label in out)


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keywords = sorted({r.keyword for r in rules()} | {p.encode() for p in BASE})
    gate = re.compile(b"|".join(map(re.escape, keywords)))
    for batch in batches:
        rows = []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
            line, n = line_of(text.as_py())
            if not gate.search(line):
                rows.append({"id": i, "n_words": n, "bases": [], "found": []})
                continue
            found = [{"start": d.start, "end": d.end, "label": d.label, "priority": d.priority, "weight": d.weight} for d in detections(line)]
            rows.append({"id": i, "n_words": n, "bases": [{"start": a, "label": b} for a, b in bases(line)], "found": found})
        yield pa.RecordBatch.from_pylist(rows, SCHEMA)


SCHEMA = pa.schema(
    [
        ("id", pa.int64()),
        ("n_words", pa.int64()),
        ("bases", pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))),
        ("found", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("priority", pa.int32()), ("weight", pa.float64())]))),
    ]
)


def scanned(docs: DataFrame) -> DataFrame:
    """id, n_words, bases (start, label), found (start, end, label, priority, weight; in words, ends exclusive).

    Null and empty texts have no words and nothing is found.  Each row is scanned on its own, so
    repeated rows give the same; columns beside doc_id and text are not read.
    """
    schema = "id bigint, n_words bigint, bases array<struct<start:bigint,label:string>>, found array<struct<start:bigint,end:bigint,label:string,priority:int,weight:double>>"
    return docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(scan, schema)
