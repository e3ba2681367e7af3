"""License scans: ordered signature rules behind a keyword gate, with priority and containment suppression.

A family of licenses is one line of fixed values; the kinds of signature are five templates.  Families times
templates give a few hundred patterns.  A text first meets the gate: plain keywords that any pattern
needs.  Then only patterns whose own keyword is in the text are run.  Keywords are looked for with every run of white space as one blank, since
patterns match any run.  Of the detections, one that lies
inside another of the same or a higher priority is suppressed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wayfleet.llm.common import bounded_batches, flat
from wayfleet.llm.words import LOWER, find_words

# Label | keyword that every name of the family needs, or several without blanks between, one of which it needs | identifiers | names as patterns | links, "-" if none.
FAMILIES = """
agpl | affero | agpl-3\\.0(?:-only|-or-later)?|agpl-1\\.0 | (?:gnu )?affero general public license | gnu\\.org/licenses/agpl
lgpl | lesser | lgpl-(?:2\\.0|2\\.1|3\\.0)(?:-only|-or-later)? | (?:gnu )?lesser general public license | gnu\\.org/licenses/(?:old-licenses/)?lgpl[^ ]*
lgpl | library general | lgpl-2\\.0 | (?:gnu )?library general public license | gnu\\.org/licenses/old-licenses/library
gpl | general public | gpl-(?:1\\.0|2\\.0|3\\.0)(?:-only|-or-later)? | (?:gnu )?general public license | gnu\\.org/licenses/(?:old-licenses/)?gpl[^ ]*
gpl | gpl | gpl-(?:1\\.0|2\\.0|3\\.0)(?:-only|-or-later)? | gnu gpl | gnu\\.org/copyleft/gpl
gfdl | free documentation | gfdl-1\\.[123] | (?:gnu )?free documentation license | gnu\\.org/licenses/fdl
apache | apache | apache-(?:1\\.0|1\\.1|2\\.0) | apache (?:software )?license | apache\\.org/licenses/license-[12]\\.[01]
mit | mit | mit(?:-0|-modern-variant)? | mit(?: open source)? license | opensource\\.org/licenses?/mit
x11 | x11 | x11(?:-distribute-modifications-variant)? | x11 license | -
isc | isc | isc | isc license | opensource\\.org/licenses?/isc
bsd-2-clause | bsd | bsd-2-clause(?:-patent|-views)? | (?:simplified|freebsd|2-clause|two-clause) bsd license | opensource\\.org/licenses?/bsd-2-clause
bsd-3-clause | bsd | bsd-3-clause(?:-clear|-lbnl)? | (?:new|revised|modified|3-clause|three-clause) bsd license | opensource\\.org/licenses?/bsd-3-clause
bsd-4-clause | bsd | bsd-4-clause(?:-uc)? | (?:original|old|4-clause|four-clause) bsd license | -
bsd | bsd | 0bsd|bsd-1-clause | bsd(?:-style)? license | opensource\\.org/licenses?/bsd-license
mpl | mozilla | mpl-(?:1\\.0|1\\.1|2\\.0) | mozilla public license | mozilla\\.org/mpl
epl | eclipse | epl-(?:1\\.0|2\\.0) | eclipse public license | eclipse\\.org/legal/epl
edl | eclipse | edl-1\\.0 | eclipse distribution license | eclipse\\.org/org/documents/edl
cddl | common development | cddl-1\\.[01] | common development and distribution license | opensource\\.org/licenses?/cddl
cpl | common public | cpl-1\\.0 | common public license | opensource\\.org/licenses?/cpl
cpal | common public attribution | cpal-1\\.0 | common public attribution license | -
ipl | ibm public | ipl-1\\.0 | ibm public license | -
artistic | artistic | artistic-(?:1\\.0|2\\.0)(?:-perl)? | (?:clarified )?artistic license | perlfoundation\\.org/artistic_license
afl | academic free | afl-(?:1\\.1|2\\.0|2\\.1|3\\.0) | academic free license | opensource\\.org/licenses?/afl
osl | open software | osl-(?:1\\.0|2\\.0|2\\.1|3\\.0) | open software license | opensource\\.org/licenses?/osl
bsl | boost | bsl-1\\.0 | boost software license | boost\\.org/license_1_0
busl | business source | busl-1\\.1 | business source license | mariadb\\.com/bsl
sspl | server side | sspl-1\\.0 | server side public license | mongodb\\.com/licensing/server-side-public-license
elastic | elastic | elastic-2\\.0 | elastic license | elastic\\.co/licensing/elastic-license
zlib | zlib | zlib(?:-acknowledgement)? | zlib(?:/libpng)? license | zlib\\.net/zlib_license
libpng | libpng|png reference | libpng(?:-2\\.0)? | (?:png reference library|libpng) license | libpng\\.org/pub/png/src/libpng-license
openssl | openssl | openssl | openssl license | openssl\\.org/source/license
php | php | php-(?:3\\.0|3\\.01) | php license | php\\.net/license
python | python|psf | psf-2\\.0|python-2\\.0 | (?:python software foundation|psf) license | docs\\.python\\.org/[^ ]*license
ruby | ruby | ruby | ruby license | ruby-lang\\.org/[^ ]*license
postgresql | postgresql | postgresql | postgresql license | postgresql\\.org/about/licen[cs]e
vim | vim | vim | vim license | -
w3c | w3c | w3c(?:-19980720|-20150513)? | w3c software(?: notice and)? license | w3\\.org/consortium/legal/[^ ]*
unicode | unicode | unicode-(?:dfs-2015|dfs-2016|3\\.0|tou) | unicode license(?: agreement)? | unicode\\.org/(?:copyright|license)
icu | icu | icu | icu license | -
ntp | ntp | ntp(?:-0)? | ntp license | -
curl | curl | curl | curl license | curl\\.se/docs/copyright
unlicense | unlicense | unlicense | (?:the )?unlicense | unlicense\\.org
wtfpl | you want to public | wtfpl | do what the f[^ ]* you want to public license | wtfpl\\.net
cc0 | cc0 | cc0-1\\.0 | cc0(?: 1\\.0)?(?: universal)? (?:license|dedication) | creativecommons\\.org/publicdomain/zero
cc-by-nc-sa | noncommercial-sharealike | cc-by-nc-sa-[1234]\\.[05] | creative commons attribution-noncommercial-sharealike[^\\n]{0,30} license | creativecommons\\.org/licenses/by-nc-sa
cc-by-nc-nd | noncommercial-noderiv | cc-by-nc-nd-[1234]\\.[05] | creative commons attribution-noncommercial-noderiv[^\\n]{0,30} license | creativecommons\\.org/licenses/by-nc-nd
cc-by-nc | noncommercial | cc-by-nc-[1234]\\.[05] | creative commons attribution-noncommercial[^\\n]{0,30} license | creativecommons\\.org/licenses/by-nc/
cc-by-sa | sharealike | cc-by-sa-[1234]\\.[05] | creative commons attribution-sharealike[^\\n]{0,30} license | creativecommons\\.org/licenses/by-sa/
cc-by-nd | noderiv | cc-by-nd-[1234]\\.[05] | creative commons attribution-noderiv[^\\n]{0,30} license | creativecommons\\.org/licenses/by-nd/
cc-by | creative commons | cc-by-[1234]\\.[05] | creative commons attribution(?: [1234]\\.[05])?[^\\n-]{0,30} license | creativecommons\\.org/licenses/by/
cc-by-nc-sa | cc by-nc-sa | - | cc by-nc-sa | -
cc-by-nc-nd | cc by-nc-nd | - | cc by-nc-nd | -
cc-by-nc | cc by-nc | - | cc by-nc(?!-) | -
cc-by-sa | cc by-sa | - | cc by-sa | -
cc-by-nd | cc by-nd | - | cc by-nd | -
cc-by | cc by | - | cc by(?!-) | -
ofl | open font | ofl-1\\.[01](?:-rfn|-no-rfn)? | (?:sil )?open font license | scripts\\.sil\\.org/ofl
odbl | open database | odbl-1\\.0 | open database license | opendatacommons\\.org/licenses/odbl
pddl | public domain dedication | pddl-1\\.0 | public domain dedication and license | opendatacommons\\.org/licenses/pddl
eupl | european union | eupl-1\\.[012] | european union public licen[cs]e | joinup\\.ec\\.europa\\.eu/[^ ]*eupl
cecill | cecill | cecill-(?:1\\.0|1\\.1|2\\.0|2\\.1|b|c) | cecill(?:-[bc])? (?:free software )?license | cecill\\.info
mulan | mulan | mulanpsl-[12]\\.0 | mulan permissive software license | license\\.coscl\\.org\\.cn
ms-pl | microsoft public | ms-pl | microsoft public license | opensource\\.org/licenses?/ms-pl
ms-rl | microsoft reciprocal | ms-rl | microsoft reciprocal license | opensource\\.org/licenses?/ms-rl
apsl | apple public | apsl-(?:1\\.[012]|2\\.0) | apple public source license | opensource\\.apple\\.com/apsl
ncsa | illinois|ncsa | ncsa | (?:university of illinois(?:/ncsa)?|ncsa) open source license | opensource\\.org/licenses?/ncsa
upl | universal permissive | upl-1\\.0 | universal permissive license | oss\\.oracle\\.com/licenses/upl
json | json | json | json license | json\\.org/license
beerware | beer | beerware | beer-?ware license | -
openrail | openrail | openrail(?:\\+\\+)?-m | (?:creativeml |bigscience )?openrail(?:\\+\\+)?(?:-m)? license | -
"""
# Marks that a text carries a license of some family; wording only that family's text has.  label | keyword | pattern
WORDINGS = """
mit | without restriction | permission is hereby granted, free of charge, to any person obtaining a copy of this software[^.]{0,200}without restriction
isc | with or without fee | permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted
bsd | redistribution and use | redistribution and use in source and binary forms,? with or without modification,? are permitted
bsd-3-clause | endorse or promote | neither the name of [^.]{0,120} may be used to endorse or promote products
bsd-4-clause | advertising materials | all advertising materials mentioning features or use of this software must display
zlib | misrepresented | the origin of this software must not be misrepresented
bsl | person or organization | permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
unlicense | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | you just do what | you just do what the f[^ ]* you want to
gpl | redistribute it | redistribute it and/or modify it under the terms of the gnu general public license
lgpl | redistribute it | redistribute it and/or modify it under the terms of the gnu (?:lesser|library) general public license
agpl | redistribute it | redistribute it and/or modify it under the terms of the gnu affero general public license
proprietary | all rights reserved | all rights reserved
public-domain | public domain | (?:released|placed|dedicated|dedicate) (?:in)?to the public domain
"""
# The kinds of signature by priority, highest first: name, pattern around {id}, {name} or {link}, confidence.
KINDS = (
    ("identifier", r"spdx-license-identifier:\s*(?:{id})(?![\w.-])", 1.0),
    ("link", r"(?:https?://)?(?:www\.)?{link}", 0.95),
    ("grant", r"(?:licen[sc]ed|released|distributed|available|provided) under (?:the )?(?:terms (?:and conditions )?of )?(?:the |an? )?{name}", 0.95),
    ("version", r"{name},? ?(?:version|v\.?)? ?[0-9]+(?:\.[0-9]+)*", 0.9),
    ("name", r"(?<!\w){name}(?!\w)", 0.8),
)
WORDING = ("wording", 0.97)

# Fixed values of the base: phrases whose words stand consecutively, and their labels.
BASE = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))
BASE_CONFIDENCE = 0.8
BETWEEN_WORDS = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Rule:
    priority: int
    keywords: tuple[bytes, ...]
    label: str
    confidence: float
    pattern: re.Pattern


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, the highest priority (the smallest number) first; ties keep the order of the families.  White space in a name matches any run of it."""
    rows = [[cell.strip() for cell in line.split(" | ")] for line in FAMILIES.strip().splitlines()]
    out = []
    for priority, (kind, template, confidence) in enumerate(KINDS):
        for label, keyword, ids, name, link in rows:
            if "-" in {"link": link, "identifier": ids}.get(kind, "").split():
                continue
            body = template.replace("{id}", ids).replace("{name}", f"(?:{name})").replace("{link}", link)
            body = body.replace(" ?", r"\s*").replace(" ", r"\s+")
            # A document may name an identifier or a link without the family's keyword; their own fixed words gate them.
            gate = {"identifier": "spdx", "link": link.split("\\")[0].split("(")[0]}.get(kind, keyword)
            out.append(Rule(2 * priority, tuple(gate.encode().split(b"|")), label, confidence, re.compile(body.encode())))
    for line in WORDINGS.strip().splitlines():
        label, keyword, body = [cell.strip() for cell in line.split(" | ")]
        out.append(Rule(3, (keyword.encode(),), label, WORDING[1], re.compile(body.replace(" ", r"\s+").encode())))
    return tuple(sorted(out, key=lambda r: r.priority))


@cache
def _gates() -> tuple[tuple[tuple[bytes, ...], tuple[Rule, ...]], ...]:
    """Rules by the keywords that gate them."""
    by: dict[tuple[bytes, ...], list[Rule]] = {}
    for rule in rules():
        by.setdefault(rule.keywords, []).append(rule)
    return tuple((k, tuple(v)) for k, v in by.items())


# Every pattern has one of these in it, whatever its keyword; a text without any is done.
FIRST_GATE = (b"licen", b"spdx", b"gpl", b"://", b".org/", b".net", b".com/", b".se/", b".co/", b".eu/", b".cn", b".info", b"rights reserved", b"permission",
              b"redistribut", b"public domain", b"misrepresented", b"neither the name", b"you want to", b"advertising", b"dedication", b"cc by")


def detections(low: bytes) -> list[tuple[int, int, Rule]]:
    """(begin, end, rule) in bytes of a lower-cased text, after suppression, in order of place."""
    folded = b" ".join(low.split())
    if not any(word in folded for word in FIRST_GATE):
        return []
    found = []
    for keywords, gated in _gates():
        if any(k in folded for k in keywords):
            for rule in gated:
                found += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(low) if m.end() > m.start()]
    # By priority, then longest first: what lies inside something kept already is suppressed.
    found.sort(key=lambda f: (f[2].priority, f[0] - f[1], f[0], f[2].label))
    kept: list[tuple[int, int, Rule]] = []
    reach = _Cover()
    for begin, end, rule in found:
        if not reach.contains(begin, end):
            kept.append((begin, end, rule))
            reach.add(begin, end)
    return sorted(kept, key=lambda f: (f[0], f[1], f[2].label))


class _Cover:
    """Intervals none of which contains another; asks whether one of them contains a new one, by bisection."""

    def __init__(self) -> None:
        self.begins: list[int] = []
        self.ends: list[int] = []

    def _at(self, begin: int) -> int:
        from bisect import bisect_right

        return bisect_right(self.begins, begin)

    def contains(self, begin: int, end: int) -> bool:
        i = self._at(begin)
        # Ends grow with begins, so the last one that begins early enough reaches farthest.
        return i > 0 and self.ends[i - 1] >= end

    def add(self, begin: int, end: int) -> None:
        i = self._at(begin)
        while i < len(self.begins) and self.ends[i] <= end:
            del self.begins[i], self.ends[i]
        if i and self.begins[i - 1] == begin and self.ends[i - 1] <= end:
            i -= 1
            del self.begins[i], self.ends[i]
        self.begins.insert(i, begin)
        self.ends.insert(i, end)


@cache
def _phrases() -> tuple[tuple[re.Pattern, str], ...]:
    # The words of a phrase may share bytes with the next hit only at its ends; a look-ahead finds every place.
    word = rb"[0-9a-z\x80-\xff]"
    return tuple((re.compile(rb"(?<!" + word + rb")(?=(" + BETWEEN_WORDS.join(w.encode() for w in words) + rb")(?!" + word + rb"))"), label) for words, label in BASE)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("priority", pa.int32()), ("confidence", pa.float64())]))
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        n_words, n_base, first, last, base, labels, score, spans = [], [], [], [], [], [], [], []
        for row in range(batch.num_rows):
            low = LOWER[data[offsets[row] : offsets[row + 1]]]
            starts, _, _ = find_words(low, np.array([0, len(low)]))
            text = low.tobytes()
            hits = [(m.start(), label) for pattern, label in _phrases() for m in pattern.finditer(text)] if b"license" in text else []
            found = detections(text)
            places = np.searchsorted(starts, [h[0] for h in hits])
            base_labels = {h[1] for h in hits}
            n_words.append(len(starts))
            n_base.append(len(hits))
            first.append(int(places.min()) if hits else None)
            last.append(int(places.max()) if hits else None)
            base.append(",".join(sorted(base_labels)))
            labels.append(",".join(sorted(base_labels | {f[2].label for f in found})))
            score.append(max([f[2].confidence for f in found] + [BASE_CONFIDENCE] * bool(hits), default=0.0))
            spans.append([{"begin": b, "end": e, "label": r.label, "priority": r.priority, "confidence": r.confidence} for b, e, r in found])
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_base, pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64()),
             pa.array(base, pa.string()), pa.array(labels, pa.string()), pa.array(score, pa.float64()), pa.array(spans, spans_type)],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])


def scan_licenses(documents: DataFrame) -> DataFrame:
    """Licenses named in every whole text: base phrases by words, and what the rules find, with spans in bytes.

    Null and empty texts have no words, no labels ('') and score 0.  ``score`` is the confidence of the surest
    detection.  Rows are taken one by one, so repeated rows repeat their result, and an empty table gives an empty one.  Other columns are ignored.
    """
    bounded_batches(documents.sparkSession)
    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        _scan, f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<begin:bigint,end:bigint,label:string,priority:int,confidence:double>>")
