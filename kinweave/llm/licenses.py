"""License detection by ordered signature rules behind a keyword filter."""
from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache

from pyspark.sql import DataFrame

from .common import per_batch, table

#: Base phrases and labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Label, names and versions of license families.
FAMILIES = [
    ("agpl", ["gnu affero general public license", "affero general public license"], ["1", "2", "3"]),
    ("lgpl", ["gnu lesser general public license", "lesser general public license"], ["2", "2 1", "3"]),
    ("lgpl", ["gnu library general public license"], ["2"]),
    ("gpl", ["gnu general public license", "gnu gpl"], ["1", "2", "3"]),
    ("gfdl", ["gnu free documentation license"], ["1 1", "1 2", "1 3"]),
    ("apache", ["apache license", "apache software license", "apache public license"], ["1 0", "1 1", "2 0"]),
    ("mpl", ["mozilla public license"], ["1 0", "1 1", "2 0"]),
    ("epl", ["eclipse public license"], ["1 0", "2 0"]),
    ("cddl", ["common development and distribution license"], ["1 0", "1 1"]),
    ("eupl", ["european union public license", "european union public licence"], ["1 0", "1 1", "1 2"]),
    ("artistic", ["artistic license"], ["1 0", "2 0"]),
    ("boost", ["boost software license"], ["1 0"]),
    ("cecill", ["cecill license", "cecill free software license"], ["1 0", "2 0", "2 1"]),
    ("ofl", ["sil open font license", "open font license"], ["1 0", "1 1"]),
    ("mit", ["mit license", "the mit license"], []),
    ("isc", ["isc license"], []),
    ("zlib", ["zlib license"], []),
    ("unlicense", ["the unlicense"], []),
    ("wtfpl", ["do what the fuck you want to public license"], ["1", "2"]),
    ("bsd", ["bsd license", "bsd 2 clause license", "bsd 3 clause license", "bsd 4 clause license"], []),
    ("cc0", ["cc0", "creative commons zero"], ["1 0"]),
]
#: Signatures of license texts and notices, written out: label, score, keyword, regex over words.
NOTICES = [
    ("mit", 0.95, "granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 0.8, "warranty", "the software is provided as is without warranty of any kind express or implied"),
    ("mit", 0.8, "copies", "shall be included in all copies or substantial portions of the software"),
    ("x11", 0.9, "consortium", "except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("isc", 0.95, "permission", "permission to use copy modify and or distribute this software for any purpose"),
    ("isc", 0.95, "granted", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
    ("ntp", 0.9, "permission", "permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("bsd", 0.95, "redistribution", "redistribution and use in source and binary forms with or without modification"),
    ("bsd", 0.8, "redistributions", "redistributions of source code must retain the above copyright notice"),
    ("bsd", 0.8, "redistributions", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", 0.95, "endorse", "neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", 0.95, "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("bsd-new", 0.9, "bsd", "(?:the )?new bsd license"), ("bsd-simplified", 0.9, "bsd", "(?:simplified|freebsd) bsd license"),
    ("bsd-0-clause", 0.95, "bsd", "(?:zero clause bsd|bsd zero clause)(?: license)?"), ("bsd-0-clause", 0.95, "0bsd", "0bsd"),
    ("gpl", 0.95, "free", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", 0.9, "gnu", "you should have received a copy of the gnu general public license along with this program"),
    ("gpl", 0.9, "gpl", "(?:released|licensed|distributed|available) under (?:the )?gpl"),
    ("gpl-2", 0.95, "gplv2", "gplv2"), ("gpl-3", 0.95, "gplv3", "gplv3"),
    ("gpl-2", 0.9, "gpl", "gpl (?:version )?2 0?"), ("gpl-3", 0.9, "gpl", "gpl (?:version )?3 0?"),
    ("gpl-linking-exception", 0.9, "exception", "as a special exception .{1,200}? permission to link"),
    ("gpl-classpath-exception", 0.95, "classpath", "(?:with the )?classpath exception"),
    ("lgpl", 0.95, "lesser", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("lgpl", 0.95, "lgpl", "(?:released|licensed|distributed|available) under (?:the )?lgpl"),
    ("agpl", 0.95, "agpl", "(?:released|licensed|distributed|available) under (?:the )?agpl"), ("agpl-3", 0.95, "agplv3", "agplv3"),
    ("agpl", 0.9, "remotely", "users interacting with it remotely through a computer network"),
    ("apache-2.0", 0.95, "apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2.0", 0.9, "apache", "you may obtain a copy of the license at (?:http|https) www apache org licenses license 2 0"),
    ("apache-1.1", 0.9, "apache", "this product includes software developed by the apache software foundation"),
    ("apache-2.0", 0.9, "asl", "asl 2 0"),
    ("mpl-2.0", 0.95, "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", 0.95, "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl", 0.9, "mpl", "mpl (?:v ?)?(?:1 1|2 0)"),
    ("epl-1.0", 0.95, "eclipse", "made available under the terms of the eclipse public license v1 0"), ("epl-2.0", 0.95, "eclipse", "made available under the terms of the eclipse public license (?:v ?)?2 0"),
    ("cddl", 0.95, "cddl", "(?:subject to|under) the terms of the (?:common development and distribution license|cddl)"),
    ("cpl-1.0", 0.95, "common", "common public license(?: version)? 1 0"), ("ipl-1.0", 0.95, "ibm", "ibm public license(?: version)? 1 0"),
    ("eupl", 0.9, "eupl", "licen[sc]ed under the eupl"), ("cecill", 0.9, "cecill", "governed by the cecill(?: [bc])? license"),
    ("artistic", 0.9, "perl", "(?:under the same terms as perl itself|the perl artistic license)"),
    ("zlib", 0.95, "origin", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", 0.8, "altered", "altered source versions must be plainly marked as such"),
    ("boost-1.0", 0.95, "boost", "distributed under the boost software license version 1 0"),
    ("boost-1.0", 0.9, "organization", "free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("unlicense", 0.95, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", 0.95, "wtfpl", "wtfpl"), ("beerware", 0.95, "beer", "you can buy me a beer in return"), ("beerware", 0.9, "beerware", "beerware license"),
    ("json", 0.95, "evil", "the software shall be used for good not evil"),
    ("psf", 0.9, "python", "python software foundation license"), ("python-2.0", 0.9, "python", "python license 2 0"),
    ("ruby", 0.9, "ruby", "(?:the )?ruby license"), ("php", 0.9, "php", "(?:the )?php license(?: version)?(?: 3 0(?: 1)?)?"), ("zend", 0.9, "zend", "(?:the )?zend engine license"),
    ("openssl", 0.95, "openssl", "this product includes software developed by the openssl project"), ("openssl", 0.95, "cryptographic", "this product includes cryptographic software written by eric young"),
    ("openssl", 0.9, "openssl", "(?:the )?openssl license"), ("postgresql", 0.95, "postgresql", "(?:the )?postgresql licen[sc]e"),
    ("curl", 0.9, "curl", "(?:the )?curl license"), ("libpng", 0.9, "libpng", "libpng license"), ("ijg", 0.95, "jpeg", "this software is based in part on the work of the independent jpeg group"),
    ("icu", 0.9, "icu", "icu license"), ("unicode", 0.9, "unicode", "unicode (?:inc )?license agreement(?: data files and software)?"), ("w3c", 0.95, "w3c", "w3c software (?:notice and )?license"),
    ("ncsa", 0.9, "illinois", "university of illinois ncsa open source license"), ("afl", 0.9, "academic", "academic free license(?: version)?(?: [123] [012])?"),
    ("osl", 0.9, "open", "open software license(?: version)?(?: [123] [012])?"), ("qpl", 0.95, "public", "q public license"), ("sleepycat", 0.95, "sleepycat", "sleepycat license"),
    ("ms-pl", 0.95, "microsoft", "microsoft public license"), ("ms-rl", 0.95, "microsoft", "microsoft reciprocal license"), ("upl-1.0", 0.9, "universal", "universal permissive license(?: v ?1 0)?"),
    ("blueoak-1.0.0", 0.95, "blue", "blue oak model license(?: 1 0 0)?"), ("mulan", 0.95, "mulan", "mulan (?:psl|permissive software license)(?: v2)?"), ("vim", 0.9, "vim", "vim license"), ("tcl", 0.9, "tcl", "tcl tk license"),
    ("ofl", 0.95, "font", "this font software is licensed under the sil open font license"), ("lppl", 0.95, "latex", "latex project public license"), ("latex-2e", 0.9, "lppl", "lppl"),
    ("odbl", 0.95, "database", "open (?:data commons open )?database license"), ("odc-by", 0.95, "commons", "open data commons attribution license"), ("pddl", 0.95, "dedication", "public domain dedication and license"),
    ("cc0-1.0", 0.95, "waived", "to the extent possible under law .{1,120}? has waived all copyright and related or neighboring rights"),
    ("cc0", 0.9, "dedication", "public domain dedication"), ("cc-by", 0.9, "attribution", "creative commons attribution(?: license)?"),
    ("cc-by-sa", 0.95, "attribution", "creative commons attribution share ?alike(?: license)?"), ("cc-by-nc", 0.95, "attribution", "creative commons attribution non ?commercial(?: license)?"),
    ("cc-by-nd", 0.95, "attribution", "creative commons attribution no ?deriv(?:ative)?s(?: works)?(?: license)?"), ("cc-by-nc-sa", 0.98, "attribution", "creative commons attribution non ?commercial share ?alike(?: license)?"),
    ("cc", 0.6, "commons", "(?:under|some rights reserved) (?:a )?creative commons(?: license)?"),
    ("public-domain", 0.8, "domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"), ("public-domain", 0.8, "domain", "(?:this (?:work|file|code|software) )?is in the public domain"),
    ("sspl-1.0", 0.95, "side", "server side public license(?: version 1)?"), ("busl-1.1", 0.95, "business", "business source license(?: 1 1)?"), ("elastic-2.0", 0.95, "elastic", "elastic license(?: 2 0)?"),
    ("commons-clause", 0.95, "commons", "commons clause(?: license condition)?"), ("polyform", 0.95, "polyform", "polyform (?:noncommercial|small business|shield|strict|internal use) license(?: 1 0 0)?"),
    ("proprietary", 0.7, "rights", "all rights reserved"), ("proprietary", 0.9, "confidential", "(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", 0.9, "unauthorized", "unauthorized copying of this file via any medium is strictly prohibited"), ("proprietary", 0.8, "permission", "may not be (?:reproduced|copied|used|distributed) without (?:the )?(?:prior )?(?:written )?permission"),
]
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@lru_cache
def rules() -> tuple:
    """(label, score, keyword, regex) in order of priority, of equal ones the longest first; a keyword is a word that every match holds."""
    out = []
    for label, names, versions in FAMILIES:
        for name in names:
            key = max(name.split(), key=len)
            for v in versions:
                for link in ("version", "v", "", "as version"):
                    for tail in (" or (?:any )?later", " only", ""):
                        tag = f"{label}-{v.replace(' ', '.')}" + ("-or-later" if "later" in tail else "-only" if tail else "")
                        out.append((10 + (not tail), tag, 1.0, key, f"{name} {link} ?{v}{tail}" if link else f"{name} {v}{tail}"))
            for verb in ("licensed under(?: the)?", "released under(?: the)?", "distributed under(?: the)?(?: terms of the)?"):
                out.append((20, label, 0.95, key, f"{verb} {name}"))
            out.append((30, label, 0.9, key, name))
    for kind in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"):
        tag = "cc-" + kind.replace(" ", "-")
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            out.append((10, f"{tag}-{v.replace(' ', '.')}", 1.0, "cc", f"cc {kind} {v}"))
        out.append((30 - len(kind), tag, 0.9, "cc", f"cc {kind}"))
    for spdx in ("mit", "apache 2 0", "gpl 2 0", "gpl 3 0", "lgpl 2 1", "lgpl 3 0", "bsd 2 clause", "bsd 3 clause", "mpl 2 0", "isc"):
        out.append((5, spdx.replace(" 0", ".0").replace(" 1", ".1").replace(" ", "-"), 1.0, "spdx", f"spdx license identifier {spdx}"))
    out += [(25, label, s, key, text) for label, s, key, text in NOTICES]
    return tuple((label, s, key, re.compile(f"(?<![^ ]){rx}(?![^ ])")) for _, label, s, key, rx in sorted(out, key=lambda r: (r[0], -len(r[4]))))


def detect(joined: str, held: set[str]) -> list[tuple[int, int, str, float]]:
    """(first character, end, label, score) of detections that none of an earlier rule contains; held are the words of the text.

    Rules come by priority, so a name inside a version's match goes. A longer match of a later rule
    does not take an earlier rule's away.
    """
    keep: list = []
    for label, s, key, rx in rules():
        if key in held:
            for m in rx.finditer(joined):
                if not any(a <= m.start() and m.end() <= b for a, b, _, _ in keep):
                    keep.append((*m.span(), label, s))
    return keep


@lru_cache
def keywords() -> frozenset[str]:
    return frozenset(r[2] for r in rules()) | {w for p in BASE for w in p.split()[:1]}


def scan_text(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels and score of one text."""
    words = WORDS.findall((text or "").encode().lower().decode())  # bytes have only A-Z to lower
    held = keywords().intersection(words)
    if not held:
        return len(words), 0, None, None, "", "", 0.0
    joined = " ".join(words)
    bounds, at = [], 0
    for w in words:
        bounds.append(at)
        at += len(w) + 1
    places, base, padded = [], set(), f" {joined} "
    for phrase, label in BASE.items():
        at = padded.find(f" {phrase} ")
        while at >= 0:
            places.append(bisect_right(bounds, at) - 1)
            base.add(label)
            at = padded.find(f" {phrase} ", at + 1)
    found = detect(joined, held)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {f[2] for f in found})), max([f[3] for f in found] + [0.9] * bool(base) + [0.0]))


def scan(docs: DataFrame) -> DataFrame:
    """Licenses of every whole text of (doc_id, text).

    Null or empty text has no words: counts 0, labels empty, score 0, no places.
    Long texts are scanned whole. Repeated rows and null ids are scanned each; an
    empty table gives no rows; other columns are not read.
    """
    def run(b):
        return [b["doc_id"], *zip(*map(scan_text, b["text"].to_pylist()))]

    return per_batch(docs.select("doc_id", "text"), run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op5_licenses(spark, sf_dir) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
