"""License scan: ordered signature rules over normalised words.

A text's words (ASCII letters in lower case, digits, everything beyond ASCII) are joined by single
blanks, so punctuation and line breaks do not hide a phrase. A rule is a regular expression over
that text with a label, a priority and a confidence. Keywords that a rule cannot match without are
looked for first; only rules whose keyword occurs are run. Detections that lie inside one of higher
priority (or of equal priority and greater length), or overlap it, are dropped.

The rules are hand-written names of licenses combined with hand-written forms of speech.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.base import documents, fields, query, renamed

# Phrases of the base scan and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

_SEPARATORS = [c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122)]
_WORDS = bytes.maketrans(
    bytes([*_SEPARATORS, *range(65, 91)]), bytes([*(32 for _ in _SEPARATORS), *range(97, 123)])
)


def normal_words(raw: bytes) -> list[bytes]:
    """Words of a text: ASCII letters in lower case, digits and whatever is beyond ASCII."""
    return raw.translate(_WORDS).split()


_V = "(?:version |v |v)?"
# label; name in running text; identifier as written in machine-readable headers; keyword, which every
# alternative of the name and of the identifier holds.
_NAMES = (
    ("mit", r"(?:the )?mit(?: expat)?", r"mit", "mit"),
    ("mit-0", r"mit no attribution", r"mit 0", "mit"),
    ("x11", r"(?:mit )?x11", r"x11", "x11"),
    ("apache-1.1", rf"apache(?: software)? license {_V}1 1", r"apache 1 1", "apache"),
    ("apache-2.0", rf"apache(?: software)? license {_V}2(?: 0)?|apache {_V}2(?: 0)?", r"apache 2 0", "apache"),
    ("gpl-1.0", rf"gnu (?:general )?public license {_V}1(?: 0)?", r"gpl 1 0(?: only| or later)?", "1"),
    ("gpl-2.0", rf"(?:gnu )?(?:general public license|gpl) {_V}2(?: 0)?", r"gpl 2 0(?: only| or later)?", "2"),
    ("gpl-3.0", rf"(?:gnu )?(?:general public license|gpl) {_V}3(?: 0)?", r"gpl 3 0(?: only| or later)?", "3"),
    ("lgpl-2.1", rf"(?:gnu )?(?:lesser|library) general public license {_V}2 1|lgpl {_V}2 1", r"lgpl 2 1(?: only| or later)?", "2"),
    ("lgpl-3.0", rf"(?:gnu )?lesser general public license {_V}3(?: 0)?|lgpl {_V}3(?: 0)?", r"lgpl 3 0(?: only| or later)?", "3"),
    ("agpl-3.0", rf"(?:gnu )?affero general public license {_V}3(?: 0)?|agpl {_V}3(?: 0)?", r"agpl 3 0(?: only| or later)?", "3"),
    ("bsd-2-clause", r"(?:2 clause|two clause|simplified) bsd|bsd 2 clause", r"bsd 2 clause", "bsd"),
    ("bsd-3-clause", r"(?:3 clause|three clause|new|revised) bsd|bsd 3 clause", r"bsd 3 clause", "bsd"),
    ("bsd-4-clause", r"(?:4 clause|four clause|original) bsd|bsd 4 clause", r"bsd 4 clause", "bsd"),
    ("0bsd", r"zero clause bsd", r"0bsd", "bsd"),
    ("isc", r"isc", r"isc", "isc"),
    ("zlib", r"zlib(?: libpng)?", r"zlib", "zlib"),
    ("unlicense", r"unlicense", r"unlicense", "unlicense"),
    ("wtfpl", r"do what the fuck you want to public|wtfpl", r"wtfpl", "w"),
    ("bsl-1.0", rf"boost software license {_V}1(?: 0)?|boost software", r"bsl 1 0", "b"),
    ("mpl-1.1", rf"mozilla public license {_V}1 1", r"mpl 1 1", "1"),
    ("mpl-2.0", rf"mozilla public license {_V}2(?: 0)?|mpl {_V}2(?: 0)?", r"mpl 2 0", "2"),
    ("epl-1.0", rf"eclipse public license {_V}1(?: 0)?", r"epl 1 0", "1"),
    ("epl-2.0", rf"eclipse public license {_V}2(?: 0)?", r"epl 2 0", "2"),
    ("cddl-1.0", rf"common development and distribution license {_V}1(?: 0)?", r"cddl 1 0", "1"),
    ("eupl-1.2", rf"european union public licen[cs]e {_V}1 2", r"eupl 1 2", "eu"),
    ("artistic-2.0", rf"artistic license {_V}2(?: 0)?", r"artistic 2 0", "artistic"),
    ("psf-2.0", rf"python software foundation license(?: {_V}2)?", r"(?:psf|python) 2 0", "p"),
    ("ofl-1.1", rf"sil open font license(?: {_V}1 1)?", r"ofl 1 1", "o"),
    ("cc0-1.0", rf"cc0(?: {_V}1 0)?|creative commons zero", r"cc0 1 0", "c"),
    *(
        (
            f"cc-{kind}-{version}",
            rf"(?:cc|creative commons) (?:{short}|{long})(?: international| license)* {_V}{version.replace('.', ' ')}",
            rf"cc {short} {version.replace('.', ' ')}",
            "c",
        )
        for kind, short, long in (
            ("by", "by", "attribution"),
            ("by-sa", "by sa", "attribution share ?alike"),
            ("by-nd", "by nd", "attribution no ?deriv(?:ative)?s"),
            ("by-nc", "by nc", "attribution non ?commercial"),
            ("by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
            ("by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
        )
        for version in ("2.0", "3.0", "4.0")
    ),
    ("odc-by-1.0", rf"open data commons attribution license(?: {_V}1 0)?", r"odc by 1 0", "o"),
    ("odbl-1.0", rf"open (?:data commons open )?database license(?: {_V}1 0)?|odbl", r"odbl 1 0", "b"),
    ("gfdl-1.3", rf"gnu free documentation license(?: {_V}1 3)?", r"gfdl 1 3(?: only| or later)?", "g"),
)
# form around a name; priority; confidence; keyword of the form.
_FORMS = (
    ("spdx license identifier {id}", 4, 1.0, "spdx"),
    (r"(?:re|dual )?licen[cs]ed (?:\w+ )?(?:under|by) (?:the )?(?:terms of (?:the )?)?(?:{name})(?: licen[cs]e)?", 3, 0.95, "licen"),
    (r"(?:released|distributed|available|published|provided|made available|offered) (?:\w+ )?under (?:the )?(?:terms of (?:the )?)?(?:{name})(?: licen[cs]e)?", 3, 0.9, "under"),
    (r"subject to (?:the )?(?:terms of (?:the )?)?(?:{name})(?: licen[cs]e)?", 2, 0.85, "subject"),
    (r"licen[cs]e (?:is )?(?:the )?(?:{name})", 2, 0.8, "licen"),
    (r"(?:{name}) licen[cs]e(?:d)?", 1, 0.7, "licen"),
)
_GENERAL = (
    ("public-domain", r"(?:dedicated to|placed in(?:to)?|released into) the public domain", 3, 0.9, "public domain"),
    ("all-rights-reserved", r"all rights reserved", 1, 0.6, "rights reserved"),
    ("proprietary", r"proprietary and confidential|confidential and proprietary", 2, 0.8, "proprietary"),
    ("gpl-3.0", r"gnu general public license version 3", 2, 0.85, "public license"),
    ("gpl", r"gnu general public licen[cs]e|gnu gpl", 0, 0.5, "gnu"),
    ("copyright-notice", r"copyright (?:c )?(?:19|20)\d\d", 0, 0.3, "copyright"),
)
# Openings and headers of license texts in normal words, each with a word group that all forms of it hold.
_TEXTS = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "associated documentation files"),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "person or organization obtaining"),
    ("isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement", "without a written agreement"),
    ("bsd", r"redistribution and use in source and binary forms(?: with or without modification)? are permitted provided that the following conditions are met", "source and binary forms"),
    ("bsd-3-clause", r"neither the name of (?:\w+ ){1,8}nor the names of (?:its|any|their) contributors may be used to endorse or promote products", "endorse or promote products"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "all advertising materials"),
    ("apache-2.0", r"you may not use this file except in compliance with the license", "except in compliance"),
    ("gpl", r"this (?:program|library|file) is free software(?: you can redistribute it and or modify it)? under the terms of the gnu general public license", "is free software"),
    ("gpl", r"this program is free software you can redistribute it and or modify it", "is free software"),
    ("lgpl", r"under the terms of the gnu (?:lesser|library) general public license", "general public license"),
    ("agpl", r"under the terms of the gnu affero general public license", "affero general public license"),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "free documentation license"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license", "mozilla public license"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license", "mozilla public license"),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license"),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution license", "common development and distribution"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered software"),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document", "verbatim or modified copies"),
    ("fsf-text", r"everyone is permitted to copy and distribute verbatim copies of this license document", "verbatim copies of this license"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "authors be held liable"),
    ("cc0-1.0", r"has waived all copyright and related or neighboring rights", "neighboring rights"),
    ("cc-by", r"this work is licensed under a creative commons attribution(?: \d+ \d+)?(?: international| unported)? license", "creative commons attribution"),
    ("cc-by-sa", r"this work is licensed under a creative commons attribution share ?alike", "creative commons attribution"),
    ("ofl-1.1", r"this font software is licensed under the sil open font license", "open font license"),
    ("artistic", r"the intent of this document is to state the conditions under which a package may be copied", "a package may be copied"),
    ("psf-2.0", r"psf hereby grants licensee a nonexclusive royalty free world wide license", "psf hereby grants"),
    ("eupl", r"licensed under the eupl version", "under the eupl"),
    ("ncsa", r"deal with the software without restriction including without limitation the rights to use copy modify", "deal with the software"),
    ("as-is", r"the software is provided as is without warranty of any kind express or implied", "warranty of any kind"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    priority: int
    confidence: float
    keywords: tuple[str, ...]


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules, the highest priority first."""
    found = [
        Rule(label, re.compile(rf"(?<!\S)(?:{form.format(name=name, id=ident)})(?!\S)"), priority, confidence, (keyword, key))
        for label, name, ident, key in _NAMES
        for form, priority, confidence, keyword in _FORMS
    ]
    found += [
        Rule(label, re.compile(rf"(?<!\S)(?:{pattern})(?!\S)"), priority, confidence, (keyword,))
        for label, pattern, priority, confidence, keyword in _GENERAL
    ]
    found += [Rule(label, re.compile(rf"(?<!\S)(?:{pattern})(?!\S)"), 5, 0.95, (keyword,)) for label, pattern, keyword in _TEXTS]
    return tuple(sorted(found, key=lambda rule: -rule.priority))


def detections(text: str) -> list[tuple[int, int, str, float]]:
    """What stands after suppression: ``(start, end, label, confidence)`` in the normalised text."""
    present: dict[str, bool] = {}

    def has(keyword: str) -> bool:
        if keyword not in present:
            present[keyword] = keyword in text
        return present[keyword]

    hits = [
        (-rule.priority, m.start() - m.end(), m.start(), m.end(), rule.label, rule.confidence)
        for rule in rules()
        if all(map(has, rule.keywords))
        for m in rule.pattern.finditer(text)
    ]
    # Kept ones never overlap, so their starts and ends ascend together and one place decides.
    kept: list[tuple[int, int, str, float]] = []
    starts: list[int] = []
    for _, _, start, end, label, confidence in sorted(hits):
        at = bisect_right(starts, start)
        if (at == 0 or kept[at - 1][1] <= start) and (at == len(kept) or end <= kept[at][0]):
            starts.insert(at, start)
            kept.insert(at, (start, end, label, confidence))
    return kept


# What every rule and base phrase needs one of; a text without any is not normalised further.
_GATES = (b"licen", b"spdx", b"under", b"subject", b"public domain", b"rights reserved", b"proprietary", b"gnu", b"copyright", b"apache", b"cc by", *(
    keyword.encode() for _, _, keyword in _TEXTS
))

_SPAN = fields(start="int", end="int", label="string")
_RESULT = fields(
    n_words="long", n_base="long", first_word="long", last_word="long", base_labels="string", labels="string", score="double",
    spans=T.ArrayType(_SPAN),
)


def scan_text(raw: bytes) -> dict:
    """The scan of one text."""
    words = normal_words(raw)
    result = {"n_words": len(words), "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "spans": []}
    line = b" ".join(words)
    if not any(gate in line for gate in _GATES):
        return result
    padded, starts, base = b" " + line + b" ", [], set()
    for phrase, label in BASE_PHRASES:
        needle, at, counted, words_before = b" " + phrase.encode() + b" ", -1, 0, -1
        while (at := padded.find(needle, at + 1)) >= 0:
            words_before += padded.count(b" ", counted, at + 1)
            counted = at + 1
            starts.append(words_before)
            base.add(label)
    found = detections(line.decode("utf-8", "replace"))
    doubt = 0.1 if base else 1.0
    for _, _, _, confidence in found:
        doubt *= 1.0 - confidence
    result |= {"n_base": len(starts), "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | {x[2] for x in found})), "score": round(1.0 - doubt, 6)}
    result["spans"] = [{"start": s, "end": e, "label": label} for s, e, label, _ in found]
    if starts:
        result |= {"first_word": min(starts), "last_word": max(starts)}
    return result


@arrow_udf(_RESULT)
def _scan(texts: pa.Array) -> pa.Array:
    rows = [scan_text(raw or b"") for raw in texts.cast(pa.binary()).to_pylist()]
    return pa.array(rows, to_arrow_type(_RESULT))


_scan = _scan.asNondeterministic()  # so that it is never evaluated twice


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: word count, base phrases and where they stand, labels, score, and the
    spans of the rules (in the text of normalised words).

    A missing text counts as empty: no words, no labels, score 0. Repeated rows stay, a missing id
    stays missing, and an empty table gives an empty result. Other columns are not read.
    """
    rows = renamed(docs, doc_id=id_column, text=text_column).select("doc_id", _scan("text").alias("s"))
    return rows.select("doc_id", "s.*")


@query()
def op5_license_scan(spark, sf_dir):
    """License phrases and rule labels of every document."""
    return scan_licenses(documents(spark, sf_dir)).drop("spans")
