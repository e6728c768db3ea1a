"""License scan, quality statistics and sharding against brute force."""

import re
import zlib
from collections import Counter, defaultdict
from re import _constants as sre
from re import _parser as parser

import numpy as np
import pytest

import __spark_entry__ as entry_points
from tests.llm.conftest import SF
from tidemark.llm.base import labels_of
from tidemark.llm.licenses import _GATES, BASE_PHRASES, detections, rules, scan_licenses, scan_text
from tidemark.llm.quality import Condition, covered, judge_quality, learn, statistics
from tidemark.llm.shards import assign_shards
from tidemark.llm.words import WordNumbers


def plain_base(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    starts, labels = [], set()
    for phrase, label in BASE_PHRASES:
        parts = phrase.split()
        for at in range(len(words) - len(parts) + 1):
            if words[at : at + len(parts)] == parts:
                starts.append(at)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


LICENSED = [
    "Released under the MIT License. apache license, version 2; CC-BY-NC cc by nc by nc", "under the mit license" * 2,
    "SPDX-License-Identifier: GPL-3.0-or-later", "éunder the mit license", "under the\nMIT  license, under the mit license",
]


def test_base_scan(texts):
    for text in [*texts, *LICENSED]:
        got = scan_text((text or "").encode())
        assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == plain_base(text)
        assert set(filter(None, got["base_labels"].split(","))) <= set(got["labels"].split(","))
        assert 0 <= got["score"] <= 1


def test_rules():
    assert len(rules()) > 200
    labels = lambda text: {x[2] for x in detections(text)}
    assert labels("spdx license identifier gpl 3 0 or later") == {"gpl-3.0"}
    assert labels("licensed under the apache license version 2 0") == {"apache-2.0"}
    assert labels("licensed under cc by nc 4 0") == {"cc-by-nc-4.0"}
    assert labels("this work is licensed under the gnu general public license version 3") == {"gpl-3.0"}
    assert labels("a summit license of hermit license") == set()


def test_suppression_keeps_the_containing_rule():
    kept = detections("licensed under the gnu general public license version 2")
    assert [x[2] for x in kept] == ["gpl-2.0"]
    assert all(a[1] <= b[0] for a, b in zip(kept, kept[1:]))


def test_scan_of_awkward_rows(awkward, nothing):
    assert scan_licenses(awkward).count() == awkward.count()
    assert scan_licenses(nothing).count() == 0


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            inside.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_statistics(texts):
    known = WordNumbers()
    for text in texts:
        assert statistics((text or "").encode(), known)[:5] == plain_statistics(text)


def test_cover_finds_planted_rules():
    random = np.random.default_rng(3)
    values = {"symbols": random.random(900), "capitals": random.random(900), "noise": random.random(900)}
    bad = (values["symbols"] > 0.8) | ((values["capitals"] > 0.7) & (values["symbols"] < 0.3))
    found = learn(values, bad)
    hit = np.zeros(900, bool)
    for rule in found:
        hit |= covered(rule, values, 900)
    assert (hit & ~bad).sum() <= 10 and (hit & bad).sum() > 0.9 * bad.sum()
    assert learn(values, np.zeros(900, bool)) == []
    assert not learn(values, random.random(900) < 0.1)


def test_condition_columns(spark):
    frame = spark.range(1).selectExpr("5L n_words", "10L word_chars")
    assert frame.select(Condition("word_length", False, 1.9).column(), Condition("word_length", True, 1.9).column()).first()[:] == (True, False)


def test_quality_of_awkward_rows(spark, awkward, nothing):
    labels = labels_of(spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None)], "doc_id long, quality int"), "quality")
    got = judge_quality(awkward, labels)
    assert got.columns == [*awkward.columns, "quality"] and got.count() == awkward.count()
    assert got.where("text is null and not quality.base_failed").count() == 0
    assert judge_quality(nothing, labels.where("false")).count() == 0


def test_quality_query(spark):
    got = entry_points.queries()["op3_quality_rules"](spark, SF).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    for doc_id, text in zip(docs.doc_id, docs.text):
        row, plain = got.loc[doc_id], plain_statistics(text)
        assert tuple(row[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]]) == plain
        assert row.base_failed == (plain[0] < 20 or 100 * plain[4] > 30 * plain[0])
    assert (got.rule[labels[labels == 1].index] > 0).mean() < 0.02


def best_capacity(sizes, shards):
    low, high = max(sizes, default=0), sum(sizes)
    while low < high:
        middle, used, held = (low + high) // 2, 1, 0
        for size in sizes:
            used, held = (used + 1, size) if held + size > middle else (used, held + size)
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def check_shards(rows, texts, shards):
    groups, slots, load = {}, defaultdict(list), Counter()
    for row, text in zip(rows, texts):
        raw = (text or "").encode()
        assert row.size == len(raw) + 16 and row.text_crc32 == zlib.crc32(raw)
        assert groups.setdefault(text, row.shard) == row.shard and 0 <= row.shard < shards
        slots[row.shard].append(row.slot)
        load[row.shard] += row.size
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    first, weight = {}, Counter()
    for row, text in zip(rows, texts):
        key = (row.doc_id is not None, row.doc_id or 0)
        first[text] = min(first.get(text, key), key)
        weight[text] += row.size
    return max(load.values(), default=0), first, weight


def test_shards_against_the_best_capacity(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {row.doc_id: row for row in entry_points.queries()["op10_shards"](spark, SF).collect()}
    rows = docs.collect()
    most, first, weight = check_shards([got[row.doc_id] for row in rows], [row.text for row in rows], 40)
    assert most == best_capacity([weight[text] for text in sorted(first, key=first.get)], 40)
    assert {row.law for row in got.values()} == {"bytes"} and {row.grown_shard for row in got.values()} == {None}


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_random_groups(spark, shards, monkeypatch):
    monkeypatch.setattr("tidemark.llm.shards.BUCKETS", 8)  # several rounds of narrowing
    random = np.random.default_rng(shards)
    kinds = random.integers(0, 60, 200)
    texts = [f"{k}" * int(random.integers(1, 2) * (k % 13 + 1)) for k in kinds] + ["hot"] * 90
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted(assign_shards(frame, shards).collect(), key=lambda row: row.doc_id)
    most, first, weight = check_shards(got, texts, shards)
    assert most == best_capacity([weight[text] for text in sorted(first, key=first.get)], shards)


def test_shards_of_awkward_rows(awkward, nothing):
    got = assign_shards(awkward, 5)
    assert got.count() == awkward.count() and got.where("text_crc32 is null or shard is null").count() == 0
    assert assign_shards(nothing, 5).count() == 0


def examples(parsed):
    """Texts that hold each alternative and option of a parsed pattern at least once."""
    parts = []
    for op, value in parsed:
        if op is sre.LITERAL:
            parts.append([chr(value)])
        elif op is sre.IN:
            kind, what = value[0]
            parts.append(["1" if what is sre.CATEGORY_DIGIT else "x"] if kind is sre.CATEGORY else [chr(v) for _, v in value])
        elif op is sre.BRANCH:
            parts.append([text for way in value[1] for text in examples(way)])
        elif op is sre.SUBPATTERN:
            parts.append(examples(value[3]))
        elif op is sre.MAX_REPEAT:
            low, high, inner = value
            parts.append([text * n for n in {low, max(low, 1)} for text in examples(inner)])
        else:
            assert op is sre.ASSERT_NOT
    return ["".join(part[k % len(part)] for part in parts) for k in range(max(map(len, parts), default=1))]


def test_every_alternative_passes_the_gates_of_its_rule():
    for rule in rules():
        found = examples(parser.parse(rule.pattern.pattern))
        assert found
        for text in found:
            assert rule.pattern.fullmatch(text) and all(key in text for key in rule.keywords), (rule.label, text)
            assert any(gate.decode() in text for gate in _GATES)


def test_short_texts_of_gated_rules():
    labels = lambda text: set(scan_text(text.encode())["labels"].split(","))
    assert labels("Licensed under the GNU General Public License version 1") == {"gpl-1.0"}
    assert labels("Licensed under the Open Database License") == {"odbl-1.0"}
    assert labels("Released under the Open Data Commons Open Database License") == {"odbl-1.0"}


# The openings of license texts as they are usually written.
OPENINGS = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal",
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
    "bsd-3-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided",
    "apache-2.0": "you may not use this file except in compliance with the License. You may obtain a copy",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published",
    "lgpl": "redistribute it under the terms of the GNU Lesser General Public License as published",
    "agpl": "modify it under the terms of the GNU Affero General Public License as published",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "epl": "This program and the accompanying materials are made available under the terms of the Eclipse Public License which",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "wtfpl": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages",
    "cc0-1.0": "the person has waived all copyright and related or neighboring rights to this work",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 License",
    "ofl-1.1": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "gfdl": "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License",
    "bsl-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered",
    "postgresql": "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is",
}


def test_openings_of_license_texts():
    for label, text in OPENINGS.items():
        assert label in scan_text(("// " + text).encode())["labels"].split(","), label


def test_many_notices_take_linear_time():
    import time

    spent = []
    for times in (20_000, 80_000):
        started = time.perf_counter()
        found = scan_text(b"copyright 2020 under the mit license " * times)
        spent.append(time.perf_counter() - started)
        assert found["n_base"] == times and (found["first_word"], found["last_word"]) == (2, 6 * times - 4)
    assert spent[1] < 12 * spent[0] + 1
