"""License scan: places against a plain loop, rules on notices, and suppression."""

from __future__ import annotations

import re

from strataforge.llm.license_rules import rules
from strataforge.llm.license_scan import license_scan
from strataforge.llm.queries import LICENSE_PHRASES

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def places(text, phrases):
    w = WORDS.findall((text or "").translate(LOWER))
    found = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), sorted(found)


TEXTS = [
    None, "", " .,", "CC BY", "cc-by cc by, CC/BY", "All Rights Reserved. all rights reserved", "general PUBLIC license general",
    "cc" , "by cc", "É CC BY É", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
    "x " * 3000 + "Released under the MIT License." + " y" * 3000, "a b a b a", "all rights",
]


def test_places(spark):
    phrases = {**LICENSE_PHRASES, "a b a": "aba"}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in license_scan(docs, phrases).collect():
        n, found = places(r["text"], phrases)
        assert (r["n_words"], [tuple(x) for x in r["places"]]) == (n, found)
        assert {label for _, label in found} <= set(r["labels"])
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_table_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in license_scan(docs, LICENSE_PHRASES).collect():
        assert (r["n_words"], [tuple(x) for x in r["places"]]) == places(r["text"], LICENSE_PHRASES)


def test_rules(spark):
    texts = {
        "Licensed under the Apache License, Version 2.0 (the License)": ["apache-2.0"],
        "Released under the MIT License.": ["mit"],
        "under the GNU Lesser General Public License v2.1": ["gpl", "lgpl-2.1"],
        "distributed under the terms of the Mozilla Public License 2.0": ["mpl-2.0"],
        "Licensed under CC BY-NC 4.0.": ["cc-by", "cc-by-nc-4.0"],
        "mit dem und im": [],
        "apache helicopters and a license": [],
        "BSD 3-Clause, also Apache License 2.0": ["apache-2.0", "bsd-3-clause"],
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["text"]: r["labels"] for r in license_scan(docs, LICENSE_PHRASES).collect()}
    assert got == texts


#: Text as it is found, and labels it must have.
FOUND = [
    ("// SPDX-License-Identifier: MIT", {"mit"}),
    ("# SPDX-License-Identifier: Apache-2.0", {"apache-2.0"}),
    ("/* SPDX-License-Identifier: ISC */", {"isc"}),
    ("SPDX-License-Identifier: GPL-2.0-or-later WITH Linux-syscall-note", {"gpl-2.0", "linux-syscall-note"}),
    ("SPDX-License-Identifier: CC-BY-NC-SA-4.0", {"cc-by-nc-sa-4.0"}),
    ("Licensed under Apache 2", {"apache-2.0"}),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\")", {"mit"}),
    ("Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that", {"bsd"}),
    ("Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from", {"bsd-3-clause"}),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", {"isc"}),
    ("This program is free software; you can redistribute it and/or modify it", {"gpl"}),
    ("the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", {"gpl-2.0-or-later"}),
    ("GPLv2 with the Classpath Exception", {"gpl-2.0", "classpath-exception-2.0"}),
    ("GNU Lesser General Public License as published by the Free Software Foundation; version 2.1", {"lgpl-2.1"}),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", {"mpl-2.0"}),
    ("Dual licensed under the MIT and GPL licenses", {"dual", "mit"}),
    ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", {"dual"}),
    ("This is free and unencumbered software released into the public domain.", {"unlicense"}),
    ("The origin of this software must not be misrepresented;", {"zlib"}),
    ("https://creativecommons.org/licenses/by-sa/4.0/", {"cc-by-sa-4.0"}),
    ("The Software shall be used for Good, not Evil.", {"json"}),
    ("Unauthorized copying of this file, via any medium is strictly prohibited", {"proprietary"}),
    ("Copyright (c) 2019 Someone", {"copyright"}),
    ("{ \"license\": \"ISC\" }", {"isc"}),
]
PLAIN = [
    "He asked for permission and it was granted, free of doubt.", "The program was free; software cost extra.", "a clause of the contract on file",
    "spdx", "the mit of the day", "two versions of the story, either is fine at your option",
]


def test_hand_written_signatures(spark):
    texts = [t for t, _ in FOUND] + PLAIN
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: {d["label"] for d in r["detections"]} for r in license_scan(docs, LICENSE_PHRASES).collect()}
    missing = [(t, want, got[i]) for i, (t, want) in enumerate(FOUND) if not want <= got[i]]
    assert not missing
    assert [got[len(FOUND) + i] for i in range(len(PLAIN))] == [set()] * len(PLAIN)


def test_gates_hold_in_every_match():
    """A rule's words are in all that it matches: each signature's own plain reading passes its gate."""
    table = rules()
    assert len([r for r in table if r["priority"] >= 3]) > 300
    for r in table:
        assert r["words"] and re.compile(r["pattern"])
        plain = re.sub(r"\(\?: \[\^ \]\+\)\{0,\d+\}", "", r["pattern"])
        assert all(re.search(rf"(?<![a-z0-9]){w}(?![a-z0-9])", plain) for w in r["words"])


def test_detections_against_regexes(spark):
    """Every detection is a match of its rule, none lies in another, and every match lies in one that stayed."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    compiled = [(r["label"], re.compile(r["pattern"])) for r in rules()]
    assert len(compiled) > 300
    for r in license_scan(docs, LICENSE_PHRASES).collect():
        spaced = " " + " ".join(WORDS.findall((r["text"] or "").translate(LOWER))) + " "
        matches = {
            (spaced[: m.start()].count(" "), spaced[: m.end()].count(" "), label) for label, p in compiled for m in p.finditer(spaced)
        }
        kept = {(d["start"], d["end"], d["label"]) for d in r["detections"]}
        assert kept <= matches
        assert all(any(s <= a and b <= e for s, e, _ in kept) for a, b, _ in matches)
        assert not any(x != y and x[0] <= y[0] and y[1] <= x[1] for x in kept for y in kept)


def test_native_empty_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "All rights reserved", "w", 5)], "doc_id long, text string, _words string, Labels int")
    out = license_scan(docs, LICENSE_PHRASES)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Exchange"))
    assert out.columns == ["doc_id", "text", "_words", "n_words", "places", "detections", "labels", "score"]
    assert out.first()["_words"] == "w"
    assert license_scan(docs.limit(0), LICENSE_PHRASES).count() == 0
