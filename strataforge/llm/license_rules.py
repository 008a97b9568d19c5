"""Signature rules of the license scan, written for texts as words with single spaces.

Each rule is a regular expression with the words it cannot do without, a label, a
priority and a confidence.  Bodies, headers, tags, exceptions and dual licensing are
hand-written (``license_signatures``); notices that only name a license are made from the
names and versions below and from four ways to state one, down to a bare name.
"""

from __future__ import annotations

import re

from strataforge.llm.license_signatures import SIGNATURES, TAGGED

#: Label, names (words separated by spaces, "/" between names), versions.
FAMILIES = """
apache | apache license/apache software license/apache licence/asl | 1.0 1.1 2.0
mit | mit license/mit licence/expat license/x11 license/mit x11 license |
bsd-2-clause | bsd 2 clause/simplified bsd license/freebsd license/2 clause bsd |
bsd-3-clause | bsd 3 clause/new bsd license/modified bsd license/revised bsd license/3 clause bsd |
bsd-4-clause | bsd 4 clause/original bsd license/old bsd license/4 clause bsd |
bsd | bsd license/bsd licence/bsd style license |
gpl | gnu general public license/gnu general public licence/gnu gpl/gpl | 1.0 2.0 3.0
lgpl | gnu lesser general public license/gnu library general public license/gnu lgpl/lgpl | 2.0 2.1 3.0
agpl | gnu affero general public license/affero general public license/gnu agpl/agpl | 1.0 3.0
gfdl | gnu free documentation license/gfdl | 1.1 1.2 1.3
mpl | mozilla public license/mpl | 1.0 1.1 2.0
epl | eclipse public license/epl | 1.0 2.0
cddl | common development and distribution license/cddl | 1.0 1.1
cpl | common public license/cpl | 1.0
ipl | ibm public license | 1.0
artistic | artistic license | 1.0 2.0
bsl | boost software license/boost license | 1.0
busl | business source license/busl | 1.1
zlib | zlib license/zlib libpng license |
isc | isc license/isc licence |
unlicense | unlicense/public domain dedication |
wtfpl | wtfpl/wtfpl license | 1.0 2.0
cc0 | cc0/creative commons zero/creative commons public domain dedication | 1.0
cc-by-nc-sa | cc by nc sa/creative commons attribution noncommercial sharealike/creative commons attribution non commercial share alike | 1.0 2.0 2.5 3.0 4.0
cc-by-nc-nd | cc by nc nd/creative commons attribution noncommercial noderivatives/creative commons attribution non commercial no derivatives | 2.0 2.5 3.0 4.0
cc-by-nc | cc by nc/creative commons attribution noncommercial/creative commons attribution non commercial | 1.0 2.0 2.5 3.0 4.0
cc-by-nd | cc by nd/creative commons attribution noderivatives/creative commons attribution no derivatives | 1.0 2.0 2.5 3.0 4.0
cc-by-sa | cc by sa/creative commons attribution sharealike/creative commons attribution share alike | 1.0 2.0 2.5 3.0 4.0
cc-by | cc by/creative commons attribution | 1.0 2.0 2.5 3.0 4.0
odbl | open database license/odbl | 1.0
odc-by | open data commons attribution license/odc by | 1.0
pddl | public domain dedication and license/pddl | 1.0
ofl | open font license/sil open font license/ofl | 1.0 1.1
eupl | european union public licence/european union public license/eupl | 1.0 1.1 1.2
ms-pl | microsoft public license/ms pl |
ms-rl | microsoft reciprocal license/ms rl |
psf | python software foundation license/psf license | 2.0
php | php license | 3.0 3.01
ruby | ruby license |
openssl | openssl license |
postgresql | postgresql license/postgresql licence |
ncsa | university of illinois ncsa open source license/ncsa license |
w3c | w3c software notice and license/w3c license |
sleepycat | sleepycat license |
afl | academic free license/afl | 1.1 1.2 2.0 2.1 3.0
osl | open software license/osl | 1.0 1.1 2.0 2.1 3.0
qpl | q public license/qpl | 1.0
cecill | cecill license/cecill | 1.0 1.1 2.0 2.1
lppl | latex project public license/lppl | 1.0 1.1 1.2 1.3
mulan-psl | mulan psl/mulan permissive software license | 1.0 2.0
upl | universal permissive license/upl | 1.0
apsl | apple public source license/apsl | 1.0 1.1 1.2 2.0
sspl | server side public license/sspl | 1.0
elastic | elastic license | 1.0 2.0
polyform | polyform noncommercial license/polyform small business license | 1.0
opl | open publication license | 1.0
proprietary | all rights reserved/proprietary and confidential |
copyright | copyright notice/copyright holder/copyright holders |
"""

#: Ways to state a license, with priority and confidence.
NOTICE = r"(?:licensed|released|distributed|published|available|provided) under (?:the )?(?:terms of (?:the )?)?"
FULL, VERSIONED, PLAIN, NAMED = (4, 1.0), (3, 0.9), (2, 0.8), (1, 0.6)


def _versions(v: str) -> str:
    """A version as words: 2.0 is "2", "2 0", "v2" or "version 2 0"."""
    major, _, minor = v.partition(".")
    tail = rf"(?: {minor})?" if minor == "0" else rf" {minor}"
    return rf"(?: license| licence| international| only| or later)?(?: version| v)? v?{major}{tail}"


#: So many of a signature's words gate it, the longest ones: short words are in most texts.
GATE_WORDS = 3


def _gate(signature: str) -> list[str]:
    """Words that any match holds: of those outside of brackets, choices and gaps the longest."""
    bare = signature
    while (less := re.sub(r"\([^()]*\)\??", " # ", bare)) != bare:
        bare = less
    words = {w for w in bare.split() if re.fullmatch(r"[a-z0-9]+", w)}
    return sorted(sorted(words, key=lambda w: (-len(w), w))[:GATE_WORDS])


def anchor(rule: dict) -> str:
    """The word under which a rule is looked up: its longest."""
    return max(rule["words"], key=lambda w: (len(w), w))


def _regex(signature: str) -> str:
    """``..N`` as up to N words; brackets don't capture."""
    return re.sub(r" \.\.(\d+) ", r"(?: [^ ]+){0,\1} ", signature).replace("(", "(?:").replace("(?:?:", "(?:")


def _signatures() -> list[dict]:
    lines = [[x.strip() for x in line.split("|", 3)] for line in SIGNATURES.strip().splitlines()]
    for name in TAGGED.split():
        words = name.lower().replace("-", " ").replace(".", " ")
        lines.append([name.lower(), "6", "1.0", f"spdx license identifier {words}"])
    return [
        {"label": label, "pattern": f" {_regex(text)}(?= )", "priority": int(priority), "confidence": float(confidence), "words": _gate(text)}
        for label, priority, confidence, text in lines
    ]


def rules() -> list[dict]:
    out = []

    def add(label: str, name: str, pattern: str, rank: tuple[int, float]) -> None:
        # The leading space and the look at the next one keep to whole words.
        out.append(
            {"label": label, "pattern": f" {pattern}(?= )", "priority": rank[0], "confidence": rank[1],
             "words": sorted(set(name.split()))}
        )

    for line in filter(None, map(str.strip, FAMILIES.splitlines())):
        label, names, versions = (x.strip() for x in line.split("|"))
        for name in names.split("/"):
            literal = re.escape(name).replace(r"\ ", " ")
            for v in versions.split():
                add(f"{label}-{v}", name, NOTICE + literal + _versions(v), FULL)
                add(f"{label}-{v}", name, literal + _versions(v), VERSIONED)
            add(label, name, NOTICE + literal, PLAIN)
            add(label, name, literal, NAMED)
    return _signatures() + out
