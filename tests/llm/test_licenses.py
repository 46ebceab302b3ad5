"""License scan against a plain scan with every rule and a comparison of all detections."""

import random
import re
import re._parser as parser
from itertools import product as combos

import pytest

from meshtally.llm import license_scan
from meshtally.llm.license_signatures import BASE, signatures

RULES = signatures()
SCHEMA = "doc_id bigint, text string, _licenses string, n_words string, found string"


def expansions(pattern):
    """Strings that a pattern matches: every branch, optional parts left out and put in."""
    def walk(items):
        parts = [[""]]
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                parts.append([chr(arg)])
            elif name == "BRANCH":
                parts.append([x for branch in arg[1] for x in walk(branch)])
            elif name == "SUBPATTERN":
                parts.append(walk(arg[3]))
            elif name == "MAX_REPEAT":
                parts.append(["", *walk(arg[2])])
            elif name == "IN":
                kind, value = arg[0]
                parts.append(["1" if str(kind) != "LITERAL" else chr(value)])
            else:
                raise AssertionError(name)
        return ["".join(p) for p in combos(*parts)]
    return walk(parser.parse(pattern))


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    spaced = " " + " ".join(words) + " "
    found = []
    every = [(*r, False) for r in RULES] + [(2, label, k, phrase, True) for label, k, phrase in BASE]
    for nr, (level, label, _, pattern, base) in enumerate(every):
        for m in re.finditer(f"(?<= )(?:{pattern})(?= )", spaced):
            first = spaced[:m.start()].count(" ") - 1
            found.append((first, first + m.group().count(" "), level, nr, label, base))
    kept = [d for d in found if d[5] or not any(
        o[0] <= d[0] and o[1] >= d[1] and o[2] <= d[2] and (o[0], -o[1], o[2], o[3]) < (d[0], -d[1], d[2], d[3])
        for o in found if not o[5])]
    return len(words), sorted((d[0], -d[1], *d[2:]) for d in kept)


def texts():
    rng = random.Random(4)
    samples = [rng.choice(expansions(r[3])) for r in RULES] + [p for _, _, p in BASE] * 10
    out = [None, "", " \n", "CC BY", "cc-by cc by, CC  BY!", "xcc by", "cc byx", "ñcc by cc by", "All Rights\nReserved.",
           "GNU General Public License, version 3", "Copyright © 2021 X. All rights reserved.", "\x01cc by\x02 $0 \\1",
           "general general public license license", "cc by " * 3000, "All rights reserved. Released under the MIT License. " * 700]
    for _ in range(150):
        parts = [rng.choice(samples) if rng.random() < 0.6 else rng.choice(["the", "gpl", "3", "0", "license", "by", "naïve"])
                 for _ in range(rng.randint(1, 12))]
        out.append("".join(p.title() + rng.choice([" ", ", ", "\n", "-"]) for p in parts))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", "clash", "clash") for i, t in enumerate(texts())]
    return spark.createDataFrame([*rows, rows[3], (None, "cc by", None, None, None)], SCHEMA).repartition(3)


def test_every_match_holds_its_keyword():
    assert len(RULES) > 250
    for level, label, keyword, pattern in RULES:
        assert "," not in label and level < len(license_scan.WEIGHTS)
        for text in expansions(pattern):
            assert keyword in text.split(" "), (pattern, text)
            assert re.fullmatch(pattern, text)


def test_detections_equal_the_plain_scan(docs):
    rows = license_scan.scan(docs).collect()
    assert len(rows) == docs.count() and rows[0].n_words == "clash"
    for r in rows:
        n, kept = plain(r.text)
        assert r._licenses.n_words == n
        assert [(d["first"], d["last"], d.level, d.label, d.base) for d in r._licenses.found] == [
            (a, -b, level, label, base) for a, b, level, _, label, base in kept]


def test_report(docs):
    rows = license_scan.report(docs).collect()
    by_id = {r.doc_id: r for r in rows}
    for i, text in enumerate(texts()):
        n, kept = plain(text)
        base = [d for d in kept if d[5]]
        r = by_id[i]
        assert (r.n_words, r.n_base) == (n, len(base))
        assert (r.first_word, r.last_word) == ((min(d[0] for d in base), max(d[0] for d in base)) if base else (None, None))
        assert r.base_labels == ",".join(sorted({d[4] for d in base})) and r.labels == ",".join(sorted({d[4] for d in kept}))
        assert r.score == max([0.0, *(license_scan.WEIGHTS[d[2]] for d in kept)])
    assert by_id[9].base_labels == "gpl" and "gpl-3.0" in by_id[9].labels.split(",")
    assert len(rows) == docs.count() and license_scan.report(docs.limit(0)).count() == 0
