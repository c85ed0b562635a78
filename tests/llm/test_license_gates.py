"""Keywords of the license scan let every rule's matches through; gaps have no limit; suppression against a plain version."""

import itertools
import random
from re import _parser

import pytest

from parceltrail.llm import license_scan as scan

RULES = scan.rules()


def examples(tree, dice, gap):
    """A text that the parsed pattern matches, alternatives and counts drawn at random; `gap` stands between words."""
    out = ""
    for kind, value in tree:
        kind = str(kind)
        if kind == "LITERAL":
            out += chr(value)
        elif kind == "IN":
            out += gap if str(value[0][0]) == "NEGATE" else chr(value[0][1] if str(value[0][0]) == "LITERAL" else value[0][1][0])
        elif kind == "BRANCH":
            out += examples(dice.choice(value[1]), dice, gap)
        elif kind in ("SUBPATTERN", "ATOMIC_GROUP"):
            out += examples(value[3] if kind == "SUBPATTERN" else value, dice, gap)
        elif kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            out += examples(value[2], dice, gap) * dice.randint(value[0], max(value[0], min(1, value[1])))
        else:
            assert kind == "ASSERT_NOT"
    return out


def ungated(text):
    made = [scan.Detection(*m.span(), r.priority, r.confidence, r.label) for r in RULES for m in r.pattern.finditer(text)]
    return scan.resolved(scan.base_detections(text) + made)


@pytest.mark.parametrize("gap", [" ", "\n", "\n//" + " " * 40, "*"])
def test_gated_and_ungated_detections_agree(gap):
    dice = random.Random(1)
    for rule, _ in itertools.product(RULES, range(3)):
        text = examples(_parser.parse(rule.pattern.pattern.decode("latin-1"), rule.pattern.flags), dice, gap).encode("latin-1")
        if not rule.pattern.search(text):  # an alternative that the rule's own condition on what follows rules out
            assert "?!" in rule.pattern.pattern.decode("latin-1").removesuffix(f"(?!{scan.WORD})"), (rule, text)
            continue
        assert scan.detections(text) == ungated(text) != [], text


def test_rules_are_many_and_each_has_a_keyword():
    assert len(scan.SIGNATURES) > 200 and len(RULES) > 500
    assert len(set(scan.SIGNATURES)) == len(scan.SIGNATURES)
    assert all(rule.keywords and all(rule.keywords) for rule in RULES)
    assert scan.keywords_of("gpl{v}3 0") == (b"gpl", b"0", b"3") and scan.keywords_of("names? of (?:the )?mit licen[cs]ed") == (b"licen", b"name", b"mit")
    assert len({label for _, label, _ in scan.SIGNATURES}) > 40


@pytest.mark.parametrize("blanks", [1, 2, 11, 12, 13, 14, 60, 200])
@pytest.mark.parametrize("mark", ["\n", "\n//", "\t#\r\n"])
def test_wrapped_and_indented_notices(blanks, mark):
    gap = mark + " " * blanks
    for text, label in (
        ("licensed under the gpl v3 license", "gpl-3"), ("all rights reserved", "proprietary"),
        ("redistributions of source code must retain the above copyright notice", "bsd"),
        ("you may obtain a copy at www.apache.org/licenses/license-2.0", "apache-2"),
        ("gnu general public license as published by the free software foundation, either version 3 of the license", "gpl-3"),
    ):
        assert [d.label for d in scan.detections(text.replace(" ", gap).encode())] == [label], text


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("distributed\nunder the gpl v3", ["gpl-3"]),
        ("in the public\tdomain", ["public-domain"]),
        ("licensed under the psf license", ["psf"]),
        ("licensed under the internet systems consortium license", ["isc"]),
        ("gplv3", ["gpl-3"]),
        ("gpl-3.0-only", ["gpl-3"]),
        ("lgpl v2.1", ["lgpl-2.1"]),
        ("https://www.apache.org/licenses/license-2.0", ["apache-2"]),
        ("redistributions of source code must retain the above copyright notice", ["bsd"]),
        ("this program is free software", ["gpl"]),
        ("licensed under the gpl v3 license", ["gpl-3"]),
        ("lesser general public license as published by the free software foundation; either version 2.1", ["lgpl-2.1"]),
        ("spdx-license-identifier: apache-2.0", ["apache-2"]),
        ("https://creativecommons.org/licenses/by-nc-sa/4.0/", ["cc-by-nc-sa"]),
        ("cc by-sa 4.0", ["cc-by-sa"]),
        ("neither the name of the acme corp. nor the names of its contributors may be used to endorse or promote products", ["bsd-3-clause"]),
        ("permission is hereby granted, free of charge, to any person obtaining a copy of this software", ["mit"]),
        ("a permit, limits, gplx, xgpl 3.0 and the apache tribe", []),
        ("unlicensed", []),
    ],
)
def test_labels(text, labels):
    assert [d.label for d in scan.detections(text.encode())] == labels


def test_suppression_against_a_plain_version():
    dice = random.Random(5)
    for _ in range(400):
        found = []
        for _ in range(dice.randrange(40)):
            a = dice.randrange(60)
            found.append(scan.Detection(a, a + dice.randrange(1, 20), dice.choice([10, 30, 50, 100]), 0.5, dice.choice("ab")))
        kept = []
        for d in sorted(found, key=lambda d: (-d.priority, d.start - d.stop, d.start, d.label)):
            if d.priority == 100 or not any(k.start <= d.start and d.stop <= k.stop for k in kept):
                kept.append(d)
        assert scan.resolved(found) == sorted(kept, key=lambda d: (d.start, d.stop, d.label))


def test_very_long_gaps_and_texts_take_linear_time():
    text = b"licensed" + b" " * 2_000_000 + b"under the gpl, " + b"as licensed under the " * 50_000
    assert [d.label for d in scan.detections(text)] == ["gpl"]
