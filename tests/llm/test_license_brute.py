"""Every template at every place by plain dynamic programming, against the filtered scan."""

import random

import pytest

from prefmill.llm.license_scan import COST, TEMPLATES, Scanner, distances, licenses, spare, words_of

MIX = [t for t in TEMPLATES if len(words_of(t[1])) < 30] + [t for t in TEMPLATES if 30 <= len(words_of(t[1])) < 90]


def plain(template, words):
    """Least edit distance of the template to a run of words that ends at each word, with the last begin that has it."""
    above = [(0, -k) for k in range(len(words) + 1)]
    for i, t in enumerate(template, 1):
        row = [(i, 0)]
        for j, w in enumerate(words, 1):
            steps = [(above[j][0] + 1, above[j][1]), (row[j - 1][0] + 1, row[j - 1][1]), (above[j - 1][0] + (t != w), above[j - 1][1])]
            row.append(min(steps))
        above = row
    return [(d, -b) for d, b in above[1:]]


def everywhere(words, a=0):
    best = None
    for _, wording in MIX:
        template = words_of(wording)
        found = plain(template, words)
        if not found:
            continue
        diff = min(d for d, _ in found)
        end = [d for d, _ in found].index(diff)
        if diff <= spare(template) and (best is None or COST * diff - len(template) < best[0]):
            best = (COST * diff - len(template), diff, found[end][1], end + 1)
    if best is None:
        return []
    _, diff, first, end = best
    return [*everywhere(words[:first], a), (a + first, diff), *everywhere(words[end:], a + end)]


def test_bit_parallel_distances():
    rng = random.Random(1)
    for _ in range(300):
        t, w = rng.choices("abcd", k=rng.randint(1, 70)), rng.choices("abcd", k=rng.randint(0, 90))
        assert distances(t, w) == [d for d, _ in plain(t, w)]


def test_scan_against_every_template_at_every_place():
    rng, s = random.Random(2), Scanner(MIX)
    common = sorted({w for _, x in MIX for w in words_of(x)})
    hits = 0
    for _ in range(120):
        words = []
        for _ in range(rng.randint(1, 3)):
            words += rng.choices(common, k=rng.randint(0, 25))
            own = words_of(rng.choice(MIX)[1])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2, 3])):
                k = rng.randrange(len(own) or 1)
                own[k : k + rng.randint(0, 1)] = rng.choices(common, k=rng.randint(0, 1))
            words += own
        text = " ".join(words)
        starts = [sum(len(w) + 1 for w in words[:k]) for k in range(len(words))]
        want = [(starts[k], d) for k, d in everywhere(words)]
        assert [(x[3], x[2]) for x in s.scan([text])[0]] == want
        hits += len(want)
    assert hits > 150


@pytest.mark.parametrize("notice", ["Licensed under the Apache License,\nVersion 2.0.", "SPDX-License-Identifier: MIT", "Permission is hereby granted, free of charge,\nto any person obtaining a copy of this software and associated documentation files"])
def test_characters_that_grow_do_not_move_positions(notice):
    text = "\u0130" * 400 + " x\u212a " + notice
    found = Scanner(TEMPLATES).scan([text])[0]
    assert [x[3] for x in found] == [text.index(notice)]


def test_callers_templates_need_no_known_word():
    own = [("x", "colourless green ideas sleep furiously tonight")]
    assert [x[0] for x in Scanner(own).scan(["He said: colourless green\n ideas sleep furiously, tonight!"])[0]] == ["x"]
    assert Scanner([("nothing", "..."), ("all", "All rights reserved.")]).scan(["all rights reserved", ""]) == [[("all", pytest.approx(0.5, abs=0.5), 0, 0)], []]


def test_nulls_beside_notices_ties_and_clashing_names(spark, docs):
    rows = [(1, "All rights reserved.", "a", 1), (1, "All rights reserved.", "a", 1), (None, "All rights reserved. All rights reserved.", None, 2), (2, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, licenses string, n_licenses int")
    got = sorted((str(r.doc_id), r.licenses) for r in licenses(df).collect())
    assert got == [("1", "proprietary"), ("1", "proprietary"), ("2", ""), ("None", "proprietary,proprietary")]
    twins = [("first", "one two three four"), ("second", "one two three four")]
    assert [x[0] for x in Scanner(twins).scan(["one two three four"])[0]] == ["first"]
