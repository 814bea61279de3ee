import random

from prefmill.llm.license_scan import TEMPLATES, Scanner, blocks, licenses


def test_templates_are_found_where_they_stand():
    s, rng = Scanner(TEMPLATES), random.Random(1)
    for name, wording in TEMPLATES:
        filler = " ".join("".join(rng.choices("aeionrst", k=5)) for _ in range(30))
        found = s.scan([f"{filler}.\n{wording}\n{filler}", f"{filler} {wording} {filler}"])
        assert [f[0][:1] + f[0][2:3] for f in found] == [(name, 0), (name, 0)], (name, found)


def test_other_wording_is_left_alone():
    s = Scanner(TEMPLATES)
    assert s.scan(["", "a driver's licence is needed", "Licensed under", "warranty and copyright talk", "the MIT campus"]) == [[]] * 5
    assert [x[0] for x in s.scan(["This work is licensed under the GNU General Public License, version 2."])[0]] == ["GPL-2.0"]


def test_several_and_long(docs):
    s = Scanner(TEMPLATES)
    text = "All rights reserved. " + "word " * 5000 + "Released under the MIT License." + " word" * 5000
    assert [x[0] for x in s.scan([text])[0]] == ["proprietary", "MIT"]
    assert len(blocks(text)) == 2


def test_edges(docs, no_docs):
    rows = licenses(docs).collect()
    assert len(rows) == docs.count() and all(r.n_licenses == 0 and r.licenses == "" for r in rows)
    assert licenses(no_docs).count() == 0
