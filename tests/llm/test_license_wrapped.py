import textwrap

import pytest

from prefmill.llm.license_scan import TEMPLATES, Scanner


@pytest.mark.parametrize(("name", "wording"), TEMPLATES)
@pytest.mark.parametrize("sign", ["", "# ", " * ", "    // "])
def test_wrapped_notices_are_found(name, wording, sign):
    s = Scanner(TEMPLATES)
    for width in (12, 30, 50, 80):
        notice = "\n".join(sign + x for x in textwrap.wrap(wording, width, break_long_words=False, break_on_hyphens=False))
        found = s.scan([f"a first line\n\n{notice}\nand a last one", notice])
        assert [[x[0] for x in f] for f in found] == [[name]] * 2, (name, width)


def test_a_wrapped_notice_has_its_place():
    text = "x\n" * 400 + "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:\n" + "y\n" * 400
    assert [(x[0], x[2], x[3]) for x in Scanner(TEMPLATES).scan([text])[0]] == [("BSD-3-Clause", 0, 800)]
