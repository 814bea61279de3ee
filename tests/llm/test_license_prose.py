import pytest

from prefmill.llm.license_scan import TEMPLATES, Scanner

#: Prose that shares its common words with the long templates.
BEFORE = (
    "The permission to use this software and the associated documentation was discussed at length in the meeting, and the version of the report "
    "that was finally released to the public in March is provided for any person who is obtaining a copy of the source for further work"
)
AFTER = "and with this the work of the committee on the general conditions of redistribution was met with the approval of the following members"


@pytest.mark.parametrize(("name", "wording"), TEMPLATES)
def test_notices_are_found_within_prose(name, wording):
    s = Scanner(TEMPLATES)
    texts = [f"{BEFORE} {wording} {AFTER}", f"{BEFORE}. {AFTER}. {wording}", f"{wording} {AFTER}, {BEFORE}"]
    assert [[x[0] for x in f] for f in s.scan(texts)] == [[name]] * 3
