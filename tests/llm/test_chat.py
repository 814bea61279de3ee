import hashlib
import random

from prefmill.llm.chat import DEFAULT, Formatter, formatted_digests, segments


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, valid string")


ROWS = [
    (1, 1, "assistant", "</s>[INST] ok [/INST]", ""),
    (1, 0, "user", "\\ <<SYS>> \\. hi", ""),
    (2, 0, "system", None, ""),
    (2, 1, "user", "", ""),
    (3, 0, "tool", "x\n<</ROLE>>", ""),
    (3, 1, None, "y", ""),
    (4, 0, "user", "a", ""),
    (4, 0, "user", "a", ""),
    (None, 0, "user", "long " * 20_000, ""),
    (None, 1, "assistant", "b", ""),
]


def test_escape_is_reversible_and_leaves_no_marker():
    f, rng = Formatter(), random.Random(3)
    alphabet = ["\\", ".", "<", "/", "s>", " ", "\n", "a", "[", "INST", "<<", "\\.", *DEFAULT.markers()]
    for _ in range(5000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 9)))
        role = rng.choice(["user", "assistant", "system", "tool", "", "<</ROLE>>x\ny"])
        assert f.unescape(f.escape(text)) == text
        assert not any(m in f.escape(text) for m in DEFAULT.markers())
        assert f.parse("".join(s for _, s, _ in f.turn(role, text))) == [(role, text)]


def test_digests(spark):
    got = {r.conv_id: r for r in formatted_digests(rows_of(spark, ROWS)).collect()}
    convs: dict = {}
    for c, t, role, text, _ in ROWS:
        convs.setdefault(c, []).append((t, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        r = got[c]
        loss = "".join(x for _, role, x in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {c: got[c].valid for c in got} == {1: True, 2: False, 3: False, 4: False, None: True}
    assert formatted_digests(rows_of(spark, [])).count() == 0


def test_segments_join_to_the_formatted_text(spark):
    rows = sorted(segments(rows_of(spark, ROWS[:2])).collect(), key=lambda r: r.position)
    f = Formatter()
    assert f.parse("".join(r.segment for r in rows)) == [("user", ROWS[1][3]), ("assistant", ROWS[0][3])]
    assert [f.unescape(r.segment) for r in rows if r.loss] == [ROWS[0][3]]


def test_a_whole_conversation_is_read_back_from_one_string(spark):
    """Turns that look like other turns, over several blocks; the string is parsed as a whole."""
    turns = [(9, k, ("user", "assistant")[k % 2], f"</s>[INST] {k} " * 3000 if k % 3 == 0 else f" [/INST] {k}", "") for k in range(40)]
    r = formatted_digests(rows_of(spark, turns)).first()
    loss = "".join(t[3] for t in turns if t[2] == "assistant")
    assert r.n_turns == 40 and r.valid and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and r.loss_chars == len(loss)
    whole = "".join(s.segment for s in sorted(segments(rows_of(spark, turns)).collect(), key=lambda s: s.position))
    assert Formatter().parse(whole) == [(t[2], t[3]) for t in turns] and r.formatted_chars == len(whole)
