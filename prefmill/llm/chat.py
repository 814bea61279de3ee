"""Chat formatting: a finite-state machine over roles and a declarative template.

The template names for each role the strings around its text and whether the
text is trained on. Control strings inside texts are escaped reversibly by
``ESCAPE``, so that neither a marker nor the mask can be forged by a text. The
machine reads roles in turn order and says whether the order is valid; turns
of an invalid conversation are formatted all the same, and marked.

The text of one conversation streams through: rows are dealt by conversation,
sorted by turn, and formatted one after another; digests are carried on, and
segments leave as they are made. A conversation of any length needs the memory
of one turn, or of ``BLOCK`` characters where its output is read back.

Edge cases: null text is the empty text; a null role is the role ''; roles
that the template lacks are formatted as ``OTHER`` and make the conversation
invalid; repeated turns keep their order by (turn, role, text); a null conv_id
is one conversation; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefmill.llm.util import arrow_map

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """What stands around each role's text, which roles are trained on, and which role may follow."""

    before: dict[str, str]
    after: dict[str, str]
    trained: frozenset[str]
    follows: dict[str, frozenset[str]]
    last: frozenset[str]
    control: tuple[str, ...] = field(default=())

    def markers(self) -> list[str]:
        found = {*self.before.values(), *self.after.values(), *self.control} - {""}
        return sorted({m.strip() for m in found} - {""}, key=lambda m: (-len(m), m))


OTHER = "*"
DEFAULT = Template(
    before={"system": "<<SYS>>\n", "user": "[INST] ", "assistant": " ", OTHER: "<<ROLE>>"},
    after={"system": "\n<</SYS>>\n", "user": " [/INST]", "assistant": "</s>", OTHER: "<</ROLE>>"},
    trained=frozenset({"assistant"}),
    follows={"": frozenset({"system", "user"}), "system": frozenset({"user"}), "user": frozenset({"assistant"}), "assistant": frozenset({"user"})},
    last=frozenset({"assistant"}),
    control=("<s>", "<<ROLE>>", "<</ROLE>>"),
)


class Formatter:
    """Segments of turns, and the way back."""

    def __init__(self, template: Template = DEFAULT):
        self.t = template
        marks = "|".join(map(re.escape, template.markers()))
        self._special = re.compile(f"{re.escape(ESCAPE)}|{marks}")

    def escape(self, text: str) -> str:
        r"""Put ``\`` behind the first character of a control string and double every ``\``."""
        if not self._special.search(text):
            return text
        return self._special.sub(lambda m: ESCAPE * 2 if m[0] == ESCAPE else m[0][0] + ESCAPE + "." + m[0][1:], text)

    def unescape(self, text: str) -> str:
        if ESCAPE not in text:
            return text
        return re.sub(r"\\(\\|\.)", lambda m: ESCAPE if m[1] == ESCAPE else "", text)

    def turn(self, role: str, text: str) -> list[tuple[str, str, bool]]:
        """(kind, string, loss) segments of one turn: marker, role (others only), text, marker."""
        r = role if role in self.t.before and role != OTHER else OTHER
        name = [("role", self.escape(json.dumps(role)) + "\n", False)] if r == OTHER else []
        return [("before", self.t.before[r], False), *name, ("text", self.escape(text), r in self.t.trained), ("after", self.t.after[r], False)]

    def step(self, state: str | None, role: str) -> str | None:
        """The machine: the state is the last role, None once the order is broken."""
        return role if state is not None and role in self.t.follows.get(state, ()) else None

    def accepts(self, state: str | None) -> bool:
        return state in self.t.last if state is not None else False

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """Turns from a formatted conversation: (role, text), unescaped."""
        opens = sorted(self.t.before.items(), key=lambda kv: -len(kv[1]))
        out, at = [], 0
        while at < len(formatted):
            for role, mark in opens:
                if formatted.startswith(mark, at):
                    break
            else:
                raise ValueError(f"no turn begins at {at}")
            start = at + len(mark)
            end = formatted.index(self.t.after[role], start)
            body = formatted[start:end]
            if role == OTHER:
                name, body = body.split("\n", 1)
                role = json.loads(self.unescape(name))
            out.append((role, self.unescape(body)))
            at = end + len(self.t.after[OTHER if role not in self.t.before else role])
        return out


def ordered(turns: DataFrame) -> DataFrame:
    """Rows of a conversation together and in turn order.

    A conversation is one sequence, so its rows meet in one task; they stream
    through it. Conversations are spread by their id.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def segments(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """conv_id, position, kind, segment, loss: what a trainer concatenates, with its mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Formatter(template)
        current, position = object(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for conv, role, text in zip(*(part.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                    if conv != current:
                        current, position = conv, 0
                    for kind, segment, loss in f.turn(role, text):
                        rows.append((conv, position, kind, segment, loss))
                        position += 1
                yield _batch(rows, [("conv_id", pa.int64()), ("position", pa.int64()), ("kind", pa.string()), ("segment", pa.string()), ("loss", pa.bool_())])

    return arrow_map(ordered(turns), run, "conv_id long, position long, kind string, segment string, loss boolean")


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


#: Formatted characters that are read back at once; a conversation is written on while blocks of it are read.
BLOCK = 1 << 16


class _Digest:
    """Reads a conversation's output back: its string, many turns at a time, and the loss spans as offsets in it."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.chars, self.loss_chars, self.state = conv, 0, 0, 0, ""
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.block: list[str] = []
        self.spans: list[tuple[int, int]] = []
        self.start = 0

    def add(self, f: Formatter, made: list[tuple[str, str, bool]]) -> None:
        for _, s, loss in made:
            if loss:
                self.spans.append((self.chars, self.chars + len(s)))
            self.block.append(s)
            self.chars += len(s)
        if self.chars - self.start > BLOCK:
            self.read(f)

    def read(self, f: Formatter) -> None:
        """Turns and loss text of the block, from the string and the spans alone."""
        formatted = "".join(self.block)
        for role, text in f.parse(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            self.state = f.step(self.state, role)
        for a, b in self.spans:
            raw = f.unescape(formatted[a - self.start : b - self.start])
            self.loss_chars += len(raw)
            self.loss.update(raw.encode("utf-8"))
        self.block, self.spans, self.start = [], [], self.chars

    def row(self, f: Formatter) -> tuple:
        self.read(f)
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, f.accepts(self.state)


DIGEST = [
    ("conv_id", pa.int64()),
    ("n_turns", pa.int64()),
    ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()),
    ("formatted_chars", pa.int64()),
    ("valid", pa.bool_()),
]


def formatted_digests(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """A row a conversation, from its formatted output read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, now, rows = Formatter(template), None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for conv, role, text in zip(*(part.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                    if now is None or conv != now.conv:
                        if now is not None:
                            rows.append(now.row(f))
                        now = _Digest(conv)
                    now.add(f, f.turn(role, text))
            if len(rows) > 5000:
                yield _batch(rows, DIGEST)
                rows = []
        if now is not None:
            rows.append(now.row(f))
        yield _batch(rows, DIGEST)

    return arrow_map(ordered(turns), run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")


def digest_sql() -> str:
    """DuckDB SQL for the digests of ``conversations`` and conversation -7 under DEFAULT."""
    f = Formatter()
    t = "replace(text, '\\', '\\\\')"
    for m in f.t.markers():
        t = f"replace({t}, '{m}', '{m[0]}\\.{m[1:]}')"
    around = {r: len(f.t.before[r]) + len(f.t.after[r]) for r in ("system", "user", "assistant")}
    extra = " ".join(f"WHEN '{r}' THEN {n}" for r, n in around.items())
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) v(conv_id, turn, role, text)
), marked AS (
  SELECT *, length({t}) + CASE role {extra} END AS formatted,
         lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn) AS prev,
         lead(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn) AS next
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE role WHEN 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE role WHEN 'assistant' THEN text END, '' ORDER BY turn), '')) AS loss_sha256,
       CAST(sum(formatted) AS BIGINT) AS formatted_chars,
       bool_and((prev || '>' || role IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user'))
                AND (next <> '' OR role = 'assistant')) AS valid
FROM marked GROUP BY conv_id"""
