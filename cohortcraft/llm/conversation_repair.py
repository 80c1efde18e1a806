"""Repair of conversation structure by weighted CYK over spans of turns.

A conversation should be ``(system? (user assistant)+)?`` by the initials of its
roles. Every turn is kept (0), given the role user or assistant (1) or deleted
(2), and empty turns may be inserted anywhere (5). Blank and duplicate turns
must be deleted; a truncated turn that stays costs 5 more. Wanted is the
cheapest repair, and of equally cheap ones the least ``audit``: one letter per
turn (K, R, D) and per insertion (I), in order.

Grammar. A nonterminal says what a span leaves: nothing, a system turn alone, or
an alternating run by its first and last role, with or without a system turn in
front. Every production is binary (``PRODUCTS``). A chart cell holds the least
(cost, audit) per nonterminal; cells of single turns are closed under
insertions on both sides, longer spans join two shorter ones at every cut,
bottom-up by length. At equal cost no audit is a prefix of another, as its
letters fix its cost, so least parts give the least whole. Charts of up to
``CHART`` turns are filled completely. Longer spans join aligned halves: a
nonterminal describes its span completely, so one cut is as good as all
(tested).

Plan. Turns become compact rows (a digest for the text) and equal rows are
counted together. A conversation's first turn with a role and text is found by
aggregation and joined back. Rows are range-sorted by (conversation, turn, role,
digest), so a conversation of any length is dealt over many tasks; each task
parses what it holds of a conversation to one cell. Cells and counts of a
conversation (one per task at most) meet in one task, which fixes the audit and
cuts it into the tasks' pieces. Pieces, compact rows and texts stream by
conversation past a merger that writes the repaired turns.

Order is by turn (nulls first), then role and digest of the text, so ties have
one defined order. Null roles and texts count as one space. Rows with a null
``conv_id`` are one conversation. Equal rows are duplicates of the first.
Columns beyond the four are ignored, an empty table gives empty results.
``conv_id`` and ``turn`` are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortcraft.llm.storage import written
from cohortcraft.llm.workers import ship_package

# The costs of the edits.
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

CHART = 12
"""Turns whose spans are all filled; longer conversations join such charts."""
CACHE = 100_000
"""Cells that a worker keeps by the classes of their turns; beyond it the cache starts anew."""
BATCH = 2_000
"""Rows of one output batch."""

# What a span leaves. "" nothing, "s" a system turn, "ua" a run from user to
# assistant, "su"/"sa" a system turn and a run from user to user/assistant.
NONTERMINALS = ("", "s", "uu", "ua", "au", "aa", "su", "sa")
_FLIP = {"u": "a", "a": "u"}


def _products() -> tuple[tuple[int, int, int], ...]:
    """(left, right, whole) of every binary production."""
    number = {x: i for i, x in enumerate(NONTERMINALS)}
    runs = [f + t for f in "ua" for t in "ua"]
    out = [("", x, x) for x in NONTERMINALS] + [(x, "", x) for x in NONTERMINALS if x]
    out += [(x, y, x[0] + y[1]) for x in runs for y in runs if y[0] == _FLIP[x[1]]]
    out += [("s", y, "s" + y[1]) for y in runs if y[0] == "u"]
    out += [("s" + last, y, "s" + y[1]) for last in "ua" for y in runs if y[0] == _FLIP[last]]
    return tuple((number[a], number[b], number[c]) for a, b, c in out)


PRODUCTS = _products()
Cell = tuple  # per nonterminal (cost, audit) or None
_ACCEPTED = tuple(NONTERMINALS.index(x) for x in ("", "ua", "sa"))


def join(left: Cell, right: Cell) -> Cell:
    """Least (cost, audit) per nonterminal of two neighbouring spans."""
    out: list = [None] * len(NONTERMINALS)
    for a, b, whole in PRODUCTS:
        x, y = left[a], right[b]
        if x is not None and y is not None:
            cost, held = x[0] + y[0], out[whole]
            if held is None or cost < held[0]:
                out[whole] = (cost, x[1] + y[1])
            elif cost == held[0]:
                audit = x[1] + y[1]
                if audit < held[1]:
                    out[whole] = (cost, audit)
    return tuple(out)


def _cell(**known: tuple[int, str]) -> Cell:
    return tuple(known.get(x or "nothing") for x in NONTERMINALS)


# Insertions alone: an empty span. Longer runs of them are never cheaper.
EMPTY = _cell(
    nothing=(0, ""), uu=(INSERT, "I"), aa=(INSERT, "I"), ua=(2 * INSERT, "II"), au=(2 * INSERT, "II")
)


def leaf(kind: str) -> Cell:
    """Cell of one turn, closed under insertions. ``kind``: "x" must go; else the initial, upper case if truncated."""
    options = {"nothing": (DELETE, "D")}
    if kind != "x":
        more = TRUNCATED if kind.isupper() else 0
        initial = kind.lower()
        options |= {"uu": (more + RELABEL, "R"), "aa": (more + RELABEL, "R")}
        if initial == "s":
            options["s"] = (more, "K")
        elif initial in "ua":
            options[initial * 2] = (more, "K")
    return join(join(EMPTY, _cell(**options)), EMPTY)


_LEAVES = {kind: leaf(kind) for kind in "xsuaoSUAO"}
_CELLS: dict[str, Cell] = {}


def chart(kinds: str) -> Cell:
    """Cell of a span of turns, filled bottom-up by span length over all cuts."""
    if not kinds:
        return EMPTY
    known = _CELLS.get(kinds)
    if known is not None:
        return known
    if len(_CELLS) >= CACHE:
        _CELLS.clear()
    for length in range(1, len(kinds) + 1):
        for begin in range(len(kinds) - length + 1):
            span = kinds[begin : begin + length]
            if span in _CELLS:
                continue
            best = _LEAVES[span] if length == 1 else None
            for cut in range(1, length):
                whole = join(_CELLS[span[:cut]], _CELLS[span[cut:]])
                best = whole if best is None else least(best, whole)
            _CELLS[span] = best
    return _CELLS[kinds]


def least(x: Cell, y: Cell) -> Cell:
    return tuple(b if a is None else a if b is None else min(a, b) for a, b in zip(x, y, strict=True))


def joined(cells: list[Cell]) -> Cell:
    """Cell of neighbouring spans, pairs first."""
    while len(cells) > 1:
        cells = [join(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else EMPTY


def parse(kinds: str) -> Cell:
    """Cell of a conversation's part of any length."""
    return joined([chart(kinds[i : i + CHART]) for i in range(0, len(kinds), CHART)])


def answer(cell: Cell) -> tuple[int, str]:
    """Least (cost, audit) that leaves a well-formed conversation."""
    return min(cell[i] for i in _ACCEPTED if cell[i] is not None)


def cut(audit: str, turns: list[int]) -> list[str]:
    """Pieces of an audit for spans of so many turns; insertions at a seam go to the span before it."""
    pieces, at = [], 0
    for n in turns:
        begin = at
        while n:
            n -= audit[at] != "I"
            at += 1
        while at < len(audit) and audit[at] == "I":
            at += 1
        pieces.append(audit[begin:at])
    return pieces


SPACES = " \t\n\x0b\x0c\r"
"""What is no character of a turn's content."""
_COMPACT = ["conv_id", "turn", "role", "digest"]


def compact(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, copies, fault): distinct turns, with the first fault of their first copy."""
    text = F.coalesce("text", F.lit(" "))
    content = F.rtrim(text, F.lit(SPACES))
    turns = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.unhex(F.sha2(text, 256)).alias("digest"),
        (content == "").alias("blank"), (~F.right(content, F.lit(1)).isin(".", "!", "?")).alias("open"),
    )
    distinct = turns.groupBy(*_COMPACT).agg(F.count("*").alias("copies"), F.first("blank").alias("blank"), F.first("open").alias("open"))
    said = ("conv_id", "role", "digest")
    first = distinct.groupBy(*said).agg(
        F.when(F.bool_or(F.col("turn").isNull()), None).otherwise(F.min("turn")).alias("first_turn")
    )
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in said]
    joined_ = distinct.alias("a").join(first.alias("b"), same[0] & same[1] & same[2])
    fault = (
        F.when(F.col("blank"), "blank")
        .when(~F.col("turn").eqNullSafe(F.col("first_turn")), "duplicate")
        .when(F.col("open"), "truncated")
    )
    return joined_.select(*(F.col(f"a.{c}") for c in _COMPACT), "copies", fault.alias("fault"))


def _kind(role: str, fault: str | None) -> str:
    if fault in ("blank", "duplicate"):
        return "x"
    kind = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return kind.upper() if fault == "truncated" else kind


_LEGAL = ("su", "ua", "au")
_SPAN = (
    "conv_id bigint, turn bigint, role string, digest binary, n bigint, last_turn bigint, last_role string, low bigint, "
    "high bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, costs array<bigint>, audits array<string>"
)
_PART = 256 * CHART
_SPAN_NAMES = [c.split()[0] for c in _SPAN.split(", ")]


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for a in range(0, batch.num_rows, BATCH):
            yield from zip(*(c.to_pylist() for c in batch.slice(a, BATCH).columns), strict=True)


class _Span:
    """A task's part of one conversation, read turn by turn."""

    def __init__(self, conv_id, turn, role: str, digest: bytes) -> None:
        self.key = (conv_id, turn, role, digest)
        self.n = self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.last_turn = self.last_role = None
        self.kinds: list[str] = []
        self.cells: list[Cell] = []

    def add(self, turn, role: str, copies: int, fault: str | None) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        initial = role[:1]
        if self.n:
            self.illegal += self.last_role[:1] + initial not in _LEGAL
        self.illegal += (copies - 1) * (initial * 2 not in _LEGAL)
        self.last_turn, self.last_role = turn, role
        self.n += copies
        again = "blank" if fault == "blank" else "duplicate"
        for kind, times in ((fault, 1), (again, copies - 1)):
            if kind:
                setattr(self, kind, getattr(self, kind) + times)
        self.kinds.append(_kind(role, fault))
        self._parse()
        for done in range(0, copies - 1, _PART):
            self.kinds.extend("x" * min(_PART, copies - 1 - done))
            self._parse()

    def _parse(self) -> None:
        """Parse what came, a bounded part at a time."""
        while len(self.kinds) >= _PART:
            self.cells.append(parse("".join(self.kinds[:_PART])))
            del self.kinds[:_PART]

    def row(self) -> tuple:
        cell = joined([*self.cells, *([parse("".join(self.kinds))] if self.kinds else [])])
        return (
            *self.key, self.n, self.last_turn, self.last_role, self.low, self.high, self.turns,
            self.blank, self.duplicate, self.truncated, self.illegal,
            [None if x is None else x[0] for x in cell], [None if x is None else x[1] for x in cell],
        )


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for value in row for x in (value if isinstance(value, list) else [value]) if isinstance(x, (str, bytes)))
        if len(held) >= BATCH or size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        span = None
        for conv_id, turn, role, digest, copies, fault in _records(batches):
            if span is None or span.key[0] != conv_id:
                if span:
                    yield span.row()
                span = _Span(conv_id, turn, role, digest)
            span.add(turn, role, copies, fault)
        if span:
            yield span.row()

    yield from _batched(rows(), _arrow(_SPAN))


_PIECE = (
    "conv_id bigint, turn bigint, role string, digest binary, piece string, expected string, whole string, gaps bigint, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
)
_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _expected(before: str, piece: str, starts_with_system: bool) -> str:
    """Role that the next turn left must have, after ``piece``: "" at the very start, where a system turn may stand."""
    left = sum(x != "D" for x in piece)
    if not left:
        return before
    if not before:
        left -= starts_with_system
        before = "u"
    return before if left % 2 == 0 else _FLIP[before]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of whole conversations, in order, to the pieces of their audits; the first piece carries the totals."""

    def conversation(spans: list[dict]):
        cells = [tuple(None if c is None else (c, a) for c, a in zip(s["costs"], s["audits"], strict=True)) for s in spans]
        whole = joined(cells)
        cost, audit = answer(whole)
        has_system = whole[NONTERMINALS.index("sa")] == (cost, audit)
        totals = {c: sum(s[c] for s in spans) for c in _COUNTS}
        turns = sum(s["turns"] for s in spans)
        for a, b in zip(spans, spans[1:], strict=False):
            totals["illegal"] += a["last_role"][:1] + b["role"][:1] not in _LEGAL
            turns -= b["turn"] is not None and a["last_turn"] == b["turn"]  # one turn on both sides of a seam
        low = min((s["low"] for s in spans if s["low"] is not None), default=None)
        high = max((s["high"] for s in spans if s["high"] is not None), default=None)
        gaps = 0 if low is None else high - low + 1 - turns
        expected = ""
        for i, (s, piece) in enumerate(zip(spans, cut(audit, [s["n"] for s in spans]), strict=True)):
            rest = (audit, gaps, *totals.values(), cost) if i == 0 else (None,) * 7
            yield (s["conv_id"], s["turn"], s["role"], s["digest"], piece, expected, *rest)
            expected = _expected(expected, piece, has_system)

    def rows():
        held: list[dict] = []
        for record in _records(batches):
            span = dict(zip(_SPAN_NAMES, record, strict=True))
            if held and held[0]["conv_id"] != span["conv_id"]:
                yield from conversation(held)
                held = []
            held.append(span)
        if held:
            yield from conversation(held)

    yield from _batched(rows(), _arrow(_PIECE))


_TURN = "conv_id bigint, position bigint, role string, text string, edit string"


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (part 0), compact turns (1) and texts (2), merged in order, to the repaired turns."""

    def rows():
        conv, letters, at, position, expected, waiting = object(), "", 0, 0, "", None
        full = {"u": "user", "a": "assistant"}
        for conv_id, turn, role, digest, part, number, note, text in _records(batches):
            if conv_id != conv:
                conv, letters, at, position, expected, waiting = conv_id, "", 0, 0, "", None
            if part == 0:
                letters, at, expected = note, 0, number
            elif part == 1:
                waiting = None
                for copy in range(int(number)):
                    while letters[at] == "I":
                        expected = expected or "u"
                        yield (conv_id, position, full[expected], "", "I")
                        at, position, expected = at + 1, position + 1, _FLIP[expected]
                    if letters[at] != "D":
                        keeps = letters[at] == "K"
                        new = role if keeps else full[expected or "u"]
                        waiting = (position, new, letters[at])
                        position += 1
                        expected = "u" if keeps and not expected and role[:1] == "s" else _FLIP[expected or "u"]
                    at += 1
            elif waiting is not None:  # the first of equal texts
                yield (conv_id, waiting[0], waiting[1], text, waiting[2])
                waiting = None
            if part and waiting is None:  # a least audit has no insertion before a deletion, so these follow at once
                while at < len(letters) and letters[at] == "I":
                    expected = expected or "u"
                    yield (conv_id, position, full[expected], "", "I")
                    at, position, expected = at + 1, position + 1, _FLIP[expected]

    yield from _batched(rows(), _arrow(_TURN))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(summaries, turns) of the conversations in ``rows`` (conv_id, turn, role, text).

    Summaries, one row per conversation: gaps, the counts of faults, cost and
    audit. Turns: the repaired conversations, ``position`` from 0, with the edit
    that made each turn. The turns come partitioned by conversation and in order.
    """
    ship_package(rows.sparkSession)
    rows = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    marked = written(compact(rows), "turns")
    ordered = marked.repartitionByRange(*_COMPACT).sortWithinPartitions(*_COMPACT)
    spans = written(ordered.mapInArrow(_spans, _SPAN), "turn-spans")
    pieces = written(
        spans.repartition("conv_id").sortWithinPartitions(*_COMPACT).mapInArrow(_pieces, _PIECE), "audit-pieces"
    )
    summaries = pieces.where(F.col("whole").isNotNull()).select(
        "conv_id", "gaps", *_COUNTS, "cost", F.col("whole").alias("audit")
    )
    part = lambda df, i, number, note, text: df.select(
        *_COMPACT, F.lit(i).alias("part"), number.alias("number"), note.alias("note"), text.alias("text")
    )
    none = F.lit(None).cast("string")
    text = F.coalesce("text", F.lit(" "))
    texts = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    stream = (
        part(pieces, 0, F.col("expected"), F.col("piece"), none)
        .unionByName(part(marked, 1, F.col("copies").cast("string"), F.col("fault"), none))
        .unionByName(part(texts, 2, none, none, F.col("text")))
    )
    turns = stream.repartition("conv_id").sortWithinPartitions(*_COMPACT, "part").mapInArrow(_turns, _TURN)
    return summaries, turns


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        conv, digest = None, None
        for conv_id, role, text in _records(batches):
            if digest is None or conv_id != conv:
                if digest is not None:
                    yield (conv, digest.hexdigest())
                conv, digest = conv_id, hashlib.sha256(f"{role}:{text}".encode())
            else:
                digest.update(f"\n{role}:{text}".encode())
        if digest is not None:
            yield (conv, digest.hexdigest())

    yield from _batched(rows(), _arrow("conv_id bigint, repaired_sha256 string"))


def text_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the turns that ``repair`` returns, streamed in their order."""
    return turns.select("conv_id", "role", "text").mapInArrow(_hashes, "conv_id bigint, repaired_sha256 string")


EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def _remainder() -> Column:
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    return F.crc32(key.cast("binary")) % 20


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with drawn faults, by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its sentence marks, 3 repeats
    it, 4 makes its role user. Null keys, roles and texts count as one space.
    """
    draw = rows.select("conv_id", "turn", "role", F.coalesce("text", F.lit(" ")).alias("text"), _remainder().alias("draw"))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    copies = F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return draw.where(F.col("draw") != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")
