"""Repair of conversation structure: cheapest edits, traced over blocks of symbols.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``. Each row gets
its first fault (blank, duplicate, truncated) and a symbol of nine: must go, or one of four
kinds of role, whole or truncated. The cost vector at a place says what each state of the
pattern (start, after s, after u, after a) still has to pay to the end. Less its smallest
entry, such a vector takes few values, so the Four-Russians tables hold, for each vector and
each block of ``BLOCK`` symbols, the vector before the block and what it costs. A
conversation is solved from its end by lookups, one per block. The blocks are then expanded
backward, row by row, and the trace through them is read forward, taking the ASCII-least
letter that keeps to the cheapest cost; so ties need no search.

Rows are dealt by range of (conversation, place), so one conversation of any size lies in
neighbouring parts. Of a part only its first and last conversation can reach into other
parts; for these the part gives a map from every vector at its end to the vector at its
start, and to where each state leads. The maps, two for a part at most, are composed in
order, which tells every part the vector behind it and the state before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from weirgate.llm.common import sized_side
from weirgate.session import cut_lineage

SPACE = " \t\n\v\f\r"
DELETE, CHANGE, INSERT, UNMENDED = 4, 3, 3, 3
BLOCK = 3
GONE = 0  # the symbol of rows that must be deleted; 1 to 8: kind of role and truncation
SYMBOLS = 9
OTHER = 3  # kinds of role: 0 system, 1 user, 2 assistant
# States: 0 start, 1 after the system row, 2 after a user row, 3 after an assistant row.
STATES = 4
EXPECTED = (2, 2, 3, 2)  # the state after the row that the pattern wants next
FAR = 10**6
BODY_BYTES = 1 << 18
# A part, and so the rows of one conversation that a task holds, has about this size.
PART_ROWS, PART_CHARS = 20_000, 1 << 24
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _after(state: int, kind: int) -> int | None:
    """The state after keeping a row of this kind, if the pattern allows it."""
    if kind == 0:
        return 1 if state == 0 else None
    if kind == 1:
        return 2 if state != 2 else None
    return 3 if kind == 2 and state == 2 else None


def _closed(costs: list[int]) -> tuple[int, ...]:
    """Costs when rows may still be inserted first."""
    costs = list(costs)
    for _ in range(2):
        costs = [min(c, INSERT + costs[EXPECTED[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def _choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that consume a row."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        kind, broken = divmod(symbol - 1, 2)
        extra = UNMENDED * broken
        to = _after(state, kind)
        if to is not None:
            out.append(("K", extra, to))
        out.append(("R", CHANGE + extra, EXPECTED[state]))
    return out


def _before(costs: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    return _closed([min(c + costs[q] for _, c, q in _choices(symbol, state)) for state in range(STATES)])


def _letters(costs: tuple[int, ...], symbol: int, state: int) -> tuple[str, int]:
    """ASCII-least cheapest edits up to and with this row, and the state after it."""
    here = _before(costs, symbol)
    out = ""
    while True:
        steps = {letter: q for letter, c, q in _choices(symbol, state) if c + costs[q] == here[state]}
        if "D" in steps:
            return out + "D", steps["D"]
        if INSERT + here[EXPECTED[state]] == here[state]:
            out, state = out + "I", EXPECTED[state]
        elif "K" in steps:
            return out + "K", steps["K"]
        else:
            return out + "R", steps["R"]


@dataclass(frozen=True)
class Tables:
    """Transitions of normalised cost vectors; vectors are numbered, 0 is that of the end."""

    vectors: np.ndarray  # (V, STATES)
    one: np.ndarray  # (V, SYMBOLS): the vector before a symbol
    one_cost: np.ndarray
    block: np.ndarray  # (V, SYMBOLS ** BLOCK): the vector before a block
    block_cost: np.ndarray
    letters: list  # [V][SYMBOLS][STATES]: edits and next state
    leads: np.ndarray  # (V, SYMBOLS, STATES): next state
    tail: list  # [STATES]: rows inserted at the end

    def block_code(self, symbols: np.ndarray) -> np.ndarray:
        """One number for each whole block, the first symbol being the highest digit."""
        code = np.zeros(len(symbols) // BLOCK, dtype=np.int64)
        for i in range(BLOCK):
            code = code * SYMBOLS + symbols[i : len(code) * BLOCK : BLOCK]
        return code


@lru_cache(maxsize=1)
def tables() -> Tables:
    """The vectors that can occur, found from the end vector, and their block tables."""
    end = _closed([0, FAR, FAR, 0])
    numbers, vectors, one, one_cost = {end: 0}, [end], [], []
    for vector in vectors:  # grows while new vectors turn up
        row, cost = [], []
        for symbol in range(SYMBOLS):
            before = _before(vector, symbol)
            low = min(before)
            normal = tuple(c - low for c in before)
            if normal not in numbers:
                numbers[normal] = len(vectors)
                vectors.append(normal)
            row.append(numbers[normal])
            cost.append(low)
        one.append(row)
        one_cost.append(cost)
    step, paid = np.array(one), np.array(one_cost)
    count = len(vectors)
    block = np.empty((count, SYMBOLS**BLOCK), dtype=np.int64)
    block_cost = np.empty_like(block)
    for code, word in enumerate(product(range(SYMBOLS), repeat=BLOCK)):
        at, cost = np.arange(count), np.zeros(count, dtype=np.int64)
        for symbol in reversed(word):
            cost = cost + paid[at, symbol]
            at = step[at, symbol]
        block[:, code], block_cost[:, code] = at, cost
    letters = [[[_letters(v, s, q) for q in range(STATES)] for s in range(SYMBOLS)] for v in vectors]
    leads = np.array([[[x[1] for x in by_state] for by_state in rows] for rows in letters])
    tail = []
    for state in range(STATES):
        missing = ""
        while state not in (0, 3):
            missing, state = missing + "I", EXPECTED[state]
        tail.append(missing)
    return Tables(np.array(vectors), step, paid, block, block_cost, letters, leads, tail)


def _suffix_vectors(symbols: np.ndarray, vector: int) -> list[int]:
    """The vector behind every row: block by block from the end, then inside each block."""
    t = tables()
    codes = t.block_code(symbols).tolist()
    behind = [0] * len(symbols)
    for i in range(len(symbols) - 1, len(codes) * BLOCK - 1, -1):  # what fills no block
        behind[i] = vector
        vector = int(t.one[vector, symbols[i]])
    edges = [0] * len(codes)
    for b in range(len(codes) - 1, -1, -1):
        edges[b] = vector
        vector = int(t.block[vector, codes[b]])
    # Blocks are expanded backward from the vector behind them, all blocks at once.
    if codes:
        at = np.array(edges)
        whole = symbols[: len(codes) * BLOCK].reshape(-1, BLOCK)
        rows = np.empty((len(codes), BLOCK), dtype=np.int64)
        for i in range(BLOCK - 1, -1, -1):
            rows[:, i] = at
            at = t.one[at, whole[:, i]]
        behind[: len(codes) * BLOCK] = rows.reshape(-1).tolist()
    return behind


def solve(symbols: np.ndarray, vector: int = 0, state: int = 0) -> Iterator[str]:
    """For every row the letters of its edit, inserted rows before it included."""
    t = tables()
    for symbol, v in zip(symbols.tolist(), _suffix_vectors(symbols, vector), strict=True):
        text, state = t.letters[v][symbol][state]
        yield text


def _segment_map(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every vector behind the rows: the vector before them, and where each state leads."""
    t = tables()
    at = np.arange(len(t.vectors))
    leads = np.tile(np.arange(STATES), (len(at), 1))
    for symbol in symbols[::-1].tolist():
        leads = leads[np.arange(len(at))[:, None], t.leads[at, symbol]]
        at = t.one[at, symbol]
    return at, leads


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows as given (nulls: one space) with the planted faults of crc32(``conv:turn``) % 20:
    0 drops the row, 1 empties its text, 2 takes its ``.!?`` out, 3 repeats it, 4 makes it the user's.
    """
    name, place = cleaned(F.col(f"`{conv}`")), cleaned(F.col(f"`{turn}`"))
    number = F.crc32(F.concat(name, F.lit(":"), place).cast("binary")) % 20
    plain = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        cleaned(F.col(f"`{role}`")).alias("role"), cleaned(F.col(f"`{text}`")).alias("text"), number.alias("_h"),
    )
    kept = plain.where(F.col("_h") != 0).withColumns({
        "text": F.when(F.col("_h") == 1, "").when(F.col("_h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(F.col("_h") == 4, "user").otherwise(F.col("role")),
        "_copy": F.explode(F.when(F.col("_h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
    })
    return kept.select(F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role), F.col("text").alias(text))


def cleaned(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(" "))


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows of (conv, turn, role, text) with ``fault``, ``symbol`` and an order.

    Rows of one turn stand by role, first 64 characters and md5 of the text; equal rows are
    told apart by a number of the scan, which keeps their order when a task is run again. A
    row is a duplicate if an equal role and text stands earlier in the conversation. Only
    the pairs (conversation, text) that occur twice are joined back, without their texts.
    """
    said = F.concat_ws(":", F.length("role").cast("string"), F.col("role"), F.col("text"))
    owner = F.concat(F.when(F.col("conv").isNull(), "n").otherwise("c"), F.coalesce(F.col("conv").cast("string"), F.lit("")))
    placed = rows.select(
        "*",
        F.substring("text", 1, 64).alias("_prefix"),
        F.md5(F.col("text").cast("binary")).alias("_digest"),
        F.md5(F.concat(F.length(owner).cast("string"), F.lit(":"), owner, said).cast("binary")).alias("_same"),
        F.struct(F.col("turn").isNotNull().alias("a"), F.col("turn").alias("b"), F.monotonically_increasing_id().alias("c")).alias("_place"),
    )
    first = sized_side(
        placed.groupBy("_same").agg(F.min("_place").alias("_first"), F.count("*").alias("n"))
        .where("n > 1").select("_same", "_first"),
        F.lit(72),
    )
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    kind = (
        F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1)
        .when(F.col("role").startswith("a"), 2).otherwise(OTHER)
    )
    fault = (
        F.when(bare == "", "blank")
        .when(F.col("_place") > F.col("_first"), "duplicate")
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
    )
    symbol = F.when(fault.isin("blank", "duplicate"), GONE).otherwise(
        1 + 2 * kind + F.when(fault == "truncated", 1).otherwise(0)
    )
    return placed.join(first, "_same", "left").withColumns({"fault": fault, "symbol": symbol.cast("int")})


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows sorted inside parts that follow each other; written once, so parts stay as they are."""
    keys = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("_prefix"), F.col("_digest"), F.col("_place")]
    size = rows.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    parts = max(1, size["n"] // PART_ROWS, (size["chars"] or 0) // PART_CHARS)
    dealt = rows.repartitionByRange(int(parts), *keys).sortWithinPartitions(*keys)
    return cut_lineage(
        dealt.select("conv", "turn", "role", "text", "fault", "symbol", F.spark_partition_id().alias("part"))
    )


def _by_conversation(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Stretches of one conversation in sorted rows, across batches."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns], strict=True)

    return groupby(rows(), key=lambda r: r[0])


def _edges(ordered: DataFrame) -> list[tuple[int, int, int, int, bool]]:
    """For parts whose first or last conversation is shared with another part: (part, 0 for
    the first conversation or 1 for the last, vector behind, state before, more to come).

    Maps of at most two conversations a part are composed; the rows returned are as few.
    """
    schema = "conv_part int, last int, alone boolean, conv string, at array<int>, leads array<int>"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, groups, first, last = None, 0, None, None
        for conv, rows in _by_conversation(batches, ["conv", "part", "symbol"]):
            symbols = []
            for _, part, symbol in rows:
                symbols.append(symbol)
            last = conv, np.array(symbols)
            first = first or last
            groups += 1
        if not groups:
            return
        for which, (conv, symbols) in enumerate((first, last) if groups > 1 else (first,)):
            at, leads = _segment_map(symbols)
            row = [part, which, groups == 1, None if conv is None else str(conv), at.tolist(), leads.reshape(-1).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, arrow, strict=True)], schema=arrow)

    found = ordered.select("conv", "part", "symbol").mapInArrow(work, schema)
    # At most two rows a part, however many rows a part has.
    segments = sorted(found.collect(), key=lambda r: (r["conv_part"], r["last"]))
    out = []
    for _, run in groupby(segments, key=lambda r: r["conv"]):
        run = list(run)
        if len({r["conv_part"] for r in run}) < 2:
            continue
        count = len(tables().vectors)
        behind, vector = [], 0
        for r in reversed(run):
            behind.append(vector)
            vector = r["at"][vector]
        behind.reverse()
        state = 0
        for i, (r, v) in enumerate(zip(run, behind, strict=True)):
            out.append((r["conv_part"], r["last"], v, state, i + 1 < len(run)))
            state = np.array(r["leads"]).reshape(count, STATES)[v, state]
    return [tuple(map(int, x)) for x in out]


EDITS = "conv {0}, part int, more boolean, split boolean, turn {1}, edit string, fault string, cost int, was string, role string, text string"


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Cheapest edits that make every conversation read ``(s?(ua)+)?``, one row for each edit.

    Edits: K keep, D delete (4; required for blank rows and duplicates), R change of role to
    user or assistant (3), I insertion of an empty user or assistant row (3); a truncated row
    that stays adds 3. Among the cheapest the letters that read least in ASCII are taken.

    Columns: conv, part, turn, edit, fault, cost, ``was`` (role before), role and text after
    (null for D); ``split`` says that the conversation lies in several parts, ``more`` that
    it goes on in the next one. Rows come in order inside a part, parts in order. Null role
    or text count as one space; a null turn stands first, a null conversation is one of its
    own; repeated rows are duplicates of the first; only the initial of a role counts, any
    but s, u, a (an empty role too) can be deleted or changed only. Very long texts pass
    through whole; an empty table gives an empty one. Other columns do not take part.
    """
    plain = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        cleaned(F.col(f"`{role}`")).alias("role"), cleaned(F.col(f"`{text}`")).alias("text"),
    )
    ordered = _ordered(with_faults(plain))
    known = {(p, w): (v, q, more) for p, w, v, q, more in _edges(ordered)}
    types = dict(ordered.dtypes)
    schema = T.StructType.fromDDL(EDITS.format(types["conv"], types["turn"]))
    arrow = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables()
        fields = ["conv", "turn", "role", "text", "fault", "symbol", "part"]
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)
            held, size = [], 0
            return out

        # The last group of a part is known only when the next one fails to come.
        groups = ((c, list(g)) for c, g in _by_conversation(batches, fields))
        at_first, current = True, next(groups, None)
        while current is not None:
            following = next(groups, None)
            conv, members = current
            part = members[0][6]
            place = None
            if at_first:
                place = known.get((part, 0))
            if following is None and not (at_first and place):
                place = known.get((part, 1)) or place
            vector, state, more = place or (0, 0, 0)
            symbols = np.array([m[5] for m in members])
            for m, letters in zip(members, solve(symbols, vector, state), strict=True):
                for letter in letters[:-1]:
                    state = EXPECTED[state]
                    held.append((conv, part, bool(more), place is not None, None, letter, None, INSERT, None, "user" if state == 2 else "assistant", ""))
                edit, extra = letters[-1], UNMENDED * (m[4] == "truncated")
                role_now, text_now, cost = m[2], m[3], extra
                if edit == "D":
                    role_now, text_now, cost = None, None, DELETE
                elif edit == "R":
                    state = EXPECTED[state]
                    role_now, cost = "user" if state == 2 else "assistant", CHANGE + extra
                else:
                    state = _after(state, (m[5] - 1) // 2)
                held.append((conv, part, bool(more), place is not None, m[1], edit, m[4], cost, m[2], role_now, text_now))
                size += len(m[3]) + 64
                if size > BODY_BYTES:
                    yield flush()
            if not more:
                for _ in t.tail[state]:
                    state = EXPECTED[state]
                    held.append((conv, part, False, place is not None, None, "I", None, INSERT, None, "user" if state == 2 else "assistant", ""))
            at_first, current = False, following
        if held:
            yield flush()

    return ordered.mapInArrow(work, schema)


PIECE = (
    "conv {0}, part int, piece int, split boolean, blank bigint, duplicate bigint, truncated bigint, cost bigint, "
    "audit string, initials string, first_turn {1}, last_turn {1}, turns bigint, body binary"
)
REPORT = (
    "conv {0}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
FAULTS = ("blank", "duplicate", "truncated")
LEGAL = frozenset(("su", "ua", "au"))


class _Sum:
    """What the pieces of one conversation, taken in order, add up to."""

    def __init__(self) -> None:
        self.counts = [0, 0, 0, 0]
        self.audit: list[str] = []
        self.illegal = self.turns = 0
        self.initial = self.first = self.last = None
        self.hash, self.began = hashlib.sha256(), False

    def add(self, counts, audit, initials, first, last, turns, body) -> None:
        self.counts = [a + b for a, b in zip(self.counts, counts, strict=True)]
        self.audit.append(audit)
        pairs = ([self.initial] if self.initial is not None else []) + list(initials)
        self.illegal += sum(a + b not in LEGAL for a, b in zip(pairs, pairs[1:]))
        self.initial = pairs[-1] if pairs else None
        if first is not None:
            self.turns += turns - (self.last == first)
            self.first = first if self.first is None else self.first
            self.last = last
        if body is not None:
            self.hash.update(b"\n" + body if self.began else body)
            self.began = True

    def row(self) -> list:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return [gaps, *self.counts[:3], self.illegal, self.counts[3], "".join(self.audit), self.hash.hexdigest()]


def _piece(rows: list[tuple]) -> tuple:
    """Counts, audit, initials before the repair, turns and body of some edits in order."""
    faults = [r[3] for r in rows]
    turns = [r[1] for r in rows if r[1] is not None]
    lines = [f"{r[6]}:{r[7]}" for r in rows if r[6] is not None]
    return (
        [*(faults.count(f) for f in FAULTS), sum(r[4] for r in rows)],
        "".join(r[2] for r in rows),
        # An empty role has no initial; it stands as one that no pair allows.
        "".join(r[5][:1] or " " for r in rows if r[5] is not None),
        turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)),
        "\n".join(lines).encode() if lines else None,
    )


def report(edits: DataFrame) -> DataFrame:
    """One row for each conversation of :func:`repair`: faults, cost, audit and sha256 of the
    repaired ``role:text`` lines.

    A conversation inside one part is summed up where it lies. Of one in several parts, pieces
    of bounded size go to one task in order, which passes them through the hash and keeps
    none: a sha256 can only be taken from the first byte to the last.
    """
    types = dict(edits.dtypes)
    columns = ["conv", "turn", "edit", "fault", "cost", "was", "role", "text", "part", "split"]
    piece_schema = T.StructType.fromDDL(PIECE.format(types["conv"], types["turn"]))
    final_schema = T.StructType.fromDDL(REPORT.format(types["conv"]))
    both = T.StructType([*piece_schema.fields, *final_schema.fields[1:2], *[final_schema["illegal"], final_schema["repaired_sha256"]]])
    arrow, final_arrow = to_arrow_schema(both), to_arrow_schema(final_schema)

    def batch_of(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def pieces(rows: Iterator[tuple]) -> Iterator[tuple[tuple, list[tuple]]]:
        held, size = [], 0
        for r in rows:
            held.append(r)
            size += len(r[7] or "") + 16
            if size > BODY_BYTES:
                yield held
                held, size = [], 0
        if held:
            yield held

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = []
        for conv, rows in _by_conversation(batches, columns):
            total = None
            for number, held in enumerate(pieces(rows)):
                part, split = held[0][8:]
                counts, audit, initials, first, last, turns, body = _piece(held)
                if split:
                    out.append([conv, part, number, True, *counts, audit, initials, first, last, turns, body, None, None, None])
                    if sum(len(r[13] or b"") for r in out) > BODY_BYTES:
                        yield batch_of(out, arrow)
                        out = []
                    continue
                total = total or _Sum()
                total.add(counts, audit, initials, first, last, turns, body)
            if total:
                gaps, blank, duplicate, truncated, illegal, cost, audit, digest = total.row()
                out.append([conv, part, 0, False, blank, duplicate, truncated, cost, audit, None, None, None, None, None, gaps, illegal, digest])
            if len(out) >= 1000:
                yield batch_of(out, arrow)
                out = []
        if out:
            yield batch_of(out, arrow)

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "blank", "duplicate", "truncated", "cost", "audit", "initials", "first_turn", "last_turn", "turns", "body"]
        for conv, rows in _by_conversation(batches, names):
            total = _Sum()
            for r in rows:
                total.add(r[1:5], *r[5:])
            yield batch_of([[conv, *total.row()]], final_arrow)

    found = cut_lineage(edits.select(*columns).mapInArrow(first_pass, both))
    whole = found.where(~F.col("split")).select(*final_schema.names)
    order = [F.col("conv").asc_nulls_first(), "part", "piece"]
    spread = found.where("split").select(*piece_schema.names).repartition("conv").sortWithinPartitions(*order)
    return whole.union(spread.mapInArrow(second_pass, final_schema))


def repair_report(conversations: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Report on the damaged conversations, one row for every conversation given.

    A conversation of which no row is left has zeros, an empty audit and the empty string's
    sha256; so an empty table gives an empty report.
    """
    found = report(repair(damaged(conversations, conv=conv), conv=conv))
    given = conversations.select(F.col(f"`{conv}`").alias("_w_conv")).distinct()
    joined = given.join(found, F.col("_w_conv").eqNullSafe(F.col("conv")), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *FAULTS, "illegal", "cost")]
    return joined.select(
        F.col("_w_conv").alias(conv), *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )
