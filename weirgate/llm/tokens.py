"""Token counts by compiled finite-state transducers.

Two machines are compiled from the tokenizer file:

* the *splitter*, a deterministic transducer over character classes whose transitions say
  how many pieces begin. A text is cut into chunks; every chunk yields a map from entry
  state to exit state, the maps are composed by a parallel prefix scan, and a second pass
  from the now known entry states writes the emissions. No chunk waits for another.
* the *merger*, a transducer over the bytes of a piece whose transitions carry the change
  in the number of tokens. A state is the longest suffix that begins a vocabulary entry,
  with the last token and relative count at each of its positions; it is determinised as
  it is met. The last token of every prefix is the one entry ending there that keeps its
  boundary with the last token of what lies before it, so counts equal those of the merge
  rules.

Strings of special tokens inside a text are one token each, as the library reads them.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from weirgate.llm.common import map_texts, worker_store

CHUNK = 64
BLOCK = 1 << 19
# Bounds of the worker's memory; a full table is emptied and filled again.
KEPT_PIECES, KEPT_TRANSITIONS = 300_000, 400_000

# Character classes and states of the splitter.
END, LETTER, NUMBER, BLANK, SPACE, OTHER, QUOTE, STMD, RV, E, EL = range(11)
(START, IN_LETTERS, IN_NUMBERS, IN_OTHER, ONE_BLANK, ONE_SPACE, RUN_BLANK, RUN_SPACE, AFTER_QUOTE,
 QUOTE_RV, QUOTE_L, ENDED) = range(12)
# The code points of the Unicode property White_Space.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198,
               8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288]
HERE, BEFORE = 1, 2


def _step(state: int, kind: int) -> tuple[int, int]:
    """(next state, emission): a piece begins at this character, at the one before, or both."""
    letter = kind in (LETTER, STMD, RV, E, EL)
    late = 0
    if state == AFTER_QUOTE:
        if kind == STMD:
            return ENDED, 0
        if kind == RV:
            return QUOTE_RV, 0
        if kind == EL:
            return QUOTE_L, 0
        state = IN_OTHER
    elif state == QUOTE_RV or state == QUOTE_L:
        if kind == (E if state == QUOTE_RV else EL):
            return ENDED, 0
        # No contraction after all: the letter after the quote began a piece.
        late, state = BEFORE, IN_LETTERS
    if kind == END:
        return START, late
    if kind in (BLANK, SPACE):
        if state in (ONE_BLANK, ONE_SPACE, RUN_BLANK, RUN_SPACE):
            return (RUN_BLANK if kind == BLANK else RUN_SPACE), late
        return (ONE_BLANK if kind == BLANK else ONE_SPACE), late | HERE
    # The last character of a run of white space leaves it; a blank goes with what follows.
    if state in (RUN_BLANK, RUN_SPACE):
        late |= BEFORE
    joined = state in (ONE_BLANK, RUN_BLANK)
    if letter:
        return IN_LETTERS, late | (0 if joined or state == IN_LETTERS else HERE)
    if kind == NUMBER:
        return IN_NUMBERS, late | (0 if joined or state == IN_NUMBERS else HERE)
    if kind == QUOTE and not joined and state != IN_OTHER:
        return AFTER_QUOTE, late | HERE
    return IN_OTHER, late | (0 if joined or state == IN_OTHER else HERE)


@lru_cache(maxsize=4)
def letter_classes(path: str) -> bytes:
    """Class of every code point as the library's own splitter for the file sees it, compressed.

    Which characters are letters or numbers depends on the Unicode tables of the library,
    which are not Python's, so it is asked. A block of code points between two letters that
    stays one piece holds letters only; one that is a piece of its own holds none. Other
    blocks are halved, down to single characters; numbers likewise, between two digits.
    """
    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    for kind, lead in ((LETTER, "a"), (NUMBER, "1")):
        # Surrogates are no characters.
        runs = [range(a, a + 256) for a in range(0, 0x110000, 256) if not 0xD800 <= a < 0xE000]
        while runs:
            texts = [f"{lead}{''.join(map(chr, run))}{lead}\n" for run in runs]
            whole = "".join(texts)
            begins = np.zeros(len(whole) + 1, dtype=bool)
            begins[[start for _, (start, _) in cut(whole)]] = True
            before = np.concatenate(([0], np.cumsum(begins)))
            end = np.cumsum([len(t) for t in texts])
            start = end - [len(t) for t in texts]
            # Pieces that begin behind the first lead, up to the second one.
            inside = before[end - 1] - before[start + 1]
            apart = (inside == 2) & begins[start + 1] & begins[end - 2]
            mixed = []
            for run, n, own in zip(runs, inside.tolist(), apart.tolist(), strict=True):
                if n == 0:
                    kinds[run.start : run.stop] = kind
                elif not own and len(run) > 1:
                    middle = run.start + len(run) // 2
                    mixed += [range(run.start, middle), range(middle, run.stop)]
            runs = mixed
    return zlib.compress(kinds.tobytes())


class Splitter:
    """The compiled splitter: class of every code point, transitions, emissions."""

    def __init__(self, classes: bytes) -> None:
        kinds = np.frombuffer(zlib.decompress(classes), dtype=np.uint8).copy()
        kinds[WHITE_SPACE] = SPACE
        kinds[32] = BLANK
        for kind, characters in ((QUOTE, "'"), (STMD, "stmd"), (RV, "rv"), (E, "e"), (EL, "l")):
            kinds[[ord(c) for c in characters]] = kind
        self.kinds = kinds
        # State and class share a byte (state * 16 + class), so that a step of all chunks at
        # once is one table lookup over bytes.
        following, emission = bytearray(256), bytearray(256)
        for state in range(12):
            for kind in range(11):
                to, emitted = _step(state, kind)
                following[state << 4 | kind], emission[state << 4 | kind] = to << 4, emitted
        self.next, self.emit = bytes(following), bytes(emission)

    def begins(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where pieces begin; ``ends`` are the positions of end marks between texts."""
        found = np.zeros(len(codes) + 1, dtype=bool)
        entry = START
        for at in range(0, len(codes), BLOCK):
            kinds = self.kinds[codes[at : at + BLOCK]]
            inside = ends[np.searchsorted(ends, at) : np.searchsorted(ends, at + BLOCK)] - at
            kinds[inside] = END
            rows = -(-len(kinds) // CHUNK)
            steps = np.full((rows, CHUNK), END, dtype=np.uint8)
            steps.reshape(-1)[: len(kinds)] = kinds
            steps = np.ascontiguousarray(steps.T)
            entries, last = self._entries(steps, entry)
            state = entries
            emitted = np.empty((CHUNK, rows), dtype=np.uint8)
            for i in range(CHUNK):
                both = (state | steps[i]).tobytes()
                emitted[i] = np.frombuffer(both.translate(self.emit), dtype=np.uint8)
                state = np.frombuffer(both.translate(self.next), dtype=np.uint8)
            emitted = emitted.T.reshape(-1)[: len(kinds)]
            found[at : at + len(kinds)] |= (emitted & HERE) > 0
            late = np.flatnonzero(emitted & BEFORE) + at - 1
            found[late] = True
            entry = last
        return found[:-1]

    def _entries(self, steps: np.ndarray, entry: int) -> tuple[np.ndarray, int]:
        """Entry state of every chunk: chunk maps composed by a doubling prefix scan."""
        rows = steps.shape[1]
        maps = np.repeat(np.arange(12, dtype=np.uint8)[:, None] << 4, rows, axis=1)
        for column in steps:
            maps = np.frombuffer((maps | column).tobytes().translate(self.next), dtype=np.uint8)
            maps = maps.reshape(12, rows)
        maps = maps.T >> 4
        reach = 1
        while reach < rows:
            maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
            reach *= 2
        entries = np.empty(rows, dtype=np.uint8)
        entries[0] = entry << 4
        entries[1:] = maps[:-1, entry] << 4
        return entries, int(maps[-1, entry])


def _byte_letters() -> dict[str, int]:
    """Letter that stands for each byte in the vocabulary file: printable Latin-1 stands for
    itself, the rest follows from 256 upwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merger:
    """Lazily determinised transducer from the bytes of a piece to its number of tokens."""

    def __init__(self, model: dict) -> None:
        letters = _byte_letters()
        self.ids = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()
                    if all(c in letters for c in token)}
        self.names = {i: token for token, i in self.ids.items()}
        self.ranks = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            key = bytes(letters[c] for c in a), bytes(letters[c] for c in b)
            self.ranks.setdefault(key, rank)
        self.prefixes = {token[:n] for token in self.ids for n in range(len(token) + 1)}
        self.fits: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        self.states = [(b"", (-1,), (0,))]
        self.numbers = {self.states[0]: 0}
        self.moves: dict[int, int] = {}

    def merged(self, data: bytes) -> list[bytes]:
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.ranks.get(pair, 1 << 60) for pair in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def keeps(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > KEPT_TRANSITIONS:
                self.fits.clear()
            a, b = self.names[left], self.names[right]
            known = self.fits[left, right] = self.merged(a + b) == [a, b]
        return known

    def build(self, state: int, byte: int) -> int:
        node, lasts, counts = self.states[state]
        window = node + bytes((byte,))
        for k in range(len(window)):
            token = self.ids.get(window[k:])
            if token is not None and (lasts[k] < 0 or self.keeps(lasts[k], token)):
                break
        else:
            raise ValueError("a byte is not in the vocabulary")
        change = counts[k] + 1
        while window not in self.prefixes:
            window = window[1:]
        kept = len(window) + 1
        following = (
            window,
            (*lasts, token)[-kept:],
            (*(c - change for c in counts), 0)[-kept:],
        )
        number = self.numbers.get(following)
        if number is None:
            number = self.numbers[following] = len(self.states)
            self.states.append(following)
        move = self.moves[state << 8 | byte] = number << 16 | (change + 32768)
        return move

    def count(self, piece: bytes) -> int:
        if len(self.moves) > KEPT_TRANSITIONS:
            self.clear()
        moves, state, total = self.moves, 0, 0
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self.build(state, byte)
            total += (move & 65535) - 32768
            state = move >> 16
        return total


class PieceCounts(dict):
    """Tokens of each piece met so far."""

    def __init__(self, merger: Merger) -> None:
        self.merger = merger

    def __missing__(self, piece: str) -> int:
        if len(self) >= KEPT_PIECES:
            self.clear()
        n = self[piece] = self.merger.count(piece.encode())
        return n


class Compiled:
    """Splitter and merger of one tokenizer file."""

    def __init__(self, path: str, classes: bytes) -> None:
        with open(path, encoding="utf-8") as file:
            source = json.load(file)
        if source["model"]["type"] != "BPE" or source["pre_tokenizer"]["type"] != "ByteLevel" or source["normalizer"]:
            raise ValueError("only plain byte-level BPE files can be compiled")
        special = [t["content"] for t in source["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.splitter = Splitter(classes)
        self.pieces = PieceCounts(Merger(source["model"]))

    def counts(self, texts: list[str]) -> np.ndarray:
        parts, owners, extra = [], [], np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            between = self.special.split(text) if self.special and self.special.search(text) else [text]
            extra[i] = len(between) - 1
            parts += between
            owners += [i] * len(between)
        joined = "\0".join([*parts, ""])
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        begins = self.splitter.begins(codes, ends)
        begins[ends] = False
        starts = np.flatnonzero(begins)
        marks = begins.copy()
        marks[ends] = True
        stops = np.flatnonzero(marks)
        stops = stops[np.searchsorted(stops, starts, side="right")]
        known = self.pieces
        each = np.fromiter(
            (known[joined[a:b]] for a, b in zip(starts.tolist(), stops.tolist())), np.int64, len(starts)
        )
        before = np.concatenate(([0], np.cumsum(each)))
        edge = np.searchsorted(starts, ends)
        per_part = np.diff(before[np.concatenate(([0], edge))])
        return extra + np.bincount(owners, weights=per_part, minlength=len(texts)).astype(np.int64)


def compiled(path: str, classes: bytes | None = None) -> Compiled:
    store = worker_store()
    if ("compiled", path) not in store:
        store["compiled", path] = Compiled(path, classes or letter_classes(path))
    return store["compiled", path]


def token_counts(
    df: DataFrame, vocabulary: str, text: str = "text", limit: int = 1024, keep: list[str] | None = None
) -> DataFrame:
    """``keep`` columns (default: all) with n_bytes, n_tokens and over_limit of each text.

    ``vocabulary`` is the path of a byte-level BPE ``.json`` file present on every worker.
    Null counts as empty: 0 bytes, 0 tokens. Very long texts are counted whole. Repeated rows
    stay; each row is counted by itself, whatever its other columns hold. Extra columns pass through, save those named
    like an added one. An empty table gives an empty table.
    """
    # Found once, on the driver: a few kilobytes for every task.
    classes = letter_classes(vocabulary)

    def make():
        machine = compiled(vocabulary, classes)

        def run(texts: list[str]) -> list:
            counts = machine.counts(texts)
            return [[len(t.encode()) for t in texts], counts, counts > limit]

        return run

    return map_texts(df, text, make, "n_bytes long, n_tokens long, over_limit boolean", keep)
