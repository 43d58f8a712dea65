"""Conversation repair against a plain search over all edits."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from weirgate.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, part int, edit string, fault string"
SPACE = " \t\n\v\f\r"
WANTED = {"": "u", "s": "u", "u": "a", "a": "u"}


def plain_repair(rows):
    """(cost, audit, lines) of the cheapest edits; rows hold role, text, fault."""
    best = {}
    for q in WANTED:
        missing, state = [], q
        while state in ("s", "u"):
            state = WANTED[state]
            missing.append({"u": "user:", "a": "assistant:"}[state])
        best[q] = (3 * len(missing), "I" * len(missing), missing)
    for role, text, fault in reversed(rows):
        step = {}
        for q in WANTED:
            options = [(4 + best[q][0], "D" + best[q][1], best[q][2])]
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                i = role[:1]
                if (i == "s" and q == "") or (i == "u" and q != "u") or (i == "a" and q == "u"):
                    c, a, lines = best[i]
                    options.append((c + extra, "K" + a, [f"{role}:{text}", *lines]))
                c, a, lines = best[WANTED[q]]
                name = {"u": "user", "a": "assistant"}[WANTED[q]]
                options.append((c + extra + 3, "R" + a, [f"{name}:{text}", *lines]))
            step[q] = min(options, key=lambda x: x[:2])
        for _ in range(3):
            for q in WANTED:
                c, a, lines = step[WANTED[q]]
                name = {"u": "user:", "a": "assistant:"}[WANTED[q]]
                step[q] = min(step[q], (c + 3, "I" + a, [name, *lines]), key=lambda x: x[:2])
        best = step
    return best[""]


def plain_report(table):
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for c, turn, role, text, *_ in table:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            h = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if h == 0:
                continue
            text = "" if h == 1 else text.translate({ord(x): None for x in ".!?"}) if h == 2 else text
            role = "user" if h == 4 else role
            rows += [(turn, role, text)] * (2 if h == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:64].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        seen, judged = set(), []
        for _, role, text in rows:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        cost, audit, lines = plain_repair(judged)
        turns = [t for t, _, _ in rows if t is not None]
        faults = [f for _, _, f in judged]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def made(rng, convs, most):
    rows = []
    for conv in convs:
        for turn in range(rng.randrange(1, most)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", None, ""])
            text = rng.choice(["Yes.", "No!", "what", "Well? ", "", " \n", None, "a b c.", f"say {rng.random()}."])
            rows.append((conv, rng.choice([turn, turn, turn, turn, None, turn + 3]), role, text, 7, "x", "y"))
    return rows


def test_symbols_against_plain_search():
    rng = random.Random(3)
    names = ["system", "user", "assistant", "tool"]
    for _ in range(2000):
        rows = [(rng.choice(names), "t", rng.choice([None, None, None, "blank", "truncated"])) for _ in range(rng.randrange(14))]
        symbols = np.array(
            [0 if f == "blank" else 1 + 2 * names.index(r) + (f == "truncated") for r, _, f in rows], dtype=np.int64
        )
        letters = list(conversations.solve(symbols))
        cost, audit, _ = plain_repair(rows)
        assert audit.startswith("".join(letters)) and set(audit[len("".join(letters)):]) <= {"I"}
        # Cut anywhere, the maps of the pieces lead to the same vectors and states.
        cut = rng.randrange(len(rows) + 1)
        at, leads = conversations._segment_map(symbols[cut:])
        front = list(conversations.solve(symbols[:cut], vector=at[0]))
        _, before = conversations._segment_map(symbols[:cut])
        back = list(conversations.solve(symbols[cut:], state=before[at[0], 0]))
        assert front + back == letters and leads.shape[1] == 4


def test_report_matches_plain_version(spark, monkeypatch):
    rng = random.Random(8)
    table = made(rng, [*range(60), None], 25) + made(rng, [1000], 700)
    table += [table[5], table[5], table[9], (77, 5, "user", "long " * 90_000 + ".", 1, "e", "f")]
    table += [(88, 3, "user", "same.", 1, "e", "f")] * 40
    wanted = plain_report(table)
    rng.shuffle(table)
    df = spark.createDataFrame(table, SCHEMA)
    assert {tuple(r)[0]: tuple(r)[1:] for r in conversations.repair_report(df).collect()} == wanted
    # Small parts cut the large conversations many times.
    monkeypatch.setattr(conversations, "PART_ROWS", 23)
    monkeypatch.setattr(conversations, "BODY_BYTES", 300)
    assert {tuple(r)[0]: tuple(r)[1:] for r in conversations.repair_report(df).collect()} == wanted


def test_edits_give_legal_roles(spark):
    df = spark.createDataFrame(made(random.Random(2), range(20), 12), SCHEMA)
    edits = conversations.repair(df)
    roles: dict = {}
    for r in edits.where("edit <> 'D'").collect():
        roles.setdefault(r["conv"], []).append(r["role"][0])
    import re

    assert all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in roles.values())


def test_odd_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversations.repair_report(none).count() == 0
    # A conversation whose only row is dropped still has its row.
    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    row = conversations.repair_report(spark.createDataFrame([(1, turn, "user", "a.", 1, "e", "f")], SCHEMA)).first()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", conversations.EMPTY_SHA256)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_matches_plain_version(spark, sf):
    from weirgate.llm.queries import plans

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in plans.queries["op11_conversation_repair"](spark, sf).collect()}
    assert got == plain_report(rows)
