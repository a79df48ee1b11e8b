"""Conversation repair against a plain dynamic programme over whole audits, and that against enumeration."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from seasonmart.llm import conversation_repair as cr
from seasonmart.llm import conversations, ordering
from seasonmart.sources.sinks import Scratch

SCHEMA = "conv_id long, turn long, role string, text string, block string, place string, fault string"


def damage(rows):
    """The damage of the query in plain Python, by conversation."""
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        draw = zlib.crc32(key.encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        row = (turn, "user" if draw == 4 else role, text)
        kept.extend([] if draw == 0 else [row, row] if draw == 3 else [row])
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, *x[1:])) for c, r in found.items()}


def faults(rows):
    seen = set()
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        yield "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))


#: The last role after one more, in sequences that can still become legal.
STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def edits_of(row, fault):
    """Ways to treat a row: letter, cost, role and text that come of it."""
    _, role, text = row
    extra = 5 if fault == "truncated" else 0
    ways = [("D", 2, None)]
    if fault not in ("blank", "duplicate"):
        ways.append(("K", extra, (role, text)))
        ways += [("R", 1 + extra, (new, text)) for new in ("user", "assistant")]
    return ways


def cheapest(rows):
    """(cost, audit, lines): the best way by the states that it ends in, whole audits carried along."""
    best = {"": (0, "", ())}

    def insert(best):
        for _ in range(2):
            for roles, (cost, audit, lines) in list(best.items()):
                for new in ("user", "assistant"):
                    if (end := STEPS.get((roles, new[0]))) is not None:
                        way = (cost + 5, audit + "I", (*lines, f"{new}:"))
                        best[end] = min(best.get(end, way), way)
        return best

    for row, fault in zip(rows, faults(rows)):
        after = {}
        for at, (cost, audit, lines) in insert(dict(best)).items():
            for letter, more, line in edits_of(row, fault):
                end = at if line is None else STEPS.get((at, line[0][:1]))
                if end is not None:
                    way = (cost + more, audit + letter, lines if line is None else (*lines, ":".join(line)))
                    after[end] = min(after.get(end, way), way)
        best = after
    return min(way for end, way in insert(best).items() if end in ("", "a"))


def enumerated(rows):
    """Cost and audit by trying everything, with up to two insertions before each row and at the end."""
    marked, found = list(zip(rows, faults(rows))), []
    for chosen in itertools.product(*(edits_of(r, f) for r, f in marked)):
        for gaps in itertools.product(*([["", "u", "a", "ua", "au"]] * (len(rows) + 1))):
            cost, audit, roles = 0, "", ""
            for gap, (letter, more, line) in zip(gaps, chosen):
                cost, audit, roles = cost + 5 * len(gap) + more, audit + "I" * len(gap) + letter, roles + gap
                roles += "" if line is None else line[0][:1] or "?"
            roles, audit, cost = roles + gaps[-1], audit + "I" * len(gaps[-1]), cost + 5 * len(gaps[-1])
            if re.fullmatch(r"(s?(ua)+)?", roles):
                found.append((cost, audit))
    return min(found)


def expected(rows):
    for conv, kept in damage(rows).items():
        marks, initials = list(faults(kept)), [r[1][:1] for r in kept]
        turns = [r[0] for r in kept if r[0] is not None]
        cost, audit, lines = cheapest(kept)
        yield (
            conv,
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(marks.count(m) for m in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )


def invented(rng, convs, longest):
    rows = []
    for conv in [*range(-3, convs), None]:
        for _ in range(rng.randint(0, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = rng.choice(["So.", "Why?", "no end", " \n", "", None, "Ja!\t\n", "a. b", "x", "😀.", f"{rng.random()}."])
            rows.append((conv, rng.choice([None, *range(longest)]), role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def results(spark, tmp_path, rows):
    path = str(tmp_path)
    frame(spark, rows).write.parquet(f"{path}/conversations.parquet")
    found = conversations.op13_conversation_repair(spark, path)
    assert found.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_programme_by_enumeration():
    rng = random.Random(3)
    for _ in range(60):
        rows = [
            (i, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "", "c!"]))
            for i in range(rng.randint(0, 3))
        ]
        assert cheapest(rows)[:2] == enumerated(rows)


def test_against_plain_programme(spark, tmp_path):
    rows = invented(random.Random(7), 150, 9)
    assert results(spark, tmp_path, rows) == sorted(expected(rows), key=str)


@pytest.mark.parametrize("block", [1, 3, 512])
def test_blocks_do_not_matter(spark, tmp_path, block, monkeypatch):
    """Conversations cut into blocks of any size have the same repairs, also one with most of the rows."""
    for module in (cr, ordering):
        monkeypatch.setattr(module, "BLOCK", block)
    rng = random.Random(11)
    rows = invented(rng, 10, 30) + [
        (5, i, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "no", f"{i}."])) for i in range(700)
    ]
    assert results(spark, tmp_path, rows) == sorted(expected(rows), key=str)


def test_crossings_are_audit_least():
    rng = random.Random(2)
    for _ in range(300):
        kinds = [(rng.choice(["u", "a", "s", "t"]), rng.randrange(4)) for _ in range(rng.randint(1, 12))]
        steps = [*(cr.row_step(*k) for k in kinds), cr.END]
        states = [0, *cr.crossings(steps, 0, 0), 0]
        edits = [cr.letters(*k)[a][b] for k, a, b in zip(kinds, states, states[1:])]
        best = {0: (0, "")}
        for k in kinds:
            after = {}
            for a, (cost, audit) in best.items():
                for b in range(4):
                    if (letters := cr.letters(*k)[a][b]) is not None:
                        way = (cost + cr.row_step(*k)[0][a][b], audit + letters)
                        after[b] = min(after.get(b, way), way)
            best = after
        best = min((c + 5 * len(cr.COMPLETE[s]), a + cr.COMPLETE[s]) for s, (c, a) in best.items())
        assert "".join(edits) + cr.COMPLETE[states[-2]] == best[1], kinds


def test_empty_table_and_long_text(spark, tmp_path):
    assert results(spark, tmp_path / "none", []) == []
    rows = [(1, 0, "user", "long " * 500_000), (1, 1, "assistant", "x" * 3_000_000 + "."), (1, 1, "assistant", "x")]
    assert results(spark, tmp_path / "long", rows) == sorted(expected(rows), key=str)


def test_turns_are_real(spark):
    """Without damage: the repaired turns themselves."""
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Well."), (1, 2, "assistant", "Yes."), (2, 0, "assistant", "A.")]
    with Scratch(spark, "turns") as scratch:
        found = cr.repair(scratch, frame(spark, rows))
        turns = found.turns.orderBy("conv_id", "block", "place", "number").select("conv_id", "role", "text").collect()
        report = {r.conv_id: (r.cost, r.audit) for r in found.report.collect()}
    assert [tuple(t) for t in turns] == [(1, "user", "Well."), (1, "assistant", "Yes.")]
    assert report == {1: (2, "DKK"), 2: (2, "D")}
