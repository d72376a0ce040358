"""Conversation repair against a best-first search over edits, role strings spelled out."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from strandline.llm import conversation_repair as R
from strandline.llm import queries as llm


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def faults(rows):
    """First fault of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        if not solid:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows): nodes are taken by cost, then audit, so the first goal is the answer."""
    marks = faults(rows)
    heap = [(0, "", 0, ())]
    done = set()
    while True:
        cost, audit, i, made = heapq.heappop(heap)
        initials = "".join(r[:1] or "-" for r, _ in made)
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", initials):
            return cost, audit, list(made)
        state = (i, initials[-1:] if len(initials) > 1 else initials)
        if state in done or not re.fullmatch(r"(s?(ua)*u?)?", initials):
            continue
        done.add(state)
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 5, audit + "I", i, (*made, (role, ""))))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, made))
            if marks[i] not in ("blank", "duplicate"):
                more = 5 * (marks[i] == "truncated")
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, (*made, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, (*made, (new, text))))


def report(conv, rows):
    """The contract's row of one conversation from its (turn, role, text) in order."""
    marks = Counter(faults([(r, t) for _, r, t in rows]))
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, made = cheapest([(r, t) for _, r, t in rows])
    gaps = min(2**63 - 1, max(turns) - min(turns) + 1 - len(set(turns))) if turns else 0
    return (conv, gaps, marks["blank"], marks["duplicate"], marks["truncated"], illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in made)))


def conversations(count=150):
    rng = random.Random(5)
    out = []
    for c in range(count):
        n = rng.randrange(1, 9)
        for turn in range(n):
            role = rng.choice(["user", "assistant", "system", "tool", "user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = rng.choice(["Yes.", "no", " \n", "", f"t{rng.randrange(9)}!", "é?\t", "long " * 50 + ".", "…"])
            out.append((c, turn + rng.choice([0, 0, 0, 9]) * 10, role, text))
    out = list({(c, t): (c, t, r, x) for c, t, r, x in out}.values())
    return [*out, (None, 3, "user", "Hi."), (None, 4, "assistant", "Ho."), (990, None, "user", None), (991, None, None, "x."), (991, 0, "unknown", "y."), (992, 5, "", "z."), (993, 2**62, "user", "a."), (993, -(2**62) - 9, "user", "b.")]


def damage(rows):
    out = []
    for c, turn, role, text in rows:
        word = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{word(c)}:{word(turn)}".encode()) % 20
        role, text = word(role), word(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        out += [(c, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def expected(rows, ids):
    by = {i: [] for i in ids}
    for c, turn, role, text in rows:
        by[c].append((turn, role, text))
    return [report(c, sorted(x, key=lambda r: (r[0] is not None, r[0] or 0))) for c, x in by.items()]


def test_the_query_is_brute_force(spark, tmp_path):
    rows = conversations()
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    out = llm.queries()["op11_conversation_repair"](spark, str(tmp_path))
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    want = expected(damage(rows), {r[0] for r in rows})
    assert any(x[7] == "" for x in want) and {e for x in want for e in x[7]} == set("DKR")  # an insertion never beats a deletion
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_every_short_signature():
    text = {"k": "ok.", "t": "cut", "b": ""}
    role = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    for n in range(5):
        for kinds in itertools.product([("s", "k"), ("u", "k"), ("a", "k"), ("a", "t"), ("o", "t"), ("u", "b")], repeat=n):
            rows = [(role[r], text[t] and f"{k} {text[t]}") for k, (r, t) in enumerate(kinds)]
            signature = "".join("x" if t == "b" else r.upper() if t == "t" else r for r, t in kinds)
            cost, audit, made = cheapest(rows)
            assert R.Solver(signature).audit() == (cost, audit), signature
            got = [(r, e) for edits, given in R.replayed(signature, audit) for e, r in zip(edits, given, strict=True) if e != "D"] if n else []
            assert "".join(r for r, _ in got) == "".join(r[:1] for r, _ in made)


def test_long_signatures():
    """No recursion limit, the memo takes a few bytes a row."""
    cost, audit = R.Solver("s" + "ua" * 30000).audit()
    assert (cost, audit) == (0, "K" * 60001)
    cost, audit = R.Solver("ux" * 3001 + "a").audit()
    assert cost == 3001 * 2 + 1500 and set(audit) == {"K", "D", "R"}  # every second user row is made an assistant's


def test_operator_keeps_rows_and_roles(spark, monkeypatch):
    monkeypatch.setattr(R, "PIECE", 4)
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), f"{rng.randrange(12)}" + rng.choice([".", ""])) for c in range(6) for t in range(rng.choice([1, 3, 40]))]
    rows += [(7, 1, "user", "same.")] * 50
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn int, role string, text string, c string, at int")
    fixed = R.repair(docs)
    got = {r.conv_id: r for r in fixed.conversations.collect()}
    assert (got[7].duplicate, got[7].n_rows, got[7].audit, got[7].cost) == (49, 50, "D" * 50, 100)
    made: dict = {}
    for r in fixed.rows.orderBy("at", "k").collect():
        made.setdefault(r.conv_id, []).append((r.role, r.text))
    for c in range(6):
        cost, audit, want = cheapest([(r, t) for i, _, r, t in rows if i == c])
        assert (got[c].cost, got[c].audit, made.get(c, [])) == (cost, audit, want)


@pytest.mark.parametrize("rows", [[], [(1, 0, "user", "a.")]])
def test_empty_tables_and_dropped_conversations(spark, tmp_path, rows):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    out = llm.queries()["op11_conversation_repair"](spark, str(tmp_path))
    assert sorted(map(tuple, out.collect())) == sorted(expected(damage(rows), {r[0] for r in rows}))


def test_a_conversation_without_rows_after_damage(spark, tmp_path):
    c = next(c for c in range(999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(c, 0, "user", "a.")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    (row,) = llm.queries()["op11_conversation_repair"](spark, str(tmp_path)).collect()
    assert tuple(row) == (c, 0, 0, 0, 0, 0, 0, "", sha(""))
