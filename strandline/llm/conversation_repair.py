"""Conversation repair: the cheapest edits that give a conversation the roles (s?(ua)+)?, solved once for each distinct signature.

Each row becomes one character, its role's initial and its first fault; a conversation's characters are its signature. Distinct signatures are solved by memoised
recursion over (row, state), the cheapest edits of all conversations are joined back by signature, and the edits are replayed on the rows.
Rows are put in one global order first, over all tasks: a conversation of any length is spread over them, and what meets in one place is a
character a row, as the audit that is asked for is itself.
"""

from __future__ import annotations

import hashlib
from array import array
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import cut, text_batches

SPACE = " \t\n\x0b\x0c\r"
#: Costs of edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Initials of roles (o: any other), and the characters of rows with a fault, in the same order.
ROLES, CUT, REPEATED, BLANK = "suao", "SUAO", "1234", "5678"
#: States of the roles so far: none; a system row; a user row that waits for its answer; whole pairs.
NONE, SYSTEM, ASKED, ANSWERED = range(4)
#: The state after the next user or assistant row.
NEXT = (ASKED, ASKED, ANSWERED, ASKED)
#: Calls that one recursion may nest; rows of a piece of a signature, and of an output batch.
DEPTH, PIECE = 100, 4096
FAR = 1 << 60


class Repair(NamedTuple):
    """conversations: conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit. rows: conv_id, at and k (their order), edit, role, text."""

    conversations: DataFrame
    rows: DataFrame


def kept(state: int, initial: str) -> int | None:
    """The state after a row that keeps its role; None where that role can't stand."""
    if initial == "s":
        return SYSTEM if state == NONE else None
    if initial == "u":
        return ASKED if state != ASKED else None
    return ANSWERED if initial == "a" and state == ASKED else None


class Solver:
    """The cheapest edits of one signature (s, u, a, o; capitals: truncated; x: has to go)."""

    def __init__(self, signature: str):
        self.s, self.n = signature, len(signature)
        self.memo = array("q", [-1]) * (4 * (self.n + 1))
        for i in range(self.n, -1, -DEPTH):  # from the end, so that no recursion nests deeper than DEPTH rows
            self.rest(i, NONE)
            self.rest(i, SYSTEM)
            self.rest(i, ASKED)
            self.rest(i, ANSWERED)

    def row(self, i: int, state: int) -> dict[str, tuple[int, int]]:
        """Edits of row i: cost and next state."""
        c, out = self.s[i], {"D": (DELETE, state)}
        if c != "x":
            more = TRUNCATED if c.isupper() else 0
            after = kept(state, c.lower())
            if after is not None:
                out["K"] = (more, after)
            out["R"] = (more + REROLE, NEXT[state])
        return out

    def step(self, i: int, state: int) -> int:
        """Least cost of rows i and after with no insertion before row i."""
        if i == self.n:
            return 0 if state in (NONE, ANSWERED) else FAR
        return min(cost + self.rest(i + 1, after) for cost, after in self.row(i, state).values())

    def rest(self, i: int, state: int) -> int:
        """Least cost of rows i and after; more than two insertions in a row never pay."""
        at = 4 * i + state
        if self.memo[at] < 0:
            one, two = NEXT[state], NEXT[NEXT[state]]
            self.memo[at] = min(self.step(i, state), INSERT + self.step(i, one), 2 * INSERT + self.step(i, two))
        return self.memo[at]

    def audit(self) -> tuple[int, str]:
        """Least cost, and the ASCII-least initials of edits that have it."""
        i, state, out = 0, NONE, []
        while i < self.n or state not in (NONE, ANSWERED):
            left = self.rest(i, state)
            edits = {e: (cost, i + 1, after) for e, (cost, after) in self.row(i, state).items()} if i < self.n else {}
            edits["I"] = (INSERT, i, NEXT[state])
            edit = min(e for e, (cost, j, after) in edits.items() if cost + self.rest(j, after) == left)
            _, i, state = edits[edit]
            out.append(edit)
        return self.rest(0, NONE), "".join(out)


def replayed(signature: str, audit: str) -> list[tuple[str, str]]:
    """For each row its edits, with those of the insertions before it (the last row: after it, too), and the initials of the roles that they give (-: none)."""
    out, edits, made, i, state = [], "", "", 0, NONE
    for e in audit:
        keeps_system = e == "K" and signature[i] in "sS"
        edits, made = edits + e, made + ("-" if e == "D" else "s" if keeps_system else "u" if NEXT[state] == ASKED else "a")
        if e != "D":
            state = SYSTEM if keeps_system else NEXT[state]
        if e != "I":
            out.append((edits, made))
            edits, made, i = "", "", i + 1
    if edits:
        out[-1] = (out[-1][0] + edits, out[-1][1] + made)
    return out


def solve(batches):
    for batch in batches:
        solved = [Solver(s).audit() for s in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c for c, _ in solved], pa.int64()), pa.array([a for _, a in solved], pa.string())], ["signature", "cost", "audit"])


def replay(batches):
    """Edits of each row (at, edits, made) from (pieces, signature, audit) of conversations; the rows of a piece follow one another from its ``at`` on."""
    rows: list[tuple[int, str, str]] = []

    def out():
        batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)], ["at", "edits", "made"])
        rows.clear()
        return batch

    for batch in batches:
        for pieces, signature, audit in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
            places = (p["at"] + k for p in pieces for k in range(p["n"]))
            for at, (edits, made) in zip(places, replayed(signature, audit), strict=True):
                rows.append((at, edits, made))
                if len(rows) >= PIECE:
                    yield out()
    if rows:
        yield out()


def coded(rows: DataFrame) -> DataFrame:
    """(at, c, code) of rows in order (at, c, role, text): one character for the role's initial and the first fault."""
    last = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    blank = last == ""
    role = F.greatest(F.instr(F.lit(ROLES[:3]), F.substring("role", 1, 1)), F.lit(0))
    which = F.when((F.col("role") == "") | (role == 0), F.lit(4)).otherwise(role)
    light = rows.select("at", "c", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), which.alias("which"), blank.alias("blank"), (~blank & ~last.isin(".", "!", "?")).alias("cut"))
    # the first row of each role and text; rows find it by their own place, so no common text meets in one task
    first = light.groupBy("c", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    found = light.join(first, "at", "left")
    alphabet = F.when(F.col("blank"), F.lit(BLANK)).when(F.col("first").isNull(), F.lit(REPEATED)).when(F.col("cut"), F.lit(CUT)).otherwise(F.lit(ROLES))
    return found.select("at", "c", F.substring(alphabet, F.col("which"), F.lit(1)).alias("code"))


def count_of(characters: str) -> Column:
    return (F.length("code") - F.length(F.translate("code", characters, ""))).cast("long")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repair:
    """The cheapest repair of each conversation and its rows after it; see ``Repair``.

    Rows stand by turn (null: first), those of one turn by role and content. Faults, of which a row's first counts: blank (no character but 0x20, 0x09-0x0D), duplicate (role and text of an
    earlier row), truncated (last such character not ``.!?``). Keep costs 0, Rerole to user or assistant 1, Delete 2 (blank and
    duplicate rows have to go), Insert an empty user or assistant row 5; a truncated row that stays costs 5 more. Equal costs: the ASCII-least audit.

    A null role or text counts as one space, rows without conversation are one of their own, roles of another or no initial can't be kept. Repeated rows are duplicates.
    Texts of any length and conversations of any number of rows are taken whole; other columns are not read. No rows give no conversations.
    ``gaps`` is max turn - min turn + 1 - distinct turns (nulls apart; without turns 0; at most the largest long).
    """
    text_batches(rows.sparkSession)
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    base = rows.select(F.col(conv_col).alias("c"), F.col(turn_col).cast("long").alias("turn"), word(role_col).alias("role"), word(text_col).alias("text"))
    # one order of all rows; equal rows are told apart by where they come from, so that a conversation or a row that repeats is spread, too
    keys = ["c", "turn", "role", F.xxhash64("text"), "_from"]
    ordered = cut(base.withColumn("_from", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_from").withColumn("at", F.monotonically_increasing_id()))
    codes = coded(ordered)
    # rows of a piece are neighbours: it is their first place and their number
    pieces = codes.groupBy("c", F.expr(f"at div {PIECE}").alias("piece")).agg(F.min("at").alias("at"), F.count("*").cast("int").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]), "").alias("code"))
    whole = pieces.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("at", "n", "code"))).alias("p"))
    whole = whole.select("c", F.transform("p", lambda x: F.struct(x["at"].alias("at"), x["n"].alias("n"))).alias("pieces"), F.array_join(F.transform("p", lambda x: x["code"]), "").alias("code"))
    signed = whole.withColumn("signature", F.translate("code", REPEATED + BLANK, "x" * 8))
    solved = signed.select("signature").distinct().mapInArrow(solve, "signature string, cost long, audit string")
    audited = cut(signed.join(solved, "signature"))

    initials = F.translate("code", CUT + REPEATED + BLANK, ROLES * 3)
    legal = F.regexp_count(initials, F.lit("s(?=u)|u(?=a)|a(?=u)"))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    gaps = ordered.groupBy("c").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("turns"))
    gaps = gaps.select(F.col("c").alias("_c"), F.least(F.coalesce(wide("high") - wide("low") + 1 - wide("turns"), F.lit(0)), F.lit(2**63 - 1)).cast("long").alias("gaps"))
    conversations = audited.join(gaps, F.col("c").eqNullSafe(F.col("_c"))).select(
        F.col("c").alias(conv_col), F.length("code").cast("long").alias("n_rows"), "gaps", count_of(BLANK).alias("blank"), count_of(REPEATED).alias("duplicate"), count_of(CUT).alias("truncated"),
        (F.length("code") - 1 - legal).cast("long").alias("illegal"), "cost", "audit",
    )

    edits = audited.select("pieces", "signature", "audit").mapInArrow(replay, "at long, edits string, made string")
    each = ordered.join(edits, "at").withColumn("k", F.explode(F.sequence(F.lit(1), F.length("edits"))))
    each = each.select("c", "at", "k", "role", "text", F.substring("edits", F.col("k"), F.lit(1)).alias("edit"), F.substring("made", F.col("k"), F.lit(1)).alias("m")).where("edit <> 'D'")
    given = F.when(F.col("m") == "u", F.lit("user")).otherwise(F.lit("assistant"))
    after = each.select(F.col("c").alias(conv_col), "at", "k", "edit", F.when(F.col("edit") == "K", F.col("role")).otherwise(given).alias(role_col), F.when(F.col("edit") == "I", F.lit("")).otherwise(F.col("text")).alias(text_col))
    return Repair(conversations, after)


def line_digests(rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv_id, repaired_sha256): the hash of each conversation's ``role:text`` lines in order, joined by newlines, line by line as they stream through a task."""

    def digest(batches):
        now, h = (), None
        for batch in batches:
            done = []
            for c, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (c,) == now:
                    h.update(b"\n" + line)
                    continue
                if now:
                    done.append((now[0], h.hexdigest()))
                now, h = (c,), hashlib.sha256(line)
            yield out(done, batch.schema.field(0).type)
        if now:
            yield out([(now[0], h.hexdigest())], None)

    def out(done, kind):
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], kind or pa.int64()), pa.array([x for _, x in done], pa.string())], [conv_col, "repaired_sha256"])

    line = F.concat_ws(":", "role", "text").cast("binary").alias("line")
    placed = rows.repartition(conv_col).sortWithinPartitions(conv_col, "at", "k").select(F.col(conv_col).cast("long"), line)
    return placed.mapInArrow(digest, f"{conv_col} long, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with a fault by crc32(``conv_id:turn``) % 20: 0 dropped, 1 emptied, 2 without ``.!?``, 3 twice, 4 with role user; nulls count as one space."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    twice = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), twice.alias("_copy")).drop("_copy")


def repaired(conversations: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations``, damaged and repaired: counts of faults, cost, audit and the hash of its repaired rows."""
    fixed = repair(damaged(conversations))
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    same = lambda a, b: a["conv_id"].eqNullSafe(b["conv_id"])
    hashes = line_digests(fixed.rows)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = ids.join(fixed.conversations, same(ids, fixed.conversations), "left").select(ids["conv_id"], *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"))
    empty = hashlib.sha256(b"").hexdigest()
    return found.join(hashes, same(found, hashes), "left").select(found["conv_id"], *counts, "audit", F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
