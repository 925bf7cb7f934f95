"""Repair of conversation structure by cheapest edits, streamed.

A conversation's roles should read ``(s?(ua)+)?``: nothing, or one optional
system turn and then user and assistant in turn (by the roles' initials). Edits
of a row in order: Keep (0), Rerole to user or assistant (3), Delete (4, the
only one for blank and duplicate rows); Insert (3) puts an empty user or
assistant row anywhere; a truncated row that stays costs 3 more. Of the
cheapest edit lists the one whose initials are least in ASCII is taken.

At any place the template allows one insertion and one new role, so a state of
four (nothing, system, user or assistant was last) and an edit give one next
state. Costs to the end are computed from the last row to the first, in a
stream of rows sorted backwards; their differences between states are few, so a
step is a look-up. For each row one byte, the least initial of a cheapest edit
in each state, is the back pointer; pointers leave the task in blocks, as rows
of a stored table, so a conversation of any length takes a block of memory. A
second stream, forwards, meets each block before the rows it is for, follows
the pointers and gives the edits. Rows are shuffled by conversation and sorted
by place; no conversation is collected.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from io import StringIO

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridewise.llm.common import small_arrow_batches, stage

SPACE = " \t\n\x0b\x0c\r"
#: Rows whose pointers go into one block.
BLOCK = 1 << 16
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: States: what the repaired roles end with so far.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: The role that may be inserted or given in a state, as the state after it.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: Costs to the end behind the last row: insertions until the roles may end.
AT_END = (0, 2 * INSERT, INSERT, 0)
#: Edits by initial; a pointer holds their index, two bits a state.
EDITS = "DIKR"
MUST_GO = ("blank", "duplicate")


@lru_cache(maxsize=1 << 16)
def back_step(after: tuple[int, int, int, int], initial: str, fault: str | None) -> tuple[tuple[int, int, int, int], int, int]:
    """(costs relative to their least, that least, pointer byte) before a row, from the costs after it."""
    more = TRUNCATED if fault == "truncated" else 0
    taken = []
    for state in range(4):
        ways = [(DELETE + after[state], 0)]
        if fault not in MUST_GO:
            if initial in KEPT[state]:
                ways.append((more + after[KEPT[state][initial]], 2))
            ways.append((REROLE + more + after[NEXT[state]], 3))
        taken.append(min(ways))
    # two insertions in a row lead from user to user and from assistant to assistant, so one is enough there
    costs = [0] * 4
    costs[USER] = min(taken[USER][0], INSERT + taken[ASSISTANT][0])
    costs[ASSISTANT] = min(taken[ASSISTANT][0], INSERT + taken[USER][0])
    for state in (EMPTY, SYSTEM):
        costs[state] = min(taken[state][0], INSERT + costs[USER])
    pointer = 0
    for state in range(4):
        cost, edit = taken[state]
        if INSERT + costs[NEXT[state]] == costs[state]:
            edit = min(edit, 1) if cost == costs[state] else 1
        pointer |= edit << 2 * state
    least = min(costs)
    return tuple(c - least for c in costs), least, pointer


_POINTERS = "conv string, pos long, pointers binary"


def _pointer_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of pointers from rows (conv, pos, initial, fault), each conversation's last row first."""
    conv, low, after, held = None, 0, AT_END, bytearray()
    for frame in frames:
        out = []
        for c, p, initial, fault in zip(*(frame[k].tolist() for k in ("conv", "pos", "initial", "fault"))):
            if c != conv or len(held) == BLOCK:
                if held:
                    out.append((conv, low, bytes(reversed(held))))
                    held = bytearray()
                if c != conv:
                    conv, after = c, AT_END
            after, _, pointer = back_step(after, initial, fault)
            held.append(pointer)
            low = p
        yield pd.DataFrame(out, columns=["conv", "pos", "pointers"])
    if held:
        yield pd.DataFrame([(conv, low, bytes(reversed(held)))], columns=["conv", "pos", "pointers"])


_EDITS = "conv string, step long, edit string, cost long, turn string, role string, text string, role_before string, fault string"
_EDIT_COLUMNS = [c.split()[0] for c in _EDITS.split(", ")]


def _edit_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits in order from rows and pointer blocks, sorted by (conv, pos), blocks before rows."""
    conv, state, step = None, EMPTY, 0
    blocks: list[bytes] = []
    at = 0

    def insert(out):
        nonlocal state, step
        state, step = NEXT[state], step + 1
        out.append((conv, step, "I", INSERT, None, NAMES[state], "", None, None))

    def close(out):
        while conv is not None and AT_END[state]:
            insert(out)

    for frame in frames:
        out = []
        for c, pointers, turn, role, text, fault in zip(*(frame[k].tolist() for k in ("conv", "pointers", "turn", "role", "text", "fault"))):
            if c != conv:
                close(out)
                conv, state, step, blocks, at = c, EMPTY, 0, [], 0
            if pointers is not None:
                blocks.append(bytes(pointers))
                continue
            if at == len(blocks[0]):
                blocks.pop(0)
                at = 0
            pointer = blocks[0][at]
            at += 1
            while (edit := EDITS[pointer >> 2 * state & 3]) == "I":
                insert(out)
            step += 1
            more = TRUNCATED if fault == "truncated" else 0
            if edit == "D":
                out.append((conv, step, "D", DELETE, turn, None, text, role, fault))
            elif edit == "K":
                state = KEPT[state][role[:1]]
                out.append((conv, step, "K", more, turn, role, text, role, fault))
            else:
                state = NEXT[state]
                out.append((conv, step, "R", REROLE + more, turn, NAMES[state], text, role, fault))
        yield pd.DataFrame(out, columns=_EDIT_COLUMNS)
    out = []
    close(out)
    yield pd.DataFrame(out, columns=_EDIT_COLUMNS)


def conversation_key(conv_id: str):
    """A conversation's id as a text that is never null."""
    return F.when(F.col(conv_id).isNull(), "").otherwise(F.concat(F.lit("="), F.col(conv_id).cast("string")))


def faulted(turns: DataFrame) -> DataFrame:
    """(conv, pos, turn, role, text, fault): places from 1 in each conversation and each row's first fault.

    blank: the text has nothing but white space. duplicate: role and text were
    seen earlier in the conversation. truncated: the last character that is no
    white space is none of ``.!?``. Both windows share one shuffle by conversation.
    """
    rows = turns.select(conversation_key("conv_id").alias("conv"), "turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    by_turn = F.col("turn").asc_nulls_first()
    seen = F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy(by_turn)) > 1
    rows = rows.repartition("conv").withColumn("seen", seen)
    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("conv").orderBy(by_turn, "role", "text", "seen")).cast("long"))
    bare = F.rtrim("text", F.lit(SPACE))
    fault = (F.when(F.length(F.ltrim(bare, F.lit(SPACE))) == 0, "blank").when(F.col("seen"), "duplicate")
             .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated"))
    return rows.select("conv", "pos", F.col("turn").cast("string").alias("turn"), "role", "text", fault.alias("fault"))


def structure_edits(turns: DataFrame) -> DataFrame:
    """The edits of every conversation: (conv, step, edit, cost, turn, role, text, role_before, fault).

    Takes rows (conv_id, turn, role, text); other columns are ignored. Rows of a
    conversation count by turn (null first), then role, text; equal rows are
    neighbours. A null role or text counts as empty, rows without conv_id are
    one conversation (key '', others '=' and the id). edit: one of K, R, D, I.
    role and text are those after the edit (role null when deleted), turn,
    role_before and fault those of the row (null when inserted). Each
    conversation's rows lie in one task, in order of step (from 1). A
    conversation all of whose rows go ends with nothing; no rows, no edits.
    """
    small_arrow_batches(turns.sparkSession)
    rows = stage(faulted(turns), "repair-rows")
    backwards = (rows.select("conv", "pos", F.left("role", F.lit(1)).alias("initial"), "fault")
                 .repartition("conv").sortWithinPartitions("conv", F.desc("pos")))
    blocks = stage(backwards.mapInPandas(_pointer_blocks, _POINTERS), "repair-pointers")
    none = {c: F.lit(None).cast("string") for c in ("turn", "role", "text", "fault")}
    both = (rows.withColumn("pointers", F.lit(None).cast("binary"))
            .unionByName(blocks.withColumns(none)).repartition("conv").sortWithinPartitions("conv", "pos", F.col("pointers").isNull()))
    return both.mapInPandas(_edit_rows, _EDITS)


def repaired(edits: DataFrame, conv_id_type: str = "long") -> DataFrame:
    """The repaired conversations as rows (conv_id, step, role, text), in order of step."""
    conv = F.when(F.col("conv") != "", F.substring("conv", 2, 1 << 30)).cast(conv_id_type)
    return edits.where("edit <> 'D'").select(conv.alias("conv_id"), "step", "role", "text")


_DIGESTS = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
_LEGAL = ("su", "ua", "au")


def _digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Folds each conversation's edits, which come in order."""
    conv, names = None, [c.split()[0] for c in _DIGESTS.split(", ")]

    def closed():
        gaps = last - first + 1 - turns if turns else 0
        return (conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit.getvalue(), digest.hexdigest())

    for frame in frames:
        out = []
        for c, edit, price, turn, role, text, before, fault in zip(*(frame[k].tolist() for k in ("conv", "edit", "cost", "turn", "role", "text", "role_before", "fault"))):
            if c != conv:
                if conv is not None:
                    out.append(closed())
                conv, first, last, turns, illegal, cost, initial, said = c, None, None, 0, 0, 0, None, False
                count, audit, digest = Counter(), StringIO(), hashlib.sha256()
            audit.write(edit)
            cost += price
            if edit != "D":
                digest.update(f"{chr(10) if said else ''}{role}:{text}".encode())
                said = True
            if edit != "I":
                count[fault] += 1
                illegal += initial is not None and initial + before[:1] not in _LEGAL
                initial = before[:1]
                if turn is not None and last != int(turn):
                    turns, last = turns + 1, int(turn)
                    first = last if first is None else first
        yield pd.DataFrame(out, columns=names)
    if conv is not None:
        yield pd.DataFrame([closed()], columns=names)


def edit_digests(edits: DataFrame) -> DataFrame:
    """One row a conversation of ``structure_edits``, folded in the same tasks (its rows come in order there).

    gaps are turn numbers missing between the least and the greatest; blank,
    duplicate and truncated count rows by first fault; illegal counts
    neighbours whose initials are none of su, ua, au; cost and audit are those
    of the edits; repaired_sha256 is of the repaired ``role:text``, newline-joined.
    Conversations without rows are not there.
    """
    return edits.mapInPandas(_digests, _DIGESTS)
