"""Chat formatting with minimum-cost role repair.

Legal conversations are an automaton over the role of the last turn: an
optional system turn, then user and assistant in turn, the assistant last.  For
every input turn a dynamic program chooses between taking it as a new turn,
merging it into the one before, giving it another role, and putting an empty
turn before it; the cheapest way through is rendered.

A step is a matrix of costs between states, so a long conversation is cut into
blocks of turns: each block's matrix is one small row, the matrices of a
conversation are chained, and every block then finds its own cheapest path
between the states it was given.  No task ever holds more than a block.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from terraloom.llm.common import saved

STATES = ("none", "system", "user", "assistant")
#: Roles that may follow a role.
NEXT = {"none": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
#: Empty turns that end a conversation properly.
CLOSING = {"none": (), "system": ("user", "assistant"), "user": ("assistant",), "assistant": ()}
RELABEL, UNKNOWN, MERGE, INSERT = 4, 2, 1, 5
BLOCK = 4096
#: The place of rows without a turn, and the first of their parts.
LAST, LOOSE = (1 << 63) - 1, 1 << 62
OPEN, CLOSE, BETWEEN = "<|im_start|>", "<|im_end|>", "\n\n"


def _steps(role: str | None) -> list[tuple[str, str, int, str, str]]:
    """(from, to, cost, action, inserted role or '') of a turn with this role, cheapest first, ties in this order."""
    out = []
    for to in STATES[1:]:
        change = 0 if role == to else RELABEL if role in STATES[1:] else UNKNOWN
        label = "" if change == 0 else "relabel"
        for came in STATES:
            if to in NEXT[came]:
                out.append((came, to, change, label or "keep", ""))
            if came == to:
                out.append((came, to, change + MERGE, f"{label} merge".strip(), ""))
            out += [(came, to, change + INSERT, f"insert {label}".strip(), x) for x in NEXT[came] if to in NEXT[x]]
    return sorted(out, key=lambda s: s[2])


_STEPS = {role: _steps(role) for role in (*STATES[1:], None)}


def steps(role: str | None):
    return _STEPS.get(role, _STEPS[None])


def forward(roles: list[str | None], start: dict[str, float]) -> list[dict[str, tuple]]:
    """For each turn the cheapest (cost, step) that ends in each state."""
    out, at = [], start
    for role in roles:
        best: dict[str, tuple] = {}
        for step in steps(role):
            cost = at.get(step[0], math.inf) + step[2]
            if cost < best.get(step[1], (math.inf,))[0]:
                best[step[1]] = (cost, step)
        out.append(best)
        at = {s: c for s, (c, _) in best.items()}
    return out


def matrix(roles: list[str | None]) -> list[float]:
    """Cheapest cost from each state to each state, row by row."""
    out = []
    for came in STATES:
        last = forward(roles, {came: 0.0})[-1]
        out += [float(last[to][0]) if to in last else math.inf for to in STATES]
    return out


def chain(blocks: list[list[float]]) -> list[tuple[str, str]]:
    """(state before, state after) of each block on the cheapest way through all; ties go to the first state."""
    at, came = [0.0, math.inf, math.inf, math.inf], []
    for m in blocks:
        best = [min((at[p] + m[4 * p + q], p) for p in range(4)) for q in range(4)]
        at, came = [b[0] for b in best], [*came, [b[1] for b in best]]
    state = min(range(4), key=lambda q: (at[q] + INSERT * len(CLOSING[STATES[q]]), q))
    out = []
    for back in reversed(came):
        out.append((STATES[back[state]], STATES[state]))
        state = back[state]
    return out[::-1]


def path(roles: list[str | None], before: str, after: str) -> list[tuple]:
    """The steps of the cheapest way from one state to another."""
    table, state, out = forward(roles, {before: 0.0}), after, []
    for best in reversed(table):
        step = best[state][1]
        out.append(step)
        state = step[0]
    return out[::-1]


def _plain(text: str | None) -> str:
    """Markers inside a text cannot open or close a turn."""
    return (text or "").replace("<|", "< |")


def pieces(roles: list[str | None], texts: list[str | None], before: str, after: str, last: bool) -> list[tuple]:
    """(role, action, inserted, cost, rendered) of each turn; the rendered pieces follow on each other."""
    out = []

    def opened(came: str, role: str) -> str:
        return (f"{CLOSE}\n" if came != "none" else "") + f"{OPEN}{role}\n"

    for (came, to, cost, action, inserted), text in zip(path(roles, before, after), texts):
        if "merge" in action:
            head = BETWEEN
        elif inserted:
            head = opened(came, inserted) + opened(inserted, to)
        else:
            head = opened(came, to)
        out.append([to, action, inserted or None, cost, head + _plain(text)])
    if last:
        state = after
        for role in CLOSING[after]:
            out[-1][4] += opened(state, role)
            out[-1][3] += INSERT
            state = role
        out[-1][4] += f"{CLOSE}\n"
    return [tuple(x) for x in out]


def _ordered(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.sort_values(["_at", "role", "text"], na_position="last", kind="stable")


def _matrices(frame: pd.DataFrame) -> pd.DataFrame:
    rows = [(conv, none, block, matrix(_ordered(part).role.tolist()))
            for (conv, none, block), part in frame.groupby(["_conv", "_none", "_block"])]
    return pd.DataFrame(rows, columns=["_conv", "_none", "_block", "m"])


def _chained(frame: pd.DataFrame) -> pd.DataFrame:
    out = []
    for (conv, none), part in frame.groupby(["_conv", "_none"]):
        part = part.sort_values("_block")
        ways = chain(part.m.tolist())
        out += [(conv, none, block, before, after, i == len(ways) - 1) for i, (block, (before, after)) in enumerate(zip(part._block, ways))]
    return pd.DataFrame(out, columns=["_conv", "_none", "_block", "before", "after", "last"])


REPAIRED = ("conv_id long, turn long, role string, new_role string, action string, inserted string, cost int, rendered string, "
            "part long, place int")


def _rendered(frame: pd.DataFrame, ways: pd.DataFrame) -> pd.DataFrame:
    plan, out = {}, []
    for conv, none, block, before, after, last in ways[["_conv", "_none", "_block", "before", "after", "last"]].itertuples(index=False):
        plan[conv, none, block] = (before, after, last)
    for key, part in frame.groupby(["_conv", "_none", "_block"]):
        part = _ordered(part)
        told = pieces(part.role.tolist(), part.text.tolist(), *plan[key])
        turns = [None if a == LAST else a for a in part._at]
        out += [(None if key[1] else key[0], turn, role, *x, key[2], place) for place, (turn, role, x) in enumerate(zip(turns, part.role, told))]
    # Ids as objects: next to a null one they would become floating.
    frame = pd.DataFrame(out, columns=["conv_id", "turn", "role", "new_role", "action", "inserted", "cost", "rendered", "part", "place"])
    for name, at in (("conv_id", 0), ("turn", 1)):
        frame[name] = pd.array([row[at] for row in out], dtype="Int64")
    return frame


def repaired(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Each turn with its new role, what was done and its rendered piece.

    The pieces of a conversation, in the order of (part, place), are its rendered
    text: that is the order of (turn, role, text) with nulls last, and rows without
    a turn come behind, in an order that a hash of role and text gives, so that
    any number of them is spread over parts.  Empty turns that were put in stand
    in the piece of the turn after them, those at the end in the last piece.  Roles other
    than system, user and assistant, and null, are unknown and cheap to
    relabel.  A null text is empty, rows without a conversation form one,
    repeated rows are turns of their own (and merge).  Extra columns are not
    read.  A part holds ``block`` (two or more) consecutive turn numbers, or as
    many copies of a row without a turn.
    """
    spark = turns.sparkSession
    at = F.col(turn).cast("long")
    named = turns.select(
        F.coalesce(F.col(conv_id).cast("long"), F.lit(0)).alias("_conv"), F.col(conv_id).isNull().alias("_none"), at.alias("_at"),
        F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    turned = named.filter(F.col("_at").isNotNull()).withColumn("_block", F.floor(F.col("_at") / F.lit(block)).cast("long"))
    # Equal rows without a turn are counted before they move, then dealt to parts again.
    loose = named.filter(F.col("_at").isNull()).groupBy("_conv", "_none", "role", "text").agg(F.count(F.lit(1)).alias("_n"))
    mixed = F.shiftrightunsigned(F.xxhash64("role", "text"), 48)
    loose = loose.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).select(
        "_conv", "_none", F.lit(LAST).cast("long").alias("_at"), "role", "text",
        (F.lit(LOOSE).cast("long") + mixed * (1 << 30) + F.floor(F.col("_k") / block)).cast("long").alias("_block"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(turns.count() / 20_000))
    share = F.pmod(F.xxhash64("_conv", "_none", "_block"), F.lit(tasks)).cast("int")
    # Explicit numbers of partitions: adaptive execution would merge these few bytes into one long task.
    rows = turned.unionByName(loose).withColumn("_share", share).repartition(tasks, "_share")
    blocks = rows.select("_share", "_conv", "_none", "_block", "_at", "role", F.lit("").alias("text")).groupBy("_share").applyInPandas(
        _matrices, "_conv long, _none boolean, _block long, m array<double>")
    ways = saved(
        blocks.withColumn("_share", F.pmod(F.xxhash64("_conv", "_none"), F.lit(tasks)).cast("int")).repartition(tasks, "_share").groupBy("_share").applyInPandas(
            _chained, "_conv long, _none boolean, _block long, before string, after string, last boolean"), "ways").withColumn("_share", share).repartition(tasks, "_share")
    return rows.groupBy("_share").cogroup(ways.groupBy("_share")).applyInPandas(_rendered, REPAIRED)

