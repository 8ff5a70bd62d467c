"""Chat formatting with minimum-cost role repair.

Legal conversations are those of a small automaton: an optional system turn, then user and assistant in alternation,
starting with the user; the last turn is the user's or the assistant's. Every given turn is kept, relabelled or merged
into the turn before it, and empty turns may be inserted; dynamic programming over the automaton finds the choice of
least total cost. The repaired sequence is rendered with role marks.

A conversation of any length is worked on in chunks of ``CHUNK`` turns: each chunk becomes a matrix of least costs from
state to state, the few matrices of a conversation are combined, and then every chunk is decoded between its two known
states. The rendered text comes in pieces, one per given or inserted turn, so no cell holds a whole conversation;
their concatenation by ``position, part`` is the rendered conversation.

Defined results: turns are ordered by turn number (null last), role and text; repeated rows are turns of their own; an
unknown or null role may become any; a null text is empty; rows with a null conversation id are one conversation; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from weftmart.operators.keys import running_number
from weftmart.session import materialise

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
# the legal next roles of each state, and the states a conversation may end in
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
ENDS = (START, USER, ASSISTANT)
CHUNK = 4096


@dataclass(frozen=True)
class Costs:
    merge: float = 1.0
    relabel: float = 2.0
    unknown: float = 1.0
    insert: float = 3.0


def _role_cost(role: str | None, label: int, costs: Costs) -> float:
    role = (role or "").strip().lower()
    return 0.0 if role == ROLES[label - 1] else costs.relabel if role in ROLES else costs.unknown


def moves(costs: Costs) -> list[tuple[int, int, str, float]]:
    """``(state, next state, way, cost)``: how a turn with the next state's role can follow."""
    out = []
    for state in range(4):
        for label in (SYSTEM, USER, ASSISTANT):
            if label in LEGAL[state]:
                out.append((state, label, "next", 0.0))
            if label == state:
                out.append((state, label, "merge", costs.merge))
            for between in LEGAL[state]:
                if label in LEGAL[between]:
                    out.append((state, label, f"insert {ROLES[between - 1]}", costs.insert))
    return out


def _step(role: str | None, ways: list, costs: Costs) -> np.ndarray:
    """Least cost from state to state over one turn."""
    out = np.full((4, 4), np.inf)
    for state, label, _, cost in ways:
        out[state, label] = min(out[state, label], cost + _role_cost(role, label, costs))
    return out


def matrix(roles: list[str | None], costs: Costs) -> np.ndarray:
    """Least cost from state to state over all turns of a chunk."""
    ways = moves(costs)
    known: dict[str | None, np.ndarray] = {}
    out = np.where(np.eye(4) > 0, 0.0, np.inf)
    for role in roles:
        if role not in known:
            known[role] = _step(role, ways, costs)
        out = (out[:, :, None] + known[role][None]).min(1)
    return out


def _finish(state: int, costs: Costs) -> float:
    return 0.0 if state in ENDS else costs.insert


def repair(roles: list[str | None], costs: Costs, enter: int = START, leave: int | None = None) -> list[tuple[int, str]]:
    """``(label, way)`` per turn, at least cost; without ``leave`` the conversation ends here."""
    ways = moves(costs)
    best = np.full(4, np.inf)
    best[enter] = 0.0
    back = []
    for role in roles:
        now, how = np.full(4, np.inf), [None] * 4
        for state, label, way, cost in ways:
            total = best[state] + cost + _role_cost(role, label, costs)
            if total < now[label] - 1e-9:
                now[label], how[label] = total, (state, way)
        best = now
        back.append(how)
    at = leave if leave is not None else min(range(4), key=lambda s: (best[s] + _finish(s, costs), s))
    out = []
    for how in reversed(back):
        state, way = how[at]
        out.append((at, way))
        at = state
    return out[::-1]


MARK, CLOSE = "<|{}|>\n", "<|end|>\n"


def render(rows: pd.DataFrame, costs: Costs, enter: int, leave: int | None, last: bool) -> pd.DataFrame:
    """Pieces of a chunk; ``out_turn`` counts from the last turn of the chunk before."""
    plan = repair(rows["role"].tolist(), costs, enter, leave)
    out, turn, opened = [], 0, enter != START

    def add(position, part, number, role, new, action, text):
        out.append((position, part, number, role, new, action, turn, text))

    for (label, way), position, number, role, text in zip(plan, rows["position"], rows["turn"], rows["role"], rows["text"], strict=True):
        text = text if isinstance(text, str) else ""
        role = role if isinstance(role, str) else None
        new = ROLES[label - 1]
        kept = _role_cost(role, label, costs) == 0
        part = 0
        if way.startswith("insert"):
            turn += 1
            between = way.split()[1]
            add(position, 0, None, None, between, "insert", (CLOSE if opened else "") + MARK.format(between))
            opened, part = True, 1
        if way == "merge":
            add(position, part, number, role, new, "merge" if kept else "relabel and merge", "\n" + text)
        else:
            turn += 1
            add(position, part, number, role, new, "keep" if kept else "relabel", (CLOSE if opened else "") + MARK.format(new) + text)
            opened = True
    if last and out:
        if plan[-1][0] not in ENDS:
            turn += 1
            add(out[-1][0], 2, None, None, "user", "insert", CLOSE + MARK.format("user"))
        *rest, text = out[-1]
        out[-1] = (*rest, text + "\n" + CLOSE)
    columns = ["position", "part", "turn", "role", "new_role", "action", "out_turn", "rendered"]
    return pd.DataFrame(out, columns=columns).astype({"turn": "Int64"})


PIECES = "position bigint, part int, turn bigint, role string, new_role string, action string, out_turn bigint, rendered string"


def format_chats(
    turns: DataFrame, costs: Costs = Costs(), chunk: int = CHUNK, names: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text")
) -> DataFrame:
    """``conv_id, position, part, turn, role, new_role, action, out_turn, rendered`` for every conversation."""
    conv, turn, role, text = (F.col(f"`{n}`") for n in names)
    rows = turns.select(conv.cast("bigint").alias("conv"), turn.cast("bigint").alias("turn"), role.cast("string").alias("role"), text.cast("string").alias("text"))
    rows = rows.withColumn("unplaced", F.col("turn").isNull())
    # numbered without bringing a conversation to one task
    rows = running_number(rows, ["conv"], ["unplaced", "turn", "role", "text"], "position").drop("unplaced")
    rows = rows.withColumns({"known": F.col("conv").isNotNull(), "conv": F.coalesce("conv", F.lit(0).cast("long"))})
    rows = materialise(rows.withColumn("chunk", F.expr(f"(position - 1) div {chunk}")), "turns")
    key = ["known", "conv", "chunk"]
    chunks = rows.groupBy("known", "conv").agg(F.max("chunk").alias("last"))
    chunks = materialise(chunks.where("last > 0"), "long-chats")

    # the borders of conversations with several chunks
    def summarise(group: pd.DataFrame) -> pd.DataFrame:
        found = matrix(group.sort_values("position")["role"].tolist(), costs).ravel().tolist()
        return pd.DataFrame({"known": [group["known"].iloc[0]], "conv": [group["conv"].iloc[0]], "chunk": [group["chunk"].iloc[0]], "costs": [found]})

    long = rows.join(chunks.drop("last"), ["known", "conv"], "left_semi").select(*key, "position", "role")
    summaries = long.groupBy(*key).applyInPandas(summarise, "known boolean, conv bigint, chunk bigint, costs array<double>")

    def combine(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        steps = [np.array(c, float).reshape(4, 4) for c in group["costs"]]
        best, froms = np.array([0.0, np.inf, np.inf, np.inf]), []
        for step in steps:
            total = best[:, None] + step
            froms.append(total.argmin(0))
            best = total.min(0)
        at = min(range(4), key=lambda s: (best[s] + _finish(s, costs), s))
        borders = [at]
        for back in reversed(froms):
            at = int(back[at])
            borders.append(at)
        borders = borders[::-1]
        return group[["known", "conv", "chunk"]].assign(enter=borders[:-1], leave=borders[1:], last=group["chunk"] == group["chunk"].max())

    # one row per chunk of a conversation
    borders = summaries.groupBy("known", "conv").applyInPandas(combine, "known boolean, conv bigint, chunk bigint, enter int, leave int, last boolean")
    borders = materialise(borders, "borders")

    def decode(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("position")
        one = group.iloc[0]
        leave = None if one["leave"] < 0 else int(one["leave"])
        found = render(group, costs, int(one["enter"]), leave, bool(one["last"]))
        return found.assign(known=one["known"], conv=one["conv"], chunk=one["chunk"])

    placed = rows.join(borders, key, "left").withColumns(
        {"enter": F.coalesce("enter", F.lit(START)), "leave": F.coalesce("leave", F.lit(-1)), "last": F.coalesce("last", F.lit(True))}
    )
    pieces = placed.groupBy(*key).applyInPandas(decode, PIECES + ", known boolean, conv bigint, chunk bigint")
    pieces = materialise(pieces, "pieces")
    # turns of the chunks before, for the few conversations that have several
    counts = pieces.join(chunks.drop("last"), ["known", "conv"], "left_semi").groupBy(*key).agg(F.max("out_turn").alias("n"))
    before = Window.partitionBy("known", "conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    out = pieces.join(shift, key, "left").withColumn("out_turn", F.col("out_turn") + F.coalesce("shift", F.lit(0)))
    return out.select(
        F.expr("if(known, conv, null)").alias(names[0]), "position", "part", "turn", "role", "new_role", "action", "out_turn", "rendered"
    )


def op4_chat(spark, sf_dir: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def brute_cost(roles: list[str | None], costs: Costs = Costs(), extra: int = 1) -> float:
    """The least cost over all labels, merges and up to ``extra`` insertions before each turn; for tests."""
    best = np.inf
    options = []
    for role in roles:
        fills = [f for n in range(extra + 1) for f in product((SYSTEM, USER, ASSISTANT), repeat=n)]
        options.append([(label, fill, merge) for label in (SYSTEM, USER, ASSISTANT) for fill in fills for merge in (False, True) if not (merge and fill)])
    for choice in product(*options):
        state, cost = START, 0.0
        for role, (label, fill, merge) in zip(roles, choice, strict=True):
            cost += _role_cost(role, label, costs) + costs.insert * len(fill) + costs.merge * merge
            if merge:
                if state != label:
                    cost = np.inf
                continue
            for nxt in (*fill, label):
                if nxt not in LEGAL[state]:
                    cost = np.inf
                    break
                state = nxt
            if cost == np.inf:
                break
        best = min(best, cost + _finish(state, costs))
    return best
