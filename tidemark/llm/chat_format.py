"""Chat formatting: minimum-cost repair of role sequences, then rendering.

Legal conversations are ``[system] (user assistant)* [user]``. Each turn is kept, relabelled,
or merged into the turn before it, and empty turns may be put in; a dynamic program over
the automaton of legal turns finds the cheapest way.

Turns before another only matter by the state they end in, so a stretch of turns is a small
table: the cheapest cost from every state to every state. Long conversations are cut into
stretches: tables of all stretches are made side by side, chained, and the choices inside
each stretch follow from the states at its ends. No task holds more than one stretch. Where
very many rows share a number, or have none, their stretches are cut by role and content,
in the order of the turns, so a stretch is short there too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.staging import stored

ROLES = ("system", "user", "assistant")
# Other names of the roles.
SYNONYMS = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant"}
#: Cost of a relabel between two roles that are both legal names, or of an unknown name.
RELABEL, UNKNOWN = 3.0, 1.0
#: Cost of joining a turn to the one before, which had the same role; and of an empty turn.
MERGE, INSERT = 1.0, 2.0
#: States: nothing yet, then the role of the last turn.
START = 3
STATES = 4
#: Turns of a stretch.
STRETCH = 4096

_NEXT = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}


def _actions() -> list[tuple[int, int, int, float, bool, int]]:
    """(state before, role given, state after, cost besides the relabel, merged, role of an
    empty turn put in before, or -1); one action per turn."""
    found = []
    for before in range(STATES):
        for role in range(3):
            if role in _NEXT[before]:
                found.append((before, role, role, 0.0, False, -1))
            if role == before:
                found.append((before, role, role, MERGE, True, -1))
            found += [
                (before, role, role, INSERT, False, between)
                for between in _NEXT[before]
                if role in _NEXT[between] and role not in _NEXT[before]
            ]
    return found


ACTIONS = _actions()


def _label_cost(role: str | None, given: int) -> float:
    return 0.0 if role == ROLES[given] else RELABEL if role in ROLES else UNKNOWN


def stretch_table(roles: list[str | None]) -> np.ndarray:
    """The least cost of the turns from every state to every state."""
    steps = {}
    table = np.where(np.eye(STATES, dtype=bool), 0.0, np.inf)
    for role in roles:
        if role not in steps:
            step = np.full((STATES, STATES), np.inf)
            for before, given, after, cost, _, _ in ACTIONS:
                step[before, after] = min(step[before, after], cost + _label_cost(role, given))
            steps[role] = step
        table = (table[:, :, None] + steps[role][None]).min(axis=1)
    return table


def repair(roles: list[str | None], entry: int, leave: int) -> list[int]:
    """The cheapest actions (numbers into ``ACTIONS``) from one state to another; of equal
    ways the one whose last action stands first in ``ACTIONS``, and so on backwards."""
    best = [0.0 if state == entry else np.inf for state in range(STATES)]
    choices = []
    for role in roles:
        now, choice = [np.inf] * STATES, [-1] * STATES
        for number, (before, given, after, cost, _, _) in enumerate(ACTIONS):
            if (total := best[before] + cost + _label_cost(role, given)) < now[after]:
                now[after], choice[after] = total, number
        best = now
        choices.append(choice)
    actions, state = [], leave
    for choice in reversed(choices):
        actions.append(choice[state])
        state = ACTIONS[choice[state]][0]
    return actions[::-1]


def chain(tables: list[np.ndarray]) -> tuple[list[int], float]:
    """States before, between and after the stretches of one conversation; the cost."""
    costs = [np.where(np.arange(STATES) == START, 0.0, np.inf)]
    for table in tables:
        costs.append((costs[-1][:, None] + table).min(axis=0))
    states = [int(costs[-1].argmin())]
    for table, before in zip(reversed(tables), reversed(costs[:-1])):
        states.append(int((before + table[:, states[-1]]).argmin()))
    return states[::-1], float(costs[-1].min())


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows with equal first ``keys`` columns, which stand together, as lists of tuples;
    of equal neighbours only one."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if held and row[:keys] != held[0][:keys]:
                yield held
                held = []
            if not held or row != held[-1]:
                held.append(row)
    if held:
        yield held


#: A stretch: turns of one block of numbers; where a number of the block is crowded, one
#: number, and where it is that number itself, a role and a range of contents.
_STRETCH = pa.struct(
    [("block", pa.int64()), ("turn", pa.int64()), ("name", pa.string()), ("given", pa.string()), ("part", pa.int64())]
)
_STRETCH_TYPE = "struct<block: long, turn: long, name: string, given: string, part: long>"


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _groups(batches, 2):
        table = stretch_table([name for _, _, name, *_ in rows]).reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows[0][0]]), pa.array([rows[0][1]], _STRETCH), pa.array([table.tolist()])],
            ["key", "stretch", "table"],
        )


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _groups(batches, 1):
        states, cost = chain([np.array(table).reshape(STATES, STATES) for _, _, table in rows])
        n = len(rows)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([row[0] for row in rows]),
                pa.array([row[1] for row in rows], _STRETCH),
                pa.array(states[:-1], pa.int32()),
                pa.array(states[1:], pa.int32()),
                pa.array([cost] * n),
                pa.array([i == n - 1 for i in range(n)]),
            ],
            ["key", "stretch", "entry", "leave", "cost", "ends"],
        )


_ROW = pa.struct([("conv_id", pa.int64()), ("turn", pa.int64()), ("given_role", pa.string())])


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (_, _, _, _, _, state), *rows in _groups(batches, 2):
        actions = repair([name for _, _, _, name, *_ in rows], state["entry"], state["leave"])
        out = []
        for (_, _, row, _, text, _), number in zip(rows, actions):
            before, given, _, _, merged, between = ACTIONS[number]
            if merged:
                start = "\n"
            else:
                closed = "" if before == START else "<|end|>\n"
                empty = "" if between < 0 else f"<|{ROLES[between]}|>\n<|end|>\n"
                start = f"{closed}{empty}<|{ROLES[given]}|>\n"
            inserted = None if between < 0 else ROLES[between]
            out.append([row, ROLES[given], merged, inserted, state["cost"], start + (text or "")])
        if state["ends"]:
            out[-1][-1] += "<|end|>\n"
        row, role, merged, inserted, cost, rendered = zip(*out)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(row, _ROW),
                pa.array(role),
                pa.array(merged),
                pa.array(inserted, pa.string()),
                pa.array(cost, pa.float64()),
                pa.array(rendered),
            ],
            ["row", "role", "merged", "inserted_role", "conversation_cost", "rendered"],
        )


def _with_stretches(keyed: DataFrame, stretch: int) -> DataFrame:
    """``stretch`` of each turn, in the order of turn, name, given role and print."""
    place = ["key", "block", F.col("row.turn").alias("turn")]
    counted = keyed.groupBy(*place).agg(F.count("*").alias("rows")).where(F.col("rows") > stretch)
    crowded = stored(counted, "crowded")
    # numbers of the blocks that hold a crowded one stand alone, so that the order is kept
    blocks = crowded.select("key", "block").distinct().withColumn("cut", F.lit(True))
    turns = crowded.select("key", F.col("turn").alias("crowded_turn"), "block", "rows")
    same = [keyed["key"] == turns["key"], keyed["block"] == turns["block"], F.col("row.turn").eqNullSafe(F.col("crowded_turn"))]
    wide = keyed.join(turns, same, "left").select(keyed["*"], "rows").join(blocks, ["key", "block"], "left")
    crowd = F.col("rows").isNotNull()
    # prints are even over all 64-bit numbers: as many ranges as hold half a stretch each
    ranges = F.floor(2 * F.col("rows") / stretch) + 1
    share = (F.col("print").cast("double") + float(1 << 63)) / float(1 << 64)
    return wide.withColumn(
        "stretch",
        F.struct(
            "block",
            F.when(F.col("cut"), F.col("row.turn")).alias("turn"),
            F.when(crowd, F.col("name")).alias("name"),
            F.when(crowd, F.col("row.given_role")).alias("given"),
            F.when(crowd, F.floor(share * ranges)).cast("long").alias("part"),
        ),
    ).drop("block", "rows", "cut")


def format_chats(turns: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """``(conv_id, turn, given_role, role, merged, inserted_role, conversation_cost,
    rendered)``, one row per different turn.

    ``turns`` needs ``conv_id``, ``turn``, ``role`` and ``text``. ``rendered`` is the turn's
    part of the conversation's text: the parts in order make up the whole. The order is that
    of ``turn``, then of the role's name. ``merged`` turns go on within the turn before;
    ``inserted_role`` is that of an empty turn put in before this one.

    Role names are trimmed, lower-cased and freed of synonyms; null and other names may take
    any role. A null text is empty. Equal rows are one turn. Turns without a number come
    first. A turn without a conv_id is a conversation of its own.
    """
    role = F.lower(F.trim(F.col("role")))
    names = F.create_map(*(F.lit(x) for pair in SYNONYMS.items() for x in pair))
    keyed = turns.select(
        # null ids part by content
        F.when(F.col("conv_id").isNotNull(), F.concat(F.lit("c"), F.col("conv_id").cast("string")))
        .otherwise(F.concat(F.lit("n"), F.sha2(F.to_json(F.struct("turn", "role", "text")), 256)))
        .alias("key"),
        F.coalesce(F.floor(F.col("turn") / stretch), F.lit(-(1 << 62))).cast("long").alias("block"),
        F.struct("conv_id", "turn", F.col("role").alias("given_role")).alias("row"),
        F.coalesce(names[role], role).alias("name"),
        "text",
        F.xxhash64("text").alias("print"),
    )
    keyed = _with_stretches(keyed, stretch)
    order = ["key", "stretch", "row.turn", "name", "row.given_role", "print"]
    tables = (
        keyed.drop("text").repartition("key", "stretch").sortWithinPartitions(*order)
        .select("key", "stretch", "name", "row", "print")
        .mapInArrow(_tables, f"key string, stretch {_STRETCH_TYPE}, table array<double>")
    )
    states = stored(
        tables.repartition("key").sortWithinPartitions("key", "stretch")
        .mapInArrow(_chains, f"key string, stretch {_STRETCH_TYPE}, entry int, leave int, cost double, ends boolean"),
        "states",
    )
    # the states of a stretch travel as a row before its turns, so that the texts move once
    marked = keyed.withColumn("state", F.lit(None).cast("struct<entry: int, leave: int, cost: double, ends: boolean>"))
    heads = states.select("key", "stretch", F.struct("entry", "leave", "cost", "ends").alias("state"))
    rendered = (
        marked.unionByName(heads, allowMissingColumns=True)
        .repartition("key", "stretch")
        .sortWithinPartitions("key", "stretch", F.col("state").isNull(), *order[2:])
        .select("key", "stretch", "row", "name", "text", "state")
        .mapInArrow(
            _render,
            "row struct<conv_id: long, turn: long, given_role: string>, role string, merged boolean, "
            "inserted_role string, conversation_cost double, rendered string",
        )
    )
    return rendered.select("row.*", "role", "merged", "inserted_role", "conversation_cost", "rendered")
