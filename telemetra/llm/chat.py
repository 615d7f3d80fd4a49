"""Roles of transcript lines by a hidden Markov model, and canonical chat turns."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemetra.llm.frames import arrow_map, sorted_groups
from telemetra.operators.ordering import running_total
from telemetra.session import materialize

ROLES = ("system", "user", "assistant", "tool")
# Names by which transcripts mark speakers.
NAMES = {
    "system": 0, "user": 1, "human": 1, "customer": 1, "question": 1, "q": 1, "assistant": 2,
    "ai": 2, "bot": 2, "agent": 2, "answer": 2, "a": 2, "model": 2, "tool": 3, "function": 3,
}
_WORD = "|".join(sorted(NAMES, key=len, reverse=True))
_MARK = re.compile(
    rf"^\s*(?:(?:#+|\*+)\s*)?(?:<\|({_WORD})\|>|\[({_WORD})\]|({_WORD})\s*:|###\s*({_WORD})\s*$)\**\s*", re.I)
MARKED = 0.97  # how often a speaker's name tells the role
STAY = 0.995  # an unmarked line goes on with the speaker of the line before
FEATURES = 48
CHUNK = 256  # rows of a conversation that are decoded together
FAN = 256  # chunks that are combined to one
SLICE = 8192  # lines whose scores are held at a time
_LOW = -1e30


def marker(line: str) -> tuple[int | None, str]:
    """Role that the line's opening names, and the line without that opening."""
    found = _MARK.match(line)
    if not found:
        return None, line
    return NAMES[next(g for g in found.groups() if g).lower()], line[found.end():]


def features(line: str, first: bool) -> int:
    """One of ``FEATURES`` kinds of line: length class, ending, beginning, position."""
    size = min(5, len(line).bit_length() // 2)
    tail = line.rstrip()[-1:]
    ending = 1 if tail == "?" else 0
    opening = 1 if line.lstrip()[:1] in ("-", "*", "`", "|", "{") else 0
    return ((size * 2 + ending) * 2 + opening) * 2 + first


def parsed(text: str | None, role: str | None) -> list[tuple[int | None, int, str]]:
    """Lines of a row: named role or none, kind of line, text without the name.

    The row's own role column names the first line's speaker unless the line does.
    """
    given = NAMES.get((role or "").strip().lower())
    out = []
    for i, line in enumerate((text or "").split("\n")):
        named, rest = marker(line)
        out.append((given if named is None and i == 0 else named, features(rest, i == 0), rest))
    return out


def numbered(turns: DataFrame) -> DataFrame:
    """Rows with their place in the conversation; equal turns are ordered by role and text."""
    rows = turns.select("conv_id", "turn", "role", "text").withColumns({
        "conv": F.coalesce("conv_id", F.lit(-1)), "_nil": F.col("conv_id").isNull().cast("int"),
        "one": F.lit(1).cast("bigint")})
    order = ["turn", "role", "text"]
    placed = running_total(rows, ["conv", "_nil"], order, "one", "place").drop("one")
    return materialize(placed.withColumn("chunk", F.floor(F.col("place") / CHUNK)), "turns")


def learn(rows: DataFrame) -> dict[str, np.ndarray]:
    """Log-probabilities of first roles, of roles after roles, and of kinds of line per role.

    Counted over all rows whose role is known; the counts are at most a few hundred numbers.
    """
    def run(batches):
        count: Counter = Counter()
        for batch in batches:
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                given = NAMES.get((role or "").strip().lower())
                if given is not None:
                    count.update((given, kind) for _, kind, _ in parsed(text, role))
        yield {
            "role": [r for r, _ in count], "kind": [k for _, k in count], "n": list(count.values())}

    kinds = arrow_map(rows.select("role", "text"), run, "role int, kind int, n long").groupBy(
        "role", "kind").agg(F.sum("n").alias("n")).collect()
    known = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    roles = rows.select(
        "conv", "_nil", "place", known[F.lower(F.trim(F.coalesce("role", F.lit(""))))].alias("to"))
    before = roles.select("conv", "_nil", (F.col("place") + 1).alias("place"), F.col("to").alias("from"))
    moves = roles.join(before, ["conv", "_nil", "place"], "left").where("to is not null").groupBy(
        (F.col("place") == 0).alias("opens"), "from", "to").agg(F.count(F.lit(1)).alias("n")).collect()
    size = len(ROLES)
    emit, move, start = np.ones((size, FEATURES)), np.ones((size, size)), np.ones(size)
    for r in kinds:
        emit[r["role"], r["kind"]] += r["n"]
    for r in moves:
        if r["opens"]:
            start[r["to"]] += r["n"]
        elif r["from"] is not None:
            move[r["from"], r["to"]] += r["n"]
    return {
        "emit": np.log(emit / emit.sum(axis=1, keepdims=True)),
        "move": np.log(move / move.sum(axis=1, keepdims=True)), "start": np.log(start / start.sum())}


class Lines:
    """Lines of some rows as arrays: row, number in the row, kind, and named role or -1."""

    def __init__(self, table: pa.Table, begin: int, end: int):
        part = table.slice(begin, end - begin)
        self.rest: list[str] = []
        row, number, kind, named = [], [], [], []
        for at, (text, role) in enumerate(zip(
                part.column("text").to_pylist(), part.column("role").to_pylist())):
            for i, (name, what, rest) in enumerate(parsed(text, role)):
                row.append(at)
                number.append(i)
                kind.append(what)
                named.append(-1 if name is None else name)
                self.rest.append(rest)
        self.row, self.number, self.kind, self.named = (
            np.array(x, np.int32) for x in (row, number, kind, named))

    def steps(self, model: dict[str, np.ndarray]) -> Iterator[np.ndarray]:
        """Scores of each step from role to role (lines x states x states), ``SLICE`` at a time.

        States are the roles and, last, the one before a conversation starts.
        """
        size = len(ROLES)
        told = np.vstack([_certain(MARKED), np.zeros(size)])  # the last row is for no name
        stay = _certain(STAY)
        for at in range(0, len(self.rest), SLICE):
            part = slice(at, at + SLICE)
            turns = (self.number[part] == 0) | (self.named[part] >= 0)
            seen = model["emit"][:, self.kind[part]].T + told[self.named[part]]
            step = np.full((len(seen), size + 1, size + 1), _LOW)
            step[:, :size, :size] = np.where(turns[:, None, None], model["move"], stay) + seen[:, None, :]
            step[:, size, :size] = model["start"] + seen
            yield step


def _certain(share: float) -> np.ndarray:
    """Log-probabilities of the same role, and of each other one."""
    size = len(ROLES)
    other = (1 - share) / (size - 1)
    return np.log(np.full((size, size), other) + np.eye(size) * (share - other))


def through(steps: Iterable[np.ndarray]) -> np.ndarray:
    """Best score from each state before the steps to each state after them."""
    total = None
    for part in steps:
        while len(part) > 1:  # two neighbours at a time become one step
            even = len(part) // 2 * 2
            both = (part[:even:2, :, :, None] + part[1:even:2, None, :, :]).max(axis=2)
            part = np.concatenate([both, part[even:]])
        total = part[0] if total is None else (total[:, :, None] + part[0][None]).max(axis=1)
    return total


def best_path(steps: Iterable[np.ndarray], entry: np.ndarray, leave: np.ndarray) -> list[int]:
    """Viterbi states, given the scores of reaching the first line and of what follows."""
    reach, back = entry, []
    for part in steps:
        came = np.empty((len(part), len(entry)), np.int8)
        for i, step in enumerate(part):
            all_ = reach[:, None] + step
            came[i] = all_.argmax(axis=0)
            reach = all_.max(axis=0)
        back.append(came)
    state, path = int((reach + leave).argmax()), []
    for came in np.concatenate(back)[::-1]:
        path.append(state)
        state = int(came[state])
    return path[::-1]


def render(role: str, text: str) -> str:
    return f"<|{role}|>\n{text}\n<|end|>\n"


_KEY = ["conv", "_nil"]
_STATES = len(ROLES) + 1


def _matrices(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy().reshape(table.num_rows, _STATES, -1)


def summarised(level: DataFrame, label: str) -> DataFrame:
    """Rows ``conv, _nil, chunk, best`` with ``FAN`` neighbours combined to one."""
    def run(batches):
        for table, cuts in sorted_groups(batches, [*_KEY, "up"]):
            best = _matrices(table, "best")
            out = [through([best[b:e]]).ravel() for b, e in zip(cuts[:-1], cuts[1:])]
            yield {k: table.column(k).to_numpy()[cuts[:-1]] for k in _KEY} | {
                "chunk": table.column("up").to_numpy()[cuts[:-1]], "best": out}

    grouped = level.withColumn("up", F.floor(F.col("chunk") / FAN))
    placed = grouped.repartition(*_KEY, "up").sortWithinPartitions(*_KEY, "up", "chunk")
    return materialize(arrow_map(placed, run, "conv long, _nil int, chunk long, best array<double>"), label)


def scanned(level: DataFrame, above: DataFrame | None) -> DataFrame:
    """``before`` and ``after`` of each chunk: the best scores of reaching it and of what follows.

    ``above`` has them for the groups of ``FAN`` chunks; without it there is one group for each
    conversation.
    """
    def run(batches):
        for table, cuts in sorted_groups(batches, [*_KEY, "up"]):
            best = _matrices(table, "best")
            enter, leave = _matrices(table, "enter")[:, :, 0], _matrices(table, "leave")[:, :, 0]
            before, after = np.empty((len(best), _STATES)), np.empty((len(best), _STATES))
            for b, e in zip(cuts[:-1], cuts[1:]):
                reach, rest = enter[b], leave[b]
                for i in range(b, e):
                    before[i] = reach
                    reach = (reach[:, None] + best[i]).max(axis=0)
                for i in range(e - 1, b - 1, -1):
                    after[i] = rest
                    rest = (best[i] + rest).max(axis=1)
            yield {k: table.column(k).to_numpy() for k in [*_KEY, "chunk"]} | {
                "before": list(before), "after": list(after)}

    grouped = level.withColumn("up", F.floor(F.col("chunk") / FAN))
    if above is None:
        start = [_LOW] * len(ROLES) + [0.0]
        grouped = grouped.withColumns({
            "enter": F.array(*map(F.lit, start)), "leave": F.array(*[F.lit(0.0)] * _STATES)})
    else:
        grouped = grouped.join(above.select(
            *_KEY, F.col("chunk").alias("up"), F.col("before").alias("enter"), F.col("after").alias("leave")),
            [*_KEY, "up"])
    placed = grouped.repartition(*_KEY, "up").sortWithinPartitions(*_KEY, "up", "chunk")
    return materialize(arrow_map(
        placed, run, "conv long, _nil int, chunk long, before array<double>, after array<double>"),
        "chunk-ends")


def canonical(turns: DataFrame) -> DataFrame:
    """Turns of the conversations in rows of ``conv_id, turn, role, text``, any columns beside.

    Lines come in order of turn; a speaker's name at a line's start or the row's role column is
    evidence, not truth. Transition and emission tables are counted over all rows with a known
    role. The best path over a whole conversation is found in chunks of rows: each chunk's best
    scores from state to state, combined ``FAN`` at a time until a conversation is one group,
    then what comes before and after each chunk, level by level down, then Viterbi inside each
    chunk. So a conversation of any length is decoded exactly, and no task ever needs more than
    ``FAN`` chunks of it together. Lines of one row and role form a turn.

    Returns ``conv_id, turn, part, role, text, rendered``; ``part`` counts the turns of a row.
    A null or empty text is one empty line; null ids are one conversation; repeated rows and
    equal turn numbers follow each other in order of role and text. Empty tables give no rows.
    """
    rows = numbered(turns)
    model = learn(rows)
    keys = [*_KEY, "chunk"]

    def measured(batches):
        for table, cuts in sorted_groups(batches, keys):
            out = [through(Lines(table, int(b), int(e)).steps(model)).ravel()
                   for b, e in zip(cuts[:-1], cuts[1:])]
            yield {k: table.column(k).to_numpy()[cuts[:-1]] for k in keys} | {"best": out}

    sorted_rows = rows.repartition(*keys).sortWithinPartitions(*keys, "place")
    levels = [materialize(arrow_map(
        sorted_rows, measured, "conv long, _nil int, chunk long, best array<double>"), "chunks")]
    last = rows.agg(F.max("chunk")).first()[0] or 0
    while last >= FAN:
        levels.append(summarised(levels[-1], "chunk-groups"))
        last //= FAN
    ends = None
    for level in reversed(levels):
        ends = scanned(level, ends)

    def decoded(batches):
        for table, cuts in sorted_groups(batches, keys):
            out = {c: [] for c in ("conv_id", "turn", "part", "role", "text", "rendered")}
            convs, numbers = table.column("conv_id").to_pylist(), table.column("turn").to_pylist()
            firsts = [table.column(c).take(pa.array(cuts[:-1])).to_pylist() for c in ("before", "after")]
            for b, e, entry, leave in zip(cuts[:-1], cuts[1:], *firsts):
                lines = Lines(table, int(b), int(e))
                path = best_path(lines.steps(model), np.array(entry), np.array(leave))
                turn: list = []
                for row, name, rest, state in zip(lines.row.tolist(), lines.named.tolist(), lines.rest, path):
                    if turn and turn[0] == row and turn[1] == state and name < 0:
                        turn[3].append(rest)
                        continue
                    part = turn[2] + 1 if turn and turn[0] == row else 0
                    if turn:
                        put(out, convs, numbers, int(b), turn)
                    turn = [row, state, part, [rest]]
                put(out, convs, numbers, int(b), turn)
            yield out

    def put(out, convs, numbers, begin, turn):
        row, state, part, lines = turn
        text = "\n".join(lines)
        for name, value in zip(out, (
                convs[begin + row], numbers[begin + row], part, ROLES[state], text,
                render(ROLES[state], text))):
            out[name].append(value)

    joined = rows.join(ends, keys).repartition(*keys).sortWithinPartitions(*keys, "place")
    return arrow_map(
        joined.select("conv_id", "turn", "role", "text", *keys, "before", "after"), decoded,
        "conv_id long, turn long, part int, role string, text string, rendered string")
