"""Secret scan: all rules in one minimised automaton over bytes.

The rules' regexes are parsed, joined in one nondeterministic automaton that may start anywhere,
made deterministic by subset construction over byte classes and minimised by partition refinement.
One pass over a text's bytes then names the rules that occur in it; only for those, the exact spans
follow.
"""

from __future__ import annotations

import re
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from termloom.llm.bytesops import mix
from termloom.llm.storage import worker_state

# Kinds in their order, the form that the automaton reports (a necessary beginning, short
# so that the rules' counters do not multiply), and the exact form with the least length of group "v".
RULES = {
    "assign": (
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]""",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(?P<v>[A-Za-z0-9+/_.=-]+)""",
        6,
    ),
    "access": (r"AKIA[A-Z0-9]{4}", r"(?P<v>AKIA[A-Z0-9]+)", 20),
    "hex": (r"[0-9a-f]{12}", r"(?P<v>[0-9a-f]+)", 24),
    "github": (r"gh[pousr]_", r"(?P<v>gh[pousr]_[A-Za-z0-9]+)", 24),
    "slack": (r"xox[abprs]-", r"(?P<v>xox[abprs]-[A-Za-z0-9-]+)", 15),
    "private_key": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"(?P<v>-----BEGIN [A-Z ]*PRIVATE KEY-----)", 1),
}
BASE = ("assign", "access", "hex")


def _nfa(rules: list[str]):
    """Byte moves, empty moves and the accepting state of each rule; state 0 starts all."""
    moves: list[list[tuple[frozenset, int]]] = [[]]
    empty: list[list[int]] = [[]]

    def new() -> int:
        moves.append([])
        empty.append([])
        return len(moves) - 1

    def members(item, fold: bool) -> frozenset:
        kind, value = item
        name = str(kind)
        if name == "LITERAL":
            got = {value}
        elif name == "RANGE":
            got = set(range(value[0], value[1] + 1))
        elif name == "IN":
            flip = str(value[0][0]) == "NEGATE"
            got = set().union(*(members(v, fold) for v in value[flip:]))
            got = set(range(256)) - got if flip else got
        else:
            raise ValueError(f"{name} is not supported in a rule")
        if fold:
            got |= {ord(chr(b).swapcase()) for b in got if b < 128}
        return frozenset(b for b in got if b < 256)

    def build(tree, at: int, fold: bool) -> int:
        for kind, value in tree:
            name = str(kind)
            if name == "MAX_REPEAT":
                least, most, sub = value
                for _ in range(least):
                    at = build(sub, at, fold)
                if most == _parser.MAXREPEAT:
                    loop = new()
                    empty[at].append(loop)
                    empty[build(sub, loop, fold)].append(loop)
                    at = loop
                else:
                    ends = [at]
                    for _ in range(most - least):
                        at = build(sub, at, fold)
                        ends.append(at)
                    at = new()
                    for end in ends:
                        empty[end].append(at)
            elif name == "SUBPATTERN":
                at = build(value[3], at, fold or bool(value[1] & re.IGNORECASE))
            elif name == "BRANCH":
                end = new()
                for sub in value[1]:
                    first = new()
                    empty[at].append(first)
                    empty[build(sub, first, fold)].append(end)
                at = end
            else:
                after = new()
                moves[at].append((members((kind, value), fold), after))
                at = after
        return at

    accepts = {}
    for i, rule in enumerate(rules):
        first = new()
        empty[0].append(first)
        accepts[build(_parser.parse(rule), first, False)] = i
    return moves, empty, accepts


def automaton(rules: list[str]) -> tuple[bytes, list[int], int, list[tuple[int, ...]]]:
    """(class of each byte, flat transitions times the number of classes, first accepting, its rules)."""
    moves, empty, accepts = _nfa(rules)
    sets = list({s for row in moves for s, _ in row})
    marks = [tuple(b in s for s in sets) for b in range(256)]
    names = {m: i for i, m in enumerate(dict.fromkeys(marks))}
    classes = bytes(names[m] for m in marks)
    width = len(names)
    pick = [classes.index(i) for i in range(width)]

    def closure(states) -> frozenset:
        todo, got = list(states), set(states)
        while todo:
            for s in empty[todo.pop()]:
                if s not in got:
                    got.add(s)
                    todo.append(s)
        return frozenset(s for s in got if moves[s] or s in accepts)

    start = closure([0])
    known, order, table = {start: 0}, [start], []
    for states in order:
        row = []
        for b in pick:
            goal = closure({0} | {t for s in states for chars, t in moves[s] if b in chars})
            if goal not in known:
                known[goal] = len(order)
                order.append(goal)
            row.append(known[goal])
        table.append(row)
    table = np.array(table)
    says = [tuple(sorted(accepts[s] for s in states if s in accepts)) for states in order]

    # Minimise: states stay together while they say the same and move to the same groups.
    kinds = {v: i for i, v in enumerate(dict.fromkeys(says))}
    group = np.array([kinds[v] for v in says])
    weights = np.random.default_rng(1).integers(1, 1 << 62, width + 1, dtype=np.uint64) | np.uint64(1)
    while True:
        rows = np.column_stack([group, group[table]]).astype(np.uint64)  # compared by a 64-bit hash of each row
        _, finer = np.unique((mix(rows + np.uint64(1)) * weights).sum(axis=1, dtype=np.uint64), return_inverse=True)
        if finer.max() == group.max():
            break
        group = finer
    _, first = np.unique(group, return_index=True)
    ordered = sorted(range(len(first)), key=lambda g: (bool(says[first[g]]), g != group[0], g))
    place = np.empty(len(first), int)
    place[ordered] = np.arange(len(first))
    flat = (place[group[table[first[ordered]]]] * width).ravel().tolist()
    accepting = [says[first[g]] for g in ordered]
    n_plain = sum(not a for a in accepting)
    return classes, flat, n_plain * width, accepting[n_plain:]


def rules_in(text: bytes, machine) -> set[int]:
    """The rules that occur in a text, by one pass over its bytes."""
    classes, flat, first, says = machine
    width = max(classes) + 1
    state, found = 0, set()
    for c in text.translate(classes):
        state = flat[state + c]
        if state >= first:
            found.add(state)
    return {rule for s in found for rule in says[(s - first) // width]}


def spans_of(text: str, kinds: list[str]) -> list[tuple[int, int, str]]:
    """(start, kind's place, end) of the matches of these kinds, leftmost and non-overlapping per kind."""
    order, out = list(RULES), []
    for kind in kinds:
        _, exact, least = RULES[kind]
        for m in worker_state(f"secret_{kind}", lambda e=exact: re.compile(e, re.ASCII)).finditer(text):
            if m.end("v") - m.start("v") >= least:
                out.append((m.start(), order.index(kind), m.end()))
    return sorted(out)


SCHEMA = "doc_id long, spans array<struct<kind:string,start:int,end:int>>"


def _scan(shared):
    return lambda batches: _scanned(batches, shared.value)


def _scanned(batches, machine):
    names = list(RULES)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        rows = []
        for text in batch.column(1):
            text = text.as_py() or ""
            found = rules_in(text.encode(), machine)
            rows.append([{"kind": names[k], "start": s, "end": e} for s, k, e in spans_of(text, [names[i] for i in sorted(found)])])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every document: kind, start and end in code points (end exclusive).

    Ordered by start, then by the kind's place in RULES. NULL and empty texts have no span, equal
    texts equal spans; rows are judged alone, so any doc_id, NULL or repeated, is kept.
    """
    machine = docs.sparkSession.sparkContext.broadcast(automaton([r[0] for r in RULES.values()]))
    return docs.select("doc_id", "text").mapInArrow(_scan(machine), SCHEMA)
