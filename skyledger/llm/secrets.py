"""Secret scans with one deterministic automaton for all rules.

Rule patterns (a small regular language: literals, classes, groups, alternation, ``? * + {n} {n,}``) become automata by
subset construction, which are minimised, multiplied into one, and minimised again: one table of states by byte classes.
The product can double with each rule. Beyond STATES its states are made when a text first reaches them, from the rules'
minimised tables, and are forgotten when there are STATES of them, so that any number of rules takes bounded memory.
Texts are read once, byte by byte, whatever the rules. The few moves that begin, confirm or end a match carry marks, so
that the pass itself gives where matches lie, and its time is in proportion to the text. No rule crosses a line.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import ship


@dataclass(frozen=True)
class Rule:
    """``head`` is the part of a match whose length is bounded, ``tail`` what follows. ``least``: fewest characters of the
    match, or with ``value`` of what follows from the first character that completes it."""

    kind: str
    head: str
    tail: str
    fold: bool = False
    least: int = 0
    value: bool = False


#: The first three are the base kinds, in their order.
RULES = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)", r"[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+", True, 6, True),
    Rule("access", r"AKIA", r"[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24}", r"[0-9a-f]*"),
    Rule("github", r"gh[pousr]_", r"[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-", r"[A-Za-z0-9-]+", least=15),
    Rule("jwt", r"eyJ", r"[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=30),
    Rule("private_key", r"-----BEGIN\x20", r"[A-Z\x20]*PRIVATE\x20KEY-----"),
)
BASE = ("assign", "access", "hex")


class _Builder:
    """Nondeterministic automaton of the rules, Thompson's way: ``step[s]`` is (bytes, next), ``free[s]`` the empty moves."""

    def __init__(self) -> None:
        self.step: list[tuple[frozenset[int], int] | None] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.step.append(None)
        self.free.append([])
        return len(self.step) - 1

    def piece(self, node: tuple, start: int, fold: bool) -> int:
        """Adds ``node`` behind ``start``; its end state."""
        op = node[0]
        if op == "set":
            end = self.state()
            own = self.state()
            self.free[start].append(own)
            letters = node[1] | {c ^ 32 for c in node[1] if fold and chr(c).isalpha()}
            self.step[own] = (frozenset(letters), end)
            return end
        if op == "seq":
            for x in node[1]:
                start = self.piece(x, start, fold)
            return start
        if op == "alt":
            end = self.state()
            for x in node[1]:
                self.free[self.piece(x, start, fold)].append(end)
            return end
        _, inner, least, most = node
        for _ in range(least):
            start = self.piece(inner, start, fold)
        end = self.state()
        self.free[start].append(end)
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.piece(inner, loop, fold)].extend((loop, end))
        elif most > least:
            self.free[self.piece(inner, start, fold)].append(end)
        return end

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


_TOKEN = re.compile(r"\\x[0-9a-fA-F]{2}|\\.|\[(?:\\.|[^\]])+\]|\{\d+,?\}|[()|?*+]|.", re.S)


def _byte(token: str) -> int:
    return int(token[2:], 16) if token.startswith("\\x") else ord(token[-1])


def _class(body: str) -> set[int]:
    items = re.findall(r"\\x[0-9a-fA-F]{2}|\\.|.", body)
    out, i = set(), 0
    while i < len(items):
        if i + 2 < len(items) and items[i + 1] == "-":
            out |= set(range(_byte(items[i]), _byte(items[i + 2]) + 1))
            i += 3
        else:
            out.add(_byte(items[i]))
            i += 1
    return out


def _parse(tokens: list[str]) -> tuple:
    options, seq = [], []
    while tokens and tokens[0] != ")":
        t = tokens.pop(0)
        if t == "|":
            options.append(("seq", seq))
            seq = []
            continue
        if t == "(":
            seq.append(_parse(tokens))
            tokens.pop(0)
        elif t[0] == "[" and len(t) > 1:
            seq.append(("set", _class(t[1:-1])))
        elif t in "?*+" or (t[0] == "{" and len(t) > 1):
            least = {"?": 0, "*": 0, "+": 1}.get(t)
            least = int(t.strip("{,}")) if least is None else least
            seq[-1] = ("rep", seq[-1], least, 1 if t == "?" else None if t[-2:-1] == "," or len(t) == 1 else least)
        else:
            seq.append(("set", {_byte(t)}))
    return ("alt", [*options, ("seq", seq)]) if options else ("seq", seq)


#: Marks of a move: a match may have begun (with how many bytes it has), it is complete, it has ended before this byte.
SAVE, HIT, END = "save", "hit", "end"
#: One thread of a rule: its nondeterministic states; bytes since its start while these are known, else the register that
#: holds the start; whether it is complete.
Thread = tuple[frozenset, int, int, bool]


class _Component:
    """The automaton of one rule. A state is the threads of all starts that may still match, the earliest first.

    Once the earliest is complete, the others overlap it and go. A thread is left out of the states that earlier ones have.
    """

    def __init__(self, rule: Rule) -> None:
        self.rule, self.nfa = rule, _Builder()
        start = self.nfa.state()
        head = self.nfa.piece(_parse(_TOKEN.findall(rule.head)), start, rule.fold)
        first_of_tail = len(self.nfa.step)
        entry = self.nfa.state()
        self.nfa.free[head].append(entry)
        self.final = self.nfa.piece(_parse(_TOKEN.findall(rule.tail)), entry, rule.fold)
        self.tail = frozenset(range(first_of_tail, len(self.nfa.step)))
        self.start = self.nfa.closure({start})

    def sets(self) -> set[frozenset]:
        return {s[0] for s in self.nfa.step if s}

    def _step(self, states: frozenset, byte: int) -> frozenset:
        return self.nfa.closure({s[1] for x in states if (s := self.nfa.step[x]) and byte in s[0]})

    def _move(self, threads: tuple[Thread, ...], byte: int) -> tuple[tuple[Thread, ...], tuple]:
        marks, out, seen = [], [], set()
        for states, depth, register, complete in (*threads, (self.start, 0, -1, False)):
            new = self._step(states, byte) if byte >= 0 else frozenset()
            if complete:
                if new and self.final not in new:
                    raise ValueError(f"{self.rule.kind}: a match must stay complete until it ends")
                if new:
                    return ((new, -1, register, True),), ()
                marks.append((END,))
            elif new := new - seen:
                seen |= new
                out.append((new, depth + 1 if depth >= 0 else -1, register, False))
        used = {r for _, _, r, _ in out}
        for i, (states, depth, register, _) in enumerate(out):
            if depth >= 0 and states & self.tail:
                register = next(r for r in range(len(out) + 1) if r not in used)
                used.add(register)
                marks.append((SAVE, register, depth))
                out[i] = (states, -1, register, False)
            if self.final in states:
                if i:
                    raise ValueError(f"{self.rule.kind}: a later start must not be complete before an earlier one")
                marks.append((HIT, register))
                return ((states, -1, register, True),), tuple(marks)
        return tuple(out), tuple(marks)

    def table(self, samples: list[int]) -> tuple[list[list[int]], list[list[tuple]]]:
        """Next state and marks by state and byte class (a byte of each; -1: the text ends)."""
        index: dict[tuple, int] = {(): 0}
        todo, rows, marks = [()], [], []
        for threads in todo:  # subset construction; ``todo`` grows
            moves = [self._move(threads, b) for b in samples]
            for target, _ in moves:
                if target not in index:
                    index[target] = len(index)
                    todo.append(target)
            rows.append([index[t] for t, _ in moves])
            marks.append([m for _, m in moves])
        return minimised(rows, marks)


def minimised(rows: list[list[int]], marks: list[list[tuple]]) -> tuple[list[list[int]], list[list[tuple]]]:
    """States that behave alike as one (partition refinement); the first state stays the first."""
    names: dict[tuple, int] = {}
    output = np.array([[names.setdefault(m, len(names)) for m in row] for row in marks])
    moves, part = np.array(rows), np.zeros(len(rows), dtype=np.int64)
    while True:
        _, new = np.unique(np.hstack([output, part[moves], part[:, None]]), axis=0, return_inverse=True)
        new = new.reshape(-1)
        if new.max() == part.max():
            break
        part = new
    first = np.unique(part, return_index=True)[1]
    order = np.argsort(first)  # in order of first appearance
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return place[part[moves[first[order]]]].tolist(), [marks[i] for i in first[order].tolist()]


#: States of the product of all rules that are held at once.
STATES = 10_000


class Automaton:
    """All rules as one table: ``classes`` (class of each byte), ``rows[state][class]`` the next state, ``marks`` the moves
    that have any: (state, class) to a list of (rule, mark...). The last class is the end of the text; state 0 starts.
    Where the product has over ``states`` states there are only the rules' own ``tables``, and ``rows`` is None."""

    def __init__(self, rules: tuple[Rule, ...] = RULES, states: int = STATES) -> None:
        parts = [_Component(r) for r in rules]
        letters = [s for p in parts for s in p.sets()]
        kinds: dict[tuple, int] = {}
        self.classes = bytes(kinds.setdefault(tuple(b in s for s in letters), len(kinds)) for b in range(256))
        self.tables = [p.table([*(self.classes.index(c) for c in range(len(kinds))), -1]) for p in parts]
        self.end, self.start, self.states = len(kinds), (0,) * len(parts), states
        self.rows, self.marks = None, {}
        index, todo, rows, marks = {self.start: 0}, [self.start], [], []
        for at in todo:  # the product of the rules' automata, as far as it can be reached; ``todo`` grows
            moves = [self.move(at, c) for c in range(self.end + 1)]
            for _, target in moves:
                if target not in index:
                    index[target] = len(index)
                    todo.append(target)
            if len(todo) > states:
                return
            rows.append([index[t] for _, t in moves])
            marks.append([m for m, _ in moves])
        self.rows, marks = minimised(rows, marks)
        self.marks = {(s, c): m for s, row in enumerate(marks) for c, m in enumerate(row) if m}

    def move(self, at: tuple[int, ...], c: int) -> tuple[tuple, tuple[int, ...]]:
        """Marks and the next states of all rules, from their states and a byte class."""
        pairs = list(zip(self.tables, at, strict=True))
        marks = tuple((k, *m) for k, (t, s) in enumerate(pairs) for m in t[1][s][c])
        return marks, tuple([t[0][s][c] for t, s in pairs])


class Scanner:
    """Spans of all rules in a text."""

    def __init__(self, rules: tuple[Rule, ...] = RULES, automaton: Automaton | None = None) -> None:
        self.rules, self.automaton = rules, automaton or Automaton(rules)
        # The rows refer to one another, so that a byte costs one look-up; moves with marks, or not made so far, are None there.
        self._forget()
        if self.automaton.rows is not None:
            self.rows = rows = [[] for _ in self.automaton.rows]
            for s, (row, ids) in enumerate(zip(rows, self.automaton.rows, strict=True)):
                row[:] = [None if (s, c) in self.automaton.marks else rows[t] for c, t in enumerate(ids)]
                row.append(s)
            self.moves = {(s, c): (m, rows[self.automaton.rows[s][c]]) for (s, c), m in self.automaton.marks.items()}

    def _forget(self) -> None:
        """Holds no state but the first."""
        self.rows: list[list] = []
        self.moves: dict[tuple[int, int], tuple[tuple, list]] = {}
        self.index: dict[tuple, int] = {}
        self.at: list[tuple] = []
        self._row(self.automaton.start)

    def _row(self, at: tuple[int, ...]) -> list:
        if at not in self.index:
            self.index[at] = len(self.rows)
            self.at.append(at)
            self.rows.append([None] * (self.automaton.end + 1) + [len(self.rows)])
        return self.rows[self.index[at]]

    def _made(self, state: int, c: int) -> tuple[tuple, list]:
        """A move that no text has made so far: its marks and the row of the next state."""
        marks, target = self.automaton.move(self.at[state], c)
        if target not in self.index and len(self.rows) >= self.automaton.states:
            self._forget()
            return marks, self._row(target)
        row = self._row(target)
        if marks:
            self.moves[state, c] = marks, row
        else:
            self.rows[state][c] = row
        return marks, row

    def _found(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end), leftmost longest and without overlap for each rule, in bytes."""
        end, rules = self.automaton.end, self.rules
        symbols = data.translate(self.automaton.classes) + bytes([end])
        each, n = iter(symbols), len(symbols)
        saved: dict[tuple[int, int], int] = {}
        start, value = [0] * len(rules), [0] * len(rules)
        row, out = self.rows[0], []
        while True:
            for b in each:
                last = row
                row = row[b]
                if row is None:
                    break
            else:
                return out
            at, move = n - each.__length_hint__() - 1, (last[-1], b)
            marks, row = self.moves.get(move) or self._made(*move)
            for k, mark, *more in marks:
                if mark == SAVE:
                    saved[k, more[0]] = at + 1 - more[1]
                elif mark == HIT:
                    start[k], value[k] = saved[k, more[0]], at
                elif at - (value[k] if rules[k].value else start[k]) >= rules[k].least:
                    out.append((start[k], k, at))

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start and then kind as listed."""
        if not text:
            return []
        data = text.encode("utf-8", "surrogatepass")
        found = sorted(self._found(data))
        if len(data) > len(text):
            # Code points before each place, counted once from place to place.
            chars, done, places = 0, 0, {}
            for x in sorted({x for a, _, e in found for x in (a, e)}):
                chars += len(data[done:x].decode("utf-8", "surrogatepass"))
                places[x], done = chars, x
            found = [(places[a], k, places[e]) for a, k, e in found]
        return [(self.rules[k].kind, a, e) for a, k, e in found]


_scanners: dict[tuple, Scanner] = {}
_automaton = lru_cache(maxsize=4)(Automaton)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans (array of kind, start, end; code points, end exclusive) of every row of ``docs``.

    Null and empty texts have none. Repeated rows and null ids are rows like any other; an empty table gives an empty
    result; other columns are ignored. One match of a rule ends before the next of that rule starts; different rules may
    overlap.
    """
    ship(docs.sparkSession)
    schema = "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    automaton = _automaton(rules)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanners.get(rules) or _scanners.setdefault(rules, Scanner(rules, automaton))
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": e} for k, a, e in scanner.spans(t.as_py())] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, spans_type)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of ``scan_secrets``."""
    of = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.size(of([k])).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(of(BASE)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
