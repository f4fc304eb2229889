"""Secret scans by one combined automaton.

Each rule is a regular expression. Its positions become a deterministic
automaton by subset construction, with the threads of an unanchored search
kept in order of age, so that the leftmost match wins and is as long as it can
be; then a product over all rules is built and minimised into transition
arrays. A text's bytes are read once for all rules together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

ALL = frozenset(range(256))


@dataclass(frozen=True)
class Rule:
    """name, pattern, the least length of a match, and a character from whose last run on the length counts (``value``: only what follows the last separator of the match's head counts)."""

    name: str
    pattern: str
    least: int = 1
    value: bool = False


#: The base rules come first. The counted repetition in "hex" finds the same matches as the uncounted one with that least length, as runs of the class are maximal.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}", 16),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 24),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 16),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")


class Positions:
    """The position automaton of a pattern: literals, classes, groups, ``|``, ``? * + {n} {n,}``, ``(?i:...)``, ``\\xHH``."""

    def __init__(self, pattern: str) -> None:
        self.classes: list[frozenset[int]] = []
        self.follow: list[set[int]] = []
        self.text, self.at = pattern, 0
        self.none, self.first, self.last = self._either(False)
        if self.at != len(pattern):
            raise ValueError(f"cannot read {pattern!r} from {self.at}")
        if self.none:
            raise ValueError(f"{pattern!r} matches the empty text")

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _either(self, fold: bool):
        none, first, last = self._row(fold)
        while self._peek() == "|":
            self.at += 1
            n, f, la = self._row(fold)
            none, first, last = none or n, first | f, last | la
        return none, first, last

    def _row(self, fold: bool):
        none, first, last = True, frozenset(), frozenset()
        while self._peek() not in ("", "|", ")"):
            n, f, la = self._repeated(fold)
            self._link(last, f)
            none, first, last = none and n, first | f if none else first, last | la if n else la
        return none, first, last

    def _link(self, last, first) -> None:
        for p in last:
            self.follow[p] |= first

    def _repeated(self, fold: bool):
        begin = self.at
        part = self._atom(fold)
        c = self._peek()
        if c and c in "?*+":
            self.at += 1
            if c != "?":
                self._link(part[2], part[1])
            return part[0] or c != "+", part[1], part[2]
        if c == "{":
            to = self.text.index("}", self.at)
            after, body = to + 1, self.text[self.at + 1 : to]
            least = int(body.rstrip(","))
            none, first, last = part
            for i in range(1, least):
                self.at = begin
                n, f, la = self._atom(fold)
                self._link(last, f)
                first, last, none, part = (first | f if none else first), (last | la if n else la), none and n, (n, f, la)
            if body.endswith(","):
                self._link(part[2], part[1])
            self.at = after
            return none, first, last
        return part

    def _atom(self, fold: bool):
        c = self.text[self.at]
        self.at += 1
        if c == "(":
            if self.text.startswith("?i:", self.at):
                self.at, fold = self.at + 3, True
            elif self.text.startswith("?:", self.at):
                self.at += 2
            out = self._either(fold)
            self.at += 1
            return out
        if c == "[":
            members: set[int] = set()
            while (c := self.text[self.at]) != "]":
                low = self._one()
                if self._peek() == "-" and self.text[self.at + 1] != "]":
                    self.at += 1
                    members |= set(range(low, self._one() + 1))
                else:
                    members.add(low)
            self.at += 1
        else:
            self.at -= 1
            members = {self._one()}
        if fold:
            members |= {ord(chr(m).swapcase()) for m in members if chr(m).isascii() and chr(m).isalpha()}
        self.classes.append(frozenset(members))
        self.follow.append(set())
        p = frozenset([len(self.classes) - 1])
        return False, p, p

    def _one(self) -> int:
        c = self.text[self.at]
        if c == "\\":
            if self.text[self.at + 1] == "x":
                self.at += 4
                return int(self.text[self.at - 2 : self.at], 16)
            self.at += 1
            c = self.text[self.at]
        self.at += 1
        return ord(c)


class Search:
    """Steps of one rule's unanchored search. A state is the tuple of thread groups, the oldest first; the oldest may hold a match, and then there are no younger ones."""

    def __init__(self, rule: Rule) -> None:
        self.nfa = p = Positions(rule.pattern)
        if any(q not in p.last for x in p.last for q in p.follow[x]):
            raise ValueError(f"{rule.name}: a match must grow one byte at a time or end")
        if not p.first.isdisjoint(p.last):
            raise ValueError(f"{rule.name}: a match must have two bytes at least")
        self.start = ()

    def matched(self, state: tuple) -> bool:
        return bool(state) and not self.nfa.last.isdisjoint(state[0])

    def step(self, state: tuple, byte: int) -> tuple:
        p, seen, out = self.nfa, set(), []
        held = self.matched(state)
        for group in state:
            g = frozenset(q for x in group for q in p.follow[x] if byte in p.classes[q]) - seen
            if held and g:
                return (g & p.last,)
            if g:
                seen |= g
                out.append(g)
                if not p.last.isdisjoint(g):
                    break
        else:
            if g := frozenset(q for q in p.first if byte in p.classes[q]) - seen:
                out.append(g)
        for i, g in enumerate(out):
            if not p.last.isdisjoint(g):
                return tuple(out[: i + 1]) if i else (g & p.last,)
        return tuple(out)


@dataclass(frozen=True)
class Automaton:
    """kinds: the class of each byte; rows[s][class]: the next state, or its complement where a match of some rule ends before the byte; held[s]: the rules with a match in progress, as bits; back: each rule's positions and the positions before each."""

    rules: tuple[Rule, ...]
    kinds: bytes
    rows: tuple[tuple[int, ...], ...]
    held: tuple[int, ...]
    back: tuple[tuple[Positions, tuple[frozenset[int], ...]], ...]


@lru_cache(4)
def compiled(rules: tuple[Rule, ...] = RULES) -> Automaton:
    """The minimised automaton of all rules. It depends on the rules alone."""
    searches = [Search(r) for r in rules]
    sets = {c for s in searches for c in s.nfa.classes}
    kinds: dict[tuple, int] = {}
    kind = [kinds.setdefault(tuple(b in c for c in sets), len(kinds)) for b in range(256)]
    sample = [kind.index(k) for k in range(len(kinds))]
    memo: list[dict] = [{} for _ in searches]

    def step(i: int, state: tuple, k: int) -> tuple:
        if (state, k) not in memo[i]:
            memo[i][state, k] = searches[i].step(state, sample[k])
        return memo[i][state, k]

    states = {tuple(s.start for s in searches): 0}
    order, nexts, held = list(states), [], []
    for state in order:
        held.append(sum(s.matched(x) << i for i, (s, x) in enumerate(zip(searches, state, strict=True))))
        row = []
        for k in range(len(sample)):
            t = tuple(step(i, x, k) for i, x in enumerate(state))
            if t not in states:
                states[t] = len(order)
                order.append(t)
            row.append(states[t])
        nexts.append(row)
    ends = [[held[s] & ~held[t] for t in nexts[s]] for s in range(len(order))]
    block = {s: (held[s], tuple(map(bool, ends[s]))) for s in range(len(order))}
    names: dict = {}
    label = [names.setdefault(block[s], len(names)) for s in range(len(order))]
    while True:  # Moore's refinement: states with one label and the same labels after every byte stay together
        names = {}
        finer = [names.setdefault((label[s], *(label[t] for t in nexts[s])), len(names)) for s in range(len(order))]
        if len(names) == len(set(label)):
            break
        label = finer
    first: dict[int, int] = {}
    for s, name in enumerate(label):
        first.setdefault(name, s)
    number = {name: i for i, name in enumerate(sorted(first, key=lambda x: x != label[0]))}
    rows: list[tuple[int, ...]] = [()] * len(first)
    kept = [0] * len(first)
    for name, s in first.items():
        to = [number[label[t]] for t in nexts[s]]
        rows[number[name]] = tuple(~t if e else t for t, e in zip(to, ends[s], strict=True))
        kept[number[name]] = held[s]
    back = []
    for s in searches:
        before: list[set[int]] = [set() for _ in s.nfa.classes]
        for p, f in enumerate(s.nfa.follow):
            for q in f:
                before[q].add(p)
        back.append((s.nfa, tuple(map(frozenset, before))))
    return Automaton(rules, bytes(kind), tuple(rows), tuple(kept), tuple(back))


def _begin(nfa: Positions, before: tuple[frozenset[int], ...], data: bytes, end: int, floor: int) -> int:
    """The leftmost begin, floor or later, of a match that ends at end: the positions run backwards."""
    now, at, best = nfa.last, end, end
    while now and at > floor:
        at -= 1
        now = {p for p in now if data[at] in nfa.classes[p]}
        if not nfa.first.isdisjoint(now):
            best = at
        now = frozenset(q for p in now for q in before[p])
    return best


def _least(rule: Rule, piece: bytes) -> bool:
    if not rule.value:
        return len(piece) >= rule.least
    head = min(i for i in (piece.find(b":"), piece.find(b"=")) if i >= 0) + 1
    rest = piece[head:].lstrip(b" ")
    return len(rest[1:] if rest[:1] in (b'"', b"'") else rest) >= rule.least


def scan(data: bytes, auto: Automaton | None = None) -> list[tuple[int, int, int]]:
    """(rule's index, start, end) in bytes of all matches, leftmost and not overlapping for each rule."""
    auto = auto or compiled()
    rows, held, out = auto.rows, auto.held, []
    floor = [0] * len(auto.rules)

    def ended(bits: int, at: int) -> None:
        for i, rule in enumerate(auto.rules):
            if bits >> i & 1:
                begin = _begin(*auto.back[i], data, at, floor[i])
                floor[i] = at
                if _least(rule, data[begin:at]):
                    out.append((i, begin, at))

    row, was = rows[0], 0
    for at, kind in enumerate(data.translate(auto.kinds)):
        state = row[kind]
        if state < 0:
            state = ~state
            ended(held[was] & ~held[state], at)
        row = rows[state]
        was = state
    ended(held[was], len(data))
    return out


def found(text: str, auto: Automaton | None = None) -> list[tuple[int, int, int]]:
    """As scan(), with starts and ends in code points, which are counted once from begin to end."""
    data = text.encode("utf-8", "surrogatepass")
    hits = scan(data, auto)
    if len(data) == len(text) or not hits:
        return hits
    leads = np.frombuffer(data, np.uint8) & 0xC0 != 0x80
    place, last, n = {}, 0, 0
    for at in sorted({x for _, *span in hits for x in span}):
        n += int(np.count_nonzero(leads[last:at]))
        place[at], last = n, at
    return [(i, place[s], place[e]) for i, s, e in hits]


SCHEMA = "doc_id long, spans array<struct<kind:string,start:int,end:int>>"


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id and the spans of every rule, by start, then by the order of the rules.

    A null text counts as empty and has no spans; repeated rows give repeated
    rows; an empty table gives an empty result; other columns are not looked at.
    A very long text takes time and memory in proportion to its length. Map-only:
    no shuffle, whatever the size.
    """
    common.ready(docs.sparkSession)
    auto = compiled(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches):
            spans = [[{"kind": rules[i].name, "start": s, "end": e} for s, i, e in sorted((s, i, e) for i, s, e in found(t, auto))] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))], ["doc_id", "spans"])

    return common.texts(docs).mapInArrow(common.tidy(run), SCHEMA)


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
