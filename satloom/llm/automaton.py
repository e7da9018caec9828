"""Regular expressions to one minimal deterministic automaton over bytes, and scans with it.

All rules are compiled together: Thompson's construction gives a nondeterministic automaton, the subset construction makes it
deterministic, and partition refinement makes it minimal. Bytes that no state tells apart share a class. A state knows, as a set of
bits, the rules that end there. Compiled backward and with a loop at its start, an automaton that reads a text from its end tells
where matches begin; compiled forward without the loop, one that reads on from there tells where they end.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Lanes of text stepped together; below FEW of them each is finished by itself.
FEW = 24
#: Lanes are read in pieces of so many bytes, each begun in the state that the WARM bytes read before it lead to.
LONG, WARM = 2048, 64
#: Bytes of a loop after which the rest of it is looked up at once.
LOOP = 32


@dataclass
class Nfa:
    """Edges by state: empty ones, and ones on sets of bytes (as 256-bit numbers)."""

    empty: list[list[int]] = field(default_factory=list)
    on: list[list[tuple[int, int]]] = field(default_factory=list)

    def state(self) -> int:
        self.empty.append([])
        self.on.append([])
        return len(self.empty) - 1


class Parser:
    """Literals, ``\\xHH`` and escaped characters, classes, ``(...)`` or ``(?:...)``, ``|``, ``? * +``, ``{m}``, ``{m,}`` and ``{m,n}``."""

    def __init__(self, pattern: str, nfa: Nfa, ignore_case: bool = False, backward: bool = False) -> None:
        self.p, self.i, self.nfa, self.ignore_case, self.backward = pattern, 0, nfa, ignore_case, backward

    def parse(self) -> tuple[int, int]:
        tree = self.either()
        if self.i != len(self.p):
            raise ValueError(f"unexpected {self.p[self.i]!r} at {self.i} of {self.p!r}")
        return self.build(tree)

    def either(self):
        options = [self.sequence()]
        while self.i < len(self.p) and self.p[self.i] == "|":
            self.i += 1
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("or", options)

    def sequence(self):
        items = []
        while self.i < len(self.p) and self.p[self.i] not in "|)":
            items.append(self.repeated())
        return ("seq", items)

    def repeated(self):
        item = self.atom()
        while self.i < len(self.p) and self.p[self.i] in "?*+{":
            c = self.p[self.i]
            if c == "{":
                end = self.p.index("}", self.i)
                low, comma, high = self.p[self.i + 1 : end].partition(",")
                least, most = int(low), (int(high) if high else None) if comma else int(low)
                self.i = end + 1
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
                self.i += 1
            item = ("rep", item, least, most)
        return item

    def atom(self):
        c = self.p[self.i]
        if c == "(":
            self.i += 3 if self.p.startswith("(?:", self.i) else 1
            inner = self.either()
            if self.p[self.i : self.i + 1] != ")":
                raise ValueError(f"no ) in {self.p!r}")
            self.i += 1
            return inner
        if c == "[":
            return ("set", self.char_class())
        return ("set", self.fold(1 << self.char()))

    def char(self) -> int:
        c = self.p[self.i]
        self.i += 1
        if c == "\\":
            c = self.p[self.i]
            self.i += 1
            if c == "x":
                self.i += 2
                return int(self.p[self.i - 2 : self.i], 16)
        if ord(c) > 127:
            raise ValueError("rules are written in ASCII")
        return ord(c)

    def char_class(self) -> int:
        self.i += 1
        negated = self.p[self.i] == "^"
        self.i += negated
        found = 0
        while self.p[self.i] != "]":
            low = high = self.char()
            if self.p[self.i] == "-" and self.p[self.i + 1] != "]":
                self.i += 1
                high = self.char()
            for b in range(low, high + 1):
                found |= 1 << b
        self.i += 1
        found = self.fold(found)
        return ((1 << 256) - 1) ^ found if negated else found

    def fold(self, chars: int) -> int:
        if self.ignore_case:
            for b in range(65, 91):
                if chars >> b & 1 or chars >> (b + 32) & 1:
                    chars |= 1 << b | 1 << (b + 32)
        return chars

    def build(self, tree) -> tuple[int, int]:
        a, z = self.nfa.state(), self.nfa.state()
        kind = tree[0]
        if kind == "set":
            self.nfa.on[a].append((tree[1], z))
        elif kind == "or":
            for option in tree[1]:
                s, e = self.build(option)
                self.nfa.empty[a].append(s)
                self.nfa.empty[e].append(z)
        elif kind == "seq":
            at = a
            for item in reversed(tree[1]) if self.backward else tree[1]:
                s, e = self.build(item)
                self.nfa.empty[at].append(s)
                at = e
            self.nfa.empty[at].append(z)
        else:
            _, item, least, most = tree
            at = a
            for _ in range(least):
                s, e = self.build(item)
                self.nfa.empty[at].append(s)
                at = e
            if most is None:
                s, e = self.build(item)
                self.nfa.empty[at] += [s, z]
                self.nfa.empty[e] += [s, z]
            else:
                self.nfa.empty[at].append(z)
                for _ in range(most - least):
                    s, e = self.build(item)
                    self.nfa.empty[at].append(s)
                    self.nfa.empty[e].append(z)
                    at = e
        return a, z


@dataclass(frozen=True)
class Dfa:
    """classes: of each byte; table[state, class]: the next state; accept[state]: bits of the rules that end there. It starts in 0."""

    classes: np.ndarray
    table: np.ndarray
    accept: np.ndarray
    rules: tuple[str, ...]


def subset_construction(nfa: Nfa, start: int, finals: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sets = sorted({s for edges in nfa.on for s, _ in edges})
    signature = [tuple(s >> b & 1 for s in sets) for b in range(256)]
    known: dict[tuple[int, ...], int] = {}
    classes = np.array([known.setdefault(x, len(known)) for x in signature], np.uint8)
    sample = [signature.index(x) for x in known]

    def closure(states: set[int]) -> frozenset[int]:
        todo, found = list(states), set(states)
        while todo:
            for t in nfa.empty[todo.pop()]:
                if t not in found:
                    found.add(t)
                    todo.append(t)
        return frozenset(s for s in found if nfa.on[s] or s in finals)

    first = closure({start})
    number, rows, accept, todo = {first: 0}, [], [], [first]
    for own in todo:
        accept.append(sum({finals[s] for s in own if s in finals}))
        row = []
        for b in sample:
            target = closure({t for s in own for chars, t in nfa.on[s] if chars >> b & 1})
            if target not in number:
                number[target] = len(todo)
                todo.append(target)
            row.append(number[target])
        rows.append(row)
    return classes, np.array(rows, np.int64), np.array(accept, np.int64)


def minimised(table: np.ndarray, accept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States told apart by no text become one: blocks are split by where their states lead, until none splits."""
    _, block = np.unique(accept, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    _, order = np.unique(block, return_index=True)
    # The start comes first, the rest in the order found.
    rank = np.empty(len(order), np.int64)
    rank[np.argsort(order)] = np.arange(len(order))
    keep = np.sort(order)
    return rank[block][table[keep]], accept[keep]


def compiled(rules: dict[str, tuple[str, bool]], backward: bool = False) -> Dfa:
    """``rules``: pattern and whether case is ignored, by name; at most 62 of them. Backward, a match may end anywhere in the text."""
    nfa = Nfa()
    start = nfa.state()
    if backward:
        nfa.on[start].append(((1 << 256) - 1, start))
    finals: dict[int, int] = {}
    for bit, (pattern, ignore_case) in enumerate(rules.values()):
        a, z = Parser(pattern, nfa, ignore_case, backward).parse()
        nfa.empty[start].append(a)
        finals[z] = 1 << bit
    classes, table, accept = subset_construction(nfa, start, finals)
    table, accept = minimised(table, accept)
    return Dfa(classes, table, accept, tuple(rules))


def starts(dfa: Dfa, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where in ``data`` matches of the backward automaton begin, in order, and the bits of their rules: one pass over the bytes.

    Bytes after which every state is the first one again cut the data into lanes, and long lanes are cut into pieces. A step takes a byte
    of each piece, from its end; the last few pieces go on alone. Pieces that were not begun in the state in which the one before ended
    (few bytes tell it, nearly always) are read again from that state.
    """
    resets = (dfa.table == 0).all(axis=0)
    width = dfa.table.shape[1]
    flat = (dfa.table * width).astype(np.int32).reshape(-1)
    accept = np.repeat(dfa.accept, width)
    any_accept, hop, mask = accept != 0, flat.tolist(), accept.tolist()
    codes = dfa.classes[np.frombuffer(data, np.uint8)]
    bounds = np.concatenate([[-1], np.flatnonzero(resets[codes]), [len(codes)]])
    lengths = np.diff(bounds) - 1
    pieces = -(-lengths // LONG)
    lane = np.repeat(np.arange(len(lengths)), pieces)
    nth = np.arange(len(lane)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    high = bounds[1:][lane] - 1 - nth * LONG
    size = np.minimum(LONG, lengths[lane] - nth * LONG)
    begun, later = np.zeros(len(lane), np.int32), np.flatnonzero(nth)
    for i in range(WARM, 0, -1):
        begun[later] = flat[begun[later] + codes[high[later] + i]]

    at: list[np.ndarray] = []
    bits: list[np.ndarray] = []
    whose: list[np.ndarray] = []

    def alone(s: int, piece: int, step: int) -> int:
        """Reads the rest of ``piece`` after ``step`` bytes; the state in which it ends."""
        first, found = int(high[piece]) - step, []
        for i, c in enumerate(reversed(codes[int(high[piece] - size[piece]) + 1 : first + 1].tolist())):
            s = hop[s + c]
            if mask[s]:
                found.append((first - i, mask[s]))
        if found:
            at.append(np.array([p for p, _ in found]))
            bits.append(np.array([m for _, m in found]))
            whose.append(np.full(len(found), piece))
        return s

    order = np.argsort(-size, kind="stable")
    end, falling, state = high[order], -size[order], begun[order]
    step = 0
    while True:
        live = int(np.searchsorted(falling, -step, side="left"))
        if live <= FEW:
            break
        now = flat[state[:live] + codes[end[:live] - step]]
        state[:live] = now
        seen = np.flatnonzero(any_accept[now])
        if len(seen):
            at.append(end[seen] - step)
            bits.append(accept[now[seen]])
            whose.append(order[seen])
        step += 1
    for i in range(live):
        state[i] = alone(int(state[i]), int(order[i]), step)
    ended = np.empty_like(state)
    ended[order] = state

    wrong = later[begun[later] != ended[later - 1]].tolist()
    again = np.zeros(len(lane), bool)
    last = len(at)
    for piece in wrong:
        while piece < len(lane) and nth[piece] and begun[piece] != ended[piece - 1]:
            begun[piece], again[piece] = ended[piece - 1], True
            ended[piece] = alone(int(begun[piece]), piece, 0)
            piece += 1
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if wrong:
        holds = [~again[w] if i < last else np.ones(len(w), bool) for i, w in enumerate(whose)]
        at, bits = [x[h] for x, h in zip(at, holds, strict=True)], [x[h] for x, h in zip(bits, holds, strict=True)]
    where, which = np.concatenate(at), np.concatenate(bits)
    order = np.argsort(where, kind="stable")
    return where[order], which[order]


class Walker:
    """The forward automaton, walked from one place on. What a state loops on is passed in whole arrays."""

    def __init__(self, dfa: Dfa) -> None:
        width = dfa.table.shape[1]
        self.hop = (dfa.table * width).reshape(-1).tolist()
        self.classes, self.accept = dfa.classes.tolist(), np.repeat(dfa.accept, width).tolist()
        own = np.arange(len(dfa.table))[:, None]
        self.dead = {int(s) * width for s in np.flatnonzero((dfa.table == own).all(axis=1) & (dfa.accept == 0))}
        self.stays = {int(s) * width: (dfa.table[s] == s)[dfa.classes] for s in np.flatnonzero((dfa.table == own).any(axis=1))}

    def leaves(self, s: int, data: bytes, at: int) -> int:
        """The first place from ``at`` on whose byte leads out of state ``s``."""
        n = 4 * LOOP
        while at < len(data):
            stay = self.stays[s][np.frombuffer(data, np.uint8, min(n, len(data) - at), at)]
            if not stay.all():
                return at + int(np.argmin(stay))
            at += len(stay)
            n *= 2
        return at

    def ends(self, data: bytes, begin: int, one: int, two: int) -> tuple[int, int]:
        """The last ends of matches of the rules with bits ``one`` and ``two`` that begin at ``begin``; -1 where there is none."""
        s, last_one, last_two, i, same = 0, -1, -1, begin, 0
        while i < len(data):
            before, s = s, self.hop[s + self.classes[data[i]]]
            if s in self.dead:
                break
            i += 1
            same = same + 1 if s == before else 0
            if same == LOOP:
                i, same = self.leaves(s, data, i), 0
            if self.accept[s] & one:
                last_one = i
            if self.accept[s] & two:
                last_two = i
        return last_one, last_two


__all__ = ["Dfa", "Walker", "compiled", "starts"]
