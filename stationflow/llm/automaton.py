"""Deterministic automata over bytes, compiled from a plain subset of regular expressions.

A rule is parsed into a small nondeterministic automaton; the automata of all rules are
joined, made deterministic by subset construction and minimised by refining classes of
states. The result is one transition array over classes of bytes. ``scan`` moves many
lanes of a buffer through it at once: each lane starts as if nothing came before it,
and the few lanes that disagree with the state in which their predecessor ended are run
again from there until both runs meet, so the states are those of a single pass.

Known syntax: literals, escapes (\\xHH, \\d, \\w, escaped punctuation), classes, groups,
``|``, ``?``, ``*``, ``+``, ``{m}``, ``{m,}``, ``{m,n}`` and a leading ``(?i)``.
"""

from __future__ import annotations

import numpy as np

ALL = frozenset(range(256))
_DIGITS = frozenset(range(48, 58))
_WORD = _DIGITS | frozenset(range(65, 91)) | frozenset(range(97, 123)) | {95}


def _either_case(chars: frozenset[int]) -> frozenset[int]:
    return chars | {c ^ 32 for c in chars if chr(c).isalpha() and c < 128}


class _Parser:
    """Pattern -> tree of ("set", bytes), ("cat", parts), ("alt", parts), ("rep", part, low, high)."""

    def __init__(self, pattern: str):
        self.fold = pattern.startswith("(?i)")
        self.p, self.at = pattern.removeprefix("(?i)"), 0

    def tree(self):
        parts = [self.sequence()]
        while self.p[self.at:self.at + 1] == "|":
            self.at += 1
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self):
        parts = []
        while self.at < len(self.p) and self.p[self.at] not in "|)":
            part = self.atom()
            while self.at < len(self.p) and self.p[self.at] in "?*+{":
                part = ("rep", part, *self.bounds())
            parts.append(part)
        return ("cat", parts)

    def bounds(self) -> tuple[int, int | None]:
        c = self.p[self.at]
        self.at += 1
        if c != "{":
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        end = self.p.index("}", self.at)
        low, comma, high = self.p[self.at:end].partition(",")
        self.at = end + 1
        return int(low), (int(high) if high else None if comma else int(low))

    def escape(self) -> frozenset[int]:
        c = self.p[self.at]
        self.at += 1
        if c == "x":
            self.at += 2
            return frozenset([int(self.p[self.at - 2:self.at], 16)])
        if c in "dw":
            return _DIGITS if c == "d" else _WORD
        if c.isalnum():
            raise ValueError(f"unknown escape \\{c}")
        return frozenset([ord(c)])

    def atom(self):
        c = self.p[self.at]
        self.at += 1
        if c == "(":
            inner = self.tree()
            self.at += 1
            return inner
        if c == "[":
            return ("set", self.char_class())
        chars = self.escape() if c == "\\" else frozenset([ord(c)])
        return ("set", _either_case(chars) if self.fold else chars)

    def char_class(self) -> frozenset[int]:
        negative = self.p[self.at] == "^"
        self.at += negative
        found: frozenset[int] = frozenset()
        while self.p[self.at] != "]":
            one = self.one()
            if self.p[self.at] == "-" and self.p[self.at + 1] != "]":
                self.at += 1
                one = frozenset(range(min(one), max(self.one()) + 1))
            found |= one
        self.at += 1
        found = _either_case(found) if self.fold else found
        return ALL - found if negative else found

    def one(self) -> frozenset[int]:
        self.at += 1
        c = self.p[self.at - 1]
        return self.escape() if c == "\\" else frozenset([ord(c)])


class _Nfa:
    """Edges on sets of bytes, empty edges, and the rule that ends in a state."""

    def __init__(self):
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []
        self.ends: dict[int, int] = {}

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def add(self, tree, start: int) -> int:
        """Build ``tree`` from ``start`` on; the state where it ends."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.edges[start].append((tree[1], end))
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                own = self.state()
                self.empty[start].append(own)
                self.empty[self.add(part, own)].append(end)
            return end
        _, part, low, high = tree
        for _ in range(low):
            start = self.add(part, start)
        if high is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(part, loop)].append(loop)
            end = self.state()
            self.empty[loop].append(end)
            return end
        ends = [start]
        for _ in range(high - low):
            start = self.add(part, start)
            ends.append(start)
        end = self.state()
        for e in ends:
            self.empty[e].append(end)
        return end

    def closed(self, states) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def _mirror(tree):
    if tree[0] == "cat":
        return ("cat", [_mirror(p) for p in reversed(tree[1])])
    if tree[0] == "alt":
        return ("alt", [_mirror(p) for p in tree[1]])
    return ("rep", _mirror(tree[1]), *tree[2:]) if tree[0] == "rep" else tree


class Automaton:
    """``step[state, class_of[byte]]`` is the next state, ``accepts[state]`` the rules that
    end there, as bits. State 0 is the start. With ``search`` a match may begin anywhere;
    without it, it begins at the first byte, and ``dead`` is the state of no return.
    ``backwards`` reads the patterns from their ends."""

    def __init__(self, patterns: list[str], search: bool = False, backwards: bool = False):
        nfa = _Nfa()
        root = nfa.state()
        for rule, pattern in enumerate(patterns):
            tree = _Parser(pattern).tree()
            own = nfa.state()
            nfa.empty[root].append(own)
            nfa.ends[nfa.add(_mirror(tree) if backwards else tree, own)] = rule
        sets = {s for edges in nfa.edges for s, _ in edges}
        kinds: dict[tuple, int] = {}
        self.class_of = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds))
                                  for b in range(256)], np.int64)
        sample = [int(np.argmax(self.class_of == c)) for c in range(len(kinds))]
        first = nfa.closed([root])
        number, todo, rows, accepts = {first: 0}, [first], [], []
        while todo:
            now = todo.pop(0)
            accepts.append(sum({1 << nfa.ends[s] for s in now if s in nfa.ends}))
            row = []
            for b in sample:
                to = nfa.closed([t for s in now for chars, t in nfa.edges[s] if b in chars])
                to = to | first if search else to
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                row.append(number[to])
            rows.append(row)
        self._minimise(np.array(rows, np.int64), np.array(accepts, np.int64))
        stuck = [s for s in range(len(self.step)) if (self.step[s] == s).all() and not self.accepts[s]]
        self.dead = stuck[0] if stuck and not search else -1

    def _minimise(self, step: np.ndarray, accepts: np.ndarray) -> None:
        """Split classes of states that accept alike until their transitions agree too."""
        group = np.unique(accepts, return_inverse=True)[1]
        while True:
            finer = np.unique(np.column_stack([group, group[step]]), axis=0, return_inverse=True)[1].ravel()
            if finer.max() == group.max():
                break
            group = finer
        order: dict[int, int] = {}
        for g in group.tolist():  # state 0 stays the start
            order.setdefault(g, len(order))
        member = {order[g]: s for s, g in enumerate(group.tolist())}
        named = np.array([order[g] for g in group.tolist()])
        chosen = [member[k] for k in range(len(order))]
        self.step, self.accepts = named[step[chosen]], accepts[chosen]

    def longest(self, data: bytes, start: int, end: int, rule: int = 0, back: bool = False) -> int:
        """Bytes of the longest match of ``rule`` from ``start`` on, not beyond ``end``
        (backwards: that ends at ``end`` and begins at ``start`` or later); -1 if none."""
        state, best = 0, 0 if self.accepts[0] >> rule & 1 else -1
        for n in range(end - start):
            state = self.step[state, self.class_of[data[end - 1 - n if back else start + n]]]
            if state == self.dead:
                break
            if self.accepts[state] >> rule & 1:
                best = n + 1
        return best

    def scan(self, data: np.ndarray, lane: int = 1024) -> np.ndarray:
        """The state after each byte, in one pass over the buffer."""
        width = self.step.shape[1]
        step = (self.step * width).astype(np.int32).ravel()  # states as offsets of their rows
        n = len(data)
        lanes = -(-n // lane)
        padded = np.zeros(lanes * lane, np.int32)
        padded[:n] = self.class_of[data]
        columns = np.ascontiguousarray(padded.reshape(lanes, lane).T)
        states = np.empty((lane, lanes), np.int32)
        now = np.zeros(lanes, np.int32)
        for j in range(lane):
            now = step[now + columns[j]]
            states[j] = now
        started = np.zeros(lanes, np.int32)
        while True:
            due = np.concatenate([[0], states[-1][:-1]]).astype(np.int32)
            wrong = np.nonzero(started != due)[0]
            if not len(wrong):
                break
            started[wrong] = due[wrong]
            now = due[wrong]
            for j in range(lane):
                now = step[now + columns[j, wrong]]
                open_ = states[j, wrong] != now
                wrong, now = wrong[open_], now[open_]
                if not len(wrong):
                    break
                states[j, wrong] = now
        return states.T.ravel()[:n] // width
