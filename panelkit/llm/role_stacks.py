"""A role grammar's LR automaton, its stacks as one shared graph, and the cheapest edits that make a row of roles a sentence.

Stacks share what lies below their tops (a graph-structured stack): a stack is (top state, stack below), and equal ones are
one node. The grammar must keep its stacks shallow (left recursion), so that they can be numbered. All rows read so far
lead to one (cost, audit) for each node: ways that meet in a node are merged to the least one.

Audits are compared without being written out: inserted rows come before the row they precede, so two audits over the
same rows both end with that row's own letter, and neither begins the other. Which of two ways is less then follows from
the order of the nodes they come from, and from the last step's letters where they come from the same node.
"""
from collections import defaultdict
from functools import cached_property

END = "$"
#: Conversations: perhaps a system row, then pairs of a user and an assistant row; or nothing at all.
ROLES = (("C", ""), ("C", "T"), ("T", "Hua"), ("T", "Tua"), ("H", ""), ("H", "s"))
#: Costs of a row that is left as it is, deleted, given another role, and inserted; and of a faulty row that stays.
KEEP, DELETE, REROLE, INSERT, FAULTY = 0, 4, 3, 3, 3
#: Numbered stacks beyond which a grammar isn't shallow.
SHALLOW = 10_000


class Automaton:
    """SLR(1) tables of a grammar: rules (left, right) over single characters, the first rule's left being the start."""

    def __init__(self, rules=ROLES):
        self.rules = [("^", rules[0][0]), *rules]
        self.left = {a for a, _ in self.rules}
        follow = self._follow()
        self.states, self.shifts, self.reduces = [self._closed({(0, 0)})], {}, {}
        for at, items in enumerate(self.states):            # grows on the way
            moved = defaultdict(set)
            for rule, dot in sorted(items):
                right = self.rules[rule][1]
                if dot < len(right):
                    moved[right[dot]].add((rule, dot + 1))
                else:
                    for t in {END} if rule == 0 else follow[self.rules[rule][0]]:
                        if self.reduces.setdefault((at, t), rule) != rule:
                            raise ValueError(f"two reductions before {t!r}")
            for symbol, kernel in moved.items():
                if (at, symbol) in self.reduces:
                    raise ValueError(f"a reduction and a shift before {symbol!r}")
                items_after = self._closed(kernel)
                if items_after not in self.states:
                    self.states.append(items_after)
                self.shifts[at, symbol] = self.states.index(items_after)

    def _closed(self, items: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            rule, dot = todo.pop()
            for k, (left, _) in enumerate(self.rules):
                if self.rules[rule][1][dot : dot + 1] == left and (k, 0) not in items:
                    items.add((k, 0))
                    todo.append((k, 0))
        return frozenset(items)

    def _follow(self) -> dict:
        """What may come after each left side."""
        empty, first, follow = set(), defaultdict(set), defaultdict(set, {"^": {END}})
        size = -1
        while size != (size := len(empty) + sum(map(len, [*first.values(), *follow.values()]))):
            for left, right in self.rules:
                if all(c in empty for c in right):
                    empty.add(left)
                for c in right:
                    first[left] |= first[c] if c in self.left else {c}
                    if c not in empty:
                        break
                after = set(follow[left])
                for c in reversed(right):
                    if c in self.left:
                        follow[c] |= after
                        after = after | first[c] if c in empty else set(first[c])
                    else:
                        after = {c}
        return follow


class RoleStacks:
    """The shared stacks of a grammar, numbered; 0 is the empty one. `targets` are the roles a row can be given."""

    def __init__(self, rules=ROLES, targets: str = "ua"):
        self.automaton, self.targets = Automaton(rules), targets
        self.tokens = sorted({c for _, right in rules for c in right} - self.automaton.left)
        self.nodes = [(0, None)]
        self.number = {self.nodes[0]: 0}
        self.moves: list[dict[str, int]] = []
        for at, node in enumerate(self.nodes):              # grows on the way
            self.moves.append({t: self._node(to) for t in self.tokens if (to := self._read(node, t))})
            if len(self.nodes) > SHALLOW:
                raise ValueError("this grammar's stacks grow without a bound")
            if sum(t in self.moves[at] for t in targets) > 1:
                raise ValueError("a stack must decide which role a row can be given")
        self.accepting = [bool(self._read(node, END)) for node in self.nodes]
        self._edges: dict[tuple, list] = {}

    def _node(self, node) -> int:
        if node not in self.number:
            self.number[node] = len(self.nodes)
            self.nodes.append(node)
        return self.number[node]

    def _reduced(self, node, rule: int):
        for _ in self.automaton.rules[rule][1]:
            node = node[1]
        to = self.automaton.shifts.get((node[0], self.automaton.rules[rule][0]))
        return None if to is None else (to, node)

    def _read(self, node, token: str):
        """The stack after a token, reduced as far as no further token is needed; None if it can't come here."""
        a = self.automaton
        while (node[0], token) in a.reduces:
            rule = a.reduces[node[0], token]
            if rule == 0:
                return node
            node = self._reduced(node, rule)
        if token == END or (node[0], token) not in a.shifts:
            return None
        node = (a.shifts[node[0], token], node)
        while len(a.states[node[0]]) == 1:                  # one item, and that is complete: nothing else can be done
            (rule, dot), = a.states[node[0]]
            if dot < len(a.rules[rule][1]) or rule == 0:
                break
            node = self._reduced(node, rule)
        return node

    def target(self, stack: int) -> str:
        """The one role that a row inserted or given a role here can have."""
        return next(t for t in self.targets if t in self.moves[stack])

    @cached_property
    def inserted(self) -> list[dict[int, int]]:
        """For each stack, the stacks that inserted rows lead to, with the fewest of them."""
        out = []
        for start in range(len(self.nodes)):
            found, todo = {start: 0}, [start]
            for stack in todo:                              # grows on the way
                for to in (self.moves[stack].get(t) for t in self.targets):
                    if to is not None and to not in found:
                        found[to] = found[stack] + 1
                        todo.append(to)
            out.append(found)
        return out

    def edges(self, initial: str, must_go: bool, faulty: bool) -> list[tuple[int, int, int, str]]:
        """(stack before, stack after, cost, letters) of the ways past a row of this kind, the least one for each two stacks."""
        kind = initial if initial in self.tokens else "", must_go, faulty
        if kind not in self._edges:
            best: dict[tuple[int, int], tuple[int, str]] = {}
            stays = FAULTY if faulty else 0

            def offer(before, after, cost, letters):
                if after is not None and (cost, letters) < best.get((before, after), (cost + 1, "")):
                    best[before, after] = cost, letters

            for before, reached in enumerate(self.inserted):
                for stack, k in reached.items():
                    paid, said = INSERT * k, "I" * k
                    offer(before, stack, paid + DELETE, said + "D")
                    if not must_go:
                        offer(before, self.moves[stack].get(kind[0]), paid + KEEP + stays, said + "K")
                        for t in self.targets:
                            offer(before, self.moves[stack].get(t), paid + REROLE + stays, said + "R")
            self._edges[kind] = [(a, b, *way) for (a, b), way in sorted(best.items())]
        return self._edges[kind]

    def through(self, rows: list[tuple[str, bool, bool]], start: int) -> dict[int, tuple[int, str]]:
        """The least (cost, audit) from stack `start` past all rows (edges' arguments) to every stack that can be reached."""
        tops = {start: (0, 0)}                              # cost, and the audit's place in the order of the tops' audits
        below: list[dict[int, tuple[int, str]]] = []
        for row in rows:
            ways: dict[int, tuple] = {}
            for before, after, cost, letters in self.edges(*row):
                if before in tops:
                    paid, place = tops[before]
                    way = paid + cost, place, letters, before
                    if after not in ways or way < ways[after]:
                        ways[after] = way
            tops, links = merged(ways)
            below.append(links)
        out = {}
        for top, (cost, _) in tops.items():
            letters, at = [], top
            for links in reversed(below):
                at, said = links[at]
                letters.append(said)
            out[top] = cost, "".join(reversed(letters))
        return out

    def closing(self) -> dict[int, tuple[int, str]]:
        """(cost, letters) of the rows inserted at the end, for every stack from which a sentence can be ended."""
        ends = {s: min((k for to, k in reached.items() if self.accepting[to]), default=None) for s, reached in enumerate(self.inserted)}
        return {s: (INSERT * k, "I" * k) for s, k in ends.items() if k is not None}

    def replay(self, start: int, audit: str, initials: str) -> list[tuple[str, str | None]]:
        """Each letter of an audit from stack `start` with the role that it gives: None where a row keeps its role or goes."""
        stack, rows, out = start, iter(initials), []
        for letter in audit:
            initial = None if letter == "I" else next(rows)
            role = self.target(stack) if letter in "IR" else None
            if letter != "D":
                stack = self.moves[stack][role or initial]
            out.append((letter, role))
        return out


def merged(ways: dict[int, tuple]) -> tuple[dict[int, tuple[int, int]], dict[int, tuple[int, object]]]:
    """From the least (cost, place, letters, stack before) of each top: the tops with their audits' places, and links down."""
    order = {w: i for i, w in enumerate(sorted({w[1:3] for w in ways.values()}))}
    return {top: (w[0], order[w[1:3]]) for top, w in ways.items()}, {top: (w[3], w[2]) for top, w in ways.items()}
