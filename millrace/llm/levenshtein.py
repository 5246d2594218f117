"""A lexicon trie intersected with Levenshtein automata, determinised on demand and run over many words at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Term:
    text: bytes
    stem: bool = False  # also matches words that go on after it
    edits: int = 0  # insertions, deletions and substitutions of bytes that are allowed
    free: bool = False  # edits may be at the first byte too, and a swap of neighbouring bytes is one edit


class LexiconAutomaton:
    """Accepts every word within a term's edits; the first byte has to be right unless the term is free.

    A state is the set of (trie node, whether only free terms are left, edits so far) that the bytes read allow, closed
    under skipped term bytes; a stem that has been met stays in the set, and a swap waits in it for its second byte.
    States and transitions are made when a word first needs them, at most ``most_states``; when they run out, the table
    starts anew, so memory is bounded whatever the words are.
    """

    DEAD = 0

    def __init__(self, terms: list[Term], most_states: int = 50_000):
        self.terms, self.most_states = terms, most_states
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.into: list[int] = [-1]  # the byte that leads to the node's parent
        self.reach: tuple[list[int], list[int]] = ([0], [0])  # the most edits that a term, or a free one, below the node allows
        for i, term in enumerate(terms):
            node, before = 0, -1
            for b in (None, *term.text):
                if b is not None:
                    if b not in self.children[node]:
                        self.children[node][b] = len(self.children)
                        self.children.append({})
                        self.ends.append([])
                        self.into.append(before)
                        for reach in self.reach:
                            reach.append(0)
                    node, before = self.children[node][b], b
                for reach in self.reach[: 1 + term.free]:
                    reach[node] = max(reach[node], term.edits)
            self.ends[node].append(i)
        letters = sorted({b for t in terms for b in t.text})
        self.letter = np.zeros(256, np.int64)  # 0: a byte that no term has
        self.letter[letters] = np.arange(1, len(letters) + 1)
        self.letters = [-1, *letters]
        self.first = np.full(256, self.reach[1][0] > 0)
        self.first[list(self.children[0])] = True
        self.restart()

    def restart(self) -> None:
        self.sets: list[frozenset] = [frozenset(), self._closed({(0, 0, 0)})]
        self.ids = {self.sets[0]: 0, self.sets[1]: 1}
        self.table = np.full((1024, len(self.letters)), -1, np.int64)
        self.table[0] = 0
        self.hit_term, self.hit_edits = [-1, -1], [0, 0]

    def _ended(self, node: int, free: int, e: int) -> list[int]:
        """The terms that end at the node and allow what was edited."""
        return [i for i in self.ends[node] if e <= self.terms[i].edits and (self.terms[i].free or not free)]

    def _closed(self, items: set[tuple[int, int, int]]) -> frozenset:
        """With term bytes skipped, and only the fewest edits for each node. Met stems are (-1 - term, 0, edits)."""
        best: dict[tuple[int, int], int] = {}
        todo = list(items)
        while todo:
            node, free, e = todo.pop()
            if best.get((node, free), 99) <= e or best.get((node, 0), 99) <= e:
                continue
            best[node, free] = e
            if 0 <= node < len(self.children):
                todo += [(-1 - i, 0, e) for i in self._ended(node, free, e) if self.terms[i].stem]
                free = free or int(node == 0)
                todo += [(child, free, e + 1) for child in self.children[node].values() if e + 1 <= self.reach[free][child]]
        return frozenset((node, free, e) for (node, free), e in best.items() if not free or best.get((node, 0), 99) > e)

    def _step(self, state: int, letter: int) -> int:
        b, size = self.letters[letter], len(self.children)
        items: set[tuple[int, int, int]] = set()
        for node, free, e in self.sets[state]:
            if node < 0:
                items.add((node, free, e))
                continue
            if node >= size:  # half of a swap
                if self.into[node - size] == b:
                    items.add((node - size, free, e))
                continue
            edited = free or int(node == 0)
            for c, child in self.children[node].items():
                if c == b:
                    if e <= self.reach[free][child]:
                        items.add((child, free, e))
                    continue
                if e + 1 <= self.reach[edited][child]:
                    items.add((child, edited, e + 1))
                other = self.children[child].get(b)
                if other is not None and e + 1 <= self.reach[1][other]:
                    items.add((size + other, 1, e + 1))
            if e + 1 <= self.reach[edited][node]:
                items.add((node, edited, e + 1))
        closed = self._closed(items)
        if closed not in self.ids:
            self.ids[closed] = len(self.sets)
            self.sets.append(closed)
            hits = [(e, i) for node, free, e in closed if node < len(self.children) for i in ([-1 - node] if node < 0 else self._ended(node, free, e))]
            e, i = min(hits, default=(0, -1))
            self.hit_term.append(i)
            self.hit_edits.append(e)
            if len(self.sets) > len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        self.table[state, letter] = self.ids[closed]
        return self.ids[closed]

    def match(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word numbers, term numbers, edits) of the words data[start:end] that are accepted."""
        if len(self.sets) > self.most_states:
            self.restart()
        live = np.flatnonzero(self.first[data[starts]]) if len(starts) else np.zeros(0, np.int64)
        state = np.ones(len(live), np.int64)
        at, found = starts[live], []
        while len(live):
            letter = self.letter[data[at]]
            after = self.table[state, letter]
            for s, x in np.unique(np.stack([state, letter])[:, after < 0], axis=1).T.tolist():
                self._step(s, x)
            after = self.table[state, letter]
            at = at + 1
            over = at >= ends[live]
            if over.any():
                found.append((live[over], after[over]))
            go = ~over & (after != self.DEAD)
            live, state, at = live[go], after[go], at[go]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        word, state = (np.concatenate(x) for x in zip(*found))
        term, edits = np.array(self.hit_term, np.int64)[state], np.array(self.hit_edits, np.int64)[state]
        good = term >= 0
        order = np.argsort(word[good], kind="stable")
        return word[good][order], term[good][order], edits[good][order]
