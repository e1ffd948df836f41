"""A lexicon trie intersected with Levenshtein automata, made deterministic as it is used.

A place of the automaton is (trie node, edits so far). The set of places that a
word's first characters can reach is one state; states and their steps are kept
once made, so a word costs one look-up a character, and a word that is far from
all terms ends at its first impossible character. A term allows as many edits as
its length does (`allowed`); a stem allows none and any ending of at most `ENDING`
characters.
"""

from __future__ import annotations

from typing import NamedTuple

ENDING = 8
KEPT = 200_000  # states and words that are remembered before the memory starts anew


class Hit(NamedTuple):
    term: str
    edits: int


def allowed(term: str) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 8 else 2


class Lexicon:
    """match(word) is the nearest term: fewest edits, then greatest weight, then first in order; None if no term allows it."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float], never: frozenset[str] = frozenset()):
        self.weights = {**stems, **terms}
        self.never = never
        self.children: list[dict[str, int]] = [{}]
        self.most = [0]  # edits that some term below a node allows
        self.ends: list[str | None] = [None]
        self.stem_ends: list[str | None] = [None]
        for names, ends, edits in ((terms, self.ends, allowed), (stems, self.stem_ends, lambda _: 0)):
            for name in names:
                node = 0
                for c in name:
                    self.most[node] = max(self.most[node], edits(name))
                    if c not in self.children[node]:
                        self.children[node][c] = len(self.children)
                        self.children.append({})
                        for column in (self.ends, self.stem_ends):
                            column.append(None)
                        self.most.append(0)
                    node = self.children[node][c]
                self.most[node] = max(self.most[node], edits(name))
                ends[node] = name
        self._forget()

    def _forget(self) -> None:
        self.steps: list[dict[str, int]] = []
        self.places: list[frozenset] = []
        self.finals: list[Hit | None] = []
        self.number: dict[frozenset, int] = {}
        self.known: dict[str, Hit | None] = {}
        self.start = self._state({(0, 0)})

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("steps", "places", "finals", "number", "known", "start")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def _state(self, places: set) -> int:
        """The number of a set of places, closed under skipping characters of a term (deletions)."""
        open_ = list(places)
        while open_:
            node, edits = open_.pop()
            if node >= 0:
                for child in self.children[node].values():
                    if edits < self.most[child] and (child, edits + 1) not in places:
                        places.add((child, edits + 1))
                        open_.append((child, edits + 1))
        key = frozenset(places)
        if key not in self.number:
            self.number[key] = len(self.places)
            self.places.append(key)
            self.steps.append({})
            found = [(e, -self.weights[self.ends[n]], self.ends[n]) for n, e in key if n >= 0 and self.ends[n] is not None and e <= allowed(self.ends[n])]
            # (-1 - node, length) is a place in the ending of the stem at node
            found += [(0, -self.weights[self.stem_ends[-1 - n]], self.stem_ends[-1 - n]) for n, _ in key if n < 0]
            found += [(0, -self.weights[self.stem_ends[n]], self.stem_ends[n]) for n, e in key if n >= 0 and e == 0 and self.stem_ends[n] is not None]
            best = min(found, default=None)
            self.finals.append(Hit(best[2], best[0]) if best else None)
        return self.number[key]

    def _step(self, state: int, c: str) -> int:
        after = set()
        for node, edits in self.places[state]:
            if node < 0:
                if edits < ENDING:
                    after.add((node, edits + 1))
                continue
            if self.stem_ends[node] is not None and edits == 0:
                after.add((-1 - node, 1))
            for letter, child in self.children[node].items():
                if letter == c:
                    after.add((child, edits))
                elif edits < self.most[child]:
                    after.add((child, edits + 1))  # another character
            if edits < self.most[node]:
                after.add((node, edits + 1))  # one too many
        return self._state(after) if after else -1

    def match(self, word: str) -> Hit | None:
        if word in self.known:
            return self.known[word]
        if len(self.known) > KEPT or len(self.places) > KEPT:
            self._forget()
        state = self.start
        for c in word:
            steps = self.steps[state]
            if c not in steps:
                steps[c] = self._step(state, c)
            state = steps[c]
            if state < 0:
                break
        hit = self.finals[state] if state >= 0 else None
        self.known[word] = hit = None if hit and hit.term != word and word in self.never else hit
        return hit
