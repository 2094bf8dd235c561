"""A generalised suffix automaton over sequences of hashable tokens."""

from __future__ import annotations

from collections.abc import Sequence


class SuffixAutomaton:
    """All substrings of the sequences added so far.

    ``first[state]`` is the owner of the earliest added sequence in which the
    state's substrings occur: add sequences in rising order of owner and it is the
    smallest owner. Size is linear in the tokens added.
    """

    __slots__ = ("steps", "link", "length", "first")

    def __init__(self) -> None:
        self.steps: list[dict] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        self.first: list = [None]

    def __len__(self) -> int:
        return len(self.link)

    def _state(self, steps: dict, length: int, link: int, owner) -> int:
        self.steps.append(steps)
        self.length.append(length)
        self.link.append(link)
        self.first.append(owner)
        return len(self.link) - 1

    def _split(self, parent: int, token, target: int) -> int:
        """The state for parent + token where ``target`` also holds longer substrings."""
        steps, link, length = self.steps, self.link, self.length
        clone = self._state(dict(steps[target]), length[parent] + 1, link[target], self.first[target])
        link[target] = clone
        while parent != -1 and steps[parent].get(token) == target:
            steps[parent][token] = clone
            parent = link[parent]
        return clone

    def add(self, tokens: Sequence, owner) -> None:
        # The lists are bound to local names: this loop is the cost of a build.
        steps, link, length, first = self.steps, self.link, self.length, self.first
        last = 0
        for token in tokens:
            there = steps[last].get(token)
            if there is not None:
                last = there if length[there] == length[last] + 1 else self._split(last, token, there)
                continue
            new = len(link)
            steps.append({})
            length.append(length[last] + 1)
            link.append(0)
            first.append(owner)
            parent = last
            while parent != -1:
                onward = steps[parent]
                there = onward.get(token)
                if there is not None:
                    link[new] = there if length[there] == length[parent] + 1 else self._split(parent, token, there)
                    break
                onward[token] = new
                parent = link[parent]
            last = new

    def firsts(self, tokens: Sequence, size: int, unseen) -> list:
        """For every run of ``size`` tokens: the first owner of a sequence with it, or ``unseen``."""
        steps, link, length, first = self.steps, self.link, self.length, self.first
        state = matched = 0
        found = []
        for token in tokens:
            there = steps[state].get(token)
            while there is None and state:
                state = link[state]
                matched = length[state]
                there = steps[state].get(token)
            if there is None:
                found.append(unseen)
                continue
            state = there
            matched += 1
            if matched < size:
                found.append(unseen)
                continue
            # Only the last ``size`` tokens count, so the match is cut to them.
            while length[link[state]] >= size:
                state = link[state]
            matched = size
            found.append(first[state])
        return found[size - 1 :]

    def advance(self, state: int, matched: int, token) -> tuple[int, int]:
        """Matching statistics one token on: the state and length of the longest suffix that occurs."""
        steps, link = self.steps, self.link
        while state and token not in steps[state]:
            state = link[state]
            matched = self.length[state]
        there = steps[state].get(token)
        return (there, matched + 1) if there is not None else (0, 0)

    def capped(self, state: int, size: int) -> int:
        """From a state that matches at least ``size`` tokens, the state of its suffix of that size."""
        link, length = self.link, self.length
        while length[link[state]] >= size:
            state = link[state]
        return state
