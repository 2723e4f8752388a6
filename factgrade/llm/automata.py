"""Acyclic automata over words with a count on every arc.

A path from the root spells a phrase, and the count of its last arc is how often the phrase occurs; phrases that were
not counted, but begin a counted one, have 0.  States that continue alike are one state, so endings are shared.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import zstandard

Arc = tuple[bytes, int, int]
#: The state without arcs.
END = 0


class Automaton:
    """States are numbers; ``arcs[state]`` are its (word, count, target) in the order of the words' bytes."""

    def __init__(self) -> None:
        self.arcs: list[tuple[Arc, ...]] = [()]
        self.register: dict[tuple[Arc, ...], int] = {(): END}
        self.root = END

    def state(self, arcs: tuple[Arc, ...]) -> int:
        """The state with these arcs, made if there is none."""
        found = self.register.get(arcs)
        if found is None:
            found = self.register[arcs] = len(self.arcs)
            self.arcs.append(arcs)
        return found

    @classmethod
    def build(cls, phrases: Iterable[tuple[tuple[bytes, ...], int]]) -> Automaton:
        """From distinct phrases in sorted order, a phrase before those that it begins.

        Only the path of the last phrase is open.  What the next one leaves behind can't change any more: its states
        are looked up among the finished ones, from the end backwards.
        """
        made = cls()
        path: list[bytes] = []
        opened: list[list[Arc]] = [[]]
        counts: list[int] = []

        def close(depth: int) -> None:
            while len(path) > depth:
                target = made.state(tuple(opened.pop()))
                opened[-1].append((path.pop(), counts.pop(), target))

        for words, n in phrases:
            common = 0
            while common < min(len(path), len(words)) and path[common] == words[common]:
                common += 1
            close(common)
            for word in words[common:]:
                path.append(word)
                counts.append(0)
                opened.append([])
            counts[-1] += n
        close(0)
        made.root = made.state(tuple(opened[0]))
        return made

    @classmethod
    def union(cls, parts: list[Automaton], least: int = 0) -> Automaton:
        """One automaton with the sums of the counts; phrases under ``least`` that begin no other are left out.

        States that are met together are merged once, however many paths lead to them.
        """
        made = cls()
        known: dict[tuple[tuple[int, int], ...], int] = {}

        def merge(at: tuple[tuple[int, int], ...]) -> int:
            found = known.get(at)
            if found is not None:
                return found
            sums: dict[bytes, int] = {}
            targets: dict[bytes, list[tuple[int, int]]] = {}
            for i, state in at:
                for word, n, target in parts[i].arcs[state]:
                    sums[word] = sums.get(word, 0) + n
                    if target != END:
                        targets.setdefault(word, []).append((i, target))
            arcs = []
            for word in sorted(sums):
                target = merge(tuple(targets[word])) if word in targets else END
                if sums[word] >= least or target != END:
                    arcs.append((word, sums[word], target))
            found = known[at] = made.state(tuple(arcs))
            return found

        made.root = merge(tuple((i, p.root) for i, p in enumerate(parts)))
        return made

    def phrases(self) -> Iterator[tuple[tuple[bytes, ...], int]]:
        """All phrases with a count, in sorted order."""

        def walk(state: int, before: tuple[bytes, ...]) -> Iterator[tuple[tuple[bytes, ...], int]]:
            for word, n, target in self.arcs[state]:
                here = (*before, word)
                if n:
                    yield here, n
                yield from walk(target, here)

        return walk(self.root, ())

    def compose(self, asked: Automaton) -> Iterator[tuple[tuple[bytes, ...], int]]:
        """The phrases of ``asked`` with their counts here: both are walked at once, along the words they share."""

        def walk(mine: int, other: int, before: tuple[bytes, ...]) -> Iterator[tuple[tuple[bytes, ...], int]]:
            there = {word: (n, target) for word, n, target in self.arcs[mine]}
            for word, wanted, target in asked.arcs[other]:
                n, next_ = there.get(word, (0, END))
                here = (*before, word)
                if wanted:
                    yield here, n
                yield from walk(next_, target, here)

        return walk(self.root, asked.root, ())

    def dump(self) -> bytes:
        flat = [arc for arcs in self.arcs for arc in arcs]
        words = sorted({word for word, _, _ in flat})
        place = {word: i for i, word in enumerate(words)}
        numbers = [
            [self.root, len(self.arcs), len(flat), len(words)],
            [len(arcs) for arcs in self.arcs],
            [place[word] for word, _, _ in flat],
            [target for _, _, target in flat],
            [n for _, n, _ in flat],
            [len(word) for word in words],
        ]
        packed = b"".join(np.array(x, np.int64).tobytes() for x in numbers)
        return zstandard.compress(packed + b"".join(words), 3)

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        data = zstandard.decompress(data)
        root, states, arcs, words = np.frombuffer(data, np.int64, 4).tolist()
        at = 32

        def take(n: int) -> list[int]:
            nonlocal at
            found = np.frombuffer(data, np.int64, n, at).tolist()
            at += 8 * n
            return found

        degrees, labels, targets, counts, lengths = take(states), take(arcs), take(arcs), take(arcs), take(words)
        vocabulary = []
        for n in lengths:
            vocabulary.append(data[at : at + n])
            at += n
        made = cls()
        made.root, made.arcs, first = root, [], 0
        for n in degrees:
            made.arcs.append(tuple((vocabulary[labels[i]], counts[i], targets[i]) for i in range(first, first + n)))
            first += n
        return made
