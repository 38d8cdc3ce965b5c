"""A bounded memo for results by word: two generations, so that frequent words stay."""

from __future__ import annotations

from collections.abc import Callable
from itertools import filterfalse

SIZE = 150_000


class Memo:
    """Looks words up, and has the missing ones of a text computed together."""

    def __init__(self, compute: Callable[[list], list], size: int = SIZE):
        self.compute, self.size = compute, size
        self.young: dict = {}
        self.old: dict = {}

    def look_up(self, words: list) -> list:
        """The results of the words, in order. `compute` sees every missing word once, and is free of state, so a memo never changes results."""
        found = list(map(self.young.get, words))
        if None in found:
            missing = list(dict.fromkeys(w for w, x in zip(words, found) if x is None))
            known = list(map(self.old.get, missing))
            fresh = [w for w, x in zip(missing, known) if x is None]
            self.young.update((w, x) for w, x in zip(missing, known) if x is not None)
            if fresh:
                self.young.update(zip(fresh, self.compute(fresh)))
            found = list(map(self.young.__getitem__, words))
            if len(self.young) > self.size:
                self.young, self.old = {}, self.young
        return found

    def covering(self, lists: list[list]) -> dict:
        """The results of all words of the lists, by word, for use before the next look-up."""
        missing: set = set()
        for words in lists:
            missing.update(filterfalse(self.young.__contains__, words))
        known = {w: self.old[w] for w in missing if w in self.old}
        fresh = list(missing.difference(known))
        here = self.young
        here.update(known)
        if fresh:
            here.update(zip(fresh, self.compute(fresh)))
        if len(here) > self.size:
            self.young, self.old = {}, here
        return here
