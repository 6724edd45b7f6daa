"""A bounded cache from a piece of text to what an encoder makes of it."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Generic, TypeVar

K = TypeVar("K")
V = TypeVar("V")


class WordCache(Generic[K, V]):
    """Two generations: when the younger one is full it becomes the older one, and what is asked for again moves back.

    So the words in use stay. Words longer than ``longest`` (encoded data, scripts without spaces) are not kept at all, so that memory
    is bounded by twice ``size`` words of that length, plus the words of one call.
    """

    def __init__(self, encode: Callable[[list[K]], Iterable[V]], size: int, longest: int = 48) -> None:
        self.encode, self.size, self.longest = encode, size, longest
        self.young: dict[K, V] = {}
        self.old: dict[K, V] = {}

    def values(self, words: list[K]) -> Iterable[V]:
        """The value of each word, in order."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        unknown = set(words).difference(self.young)
        if unknown:
            old, new = self.old, []
            for word in unknown:
                value = old.get(word)
                if value is None:
                    new.append(word)
                else:
                    self.young[word] = value
            found = zip(new, self.encode(new))
            if any(len(word) > self.longest for word in new):
                once = dict(found)
                self.young.update((word, value) for word, value in once.items() if len(word) <= self.longest)
                return [once[word] if word in once else self.young[word] for word in words]
            self.young.update(found)
        return map(self.young.__getitem__, words)
