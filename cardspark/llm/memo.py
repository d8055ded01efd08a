"""A bounded memory of what texts are worth encoding once.

Two generations: what the slice at hand wants is in the young one; when that is
full it becomes the old one, and the old one is dropped. So what is asked for
often stays, however many rare keys pass by, and at most twice the bound is
held."""

from __future__ import annotations

from collections.abc import Callable, Iterable


class _Known(dict):
    """Values that stay, and ``beside`` them those of one call."""

    beside: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        return self.beside[key]


class Memo:
    def __init__(self, bound: int, longest: int):
        self.bound, self.longest = bound, longest
        self.young, self.old = _Known(), _Known()

    def of(self, wanted: Iterable[str],
           make: Callable[[list[str]], list[bytes]]) -> dict[str, bytes]:
        """A mapping that has every key of ``wanted`` (a set); ``make`` gives the
        values of those not remembered. Keys over ``longest`` characters are not
        kept beyond this call."""
        if len(self.young) > self.bound:
            self.young, self.old = _Known(), self.young
        young, old = self.young, self.old
        missing = []
        for key in wanted - young.keys():
            value = old.get(key)
            if value is None:
                missing.append(key)
            else:
                young[key] = value
        young.beside = {}
        for key, value in zip(missing, make(missing)):
            (young if len(key) <= self.longest else young.beside)[key] = value
        return young
