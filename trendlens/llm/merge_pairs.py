"""Which tokens may stand side by side in a byte-pair encoding.

A sequence of tokens is what the merges make of its text exactly if every two
neighbours are: merging the text of the two alone gives just these two.  So an
encoding is the one path through a lattice of tokens whose neighbours all
agree, and every prefix of a text has exactly one such path.
"""

from __future__ import annotations

from collections.abc import Callable

_NEVER = float("inf")


class MergePairs:
    """``rank(l, r)``: place of the merge of two tokens, None if there is none.
    ``atomic(t)``: the token is a single symbol.  ``splits``: (left, right,
    rank) of the only merge that makes a token, where that is known."""

    def __init__(self, rank: Callable, atomic: Callable, splits: dict | None = None,
                 room: int = 1_000_000):
        self._rank, self._atomic, self._room = rank, atomic, room
        self._splits: dict = splits or {}
        self._allowed: dict = {}

    def merge(self, symbols: list[str]) -> tuple[list[str], tuple | None]:
        """Merges by hand, lowest rank and then leftmost first; also the last merge."""
        last = None
        while len(symbols) > 1:
            found = [(m, k) for k in range(len(symbols) - 1)
                     if (m := self._rank(symbols[k], symbols[k + 1])) is not None]
            if not found:
                break
            m, k = min(found)
            last = (symbols[k], symbols[k + 1], m)
            symbols = symbols[:k] + [symbols[k] + symbols[k + 1]] + symbols[k + 2:]
        return symbols, last

    def split(self, token: str) -> tuple | None:
        """(left, right, rank) of the merge that makes ``token``; None if its own
        text doesn't merge to it."""
        got = self._splits.get(token, self)
        if got is self:
            parts, last = self.merge(list(token))
            got = self._splits[token] = last if len(parts) == 1 else None
        return got

    def usable(self, token: str) -> bool:
        """Whether the token's own text merges to it."""
        if self._atomic(token):
            return True
        made = self.split(token)
        return made is not None and self._agree(made[0], made[1], made[2])

    def allows(self, left: str, right: str) -> bool:
        got = self._allowed.get((left, right))
        if got is None:
            if len(self._allowed) >= self._room:
                self._allowed.clear()
            got = self._allowed[left, right] = self._agree(left, right)
        return got

    def _agree(self, left: str, right: str, limit: float = _NEVER) -> bool:
        # Backwards in time: undo the later of the two merges that made the
        # tokens, and see whether what then stood at the border would have
        # merged across it earlier.  Of equal ranks the left one comes first.
        tie = False
        while True:
            m = self._rank(left, right)
            if m is not None and (m < limit or (tie and m == limit)):
                return False
            a = None if self._atomic(left) else self.split(left)
            b = None if self._atomic(right) else self.split(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[2] > b[2]):
                left, limit, tie = a[1], a[2], False
            else:
                right, limit, tie = b[0], b[2], True
