"""White-space chunking with memos: the piece of work that every tokenizer operator shares.

Byte-level patterns never cross the boundary before a space that precedes a visible character, so a text is the
concatenation of chunks that can be encoded one by one, and each distinct chunk needs to be encoded once per worker.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: Unicode's White_Space characters, as the tokenizers' patterns take them.
WHITE = "".join(map(chr, (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: A word without one last stop, that stop, any other run of visible characters, white space. A stop is cut off only
#: behind a letter or number, where the patterns end a token too.
SPLIT = re.compile(
    rf" ?[^{WHITE}.,]++(?<=[^\W_])(?=[.,](?:[{WHITE}]|\Z))|(?<=[^\W_])[.,](?=[{WHITE}]|\Z)| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
#: Characters that Python's str.split takes as white space and the patterns don't.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


class Memo(dict):
    """Values by chunk, filled for a whole batch at a time and emptied when it grows beyond ``limit`` entries."""

    def __init__(self, fill: Callable[[list[str]], list], limit: int = 800_000):
        super().__init__()
        self.fill, self.limit = fill, limit

    def prepare(self, keys: set[str]) -> None:
        if len(self) > self.limit:
            self.clear()
        missing = [k for k in keys if k not in self]
        if missing:
            self.update(zip(missing, self.fill(missing), strict=True))

    def values_of(self, keys: list[str]) -> list:
        """Value of each key, in order, with one look-up of those that are known."""
        found = list(map(self.get, keys))
        if None in found:
            self.prepare({k for k, v in zip(keys, found, strict=True) if v is None})
            found = [self[k] if v is None else v for k, v in zip(keys, found, strict=True)]
        return found
