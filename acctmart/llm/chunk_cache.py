"""Byte-pair encoding of whole texts with a bounded cache of encoded stretches.

The pre-tokenizers' pattern never lets a token reach over the start of a space that is
followed by a non-space. Texts in which every space is followed by one can so be encoded
stretch by stretch, and stretches repeat. Any other text is encoded as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: Stretches a task keeps at most; the cache starts anew beyond it.
CACHED = 400_000
#: Longer stretches are not kept.
LONGEST = 100

_UNSAFE = re.compile(r" \s| \Z")

Encode = Callable[[list[str]], list[bytes]]


class StretchEncoder:
    """Encodes texts to the bytes of their ids.

    ``encode`` does so for any texts. ``encode_joined`` does for stretches that begin with
    a space before a non-space, whose concatenation may be encoded at once. Texts that hold
    one of ``marks``, which stretches could cut, are encoded as a whole.
    """

    def __init__(
        self, encode: Encode, encode_joined: Encode | None = None, cached: int = CACHED, marks: tuple[str, ...] = ()
    ) -> None:
        self.encode = encode
        self.marks = marks
        self.encode_joined = encode_joined or encode
        self.cached = cached
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids' bytes of every text."""
        if len(self.known) > self.cached:
            self.known.clear()
        get = self.known.get
        result: list[bytes] = [b""] * len(texts)
        whole, open_texts, new = [], [], {}
        for i, text in enumerate(texts):
            if _UNSAFE.search(text) or (self.marks and any(m in text for m in self.marks)):
                whole.append(i)
                continue
            # The first stretch has no space before it, and a space as its mark here.
            parts = text.split(" ")
            parts[0] = " " + parts[0]
            found = list(map(get, parts))
            if None in found:
                missing = [k for k, ids in enumerate(found) if ids is None]
                open_texts.append((i, parts, found, missing))
                for k in missing:
                    new[parts[k]] = b""
            else:
                result[i] = b"".join(found)
        first = [p for p in new if p[:1] == " "]
        later = [p for p in new if p[:1] != " "]
        new.update(zip(first, self.encode([p[1:] for p in first])))
        new.update(zip(later, self.encode_joined([" " + p for p in later])))
        for i, parts, found, missing in open_texts:
            for k in missing:
                found[k] = new[parts[k]]
            result[i] = b"".join(found)
        self.known.update((p, ids) for p, ids in new.items() if len(p) <= LONGEST)
        for i, ids in zip(whole, self.encode([texts[i] for i in whole])):
            result[i] = ids
        return result
