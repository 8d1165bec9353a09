"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def components(texts, width=4, percent=85):
    """{key: (set size, smallest reachable key)} of {key: text}, by all pairs."""
    sets = {k: shingles(t, width) for k, t in texts.items()}
    keys, label = sorted(sets), {k: k for k in sets}
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    return {k: (len(sets[k]), label[k]) for k in keys}


def contamination(texts, items, window=13, share=20):
    """Per text: words, hit words, items, digest of the items, verdict."""
    windows = {}
    for item, text in items:
        words = WORD.findall(lower(text))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    out = []
    for text in texts:
        words, hit, found = WORD.findall(lower(text)), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                items_here = windows.get(tuple(words[i : i + n]))
                if items_here:
                    found |= items_here
                    hit.update(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return out
