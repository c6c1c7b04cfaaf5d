"""Plain versions that several tests compare with."""

from __future__ import annotations

import re


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def search(texts, items):
    table = {}
    for name, text in items:
        own = words(text)
        for i in range(max(len(own) - 9, min(len(own), 1))):
            table.setdefault(tuple(own[i : i + 10]), set()).add(name or "")
    out = []
    for key, text in texts:
        own, hit, names = words(text), set(), set()
        for size in {len(w) for w in table}:
            for i in range(len(own) - size + 1):
                if (found := table.get(tuple(own[i : i + size]))) is not None:
                    hit.update(range(i, i + size))
                    names |= found
        out.append((str(key), len(own), len(hit), tuple(sorted(names))))
    return sorted(out)
