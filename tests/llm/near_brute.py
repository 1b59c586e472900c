"""Brute force for groups of similar texts."""

from __future__ import annotations

import re


def shingle_set(text, words):
    text = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
    found = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def smallest_reached(docs, words, num, den):
    """`(doc_id, text, set size, smallest id reached)` of each document."""
    sets = [shingle_set(d.text, words) for d in docs]
    group = list(range(len(docs)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, one in enumerate(sets):
        for j, two in enumerate(sets[:i]):
            if one and two and den * len(one & two) >= num * len(one | two):
                group[root(i)] = root(j)
    lowest = {}
    for i, doc in enumerate(docs):
        if doc.doc_id is not None:
            lowest[root(i)] = min(doc.doc_id, lowest.get(root(i), doc.doc_id))
    return [(d.doc_id, d.text, len(s), lowest.get(root(i)) if s else d.doc_id) for i, (d, s) in enumerate(zip(docs, sets, strict=True))]
