"""Plain versions that several tests compare with."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(text: str | None) -> frozenset:
    words = WORD.findall((text or "").encode().lower())  # bytes.lower() changes A-Z only
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def near_brute(rows, percent: int = 85) -> dict:
    """doc_id -> (set size, component, kept) by comparing every pair that shares a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    tested = set()
    for ids in by.values():
        for k, a in enumerate(ids):
            for b in ids[:k]:
                if (a, b) not in tested and find(a) != find(b):
                    tested.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * len(sets[a] | sets[b]):
                        x, y = find(a), find(b)
                        root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def pack_brute(rows, texts, tokenizer):
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert set(by_doc) == set(ids)
    for i, found in by_doc.items():
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[i])
    used = 0
    for found in by_seq.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        used += at
    assert sorted(by_seq) == list(range(len(by_seq)))
    return used / (len(by_seq) * 1024)
