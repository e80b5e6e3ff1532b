"""Inverted pair bitmaps: per key the documents that hold it, with planes for how often.

A posting is (key, document, times). It is kept as bitmaps of document numbers: plane j of a key
has the documents in whose ``times`` bit j is set. So the union of a key's planes is its document
bitmap, its popcount the number of documents, and the popcounts of the planes, weighted by
2**j, add up to the number of occurrences. A bitmap is cut into containers of 4,096
documents; a container is a sorted list of numbers or, if that is larger, 512 bytes of bits.
Bitmaps of the same keys from several places merge by OR.
"""

from __future__ import annotations

import numpy as np
import zstandard

U64 = np.uint64
SLOT_BITS = 12
SLOTS = 1 << SLOT_BITS
DENSE = SLOTS // 16  # documents from which bits are smaller than a list of two-byte numbers
_SLOT = U64(SLOTS - 1)


def _edges(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def _shuffled(values: np.ndarray) -> bytes:
    """Bytes of all numbers, first bytes first: the nearly constant high ones then compress well."""
    return values.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def _unshuffled(data: memoryview, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def planes_of(entry: np.ndarray, times: np.ndarray) -> list[np.ndarray]:
    """Of distinct sorted entries (key << 32 | document): those of each plane."""
    return [entry[(times >> j) & 1 == 1] for j in range(int(times.max()).bit_length())] if len(entry) else []


def pack(planes: list[np.ndarray]) -> bytes:
    """Planes of sorted distinct entries as compressed containers."""
    parts: list[bytes] = []
    for entry in planes:
        box = entry >> U64(SLOT_BITS)
        first = _edges(box)
        size = np.diff(np.concatenate([first, [len(entry)]]))
        slot = (entry & _SLOT).astype(np.uint16)
        dense = size > DENSE
        inside = np.repeat(dense, size)
        bits = np.zeros((int(dense.sum()), SLOTS), dtype=bool)
        bits[np.repeat(np.arange(len(bits)), size[dense]), slot[inside]] = True
        steps = np.diff(np.concatenate([np.zeros(1, U64), box[first]]))  # ascending, so steps are small
        parts += [_shuffled(steps), _shuffled(size.astype(np.uint16)), _shuffled(slot[~inside]), np.packbits(bits, axis=1).tobytes()]
    head = np.array([len(parts), *map(len, parts)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    """The planes that ``pack`` was given."""
    raw = memoryview(zstandard.ZstdDecompressor().decompress(data))
    n = int(np.frombuffer(raw[:8], np.int64)[0])
    ends = np.cumsum(np.frombuffer(raw[8 : 8 + 8 * n], np.int64)) + 8 + 8 * n
    begins = np.concatenate([[8 + 8 * n], ends[:-1]]) if n else ends
    part = [raw[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
    planes = []
    for k in range(0, n, 4):
        box = np.cumsum(_unshuffled(part[k], U64), dtype=U64)
        size = _unshuffled(part[k + 1], np.uint16).astype(np.int64)
        slot = np.zeros(int(size.sum()), U64)
        inside = np.repeat(size > DENSE, size)
        slot[~inside] = _unshuffled(part[k + 2], np.uint16)
        bits = np.unpackbits(np.frombuffer(part[k + 3], np.uint8)).reshape(-1, SLOTS)
        slot[inside] = np.nonzero(bits)[1]
        planes.append((np.repeat(box, size) << U64(SLOT_BITS)) | slot)
    return planes


def merged(packs: list[bytes]) -> list[np.ndarray]:
    """The OR, plane by plane, of several packs."""
    found: list[list[np.ndarray]] = []
    for data in packs:
        for j, plane in enumerate(unpack(data)):
            if j == len(found):
                found.append([])
            found[j].append(plane)
    return [np.unique(np.concatenate(f)) for f in found]


def counts(planes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each key: key, number of documents, number of occurrences (popcounts of the planes)."""
    if not planes:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    held = np.unique(np.concatenate(planes)) >> U64(32)
    first = _edges(held)
    keys, docs = held[first], np.diff(np.concatenate([first, [len(held)]]))
    times = np.zeros(len(keys), np.int64)
    for j, plane in enumerate(planes):
        of = plane >> U64(32)
        at = _edges(of)
        times[np.searchsorted(keys, of[at])] += np.diff(np.concatenate([at, [len(of)]])) << j
    return keys, docs, times


def sums(planes: list[np.ndarray], keys: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Scores back along the postings: per document the sum of times * value of its keys, for each of ``values``.

    ``keys`` are sorted and hold every key of the planes.
    """
    if not planes:
        return np.zeros(0, U64), [np.zeros(0, np.int64) for _ in values]
    entry = np.concatenate(planes)
    weight = np.repeat(np.int64(1) << np.arange(len(planes), dtype=np.int64), [len(p) for p in planes])
    doc = entry & U64(0xFFFFFFFF)
    at = np.searchsorted(keys, entry >> U64(32))
    order = np.argsort(doc, kind="stable")
    first = _edges(doc[order])
    return doc[order][first], [np.add.reduceat((weight * v[at])[order], first) for v in values]
