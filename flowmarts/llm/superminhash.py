"""SuperMinHash signatures of word shingles.

Each element of a set walks through its own random permutation of the ``m`` slots. In step ``j`` it offers
``j + r``, with a fresh uniform ``r``, to the next slot of its permutation; a slot keeps the least offer. Ranks
within an element exclude each other, which gives the estimate a lower variance than independent hashes. Once a
document has no slot above ``j``, later steps can't change it and it stops. All elements of a block of
documents take a step together.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

SHINGLE = 5
ROWS, BANDS = 5, 50
SLOTS = ROWS * BANDS
BLOCK = 40_000

U = np.uint64
GOLDEN, MIX1, MIX2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * MIX1
        x = (x ^ (x >> U(27))) * MIX2
    return x ^ (x >> U(31))


with np.errstate(over="ignore"):
    BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
BASE = U(0xD6E8FEB86659FD93)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))


def powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def shingle_hashes(body: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of one text.

    ``body`` holds the bytes of words separated by one space each. A text of fewer words is one shingle. A
    shingle's hash is a polynomial over its bytes, taken from prefix sums, so the cost is that of the bytes.
    """
    size = len(body)
    if size == 0:
        return np.empty(0, dtype=np.uint64)
    spaces = np.flatnonzero(body == 32)
    starts = np.concatenate(([0], spaces + 1))
    ends = np.append(spaces, size)
    if len(starts) < SHINGLE:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(starts) - SHINGLE + 1], ends[SHINGLE - 1 :]
    with np.errstate(over="ignore"):
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[body] * up[:size], out=sums[1:])
        raw = (sums[ends] - sums[starts]) * down[starts]
        raw += (ends - starts).astype(np.uint64) * GOLDEN
    return np.unique(mixed(raw))


def _block_signatures(values: np.ndarray, owner: np.ndarray, documents: int, slots: int) -> np.ndarray:
    best = np.full(documents * slots, np.inf)
    table = best.reshape(documents, slots)
    rows, places = np.arange(len(values)), None
    with np.errstate(over="ignore"):
        for j in range(slots):
            draw = mixed(values + U(j + 1) * GOLDEN)
            r = (draw >> U(11)).astype(np.float64) * 2.0**-53
            k = j + ((mixed(draw ^ MIX2) >> U(32)) * U(slots - j) >> U(32)).astype(np.int64)
            if places is None:
                slot = k
            else:
                slot = places[rows, k].astype(np.int64)
                places[rows, k] = places[rows, j]
                places[rows, j] = slot
            np.minimum.at(best, owner * slots + slot, r + j)
            open_ = (table.max(axis=1) >= j + 1)[owner]
            if not open_.any():
                break
            if places is None:
                values, owner, k = values[open_], owner[open_], k[open_]
                rows = np.arange(len(values))
                places = np.tile(np.arange(slots, dtype=np.uint16 if slots > 256 else np.uint8), (len(values), 1))
                places[rows, k] = 0
                places[:, 0] = k
            elif not open_.all():
                values, owner, places = values[open_], owner[open_], places[open_]
                rows = np.arange(len(values))
    return table


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` values for each set of distinct hashes; an empty set has infinite values."""
    out = np.full((len(sets), slots), np.inf)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (last == first or total + sizes[last] <= BLOCK):
            total += sizes[last]
            last += 1
        if total:
            values = np.concatenate(sets[first:last])
            owner = np.repeat(np.arange(last - first), sizes[first:last])
            out[first:last] = _block_signatures(values, owner, last - first, slots)
        first = last
    return out


def band_hashes(table: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit hash of each run of ``rows`` signature values, different for each band."""
    bits = table.view(np.uint64).reshape(len(table), -1, rows)
    with np.errstate(over="ignore"):
        h = np.broadcast_to(np.arange(1, bits.shape[1] + 1, dtype=np.uint64) * GOLDEN, bits.shape[:2])
        for i in range(rows):
            h = mixed(h ^ mixed(bits[:, :, i] + GOLDEN))
    return h.view(np.int64)


def fingerprint(values: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that stand for the set."""
    with np.errstate(over="ignore"):
        one = np.sum(mixed(values ^ MIX1), dtype=np.uint64)
        two = np.sum(mixed(values + MIX2), dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
