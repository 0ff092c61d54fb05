"""Periodic runs of words, found by string synchronising sets.

At scale ``t`` (4, 8, 16, ...) every fragment of ``t`` words has a hash, and a position is selected if the least hash
of the ``t + 1`` fragments from it on is that of the first or the last. The choice depends on the next ``2 t`` words
only, so equal stretches are selected alike, and about ``2 / t`` of all positions are. A run whose period ``p`` is
in ``[3 t, 6 t)`` holds a selected position and, ``p`` words on, another one with the same ``2 t`` words: such pairs
propose the periods of the scale. Fragments that themselves have a period of ``t / 3`` or less are left out of the
choice, for they would select nearly every position. What that omits comes from the highly periodic regions, found
apart: periods below 12 by comparing the words with themselves 1 to 11 places on, and squares whose half
is highly periodic from two regions that meet, in the distances that put them in phase.

A proposal is extended in both directions by binary search over prefix hashes of 64 bits, and the run found is compared
word by word; where a hash was wrong, its bounds are found by words. Texts are taken in blocks, put one after the other with a separator of its own
after each, and all steps are array operations over a block. Each document is a task's own matter: nothing is
shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmarts.llm.common import let, read, words

MIN_RUN = 12
DIRECT = 12
BLOCK = 150_000

U = np.uint64
STEP, BASE = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)
NOWHERE = U(0xFFFFFFFFFFFFFFFF)

FOUND = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over 64 bits."""
    x = (x ^ (x >> U(32))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(29))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(32))


def _ahead(x: np.ndarray, by: int, fill: int) -> np.ndarray:
    out = np.full(len(x), fill, dtype=x.dtype)
    out[: max(len(x) - by, 0)] = x[by:]
    return out


def _stretches(true: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First positions and ends of the maximal stretches of true."""
    edges = np.zeros(len(true) + 2, dtype=np.int8)
    edges[1:-1] = true
    turns = np.flatnonzero(edges[1:] != edges[:-1])
    return turns[::2], turns[1::2]


def _covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a position lies in one of the intervals ``[start, end)``."""
    depth = np.zeros(size + 1, dtype=np.int32)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0


def _selected(prints: np.ndarray, t: int, skip: np.ndarray) -> np.ndarray:
    """Positions of the synchronising set at scale ``t``; fragments in ``skip`` take no part."""
    ids = np.where(skip, NOWHERE, prints)
    least, width = ids, 1
    while width < t:
        least = np.minimum(least, _ahead(least, width, NOWHERE))
        width *= 2
    last = _ahead(ids, t, NOWHERE)
    least = np.minimum(least, last)
    return np.flatnonzero((least != NOWHERE) & ((ids == least) | (last == least)))


def _proposals(places: np.ndarray, context: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places with equal context and a distance in ``[3 t, 6 t)``: first places and distances."""
    firsts, periods = [], []
    at, step = np.arange(len(places)), 1
    while True:
        at = at[at + step < len(places)]
        far = places[at + step] - places[at]
        near = far < 6 * t
        at, far = at[near], far[near]
        if not len(at):
            break
        hit = (far >= 3 * t) & (context[at + step] == context[at])
        firsts.append(places[at[hit]])
        periods.append(far[hit])
        step += 1
    if not firsts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(firsts), np.concatenate(periods)


def _smallest(runs: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods put together, with the smallest period of each start and end."""
    a, b, p = (np.concatenate(x) for x in zip(*runs, strict=True))
    order = np.lexsort((p, b, a))
    a, b, p = a[order], b[order], p[order]
    least = np.ones(len(a), dtype=bool)
    least[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[least], b[least], p[least]


class _Block:
    """Words of some texts as numbers, each text followed by a number that occurs once."""

    def __init__(self, numbers: np.ndarray, owner: np.ndarray, sizes: np.ndarray):
        self.t, self.owner, self.sizes = numbers, owner, sizes
        with np.errstate(over="ignore"):
            self.values = _mixed((numbers.astype(np.uint64) + U(1)) * STEP)
            self.powers = np.full(len(numbers) + 1, BASE, dtype=np.uint64)
            self.powers[0] = 1
            np.multiply.accumulate(self.powers, out=self.powers)
            self.sums = np.zeros(len(numbers) + 1, dtype=np.uint64)
            np.cumsum(self.values * self.powers[:-1], out=self.sums[1:])

    def _reach(self, at: np.ndarray, p: np.ndarray, side: int) -> np.ndarray:
        """How many words from ``at`` on (``side`` 1) or before it (-1) equal those ``p`` further on."""
        got = np.zeros(len(at), dtype=np.int64)
        room = len(self.t) - at - p if side > 0 else at
        step = 1 << (int(self.sizes.max(initial=1)).bit_length())
        while step:
            ok = np.flatnonzero(got + step <= room)
            a = at[ok] + side * got[ok]
            b = a + side * step
            lo, hi, q = np.minimum(a, b), np.maximum(a, b), p[ok]
            with np.errstate(over="ignore"):
                same = (self.sums[hi] - self.sums[lo]) * self.powers[q] == self.sums[hi + q] - self.sums[lo + q]
            got[ok[same]] += step
            step >>= 1
        return got

    def _run_at(self, at: int, p: int) -> tuple[int, int]:
        """Start and end of the run of period ``p`` about ``at``, word by word."""
        t, start, end = self.t, at, at
        while start > 0 and t[start - 1] == t[start - 1 + p]:
            start -= 1
        while end + p < len(t) and t[end] == t[end + p]:
            end += 1
        return start, end + p

    def _is_run(self, start: int, end: int, p: int) -> bool:
        t = self.t
        if start > 0 and t[start - 1] == t[start - 1 + p] or end < len(t) and t[end] == t[end - p]:
            return False
        return bool(np.array_equal(t[start : end - p], t[start + p : end]))

    def _short(self) -> tuple[list, list]:
        """Runs with periods below ``DIRECT``, and all regions that hold three periods."""
        runs, regions = [], []
        for p in range(1, min(DIRECT, len(self.t))):
            a, b = _stretches(self.t[:-p] == self.t[p:])
            b = b + p
            for into, least in ((runs, max(MIN_RUN, 2 * p)), (regions, max(4, 3 * p))):
                long = b - a >= least
                into.append((a[long], b[long], np.full(int(long.sum()), p)))
        return runs, regions

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and smallest periods of all runs, by start and period."""
        found, regions = self._short()
        prints, where, owner, width = self.values, np.arange(len(self.t)), self.owner, 1
        t = DIRECT // 3
        while len(self.sizes) and 6 * t <= self.sizes.max():
            # Shorter texts can't hold two periods of this scale and leave.
            alive = self.sizes[owner] >= 6 * t
            prints, where, owner = prints[alive], where[alive], owner[alive]
            with np.errstate(over="ignore"):
                while width < t:
                    prints, width = _mixed(prints * BASE + _ahead(prints, width, 0)), 2 * width
                double = _mixed(prints * BASE + _ahead(prints, width, 0))
            skip = np.zeros(len(self.t), dtype=bool)
            known = [r for r in regions if len(r[0])]
            if known:
                a, b, p = (np.concatenate(x) for x in zip(*known, strict=True))
                dense = (3 * p <= t) & (b - a >= t)
                skip = _covered(len(self.t), a[dense], b[dense] - t + 1)
            places = _selected(prints, t, skip[where])
            first, period = _proposals(places, double[places], t)
            found.append(self._extended(where[first], period, t))
            regions.append(found[-1])
            t *= 2
        if not found:
            return (np.empty(0, np.int64),) * 3
        found.append(self._extended(*self._between(*_smallest(regions)), 0))
        a, b, p = _smallest(found)
        order = np.lexsort((p, a))
        return a[order], b[order], p[order]

    def _between(self, a: np.ndarray, b: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proposals of runs ``u u`` whose ``u`` is highly periodic itself, from its regions.

        Each ``u`` then lies in a region of the same period ``q``, the second region starting within ``q`` words of the
        end of the first. Only distances that put their words in phase can be periods: one in ``q``.
        """
        long = b - a >= 8 * q
        order = np.lexsort((a[long], q[long]))
        a, b, q = a[long][order], b[long][order], q[long][order]
        firsts, periods = [], []
        for k in np.flatnonzero((q[1:] == q[:-1]) & (a[1:] <= b[:-1])).tolist():
            (a1, a2), (b1, b2), n = a[k : k + 2].tolist(), b[k : k + 2].tolist(), int(q[k])
            width, root = self.t.itemsize, self.t[b1 - n : b1].tobytes()
            body = self.t[a2 : a2 + 2 * n].tobytes()
            at = body.find(root)
            while at >= 0 and at % width:
                at = body.find(root, at + 1)
            if at < 0:
                continue
            phase = (a2 + at // width - b1) % n
            p = np.arange(phase, min(b1 - a1, b2 - a2) + 1, n, dtype=np.int64)
            p = p[p >= max(DIRECT, 8 * n)]
            first = np.maximum(a1, a2 - p)
            inside = first < np.minimum(b1, b2 - p)
            firsts.append(first[inside])
            periods.append(p[inside])
        if not firsts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(firsts), np.concatenate(periods)

    def _extended(self, at: np.ndarray, p: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The runs about proposals (first places, periods) with ``2 t`` equal words."""
        order = np.lexsort((at, p))
        at, p = at[order], p[order]
        # Contexts that overlap or touch are in one run.
        new = np.ones(len(at), dtype=bool)
        new[1:] = (p[1:] != p[:-1]) | (at[1:] - at[:-1] > 2 * t)
        at, p = at[new], p[new]
        start, end = at - self._reach(at, p, -1), at + self._reach(at, p, 1) + p
        rows = set()
        for i, a, b, q in zip(at.tolist(), start.tolist(), end.tolist(), p.tolist(), strict=True):
            if b - a < 2 * q or (a, b, q) in rows:
                continue
            if not self._is_run(a, b, q):
                a, b = self._run_at(i, q)
            if b - a >= 2 * q:
                rows.add((a, b, q))
        out = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
        return out[:, 0], out[:, 1], out[:, 2]


def word_runs(texts: list[list]) -> list[tuple[list[tuple[int, int, int]], np.ndarray | None]]:
    """For each list of words its runs (start, length, period) and a mask of the words that stay, None for all."""
    numbers: dict = {}
    sizes = np.array([len(w) for w in texts], dtype=np.int64)
    whole = np.empty(int(sizes.sum()) + len(texts), dtype=np.int64)
    firsts = np.concatenate(([0], np.cumsum(sizes + 1)))
    for i, (a, w) in enumerate(zip(firsts.tolist(), texts, strict=False)):
        whole[a : a + len(w)] = [numbers.setdefault(x, len(numbers)) for x in w]
        whole[a + len(w)] = -2 - i
    a, b, p = _Block(whole, np.repeat(np.arange(len(texts)), sizes + 1), sizes).runs()
    gone = _covered(len(whole), a + p, b)
    owner = np.searchsorted(firsts, a, side="right") - 1
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    triples = np.stack((a - firsts[owner], b - a, p), axis=1).tolist()
    out = []
    for i, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        mask = ~gone[firsts[i] : firsts[i] + sizes[i]] if hi > lo else None
        out.append(([tuple(r) for r in triples[lo:hi]], mask))
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of texts, in blocks of about ``BLOCK`` words; a longer text is a block of its own."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            w = (text.as_py() or "").encode().split()
            if held and held + len(w) > BLOCK:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(key.as_py())
            texts.append(w)
            held += len(w) + 1
    if ids:
        yield ids, texts


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    triple = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for ids, texts in _blocks(batches):
        results = word_runs(texts)
        kept = [w if mask is None else [x for x, stay in zip(w, mask.tolist(), strict=True) if stay] for w, (_, mask) in zip(texts, results, strict=True)]
        flat = np.array([r for runs, _ in results for r in runs], dtype=np.int64).reshape(-1, 3)
        offsets = np.cumsum([0, *[len(runs) for runs, _ in results]]).astype(np.int32)
        values = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(triple))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(w) for w in texts], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), values),
                pa.array([b" ".join(w).decode() for w in kept], pa.string()),
            ],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, collapsed``.

    Words are what stands between blanks (space, \\x09 to \\x0D). ``runs`` holds every maximal stretch with
    smallest period ``q`` and a length of at least ``max(12, 2 q)`` words as (start, length, period), by start and
    period. ``collapsed`` joins by a space the words that stay: a run keeps its first period, and a word goes if any run
    drops it. A null text has no words and an empty result; a null or repeated id is a row like others; an
    empty table gives none; other columns play no part, whatever their names. Texts are read whole. A task
    holds one block of words, and a text longer than a block as a whole: some 200 bytes a word.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_found, FOUND)


def with_planted_runs(doc_id: Column, text: Column) -> Column:
    """``text``, in a tenth of the documents with a periodic rest.

    With h the CRC of the decimal id and g = h div 10, texts with h mod 10 = 0 and n > 0 words have, from word
    a = g mod n on, the first 1 + (n - a) div (3 + g mod 8) words over and over. A null id plants nothing.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))

    def planted(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10)

        def periodic(s: Column) -> Column:
            a = s.a
            p = 1 + F.floor((n - a) / (3 + g % 8))
            return F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))

        places = let(F.struct((g % n).alias("a")), periodic)
        return let(places, lambda at: F.array_join(F.transform(at, lambda i: F.get(w, i)), " "))

    many = let(words(text), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(F.lit("")))
    return F.when(F.coalesce(h % 10 == 0, F.lit(False)), many).otherwise(text)


def op12_synchronising_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", with_planted_runs(F.col("doc_id"), F.col("text")).alias("text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("p"))))
    named = found.withColumn("longest", longest)
    return named.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.p")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
