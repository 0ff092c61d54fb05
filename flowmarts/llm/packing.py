"""Packing of token sequences by linear grouping.

Pieces have 1 to ``limit`` tokens, so their lengths are a histogram of at most ``limit`` counts at any number of
documents, and the packing is planned on it: the driver holds counts, never pieces. Large lengths, sorted, are cut
into groups of equal count and rounded up to the longest of their group; an optimal mixture of configurations of these
few sizes comes from a linear programme with column generation. Actual lengths then take the places of their
group, and the rest, small ones above all, goes best-fit into the room that rounding has left. Sequences with
equal contents are one class with a count throughout, so the plan has some thousand rows whatever the input.

Pieces learn their place by their rank among the pieces of their length: counts per partition and length are
summed up, and a piece adds its number in its own partition. No group of pieces is gathered or sorted.
"""

from __future__ import annotations

import os
import sys
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import regex
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowmarts.llm.common import checkpointed, join_table, read

LIMIT = 1024
END = 2
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

GROUPS = 256
WASTES = (1024, 16, 8, 4, 2, 1, 0)
MOST = 4  # lengths above a fifth of the limit are large: at most four to a sequence
KEPT_WORDS = 400_000
LONG_WORD = 64
# The words of ``public_tokenizers.PATTERN``; what most words are is tried first, and nothing is tried twice.
WORD = r" ?\p{L}++| ?\p{N}++|'(?:s|t|re|ve|m|ll|d)| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
BLOCK_CHARS = 2_000_000

PIECES = "doc_id long, piece int, start long, length long, ids binary"
NAMES = ["doc_id", "piece", "start", "length", "ids"]
TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]


# Tokens


def _letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if it is printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + k) for k, b in enumerate(others)}}


class Words(dict):
    """Ids of words, as little-endian 32-bit numbers: no merge crosses a word of the tokenizer's pattern, and words repeat.

    A word goes straight to the tokenizer's model, in the letters of its bytes. A special token's string is
    ordinary text. Words met lately are kept, ``KEPT_WORDS`` of them at least and twice as many at most.
    """

    def __init__(self, body: bytes):
        super().__init__()
        self.merged = Tokenizer.from_str(body.decode()).model.tokenize
        self.letters = _letters()
        self.split = regex.compile(WORD).findall
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            letters = word.encode().decode("latin-1").translate(self.letters)
            ids = array("I", [token.id for token in self.merged(letters)]).tobytes()
        if len(word) <= LONG_WORD:
            if len(self) >= KEPT_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        return b"".join([self[w] for w in self.split(text)])


def _cut(tokenizer: bytes, limit: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        # Workers are reused between tasks: the vocabulary and the words met stay in the process.
        kept_here = vars(sys.modules["__main__"]).setdefault("_kept_words", {})
        if tokenizer not in kept_here:
            kept_here.clear()
            kept_here[tokenizer] = Words(tokenizer)
        words, last = kept_here[tokenizer], array("I", [end]).tobytes()

        rows, chars = [], 0

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], names=NAMES)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                body = words.ids(text) + last
                size = len(body) // 4
                start, stop, piece = 0, (size - 1) % limit + 1, 0
                while start < size:
                    rows.append((key, piece, start, stop - start, body[4 * start : 4 * stop]))
                    start, stop, piece = stop, stop + limit, piece + 1
                chars += len(text)
                if chars >= BLOCK_CHARS:
                    yield batch_of()
                    rows, chars = [], 0
        if rows:
            yield batch_of()

    return run


def tokenizer_bytes(spark: SparkSession, path: str = TOKENIZER) -> bytes:
    """The tokenizer's file, a few megabytes: the driver's own by its path, another by a URL that Spark reads."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as file:
        return file.read()


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The token pieces of each document: ``doc_id, piece, start, length, ids``.

    A document is the ids of its whole text (null: none) and the id ``end``. One of more than ``limit`` tokens is cut
    into pieces of ``limit``, the first of which has the rest of the division. ``ids`` are little-endian 32-bit
    numbers. Null and repeated ids are rows like others; an empty table gives none; other columns play no part.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_cut(tokenizer_bytes(docs.sparkSession, tokenizer), limit, end), PIECES)


# The plan


class _Prices:
    """What up to four sizes can be worth together in a room."""

    def __init__(self, sizes: np.ndarray, limit: int):
        self.sizes, self.limit = sizes, limit
        one, two = np.triu_indices(len(sizes))
        total = sizes[one] + sizes[two]
        # Pairs by the room they take: the best pair of a room is a maximum over a stretch.
        order = np.argsort(total, kind="stable")
        order = order[total[order] <= limit]
        self.one, self.two = one[order], two[order]
        self.rooms, self.first = np.unique(total[order], return_index=True)

    def best(self, prices: np.ndarray, most: int) -> tuple[float, list[int]]:
        """Sum of prices and indexes of the configuration of up to ``most`` sizes that is worth most."""
        ones = np.zeros(self.limit + 1)
        ones[self.sizes] = prices
        ones = np.maximum.accumulate(ones)
        twos = ones.copy()
        if len(self.rooms):
            pairs = np.maximum.reduceat(prices[self.one] + prices[self.two], self.first)
            twos[self.rooms] = np.maximum(twos[self.rooms], pairs)
        twos = np.maximum.accumulate(twos)
        left, right = {2: (ones, ones), 3: (ones, twos), 4: (twos, twos)}[most]
        sums = left + right[::-1]
        room = int(sums.argmax())
        members = []
        for table, space in ((left, room), (right, self.limit - room)):
            members += self._pair(prices, space) if table is twos and twos[space] > ones[space] else self._single(prices, space)
        return float(sums[room]), members

    def _single(self, prices: np.ndarray, room: int) -> list[int]:
        worth = np.where(self.sizes <= room, prices, 0.0)
        return [int(worth.argmax())] if worth.max() > 0 else []

    def _pair(self, prices: np.ndarray, room: int) -> list[int]:
        inside = int(np.searchsorted(self.rooms, room, side="right"))
        stop = self.first[inside] if inside < len(self.first) else len(self.one)
        at = int((prices[self.one[:stop]] + prices[self.two[:stop]]).argmax())
        return [int(self.one[at]), int(self.two[at])]


def _configurations(sizes: np.ndarray, wanted: np.ndarray, limit: int, most: int, rounds: int = 5_000) -> list[tuple[float, list[int]]]:
    """How often each configuration (up to ``most`` sizes, by index) is taken in an optimal mixture covering ``wanted``.

    Column generation: the dual values of the mixture price the sizes, and the configuration worth most enters as
    long as it is worth more than the one sequence it costs. Stopped after ``rounds``, the mixture still
    covers everything, with some sequences more.
    """
    k = len(sizes)
    chosen = [[i] * int(limit // sizes[i]) for i in range(k)]
    basis = np.diag((limit // sizes).astype(float))
    priced = _Prices(sizes, limit)
    for turn in range(rounds):
        if turn % 64 == 0:
            inverse = np.linalg.inv(basis)
        amounts = np.maximum(inverse @ wanted, 0)
        worth, members = priced.best(np.maximum(inverse.sum(axis=0), 0), most)
        if worth <= 1 + 1e-7:
            break
        column = np.bincount(members, minlength=k).astype(float)
        direction = inverse @ column
        rising = direction > 1e-9
        if not rising.any():
            break
        leaves = int(np.where(rising, amounts / np.where(rising, direction, 1), np.inf).argmin())
        basis[:, leaves], chosen[leaves] = column, members
        row = inverse[leaves] / direction[leaves]
        inverse -= np.outer(direction, row)
        inverse[leaves] = row
    return [(float(a), members) for a, members in zip(amounts, chosen, strict=True) if a > 1e-9]


class _Runs:
    """Lengths in falling order as (length, count), taken from the front."""

    def __init__(self, pairs: list[tuple[int, int]]):
        self.pairs, self.at = [list(p) for p in pairs], 0

    def take(self, most: int) -> tuple[int, int]:
        """Up to ``most`` items of one length: length and count, count 0 if there are none."""
        if self.at == len(self.pairs):
            return 0, 0
        length, count = self.pairs[self.at]
        got = min(most, count)
        self.pairs[self.at][1] -= got
        self.at += count == got
        return length, got


class _Bins:
    """Classes of sequences with equal contents, by the room they have left."""

    def __init__(self, limit: int):
        self.limit = limit
        self.rooms: list[int] = []
        self.classes: dict[int, list[tuple[int, tuple]]] = defaultdict(list)

    def add(self, room: int, count: int, contents: tuple) -> None:
        if not self.classes[room]:
            insort(self.rooms, room)
        self.classes[room].append((count, contents))

    def best_fit(self, length: int, count: int) -> None:
        """Put ``count`` items of one length each where the least room is left that takes it."""
        while count:
            k = bisect_left(self.rooms, length)
            if k == len(self.rooms):
                each = self.limit // length
                room, bins, contents = self.limit, -(-count // each), ()
            else:
                room = self.rooms[k]
                bins, contents = self.classes[room].pop()
                if not self.classes[room]:
                    del self.rooms[k]
                each = room // length
            full = min(bins, count // each)
            rest = count - full * each if full < bins else 0
            if full:
                self.add(room - each * length, full, (*contents, (length, each)))
            if rest:
                self.add(room - rest * length, 1, (*contents, (length, rest)))
            if bins - full - (rest > 0):
                self.add(room, bins - full - (rest > 0), contents)
            count -= full * each + rest

    def count(self) -> int:
        return sum(count for classes in self.classes.values() for count, _ in classes)


def _substituted(large: list[tuple[int, int]], limit: int, groups: int, most: int) -> list[tuple[int, int, tuple]]:
    """Sequences of large lengths as (count, room left, contents): configurations of groups, filled with actual lengths."""
    total = sum(n for _, n in large)
    members: list[list[tuple[int, int]]] = []
    queue = _Runs(large)
    for g in range(min(groups, total)):
        wanted = total * (g + 1) // min(groups, total) - total * g // min(groups, total)
        mine = []
        while wanted:
            length, got = queue.take(wanted)
            mine.append((length, got))
            wanted -= got
        if members and members[-1][0][0] == mine[0][0]:
            members[-1] += mine
        else:
            members.append(mine)
    if not members:
        return []
    sizes = np.array([mine[0][0] for mine in members])
    demand = np.array([float(sum(n for _, n in mine)) for mine in members])
    runs = [_Runs(mine) for mine in members]
    out = []
    for amount, configuration in _configurations(sizes, demand, limit, most):
        classes = [(int(amount + 1e-6), limit, ())]
        for g in sorted(configuration):
            filled = []
            for count, room, contents in classes:
                while count:
                    length, got = runs[g].take(count)
                    if not got:
                        filled.append((count, room, contents))
                        break
                    filled.append((got, room - length, (*contents, (length, 1))))
                    count -= got
            classes = filled
        out += [c for c in classes if c[0] and c[2]]
    return out


def plan(histogram: dict[int, int], limit: int = LIMIT, groups: int = GROUPS, most: int = MOST) -> list[tuple[int, int, int, int, int, int]]:
    """Places of the pieces of each length below ``limit``.

    Sequences of the configurations stay as they are if their actual lengths leave no more than some tokens; the others'
    pieces go best-fit with the rest. Of ``WASTES`` the bound that takes the fewest sequences is chosen.
    Rows (length, first, count, sequence, offset, times): piece ``first + k`` of that length, k below count, is in
    ``sequence + k // times`` at ``offset + k % times * length``.
    """
    below = {length: n for length, n in histogram.items() if length < limit and n}
    large = sorted(((length, n) for length, n in below.items() if length * (most + 1) > limit), reverse=True)
    filled = _substituted(large, limit, groups, most)
    plans = []
    for waste in WASTES:
        bins, rest = _Bins(limit), dict(below)
        for count, room, contents in filled:
            if room <= waste:
                bins.add(room, count, contents)
                for length, times in contents:
                    rest[length] -= count * times
        for length in sorted(rest, reverse=True):
            bins.best_fit(length, rest[length])
        plans.append(bins)
    bins = min(plans, key=_Bins.count)

    rows, used, sequence = [], defaultdict(int), 0
    for room in bins.rooms:
        for count, contents in bins.classes[room]:
            offset = 0
            for length, times in contents:
                rows.append((length, used[length], count * times, sequence, offset, times))
                used[length] += count * times
                offset += length * times
            sequence += count
    return rows


# Places


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part = TaskContext.get().partitionId()
    met: dict[int, int] = {}
    for batch in batches:
        length = batch["length"]
        batch["__part"] = part
        batch["__nth"] = batch.groupby("length").cumcount() + length.map(met).fillna(0).astype("int64")
        for size, n in length.value_counts().items():
            met[size] = met.get(size, 0) + n
        yield batch


def pack(rows: DataFrame, limit: int = LIMIT, groups: int = GROUPS) -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset``, the place of each in sequences of at most ``limit`` tokens.

    ``rows`` has a column ``length`` of 1 to ``limit``; a row without such a length is an error. Rows of equal
    length are interchangeable, so repeated rows and ties each have their place. Other columns pass
    through, except that ``sequence_id`` and ``offset`` are replaced. An empty table gives an empty result.
    """
    rows = rows.drop("sequence_id", "offset").withColumn("length", F.col("length").cast("long"))
    right = F.coalesce(F.col("length").between(1, limit), F.lit(False))
    rows = rows.withColumn("length", F.when(right, F.col("length")).otherwise(F.raise_error(F.lit(f"length not in 1 to {limit}")).cast("long")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    numbered = checkpointed(rows.mapInPandas(_numbered, f"{schema}, __part int, __nth long"))
    counts = checkpointed(numbered.groupBy("length", "__part").agg(F.count("*").alias("__n")))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    before = W.partitionBy("length").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select("length", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    ranked = join_table(numbered, checkpointed(firsts), ["length", "__part"])
    ranked = ranked.withColumn("__rank", F.col("__first") + F.col("__nth")).drop("__first", "__nth", "__part")

    # At most some thousand rows: the classes of the plan are bounded by lengths and configurations.
    names = "__length long, __from long, __count long, __sequence long, __offset long, __times long"
    table = plan(histogram, limit, groups)
    places = F.broadcast(rows.sparkSession.createDataFrame(table, names))
    here = (F.col("length") == F.col("__length")) & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__from") + F.col("__count"))
    placed = ranked.join(places, here, "left")
    k = F.col("__rank") - F.col("__from")
    whole = F.lit(max((row[3] + row[2] // row[5] for row in table), default=0)) + F.col("__rank")
    full = F.col("length") == limit
    sequence = F.when(full, whole).otherwise(F.col("__sequence") + F.floor(k / F.col("__times")))
    offset = F.when(full, F.lit(0)).otherwise(F.col("__offset") + k % F.col("__times") * F.col("length"))
    return placed.select(*rows.columns, sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids, doc_ids`` of packed pieces: their ids put together in the order of ``offset``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("n_tokens"))
    body = F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p.ids))
    return grouped.select("sequence_id", "n_tokens", body.alias("ids"), F.col("parts.doc_id").alias("doc_ids"))


def op13_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = pieces(read(spark, sf_dir, "documents"))
    digested = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(digested)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
