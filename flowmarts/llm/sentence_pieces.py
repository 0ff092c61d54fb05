"""SentencePiece encoding and decoding by a streaming Viterbi search.

The models used here are of the merge (BPE) kind, where the best segmentation is the one that merging by rank
arrives at. A sequence of pieces is that segmentation exactly if each neighbouring pair is the segmentation of
its own text. So the search runs from left to right over the characters: each end position keeps one
backpointer, to the only piece that can end the encoding of the text so far. A new piece reaches back at most the
length of the longest piece, so only the paths of that window survive. When all of them run through one
boundary, the ids before it are committed and forgotten: memory is bounded by the window, not by the text.

Every boundary that no piece spans is such a point of convergence: before a word mark, and around characters
that occur in no longer piece. Between two of them equal stretches have equal ids, which are kept for a while.
"""

from __future__ import annotations

import itertools
import re
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmarts.llm.common import read

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
KEPT_STRETCHES = 800_000
KEPT_PAIRS = 100_000
PAIR_BITS = 21
SPREAD = np.uint64(0x9E3779B97F4A7C15)
COMMIT_EVERY = 64
LOW = float("-inf")
LOCKSTEP_CHARS = 64
BLOCK_CHARS = 2_000_000


class Pieces:
    """Vocabulary of a SentencePiece model of the merge kind with byte fallback and the identity normaliser."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        source = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_ids = [0] * 256
        self.text: list[bytes] = []
        for i in range(source.get_piece_size()):
            piece = source.id_to_piece(i)
            if source.is_control(i) or source.is_unknown(i):
                self.text.append(b"")
            elif source.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.text.append(bytes([value]))
            else:
                self.ids[piece] = i
                self.score[piece] = source.get_score(i)
                self.text.append(piece.replace(MARK, " ").encode())
        self.longest = max(map(len, self.ids))
        self.pairs: dict[tuple[str, str], bool] = {}
        self.stretches: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.lockstep = Lockstep(self)

    def merges(self, text: str, border: int) -> bool:
        """Whether merging ``text`` leaves a border after so many characters and none elsewhere.

        Merging takes the pair of best rank, the leftmost of equals. A merge over the border decides.
        """
        parts, score, low = list(text), self.score, LOW
        gains = [score.get(a + b, low) for a, b in zip(parts, parts[1:])]
        while gains:
            best = max(gains)
            if best == low:
                break
            at = gains.index(best)
            if at == border - 1:
                return False
            if at < border:
                border -= 1
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del gains[at]
            if at:
                gains[at - 1] = score.get(parts[at - 1] + parts[at], low)
            if at < len(gains):
                gains[at] = score.get(parts[at] + parts[at + 1], low)
        return len(parts) == (2 if border else 1)

    def fit(self, left: str, right: str) -> bool:
        """Whether the two pieces are the encoding of their text; an empty left one asks for the right alone."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            joined = left + right
            known = (not left or joined not in self.score) and self.merges(joined, len(left))
            self.pairs[key] = known
        return known

    def viterbi(self, text: str) -> Iterator[str]:
        """Pieces of one stretch, each as soon as all surviving paths agree on it."""
        window, ended = "", [""]  # ended[k]: the piece that ends after k characters of the window
        longest, score, pairs = self.longest, self.score, self.pairs
        for char in text:
            window += char
            size = len(ended)
            found = ""
            for first in range(max(size - longest, 0), size):
                piece = window[first:]
                if piece not in score and first < size - 1:
                    continue
                before = ended[first]
                if not before and first:
                    continue
                fits = pairs.get((before, piece))
                if fits is None:
                    fits = self.fit(before, piece)
                if fits:
                    found = piece
                    break
            ended.append(found)
            if size >= COMMIT_EVERY + self.longest and size % COMMIT_EVERY == 0:
                boundary = self.converged(ended, size)
                if boundary:
                    yield from self.path(ended, boundary)
                    # The piece before the window stays: the next ones must fit it.
                    window, ended = window[boundary:], ended[boundary:]
        yield from self.path(ended, len(ended) - 1)

    def path(self, ended: list[str], to: int) -> list[str]:
        out = []
        while to > 0:
            out.append(ended[to])
            to -= len(ended[to])
        return out[::-1]

    def converged(self, ended: list[str], size: int) -> int:
        """The last boundary on the paths of all positions that later pieces can start from; 0 if only the start."""
        tips = {k for k in range(max(size - self.longest + 1, 0), size + 1) if ended[k] or k == 0}
        while len(tips) > 1:
            last = max(tips)
            tips.remove(last)
            tips.add(last - len(ended[last]))
        return tips.pop()

    def numbered(self, pieces: Iterable[str]) -> list[int]:
        ids: list[int] = []
        for piece in pieces:
            if piece in self.ids:
                ids.append(self.ids[piece])
            else:
                ids.extend(self.byte_ids[b] for b in piece.encode())
        return ids

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian 32-bit numbers; a word mark goes before the first character."""
        out: list[bytes] = []
        block: list[list[str]] = []
        chars = 0
        for i, text in enumerate(texts):
            block.append(STRETCH.findall(MARK + text.replace(" ", MARK)) if text else [])
            chars += len(text)
            if chars >= BLOCK_CHARS or i == len(texts) - 1:
                self.learn(block)
                out += [b"".join(map(self.stretches.__getitem__, found)) for found in block]
                block, chars = [], 0
        return out

    def learn(self, block: list[list[str]]) -> None:
        """Encode the stretches of a block that aren't known yet."""
        if len(self.stretches) > KEPT_STRETCHES // 2:
            self.older, self.stretches = self.stretches, {}
        met = set().union(*block).difference(self.stretches)
        back = met.intersection(self.older)
        self.stretches.update(zip(back, map(self.older.__getitem__, back), strict=True))
        fresh = met.difference(back)
        short = [x for x in fresh if len(x) <= LOCKSTEP_CHARS]
        for at in range(0, len(short), 20_000):
            some = short[at : at + 20_000]
            self.stretches.update(zip(some, self.lockstep.encode(some), strict=True))
        for x in fresh:
            if len(x) > LOCKSTEP_CHARS:
                self.stretches[x] = np.array(self.numbered(self.viterbi(x)), dtype="<i4").tobytes()

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the word mark that encoding has put first is taken off, bytes that are no UTF-8 become U+FFFD."""
        body = b"".join([self.text[i] for i in ids])
        return body.removeprefix(b" ").decode("utf-8", "replace")


class Lookup:
    """Values of 64-bit keys that are not negative, in an open table that is asked for many keys at once."""

    def __init__(self, bits: int) -> None:
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, -1, dtype=np.int64)
        self.count = 0

    def places(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.view(np.uint64) * SPREAD) >> self.shift).view(np.int64)

    def put(self, keys: np.ndarray, values: list[int]) -> None:
        for key, at, value in zip(keys.tolist(), self.places(keys).tolist(), values, strict=True):
            while self.keys[at] >= 0:
                at = (at + 1) & self.mask
            self.keys[at], self.values[at] = key, value
        self.count += len(values)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 where there is none."""
        at = self.places(keys)
        found = self.values[at]
        off = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] >= 0))
        while len(off):
            at[off] = (at[off] + 1) & self.mask
            there = self.keys[at[off]]
            found[off] = self.values[at[off]]
            off = off[(there != keys[off]) & (there >= 0)]
        return found


class Lockstep:
    """The same search over many short stretches at once: all take the step from a position together.

    Pieces are found by walking a trie, and pairs are looked up among known answers; pairs that are new are
    merged once.
    """

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.names = list(pieces.ids)
        self.vocab = np.array(list(pieces.ids.values()), dtype=np.int64)
        letters = sorted(set("".join(self.names)))
        self.letters = np.array([ord(c) for c in letters], dtype=np.int64)
        code = {c: i + 1 for i, c in enumerate(letters)}
        self.width = len(letters) + 1
        edges: dict[int, int] = {}
        piece_at = [-1]
        for k, name in enumerate(self.names):
            node = 0
            for c in name:
                key = node * self.width + code[c]
                node = edges.setdefault(key, len(piece_at))
                if node == len(piece_at):
                    piece_at.append(-1)
            piece_at[node] = k
        self.piece_at = np.array(piece_at, dtype=np.int64)
        self.edges = Lookup(19)
        self.edges.put(np.array(list(edges), dtype=np.int64), list(edges.values()))
        self.sizes = np.array([len(n) for n in self.names], dtype=np.int64)
        self.known = Lookup(PAIR_BITS)

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``left`` counts from 1, 0 being the start; pieces of unknown characters fit anything."""
        keys = left * len(self.names) + right
        answers = self.known.get(keys)
        missing = np.unique(keys[answers < 0])
        if len(missing):
            if self.known.count + len(missing) > 1 << (PAIR_BITS - 1):
                self.known = Lookup(PAIR_BITS)
                missing = np.unique(keys)
            names, merges, score = self.names, self.pieces.merges, self.pieces.score
            found = []
            for key in missing.tolist():
                one, two = divmod(key, len(names))
                before = names[one - 1] if one else ""
                joined = before + names[two]
                found.append(int((not before or joined not in score) and merges(joined, len(before))))
            self.known.put(missing, found)
            answers = self.known.get(keys)
        return answers > 0

    def encode(self, stretches: list[str]) -> list[bytes]:
        count = len(stretches)
        lengths = np.array([len(x) for x in stretches], dtype=np.int64)
        starts = np.zeros(count, dtype=np.int64)
        np.cumsum(lengths[:-1], out=starts[1:])
        points = np.frombuffer("".join(stretches).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        code = np.searchsorted(self.letters, points)
        code = np.where(self.letters[np.minimum(code, len(self.letters) - 1)] == points, code + 1, 0)
        # ended[s + k]: 1 + the piece that ends before character k of the stretch at s; -1 an unknown character, 0 the start.
        slots = starts + np.arange(count)
        ended = np.zeros(len(points) + count, dtype=np.int64)
        for i in range(int(lengths.max(initial=0))):
            rows = np.flatnonzero(lengths > i)
            before = ended[slots[rows] + i]
            unknown = code[starts[rows] + i] == 0
            ended[slots[rows[unknown]] + i + 1] = -1
            rows, before = rows[~unknown], before[~unknown]
            node = np.zeros(len(rows), dtype=np.int64)
            for length in range(1, self.pieces.longest + 1):
                inside = lengths[rows] >= i + length
                rows, before, node = rows[inside], before[inside], node[inside]
                if not len(rows):
                    break
                keys = node * self.width + code[starts[rows] + i + length - 1]
                node = self.edges.get(keys)
                there = node >= 0
                rows, before, node = rows[there], before[there], node[there]
                piece = self.piece_at[node]
                ends = piece >= 0
                ended_rows, ended_pieces = rows[ends], piece[ends]
                fit = self.fits(np.maximum(before[ends], 0), ended_pieces)
                ended[slots[ended_rows[fit]] + i + length] = ended_pieces[fit] + 1
        return self.collected(stretches, lengths, slots, ended)

    def collected(self, stretches: list[str], lengths: np.ndarray, slots: np.ndarray, ended: np.ndarray) -> list[bytes]:
        """Ids along the paths that end with the stretches."""
        owners, places, ids = [], [], []
        rows, at, odd = np.arange(len(lengths)), lengths.copy(), np.zeros(len(lengths), dtype=bool)
        while len(rows):
            piece = ended[slots[rows] + at]
            odd[rows[piece < 1]] = True
            owners.append(rows)
            places.append(at)
            ids.append(self.vocab[piece - 1])
            at = at - np.where(piece < 1, 1, self.sizes[piece - 1])
            left = at > 0
            rows, at = rows[left], at[left]
        owner, place = np.concatenate(owners), np.concatenate(places)
        order = np.lexsort((place, owner))
        flat = np.concatenate(ids)[order].astype("<i4").tobytes()
        cuts = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(lengths))))) * 4
        out = [flat[a:b] for a, b in itertools.pairwise(cuts.tolist())]
        for k in np.flatnonzero(odd).tolist():  # with characters that no piece has
            out[k] = np.array(self.pieces.numbered(self.pieces.viterbi(stretches[k])), dtype="<i4").tobytes()
        return out


# A line break is in no longer piece; a run of marks belongs to what follows it.
STRETCH = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")


def _encoded(model: bytes, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Workers are reused between tasks: what one has learnt stays in its process.
        kept_here = vars(sys.modules["__main__"]).setdefault("_kept_pieces", {})
        if model not in kept_here:
            kept_here.clear()
            kept_here[model] = Pieces(model)
        pieces = kept_here[model]
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            bodies = pieces.encode_all(texts)
            numbers = [np.frombuffer(b, dtype="<i4") for b in bodies]
            trips = [pieces.decode(n.tolist()) == t.replace(MARK, " ") for n, t in zip(numbers, texts, strict=True)]
            starts = np.zeros(len(numbers) + 1, dtype=np.int32)
            np.cumsum([len(n) for n in numbers], out=starts[1:])
            flat = np.frombuffer(b"".join(bodies), dtype="<i4")
            added = [
                pa.array([len(n) for n in numbers], pa.int64()),
                pa.ListArray.from_arrays(pa.array(starts), pa.array(flat)),
                pa.array(trips, pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], *added], names=[*keep, "n_ids", "ids", "round_trip"]
            )

    return run


def model_bytes(spark: SparkSession, path: str = MODEL) -> bytes:
    """The model file, half a megabyte; Spark reads it, so that any store will do."""
    if path.startswith("/"):
        path = f"file://{path}"
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def encode(docs: DataFrame, model: str = MODEL, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_ids``, ``ids`` and ``round_trip``: whether the ids decode to the text.

    A null text counts as empty and has no ids. The word mark itself (U+2581) reads as a space, as in the
    library; the round trip is judged after that. Columns called like the added ones are replaced; repeated
    rows are encoded alike; an empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in (text_col, "n_ids", "ids", "round_trip")]
    rows = docs.select(*[F.col(c) for c in kept], F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    schema = T.StructType(rows.drop("__text").schema.fields)
    schema = schema.add("n_ids", T.LongType()).add("ids", T.ArrayType(T.IntegerType())).add("round_trip", T.BooleanType())
    return rows.mapInArrow(_encoded(model_bytes(docs.sparkSession, model), kept), schema)


def decode(encoded: DataFrame, model: str = MODEL, ids_col: str = "ids", to: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids in column ``to``; null ids are an empty text."""
    body = model_bytes(encoded.sparkSession, model)

    @F.pandas_udf("string")
    def text_of(ids):
        pieces = Pieces(body)
        return ids.map(lambda row: pieces.decode([int(i) for i in row]) if row is not None else "")

    return encoded.withColumn(to, text_of(F.col(ids_col)))


def op5_streaming_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
