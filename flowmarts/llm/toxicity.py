"""Toxicity: Levenshtein automata over a lexicon trie, and context windows around what they catch.

The lexicon is learnt: words that labelled toxic documents hold far more often than clean ones, by a likelihood-ratio
test corrected for the number of words tested. A token is a run of non-blanks without its outer marks. It is taken
as a Levenshtein automaton, a swap of neighbours being one edit, and run along the trie of the lexicon, all tokens of a
block together, with states as bits; branches on which no token is alive are left. Digits and marks inside a token are
letters like others, so ``id1ot`` is one edit from its term; ``i_d_i_o_t`` and ``idiooot`` are read without their marks and
repeats. Words that clean documents use are known and not taken for misspellings. Each hit counts by its term, its
distance and the words around it: inside quotation marks or after a reporting verb it counts less, next to an address
more. A logistic regression on a few sums of hits gives the score.
"""

from __future__ import annotations

import math
import re
import sys
import warnings
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmarts.llm.common import checkpointed, chosen_by_hash, read

TRAIN_ROWS = 20_000
LEXICON_SIZE = 400
LEAST_TOXIC_DOCS = 3
LEAST_LOG_ODDS = 2.0
FALSE_TERMS = 0.05
WINDOW = 6
BLOCK_CHARS = 4_000_000
LONGEST_WORD = 60
SEEN_WORDS = 400_000
NEAR_WEIGHT = 0.8
FEATURES = ["hits", "terms", "density", "direct"]

RUN = re.compile(r"\S+")
OUTER = re.compile(r"^[\W_]+|[\W_]+$")
INNER = re.compile(r"[\W_]+")
LETTERS = re.compile(r"[^\W\d_]+")
REPEATED = re.compile(r"(.)\1{2,}")
# Letters that digits and marks stand for.
LOOKS = str.maketrans("0134578@$!|", "oieastbasil")
# Marks of quotation, reporting verbs and words of address in the four languages.
QUOTES = re.compile("[\"“”„«»‹›]")
REPORTING = frozenset("said says wrote writes quoted quote called word term sagte schrieb zitat wort dit écrit mot dijo escribió palabra".split())
ADDRESS = frozenset("you your youre u du dich dein ihr tu toi ton vous tú usted te".split())


def readings(token: str) -> list[tuple[str, int]]:
    """What a token may stand for, with the edits that are spent on it: itself without outer marks, its parts of letters,
    itself without any marks, with letters for the digits and marks that look like them, and without letters said three
    times or more."""
    if token.isalpha() and not REPEATED.search(token):
        return [(token, 0)]
    core = OUTER.sub("", token)
    out = {core: 0}
    if not core.isalpha():
        for part in LETTERS.findall(core):
            if len(part) > 1:
                out.setdefault(part, 0)
        out.setdefault(INNER.sub("", core), 1)
    seen = token.translate(LOOKS)
    if seen != token and not core.isdigit():
        out.setdefault(INNER.sub("", seen), 1)
    for word in list(out):
        squeezed = REPEATED.sub(r"\1", word)
        if squeezed != word:
            out.setdefault(squeezed, 1)
    return [(w, e) for w, e in out.items() if w]


def allowed_edits(term: str) -> int:
    """0 for up to three characters, 1 for up to nine, 2 beyond."""
    return 0 if len(term) < 4 else 1 if len(term) < 10 else 2


@dataclass
class Trie:
    """Lexicon trie: for each node its children by letter and the term that ends there."""

    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    term: list[str | None] = field(default_factory=lambda: [None])

    @staticmethod
    def of(terms: list[str]) -> Trie:
        trie = Trie()
        for term in terms:
            node = 0
            for c in term:
                after = trie.children[node].get(c)
                if after is None:
                    after = len(trie.children)
                    trie.children[node][c] = after
                    trie.children.append({})
                    trie.term.append(None)
                node = after
            trie.term[node] = term
        return trie


def near_terms(words: list[str], trie: Trie) -> dict[str, tuple[str, int]]:
    """For each word within the allowed edits of a term: the nearest term, the first of equals, and the distance.

    Bit ``j`` of state ``d`` says that the first ``j`` letters of the word can be read along the path with ``d``
    edits. A letter of the path moves all words' states at once. A swap of two neighbours is one edit: it goes from the
    state two letters of the path ago, by this letter and then the one before. Words of more than ``LONGEST_WORD``
    letters are over two edits longer than any term.
    """
    words = [w for w in words if len(w) <= LONGEST_WORD]
    if not words:
        return {}
    sizes = np.array([len(w) for w in words], dtype=np.uint64)
    width = int(sizes.max())
    letters = np.array(words, dtype=f"<U{width}").view("<u4").reshape(len(words), width)
    powers = np.uint64(1) << np.arange(width, dtype=np.uint64)
    masks: dict[str, np.ndarray] = {}
    one, two = np.uint64(1), np.uint64(2)
    inside = (two << sizes) - one
    found: dict[str, tuple[str, int]] = {}

    def step(node: int, alive: np.ndarray, r0: np.ndarray, r1: np.ndarray, r2: np.ndarray, p0: np.ndarray, p1: np.ndarray, before: np.ndarray) -> None:
        for letter, after in trie.children[node].items():
            if letter not in masks:
                masks[letter] = ((letters == ord(letter)) * powers).sum(axis=1, dtype=np.uint64)
            m = masks[letter][alive]
            s0 = (r0 & m) << one
            s1 = ((r1 & m) << one) | r0 | (r0 << one) | (s0 << one) | ((((p0 & m) << one) & before) << one)
            s2 = ((r2 & m) << one) | r1 | (r1 << one) | (s1 << one) | ((((p1 & m) << one) & before) << one)
            on = np.flatnonzero(s2 & inside[alive])
            if not len(on):
                continue
            rows, s0, s1, s2 = alive[on], s0[on], s1[on], s2[on]
            term = trie.term[after]
            if term is not None:
                last = one << sizes[rows]
                edits = np.where(s0 & last, 0, np.where(s1 & last, 1, np.where(s2 & last, 2, 9)))
                for k in np.flatnonzero(edits <= allowed_edits(term)).tolist():
                    word, distance = words[rows[k]], int(edits[k])
                    if word not in found or (distance, term) < found[word][::-1]:
                        found[word] = (term, distance)
            step(after, rows, s0, s1, s2, r0[on], r1[on], m[on])

    start = np.ones(len(words), dtype=np.uint64)
    none = start * np.uint64(0)
    step(0, np.arange(len(words)), start, start * np.uint64(3) & inside, start * np.uint64(7) & inside, none, none, none)
    return found


class Scorer:
    """Sums over the hits of a text, with the lexicon's weights and the innocent words."""

    def __init__(self, weights: dict[str, float], innocent: set[str]) -> None:
        self.weights, self.innocent = weights, innocent
        self.trie = Trie.of(sorted(weights))
        self.seen: set[str] = set()
        self.caught: dict[str, tuple[str, int]] = {}

    def learn(self, lists: list[list[str]]) -> None:
        fresh = set().union(*lists).difference(self.seen)
        if len(self.seen) > SEEN_WORDS:
            self.seen = set()
            self.caught = {}
            fresh = set().union(*lists)
        self.seen |= fresh
        meant = {token: [(w, e) for w, e in readings(token) if w not in self.innocent] for token in fresh}
        near = near_terms(sorted({w for found in meant.values() for w, _ in found}), self.trie)
        for token, found in meant.items():
            hits = [(near[w][1] + e, near[w][0]) for w, e in found if w in near]
            if hits:
                edits, term = min(hits)
                self.caught[token] = (term, edits)

    def features(self, text: str, found: list[str]) -> tuple[float, ...]:
        if self.caught.keys().isdisjoint(found):
            return (0.0, 0.0, 0.0, 0.0)
        spans = None
        total = direct = 0.0
        terms, hits = set(), 0
        for i, token in enumerate(found):
            if token not in self.caught:
                continue
            term, edits = self.caught[token]
            weight = self.weights[term] * (NEAR_WEIGHT if edits else 1.0)
            around = {OUTER.sub("", w) for w in found[max(i - WINDOW, 0) : i] + found[i + 1 : i + 1 + WINDOW]}
            if spans is None:
                spans = [m.start() for m in RUN.finditer(text)]
                quotes = [m.start() for m in QUOTES.finditer(text)]
            if quotes and quoted(quotes, spans, i, len(token)):
                weight *= 0.2
            if not REPORTING.isdisjoint(around):
                weight *= 0.5
            if not ADDRESS.isdisjoint(around):
                direct += weight
            total += weight
            terms.add(term)
            hits += 1
        return (math.log1p(total), math.log1p(len(terms)), min(1.0, 20 * hits / len(found)), math.log1p(direct))


def quoted(quotes: list[int], starts: list[int], i: int, size: int) -> bool:
    """Whether token ``i`` has a quotation mark before and after it, each within the window or at its own ends."""
    low = starts[max(i - WINDOW, 0)]
    high = starts[min(i + WINDOW, len(starts) - 1)]
    middle = starts[i] + size / 2
    # Marks are in order: the last one before the token's middle and the first one behind it are the nearest.
    k = bisect(quotes, middle)
    return k > 0 and quotes[k - 1] >= low - 2 and k < len(quotes) and quotes[k] <= high + 20


def _scored(weights: dict[str, float], innocent: set[str], keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights, innocent)
        for batch in batches:
            rows: list[tuple[float, ...]] = []
            block: list[tuple[str, list[str]]] = []
            chars = 0
            texts = batch.column("__text").to_pylist()
            for i, text in enumerate(texts):
                text = text.lower()
                block.append((text, text.split()))
                chars += len(text)
                if chars >= BLOCK_CHARS or i == len(texts) - 1:
                    scorer.learn([found for _, found in block])
                    rows += [scorer.features(*x) for x in block]
                    block, chars = [], 0
            added = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], added], names=[*keep, "features"])

    return run


def with_features(docs: DataFrame, weights: dict[str, float], innocent: set[str]) -> DataFrame:
    """``docs`` (with column ``__text``) without the text, with the list ``features``."""
    keep = [c for c in docs.columns if c != "__text"]
    schema = docs.select(*keep, F.array(F.lit(0.0)).alias("features")).schema
    return docs.mapInArrow(_scored(weights, innocent, keep), schema)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """``__text, toxic`` of at most about ``most`` labelled documents that aren't held out, chosen by a hash."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic"))
    known = checkpointed(known.where(~held_out(F.col("doc_id"))))
    share = min(1.0, most / max(known.count(), 1))
    chosen = known.where(chosen_by_hash(F.col("doc_id"), share))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("__text"))
    return checkpointed(rows.join(F.broadcast(chosen), "doc_id").select("__text", "toxic"))


def log_ratio(a: Column, b: Column, ones: float, zeros: float) -> Column:
    """The likelihood-ratio statistic (chi-squared with one degree) of ``a`` of ``ones`` and ``b`` of ``zeros`` rows having a word."""
    share = (a + b) / (ones + zeros)
    cells = [(a, share * ones), (b, share * zeros), (ones - a, (1 - share) * ones), (zeros - b, (1 - share) * zeros)]
    return 2 * sum((F.when(have > 0, have * F.log(have / due)).otherwise(0.0) for have, due in cells), F.lit(0.0))


def learn_lexicon(rows: DataFrame) -> tuple[dict[str, float], set[str]]:
    """Terms with their log-odds, and the innocent words that are near a term.

    A term is in ``LEAST_TOXIC_DOCS`` toxic rows at least, has log-odds of ``LEAST_LOG_ODDS``, and its likelihood ratio is
    beyond what ``FALSE_TERMS`` words of all that were tested would reach by chance; terms of two and three letters are
    taken without edits only. Of more than ``LEXICON_SIZE`` terms the strongest are taken. An innocent word is in two clean rows at
    least and no term.
    """
    totals = rows.agg(F.sum("toxic"), F.count("*")).first()
    toxic, clean = float(totals[0] or 0), float(totals[1] - (totals[0] or 0))
    if not toxic or not clean:
        warnings.warn("no labelled rows of both kinds: every document scores 0", stacklevel=2)
        return {}, set()
    lower = F.lower("__text")
    tokens = F.transform(F.split(lower, r"\s+"), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    words = F.array_distinct(F.concat(F.split(lower, r"[^\p{L}]+"), tokens))
    counts = rows.select("toxic", F.explode(words).alias("word")).where(F.length("word").between(2, LONGEST_WORD))
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).where("a + b >= 2")
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (clean + 1))
    counts = checkpointed(counts.withColumn("odds", odds).withColumn("ratio", log_ratio(F.col("a"), F.col("b"), toxic, clean)))
    tested = counts.where((F.col("a") + F.col("b") >= LEAST_TOXIC_DOCS) & (F.length("word") <= LONGEST_WORD - 2) & F.col("word").rlike(r"^\p{L}+$"))
    # exp(-x / 2) bounds the tail of the chi-squared distribution with one degree.
    least = 2 * math.log(max(tested.count(), 1) / FALSE_TERMS)
    strong = tested.where((F.col("a") >= LEAST_TOXIC_DOCS) & (F.col("odds") >= LEAST_LOG_ODDS) & (F.col("ratio") >= least))
    best = strong.orderBy(F.desc("ratio"), "word").limit(LEXICON_SIZE)
    weights = {r.word: float(r.odds) for r in best.collect()}
    if not weights:
        return {}, set()
    terms = sorted(weights)

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie.of(terms)
        for batch in batches:
            words = batch.column("word").to_pylist()
            near = near_terms(words, trie)
            yield pa.RecordBatch.from_arrays([pa.array([w for w in words if w in near], pa.string())], names=["word"])

    innocent = counts.where((F.col("b") >= 2) & ~F.col("word").isin(terms)).select("word").mapInArrow(beside, "word string")
    return weights, {r.word for r in innocent.toLocalIterator()}


def score(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Labels are learnt from at most about ``most`` rows whose crc32 of the id is not divisible by 5; a document
    labelled twice counts by its greater label, null labels don't count. The score uses the text alone. Null
    and empty texts have no hits and score like a text without any. Without labels of both kinds all scores
    are 0. A null id counts as empty text for ``held_out``; repeated rows score alike.
    """
    rows = training_rows(docs, labels, most)
    weights, innocent = learn_lexicon(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("__text"))
    measured = with_features(texts, weights, innocent)
    if weights:
        seen = checkpointed(with_features(rows, weights, innocent)).withColumn("x", array_to_vector("features"))
        model = LogisticRegression(featuresCol="x", labelCol="toxic", regParam=0.001, standardization=True, maxIter=60).fit(seen)
        z = F.lit(float(model.intercept))
        for k, c in enumerate(model.coefficients):
            z = z + F.lit(float(c)) * F.get("features", F.lit(k))
        chance = 1 / (1 + F.exp(-z))
    else:
        chance = F.lit(0.0)
    scored = measured.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), chance.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_levenshtein_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
