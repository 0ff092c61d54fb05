"""The pipeline's stages against brute force, each on what the one before has kept."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
import sentencepiece

import corpus_pipeline
from flowmarts.llm import sentence_pieces

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def good(rows):
    """Documents that pass, without frequent lines."""

    def norm(line):
        return re.sub(r"[\x20\x09-\x0D]+", " ", line.translate(LOWER)).strip(" ")

    holders, texts = defaultdict(set), defaultdict(set)
    for doc, text, lang, source, n in rows:
        texts[source].add(text)
        for line in text.split("\n"):
            if norm(line):
                holders[source, norm(line)].add(text)
    often = {k for k, v in holders.items() if len(v) >= 20 and 100 * len(v) >= 10 * len(texts[k[0]])}
    out = []
    for doc, text, lang, source, n in rows:
        found = words(text)
        at = defaultdict(list)
        for i in range(len(found) - 2):
            at[tuple(found[i : i + 3])].append(i)
        covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
        lines = text.split("\n")
        lost = sum(len(words(x)) for x in lines if (source, norm(x)) in often)
        if len(found) >= 50 and 100 * len(covered) <= 50 * len(found) and 100 * lost <= 50 * len(found):
            clean = "\n".join(x for x in lines if (source, norm(x)) not in often)
            out.append((doc, clean, lang, source, len(clean)))
    return out


def last_of_equal(rows):
    best = {}
    for r in rows:
        key = r[1].translate(LOWER)
        best[key] = max(best.get(key, r), r, key=lambda x: x[0])
    return list(best.values())


def least_of_near(rows):
    sets = []
    for r in rows:
        found = words(r[1].translate(LOWER))
        sets.append({tuple(found[i : i + 5]) for i in range(len(found) - 4)} or ({tuple(found)} if found else set()))
    above = list(range(len(rows)))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                above[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        least[top(i)] = min(least.get(top(i), r), r, key=lambda x: x[0])
    return list(least.values())


def drawn(rows):
    counts = Counter(r[3] for r in rows)
    total = sum(math.sqrt(n) for n in counts.values())
    out = []
    for r in rows:
        n = counts[r[3]]
        rate = math.sqrt(n) * len(rows) / (total * n)
        digest = hashlib.md5(f"29|{r[0]}|{hashlib.md5(r[1].encode()).hexdigest()}".encode()).hexdigest()
        u = (int(digest[:8], 16) * 2**20 + int(digest[8:13], 16)) / 2**52
        term = below = math.exp(-rate)
        k = 0
        while below <= u:
            k += 1
            term *= rate / k
            below += term
        out += [r] * k
    return out


@pytest.fixture(scope="module")
def folder(spark, small, tmp_path_factory):
    return str(tmp_path_factory.mktemp("stages"))


def test_stages_against_brute_force(spark, small, folder):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert docs.columns == COLUMNS
    plain = {"quality": good, "exact_dedup": last_of_equal, "near_dedup": least_of_near, "mixing": drawn}
    library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        stage(spark, docs, small).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if name == "encoding":
            got = sorted((r.doc_id, r.source, tuple(r.ids)) for r in docs.collect())
            assert got == sorted((r[0], r[3], tuple(library.encode(r[1]))) for r in before)
            assert all(r.round_trip for r in docs.collect())
        else:
            assert docs.columns == COLUMNS
            assert sorted(tuple(r) for r in docs.collect()) == sorted(plain[name](before)), name


def test_run_takes_all_stages(spark, small):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "encoding"]
    result = corpus_pipeline.run(spark, small)
    assert result.count() > 0 and result.where("not round_trip").count() == 0
