"""Operators that SQL expresses: against DuckDB on the small tables, and their edge cases."""

import zlib

import pytest
from pyspark.sql import functions as F

from checks import compare
from flowmarts.llm import exact_dedup, line_quality, mixing, near_dup, shards
from flowmarts.llm.duckdb_sql import SQL
from flowmarts.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank int, n int, copies string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, ties, other rows of the same id, columns with clashing names."""
    long = " ".join(f"word{i % 700}" for i in range(20_000)) + "\n" + "x" * 30_000
    texts = [None, "", "  \t ", "Same text", "same TEXT", "same text", long, long, "É é \U0001f600 card", "a b c a b c a b c " * 20]
    rows = [(i, t, "en", None if i % 3 == 0 else f"s{i % 2}", None, 1, 2, "c") for i, t in enumerate(texts)]
    rows += [rows[3], rows[6], (None, "same text", None, None, 0, None, None, None), (3, "another", "en", "s1", 1, 1, 1, "x")]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, small, monkeypatch, name):
    monkeypatch.setitem(compare.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(compare.SQL, name, SQL[name])
    assert compare.difference(spark, compare.connect(small), small, name) is None


def test_chunks_put_together_are_the_text():
    for body in (b"", b"a", b"ab" * 50_000, bytes(range(256)) * 300, "é\U0001f600\n".encode() * 9_000):
        cuts = exact_dedup.cut_points(body)
        assert cuts[-1] == len(body) and cuts == sorted(set(cuts))
        assert all(b - a <= exact_dedup.MAX_CHUNK for a, b in zip([0, *cuts], cuts))


def test_equal_stretches_are_cut_alike():
    import random

    random.seed(1)
    middle = bytes(random.randrange(97, 123) for _ in range(60_000))
    one, two = (set(), set())
    for seen, lead in ((one, b"short"), (two, bytes(random.randrange(97, 123) for _ in range(3_000)))):
        body, start = lead + middle, 0
        for end in exact_dedup.cut_points(body):
            seen.add(body[start:end])
            start = end
    assert len(one & two) > 0.8 * len(one)


def test_exact_dedup_of_odd_rows(odd):
    rows = exact_dedup.duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.text_sha256, []).append(r)
    for group in by.values():
        ids = [r.doc_id for r in group if r.doc_id is not None]
        assert {r.keep_id for r in group} == {max(ids)} and {r.group_size for r in group} == {len(group)}
    assert {r.doc_id for r in rows if r.kept} == {1, 2, 3, 5, 7, 8, 9}
    kept = exact_dedup.deduplicate(odd)
    assert kept.columns == odd.columns


def test_forged_md5_takes_the_digest(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: F.lit("0" * 32), raising=True)
    rows = exact_dedup.duplicates(spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")).collect()
    assert {r.doc_id: r.keep_id for r in rows} == {1: 3, 2: 2, 3: 3}


def test_shards_of_odd_rows(odd):
    out = shards.assign(odd).collect()
    assert len(out) == odd.count()
    sizes = {}
    for r in out:
        sizes.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in sizes.values())
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1 and set(sizes) <= set(range(8))
    want = sorted(((r.text or "").encode() for r in odd.collect()), key=lambda b: (len(b), zlib.crc32(b)))
    assert sorted((r["size"] - 1, r.text_crc32) for r in out) == [(len(b), zlib.crc32(b)) for b in want]


def test_shards_match_the_mixture(spark):
    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 5 < 2, "hot").otherwise("cold").alias("source"))
    for r in shards.assign(docs).groupBy("shard", "stratum").count().collect():
        assert abs(r["count"] - (200 if r.stratum == "hot" else 300)) <= 2


def test_written_shards(spark, odd, tmp_path):
    """Null and repeated ids and repeated rows take one place each."""
    docs = odd.union(odd.limit(3)).union(odd.selectExpr("cast(null as bigint)", *odd.columns[1:]))
    places = shards.assign(docs)
    shards.write_shards(docs, places, f"{tmp_path}/out")
    out = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(str, out.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert {(r.shard, r.slot) for r in out.collect()} == {(r.shard, r.slot) for r in places.collect()}


def test_rows_with_one_id_are_dealt_by_their_texts(spark):
    docs = spark.range(9_000).selectExpr("cast(null as bigint) as doc_id", "concat('text ', id) as text", "'s' as source")
    assert docs.select(shards.shuffle_key(1, F.col("doc_id"), F.crc32(F.col("text").cast("binary")))).distinct().count() > 8_990
    per_shard = {r.shard: r["count"] for r in shards.assign(docs).groupBy("shard").count().collect()}
    assert per_shard == {k: 1_125 for k in range(8)}


def test_mixing_of_odd_rows(odd):
    out = mixing.mix(odd, target_rows=400).collect()
    assert {r.copies for r in out} and all(isinstance(r.copies, int) and 1 <= r.copy <= r.copies for r in out)
    assert len({r.mix_key for r in out}) <= len(out)
    assert mixing.mix(odd, weights={"s1": 1.0}, target_rows=100).select("source").distinct().collect()[0].source == "s1"


def test_poisson_counts_have_their_mean(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"))
    for rate in (0.3, 2.5, 40.0):
        n = mixing.mix(docs, target_rows=int(20_000 * rate)).groupBy("doc_id").count()
        mean, square = n.agg(F.sum("count") / 20_000, F.sum(F.pow("count", F.lit(2))) / 20_000).first()
        assert abs(mean - rate) < 0.05 * rate and abs(square - mean**2 - rate) < 0.1 * rate


@pytest.mark.parametrize("rate", [700, 800, 5_000])
def test_poisson_counts_of_large_rates(spark, rate):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"))
    n = mixing.mix(docs, target_rows=400 * rate).groupBy("doc_id").agg(F.count("*").alias("n"), F.max("copies").alias("copies"))
    rows = n.collect()
    mean = sum(r.n for r in rows) / 400
    variance = sum((r.n - mean) ** 2 for r in rows) / 399
    assert all(r.n == r.copies for r in rows)
    assert abs(mean - rate) < 5 * (rate / 400) ** 0.5
    assert abs(variance - rate) < 0.36 * rate


def plain_measures(text):
    import re

    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(found) - 2):
        windows.setdefault(tuple(found[i : i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(found), sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_quality_of_odd_rows(odd, spark):
    many = "\n".join(f"line {i % 40} of this text, {i % 90} {i}" for i in range(3_000))
    docs = odd.select("doc_id", "text", "source").union(spark.createDataFrame([(100, many, "s"), (101, "a b " * 5_000, "s")], "doc_id long, text string, source string"))
    texts = docs.withColumn("removed", F.lit("x")).withColumn("verdict", F.lit(1))
    for r in line_quality.judge(texts).collect():
        v = r.verdict
        assert (v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words) == plain_measures(r.text)
        assert v.base_failed == (v.n_words < 50 or 100 * v.n_repeat_words > 50 * v.n_words)


def test_frequent_lines_go_and_depleted_documents_too(spark):
    furniture = "Subscribe to our   LETTER today and read on for more of this"
    rows = []
    for i in range(40):
        own = "\n".join(" ".join(f"w{i}x{j}y{k}" for k in range(12)) for j in range(6))
        rows.append((i, f"{furniture}\n{own}" if i < 30 else own, "host"))
    rows.append((99, "\n".join([furniture] * 5) + "\n" + " ".join(f"z{k}" for k in range(30)), "host"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.text for r in line_quality.keep_good(docs).collect()}
    assert set(kept) == set(range(40))
    assert not any("Subscribe" in t for t in kept.values())


def near_copies_of(base, n, first, draw):
    """``n`` texts like ``base``, each with one word changed, in other case or with other white space."""
    for i in range(n):
        lines = [list(line) for line in base]
        line = draw.choice(lines)
        line[draw.randrange(len(line))] = f"other{first + i}"
        text = "\n".join(" ".join(line) for line in lines)
        yield (first + i, text.upper() if i % 10 == 1 else text.replace(" ", "  ") if i % 10 == 2 else text, "en", "s", len(text))


@pytest.mark.parametrize("n_lines", [6, 20])
def test_near_copies_vouch_once(spark, n_lines):
    """1,000 near copies in one source leave a clean document that gets through to near-dedup; a footer still goes."""
    import random

    import corpus_pipeline

    draw = random.Random(3)
    base = [[f"w{draw.randrange(4_000)}" for _ in range(10)] for _ in range(n_lines)]
    footer = "read more of this in our letter"
    rows = list(near_copies_of(base, 1_000, 0, draw))
    for i in range(300):
        own = "\n".join(" ".join(f"v{draw.randrange(10**6)}" for _ in range(10)) for _ in range(8))
        rows.append((5_000 + i, f"{own}\n{footer}" if i < 60 else own, "en", "s", 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    judged = {r.doc_id: r for r in line_quality.judge(docs).collect()}
    assert all(judged[i].verdict.kept and judged[i].verdict.clean_text == judged[i].text for i in range(1_000))
    assert not any(footer in judged[5_000 + i].verdict.clean_text for i in range(300))
    stages = dict(corpus_pipeline.STAGES)
    for name in ("quality", "exact_dedup", "near_dedup"):
        docs = stages[name](spark, docs, "")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert sum(i < 1_000 for i in ids) >= 1 and sum(i >= 5_000 for i in ids) == 300


@pytest.mark.parametrize("operator", [exact_dedup.duplicates, shards.assign, mixing.mix, line_quality.judge])
def test_empty_table(odd, operator):
    assert operator(odd.limit(0)).collect() == []




PROBE = [(3, "same text here"), (7, "same text here"), (3, "another"), (None, "same text here"), (None, "lonely"), (7, "Same text here"), (9, None), (9, ""), (9, "another one")]


def test_exact_dedup_leaves_one_of_each_text(spark):
    """Null and repeated ids, an id with several texts, equal rows."""
    rows = [(i, t, n) for n, (i, t) in enumerate(PROBE)] + [(7, "same text here", 50), (9, "another one", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    got = exact_dedup.deduplicate(docs)
    assert got.columns == docs.columns
    texts = sorted((r.doc_id or 0, (r.text or "").lower()) for r in got.collect())
    assert texts == [(0, "lonely"), (3, "another"), (7, "same text here"), (9, ""), (9, "another one")]
    assert exact_dedup.deduplicate(docs.limit(0)).collect() == []


def test_near_dedup_leaves_one_of_each_component(spark):
    long = " ".join(f"w{i}" for i in range(100))
    near = long.replace("w50", "changed")
    rows = [*PROBE, (3, "same text here"), (None, long), (None, near), (5, near + " end"), (5, "lonely"), (None, "only null"), (None, "only null"), (2, None), (2, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, root string")
    got = near_dup.deduplicate(docs)
    assert got.columns == docs.columns
    found = sorted((r.doc_id or 0, r.text or "") for r in got.collect())
    # Rows without words are linked with nothing.
    assert found == sorted([(3, "same text here"), (3, "another"), (5, "lonely"), (9, "another one"), (5, near + " end"), (0, "only null"), (2, ""), (2, ""), (9, ""), (9, "")])
    assert near_dup.deduplicate(docs.limit(0)).collect() == []


def jaccard_components(sets):
    """Least id that each id reaches over links of 0.75, by comparing all pairs."""
    least = {i: i for i in sets}

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and sets[i]:
                one, two = sorted((top(i), top(j)))
                least[two] = one
    return {i: top(i) for i in ids}


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_near_groups_of_half_alike_texts(spark):
    """Texts that share a passage in all degrees, and chains of links, against all pairs."""
    import random

    random.seed(12)
    passage = [f"p{i}" for i in range(200)]
    texts = {}
    for i in range(220):
        own = random.choice([10, 20, 28, 32, 36, 45, 60, 90])
        start = random.randrange(0, 30)
        texts[i] = " ".join(passage[start:] + [f"o{i}x{k}" for k in range(own)])
    for i in range(220, 280):
        base = texts[random.randrange(i - 1)].split()
        for _ in range(random.randrange(1, 9)):
            base[random.randrange(len(base))] = f"c{random.randrange(999)}"
        texts[i] = " ".join(base)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()}
    assert got == jaccard_components({i: shingles(t) for i, t in texts.items()})


def test_a_large_group_of_unlinked_texts_makes_few_pairs(spark, monkeypatch):
    """5,000 texts that are 0.5 to 0.74 alike to each other: candidate pairs grow with the texts, not with their square."""
    rows = spark.range(5_000).selectExpr(
        "id as doc_id",
        "concat(array_join(transform(sequence(0, 119), x -> concat('p', x)), ' '), ' ', array_join(transform(sequence(0, 24 + cast(id % 20 as int)), x -> concat('o', id, 'x', x)), ' ')) as text",
    )
    made, crossing = [], near_dup._crossing

    def counted(members, bodies):
        pairs = crossing(members, bodies)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(near_dup, "_crossing", counted)
    got = near_dup.near_duplicates(rows).collect()
    assert all(r.kept for r in got) and len(got) == 5_000
    assert made[0] < 5_000


def test_rarest_shingles_lose_no_link(spark):
    """Every linked pair of random sets is among the pairs that meet by their rarest shingles."""
    import random

    random.seed(13)
    sets = [set(random.sample(range(60), random.randrange(5, 45))) for _ in range(40)]
    for i in range(40, 140):
        base = set(random.choice(sets))
        for _ in range(random.randrange(0, 6)):
            base ^= {random.randrange(80)}
        sets.append(base or {1})
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "cls long, body array<long>")
    members = frame.select(F.lit(1).alias("bucket"), "cls", F.size("body").cast("long").alias("n"), F.size("body").cast("long").alias("common"), F.col("cls").alias("component"))
    got = {(r.a, r.b) for r in near_dup._crossing(members, frame).collect()}
    linked = {(i, j) for i in range(140) for j in range(i + 1, 140) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert len(linked) > 100 and linked <= got
