"""Operators that SQL doesn't express: against brute force, round trips and held-out accuracy."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from flowmarts.llm import common, host_paths, licenses, near_dup, personal_data, sentence_pieces, superminhash, toxicity
from flowmarts.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"word{i % 900}" for i in range(15_000)) + "\n" + "x" * 20_000
    texts = [None, "", " \n ", "four words are here", "Four words ARE here", long, long + " tail", "É é \U0001f600 ▁ mark", "one"]
    rows = [(i, t, "x", 1, 2.0) for i, t in enumerate(texts)]
    rows += [rows[3], (None, "four words are here", None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n long, features double")


# -- near-duplicates ----------------------------------------------------------------


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} or ({tuple(found)} if found else set())


def plain_groups(rows):
    sets = [shingles(t) for _, t in rows]
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
    for i, (doc, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), doc), doc)
    return {(doc, len(sets[i]), least[top(i)], doc == least[top(i)]) for i, (doc, _) in enumerate(rows)}


def test_near_duplicates_are_those_of_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {tuple(r) for r in near_dup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()}
    assert got == plain_groups(rows)


def test_copies_of_copies_link_without_all_pairs(spark):
    """A family in which copies are further from each other than from what they were made of."""
    random.seed(4)
    base = [f"w{random.randrange(3000)}" for _ in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        words = list(base)
        for _ in range(5):
            words[random.randrange(200)] = f"v{random.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in near_dup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()}
    assert got == plain_groups(rows)


def test_near_duplicates_of_odd_rows(odd):
    got = near_dup.near_duplicates(odd).collect()
    named = {tuple(r) for r in got if r.doc_id is not None}
    assert named == plain_groups([(r.doc_id, r.text) for r in odd.where("doc_id is not null").collect()])
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert near_dup.near_duplicates(odd.limit(0)).collect() == []


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100)] + [(500, 500 + i) for i in range(1, 300)] + [(7, 7)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(7)
    roots = {r.node: r.root for r in near_dup.components(frame).collect()}
    assert {roots[i] for i in range(101)} == {0} and {roots[i] for i in range(500, 800)} == {500}


def test_few_links_take_one_round(spark, monkeypatch):
    """The links of a small table, dealt over many partitions, are joined without a round per merge of partitions."""
    links = [(i, i + 1) for i in range(100)] + [(500, 500 + i) for i in range(1, 300)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(60).checkpoint()
    written = []
    monkeypatch.setattr(near_dup, "checkpointed", lambda df: written.append(1) or common.checkpointed(df))
    roots = {r.node: r.root for r in near_dup.components(frame, at_most=len(links)).collect()}
    assert {roots[i] for i in range(101)} == {0} and {roots[i] for i in range(500, 800)} == {500} and len(written) == 1
    monkeypatch.setattr(near_dup, "LINKS_A_TASK", 20)
    assert {r.node: r.root for r in near_dup.components(frame).collect()} == roots and len(written) > 3


def test_signatures_estimate_the_similarity_with_less_variance():
    draw = np.random.default_rng(1)
    errors = []
    for _ in range(150):
        values = draw.integers(0, 2**63, 140, dtype=np.uint64)
        one, two = np.unique(values[:120]), np.unique(values[20:])
        s = superminhash.signatures([one, two])
        errors.append((s[0] == s[1]).mean() - 100 / 140)
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < (100 / 140 * 40 / 140 / superminhash.SLOTS) ** 0.5


# -- pieces -------------------------------------------------------------------------


def test_encoding_is_the_librarys_and_decodes(spark, small, odd):
    library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    encoded = sentence_pieces.encode(docs.withColumn("raw", F.col("text")))
    for r in sentence_pieces.decode(encoded).collect():
        assert r.ids == library.encode(r.raw or "") and r.n_ids == len(r.ids)
        assert r.round_trip and r.text == (r.raw or "").replace("▁", " ")
    assert sentence_pieces.encode(odd.limit(0)).collect() == []


def test_streaming_agrees_on_awkward_texts():
    model = open(sentence_pieces.MODEL, "rb").read()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = sentence_pieces.Pieces(model)
    random.seed(2)
    parts = ["the ", "ing", "  ", "\n", "é", "日", "\U0001f600", "ab", " x", "\t", "<s>", "12", "!!!!", "----", " " * 9, "tion", "ré"]
    texts = ["".join(random.choices(parts, k=random.randrange(40))) for _ in range(800)]
    texts += [" " * k for k in range(40)] + ["abcdefgh" * 2000, "\x01\x02" * 500, "".join(random.choices("etaoinshrdlu", k=9000))]
    for text, ids in zip(texts, pieces.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(text)


def test_ids_are_committed_before_the_text_ends():
    pieces = sentence_pieces.Pieces(open(sentence_pieces.MODEL, "rb").read())
    read = []

    class Counted(str):
        def __iter__(self):
            for c in str.__iter__(self):
                read.append(c)
                yield c

    first = next(pieces.viterbi(Counted("information" * 500)))
    assert first and len(read) < 500


# -- html ---------------------------------------------------------------------------

PAGE = """<html><body><nav><a href=/>Home</a></nav><div class="ad">Buy</div><article class="post-17"><h1>Head &amp; line</h1>
<p>One <b>bold</b> and<br>two.<script>x="<p>"</script><p>Three &lt; four &#233;<aside>Side</aside><ul><li>a<li>b</ul>
<form>f<input></form><div class="comments"><p>{comment}</p></div></article>{after}<footer>&copy; us</footer>"""


def test_extraction_of_a_page():
    html = PAGE.format(comment="nice!", after="")
    assert host_paths.extracted(html, None) == "Head & line\n\nOne bold and two.\n\nThree < four é\n\na\n\nb"


def test_the_host_decides(spark):
    """A page whose largest container is a thread that no rule knows follows the other pages of its host."""
    thread = "<div class=thread><p>" + "me too " * 400 + "</p></div>"
    rows = [(i, f"https://h.example/{i}", PAGE.format(comment="nice!", after=thread if i == 0 else "")) for i in range(5)]
    rows += [(9, None, None), (10, "https://h.example/x", ""), (11, "//o.example", "<p>only this"), (12, "https://h.example/y", "<section><p>no article here</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r.text for r in host_paths.extract(pages).collect()}
    assert {got[i] for i in range(5)} == {"Head & line\n\nOne bold and two.\n\nThree < four é\n\na\n\nb"}
    assert (got[9], got[10], got[11], got[12]) == ("", "", "only this", "no article here")
    assert host_paths.extract(pages.limit(0)).collect() == []


def test_names_inside_an_article():
    """What belongs to the text stays whatever its class resembles; notices, adverts, forms, sharing and comments go."""
    html = (
        '<body><div class="legal">Imprint</div><article><header class="entry-header"><h1>Head</h1></header><section id="related-work"><p>Earlier work.</p></section>'
        '<div class="share-price">12 pence</div><p class="legal">A ruling.</p><div class="share-buttons">Tweet</div><div class="cookie-notice">Cookies</div>'
        '<div class="ad-slot-3">Buy</div><div id="comments"><p>First!</p></div><p>End.</p></article>'
    )
    assert host_paths.extracted(html, None) == "Head\n\nEarlier work.\n\n12 pence\n\nA ruling.\n\nEnd."
    assert host_paths.extracted(html.replace("article>", "main>"), None) == host_paths.extracted(html, None)


def test_pages_without_articles_follow_their_host(spark):
    """Lead and body are both kept, a page whose own reading differs follows the vote, another template doesn't."""
    body = "<p>" + "some prose of the story " * 30 + "</p>"
    page = '<body class="b"><div class=top>Site</div><div class="wrap"><div class="intro"><p>' + "the lead of it " * 20 + '</p></div><div class="content">{}</div></div>{}'
    rows = [(i, f"https://h.example/{i}", page.format(body, "")) for i in range(5)]
    rows.append((5, "https://h.example/5", page.format(body, "<div class=tail><p>" + "chatter " * 60 + "</p></div>")))
    rows.append((6, "https://h.example/6", '<body class="b"><div class="wrap"><p>Teaser.</p></div><div class="story">' + body + "</div>"))
    got = {r.page_id: r.text for r in host_paths.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    story = ("some prose of the story " * 30).strip()
    assert {got[i] for i in range(6)} == {("the lead of it " * 20).strip() + "\n\n" + story}
    assert got[6] == story
    assert "chatter" in host_paths.extracted(rows[5][2], None)


def plain_consensus(rows):
    """The vote and the extraction by lists of path texts, every page compared with every path."""
    pages = {i: (re.match("https?://([^/]*)", u)[1], host_paths.Page(h)) for i, u, h in rows}
    votes = {}
    for host, page in pages.values():
        if page.best():
            votes.setdefault(host, []).append(page.best())
    out = {}
    for i, (host, page) in pages.items():
        held = votes.get(host, [])
        best = min(set(held), key=lambda p: (-held.count(p), p), default=None)
        use = best if best is not None and page.follows(best) else page.best() or b""
        chains = []
        for p, _ in page.blocks:
            chain = []
            while p >= 0:
                chain.append(page.paths.digests[p])
                p = page.paths.parents[p]
            chains.append(chain)
        out[i] = "\n\n".join(t for (_, t), c in zip(page.blocks, chains, strict=True) if use == b"" or use in c)
    return out


def test_the_vote_against_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")
    # Pages of a second kind: the same text in plain divisions.
    other = F.regexp_replace(F.regexp_replace("html", "<article>", "<div class='story p12'>"), "</article>", "</div><div class='more'>Read on</div>")
    both = pages.union(pages.where("page_id % 3 = 1").select(F.col("page_id") + 10**6, "url", other))
    got = {r.page_id: r.text for r in host_paths.extract(both).collect()}
    assert got == plain_consensus([tuple(r) for r in both.where("html is not null").collect()])


def test_deep_nesting_takes_linear_time():
    import time

    for html in ('<div class="a">' * 100_000 + "<p>here", "<span>" * 100_000 + "here", "<ul><li>" * 50_000 + "here", "<p><b>" * 50_000 + "here"):
        began = time.perf_counter()
        assert host_paths.extracted(html, None) == "here"
        assert time.perf_counter() - began < 6
    assert host_paths.extracted("<a " * 300_000, None) == ("<a " * 300_000).strip()[:-3].strip()


def test_pages_against_a_plain_reading(spark, small):
    import html

    for r in QUERIES["op2_consensus_paths"](spark, small).join(spark.read.parquet(f"{small}/pages.parquet").select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " ")))).strip() for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)


# -- personal data ------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    ones = [int(d) for d in digits[::-1]]
    return (sum(ones[::2]) + sum(sum(divmod(2 * d, 10)) for d in ones[1::2])) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and plain_luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


@pytest.fixture(scope="module")
def private(spark, small):
    texts = [
        "a@b.c_x@d.e.f, 1.2.3.4.5.6.7.8 001.2.3.0255 256.1.1.1 4111 1111-1111 1111 4111111111111111222 +1 (017) 555-7713 x@@y.z",
        "é\U0001f600 x@y.zz +1" + " " * 50 + "2",
        "write to john.doe [at] mail7 [dot] example [dot] com or call 1 (017) 555-7713. Card 4111.1111.1111.1111, host 10[.]0[.]0[.]1",
        "We met at noon. The dot. In 2020 2021 2022 it was version 1.2.3 of 12345678901234567.",
        "9" * 20_000 + " " + "a" * 20_000 + " " + "1." * 5_000 + "@",
        "",
        None,
    ]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    return docs.union(spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))


def test_base_spans_and_added_ones(spark, private):
    texts = {r.doc_id: r.text for r in private.collect()}
    rows = {r.doc_id: r for r in personal_data.digest(private).collect()}
    assert len(rows) == len(texts)
    for doc, r in rows.items():
        want = plain_spans(texts[doc])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        assert r.n_added == len(list(filter(None, r.spans.split(",")))) - len(list(filter(None, want.split(","))))
        assert sum((r.n_email, r.n_ip, r.n_card, r.n_phone)) == len(list(filter(None, want.split(","))))
    hidden = rows[10**9 + 2]
    text = texts[10**9 + 2]
    assert {text[int(a) : int(b)] for _, a, b in (s.split(":") for s in hidden.spans.split(","))} >= {"john.doe [at] mail7 [dot] example [dot] com", "10[.]0[.]0[.]1"}
    assert rows[10**9 + 3].n_added == 0
    assert sum(r.n_added for d, r in rows.items() if d < 10**9) == 0


def test_redaction(spark, private):
    out = {r.doc_id: r.text for r in personal_data.redact(private.where("doc_id >= 1000000000")).collect()}
    assert out[10**9 + 1] == "é\U0001f600 [email] +1" + " " * 50 + "2"
    assert personal_data.digest(private.limit(0)).collect() == []


def test_trees_learn_from_every_document(spark):
    docs = spark.range(30_000).selectExpr("id as doc_id", "concat('write to user', id % 25000, '@mail.example.com now') as text")
    ones = personal_data.examples(docs).where("label = 1")
    assert ones.agg(F.sum("n")).first()[0] == 30_000 and ones.count() == 25_000


# -- toxicity -----------------------------------------------------------------------


def distance(a, b):
    """Edits of single letters and swaps of neighbours, no letter edited twice."""
    table = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            best = min(table[i - 1][j] + 1, table[i][j - 1] + 1, table[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                best = min(best, table[i - 2][j - 2] + 1)
            table[i][j] = best
    return table[-1][-1]


def test_automata_catch_what_edit_distance_says():
    random.seed(5)
    terms = ["moron", "disgusting", "worthless", "scum", "réeuxment", "bad", "moro"]
    words = {"".join(random.choices("moronscudigtéx", k=random.randrange(1, 12))) for _ in range(1500)} | set(terms)
    for term in terms:
        for _ in range(60):
            word = list(term)
            for _ in range(random.randrange(1, 4)):
                at = random.randrange(len(word) + 1)
                word[at : at + random.randrange(2)] = random.choices("abmor", k=random.randrange(2))
                if random.random() < 0.5 and at + 1 < len(word):
                    word[at], word[at + 1] = word[at + 1], word[at]
            words.add("".join(word))
    words.discard("")
    got = toxicity.near_terms(sorted(words), toxicity.Trie.of(terms))
    for word in words:
        best = min(((distance(word, t), t) for t in terms if distance(word, t) <= toxicity.allowed_edits(t)), default=None)
        assert got.get(word) == (best and best[::-1]), word


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    scored = toxicity.score(docs, labels).join(labels, "doc_id").where("held_out")
    table = {(r.toxic, r.predicted): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    assert table[1, 1] >= 0.9 * (table[1, 1] + table.get((1, 0), 0))
    assert table[1, 1] >= 0.95 * (table[1, 1] + table.get((0, 1), 0))


def test_quotation_counts_less():
    scorer = toxicity.Scorer({"moron": 7.0}, set())
    texts = ["you moron go away now", 'the critic said he was called a "moron" in print']
    lists = [t.split() for t in texts]
    scorer.learn(lists)
    abuse, quote = (scorer.features(t, found) for t, found in zip(texts, lists))
    assert abuse[0] > 2 * quote[0] and abuse[3] > 0 == quote[3]


def test_lexicon_and_disguises(spark):
    """On the whole table few clean texts have a hit, and planted disguises of a term are caught."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    weights, innocent = toxicity.learn_lexicon(toxicity.training_rows(docs, labels))
    clean = docs.join(labels.where("toxic = 0").select("doc_id").distinct(), "doc_id").withColumnRenamed("text", "__text")
    hits = toxicity.with_features(clean, weights, innocent).agg(F.avg((F.col("features")[0] > 0).cast("int"))).first()[0]
    assert hits < 0.05
    disguised = ["id1ot", "st*pid", "m0ron", "idoit", "stuipd", "i_d_i_o_t", "idiooooot", "w0rthl3ss", "tra$h", "scvm", "idiot" + "t" * 90, "pathetic!!", "Moron,"]
    plain = docs.join(labels.where("toxic = 0").select("doc_id"), "doc_id").orderBy("doc_id").limit(20)
    rows = [(10**9 + 100 * i + k, f"you are such a {w} and {r.text[:300]}") for i, r in enumerate(plain.collect()) for k, w in enumerate(disguised)]
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    scored = toxicity.score(docs.union(planted), labels).where("doc_id >= 1000000000")
    assert scored.agg(F.avg("predicted")).first()[0] >= 0.9


def test_training_rows_exist_at_any_size(spark):
    """A share of 10^-7 of a table still gives rows: the choice is made on 64 bits of the hash."""
    rows = spark.range(0, 60_000_000, 1, 8)
    chosen = rows.where(common.chosen_by_hash(F.col("id"), 1e-7 * 5)).count()
    assert 5 <= chosen <= 80
    assert rows.limit(10).where(common.chosen_by_hash(F.col("id"), 1.0)).count() == 10
    assert rows.where(common.chosen_by_hash(F.col("id"), 2.0**-63)).count() <= 1


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(3, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    rows = toxicity.score(odd, labels).collect()
    assert len(rows) == odd.count() and all(r.score == 0 and r.predicted == 0 for r in rows)
    assert toxicity.score(odd.limit(0), labels.limit(0)).collect() == []


# -- licences -----------------------------------------------------------------------


def test_licence_lines_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = {"MIT License": "MIT", "GNU General Public License, version 3": "GPL", "CC BY-NC 4.0": "CC-BY-NC", "Apache License, Version 2.0": "Apache"}
    rows = {r.doc_id: r.licences for r in licenses.licences(docs).collect()}
    for r in docs.collect():
        assert rows[r.doc_id] == ",".join(sorted(f for k, f in known.items() if k in r.text)), r.doc_id


def test_licences_of_odd_rows(odd):
    rows = licenses.licences(odd).collect()
    assert len(rows) == odd.count() and all(r.licences == "" for r in rows)
    assert licenses.licences(odd.limit(0)).collect() == []


def test_licence_training_takes_every_line(spark):
    """Each line counts, by the words and pairs it shares with a notice; lines like a notice and lines without words don't."""
    lines = [f"number {i} of the old wheels turns slowly" for i in range(40)] + ["roses and thorns grow tall here", "Moon 77 rises", "", " - "] * 5
    docs = spark.createDataFrame([(i, "\n".join([*lines, "Licensed under the MIT license."])) for i in range(3)], "doc_id long, text string")
    known = licenses.notice_grams(spark)
    by_hash = {h: g for g, h in known}
    found = Counter()
    for r in licenses.examples(docs, known).where("family = 'unknown'").collect():
        found[tuple(sorted(by_hash[h] for h in r.grams))] += r.n
    want = Counter()
    for line in [x for x in lines if re.search(r"\w", x)] * 3:
        w = line.lower().split()
        want[tuple(sorted({*w, *map(" ".join, zip(w, w[1:], strict=False))} & set(by_hash.values())))] += 1
    assert found == want and sum(want.values()) == 3 * 50
