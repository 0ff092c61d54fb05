"""Conversation repair, periodic runs and packing against brute force."""

import heapq
import random
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import regex
from tokenizers import Tokenizer

from flowmarts.llm import conversation_repair, packing, repetitions
from flowmarts.llm.queries import QUERIES

EMPTY = sha256(b"").hexdigest()


def crc(text):
    return zlib.crc32(text.encode())


# Conversations


def planted(rows):
    """Rows (conv, turn, role, text) after the damage of the contract, with every conversation's id."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        h = crc(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}") % 20
        if h == 1:
            text = ""
        if h == 2:
            text = "".join(c for c in text if c not in ".!?")
        if h == 4:
            role = "user"
        mine += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def right(roles):
    rest = roles[1:] if roles[:1] == "s" else roles
    return all(c == "ua"[i % 2] for i, c in enumerate(rest)) and (roles == "" or rest != "" and len(rest) % 2 == 0)


def cheapest(rows, faults):
    """Cost, audit and repaired rows, by search over all edits in the order of (cost, audit)."""
    heap, met = [(0, "", 0, ())], set()
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        initials = "".join(role[:1] or "x" for role, _ in out)
        state = (i, initials[-1:], len(initials) == 1)
        if i == len(rows) and right(initials):
            return cost, audit, list(out)
        if state in met or not (right(initials) or right(initials + "a") or right(initials + "ua")):
            continue
        met.add(state)
        ways = [(2, "I", i, (r, "")) for r in ("user", "assistant")]
        if i < len(rows):
            role, text = rows[i]
            ways.append((3, "D", i + 1, None))
            if faults[i] not in ("blank", "duplicate"):
                extra = faults[i] == "truncated"
                ways.append((extra, "K", i + 1, (role, text)))
                ways += [(2 + extra, "R", i + 1, (r, text)) for r in ("user", "assistant")]
        for more, letter, at, row in ways:
            heapq.heappush(heap, (cost + more, audit + letter, at, (*out, row) if row else out))


def repaired(conversations, order):
    result = {}
    for conv, rows in conversations.items():
        rows = sorted(rows, key=order)
        seen, faults = set(), []
        for _, role, text in rows:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, _, _ in rows if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, out = cheapest([r[1:] for r in rows], faults)
        result[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            illegal,
            cost,
            audit,
            sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
        )
    return result


def by_turn(row):
    """Order of the operator: turn, null first, then role, then a digest of the text."""
    import hashlib

    turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), hashlib.md5(text.encode()).hexdigest())


CYK = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_conversations_are_repaired_at_least_cost(spark, size):
    folder = f"/root/testdata/{size}"
    table = pq.read_table(f"{folder}/conversations.parquet").to_pylist()
    expected = repaired(planted([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table]), by_turn)
    rows = QUERIES["op11_weighted_cyk"](spark, folder).collect()
    assert len(rows) == len(expected)
    assert {r.conv_id: tuple(r[c] for c in CYK) for r in rows} == expected


def odd_conversations():
    """Nulls, ties, repeated rows, blanks, unknown and empty roles, clashing columns."""
    random.seed(5)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User", "ua"]
    texts = ["Yes.", "No?", "so", None, "", " \t\r\n", "é\U0001f600!", "Yes.", "end. \x0b\x0c", "a\nb"]
    rows = [(random.choice([None, *range(30)]), random.choice([None, 0, 1, 2, 3, 5, 9, -4]), random.choice(roles), random.choice(texts)) for _ in range(300)]
    return rows + rows[:20] + [(77, None, None, None)] * 3 + [(78, t, "user", "Same.") for t in range(40)]


def test_odd_conversations(spark):
    rows = odd_conversations()
    extra = [(*r, "x", 1, 2, True) for r in rows]
    frame = spark.createDataFrame(extra, "conv_id long, turn long, role string, text string, audit string, copies int, digest int, seen boolean")
    for prepare, plain in ((conversation_repair.damaged, planted(rows)), (conversation_repair.rows_of, undamaged(rows))):
        found = conversation_repair.diagnosed(prepare(frame))
        expected = repaired(plain, by_turn)
        got = {r.conv_id: tuple(r[c] for c in CYK[:-1]) for r in found.collect()}
        assert got == {k: v[:-1] for k, v in expected.items()}
        lines = {}
        for r in conversation_repair.repaired(prepare(frame), found).collect():
            lines.setdefault(r.conv_id, []).append((r.place, f"{r.role}:{r.text}"))
        for conv, row in expected.items():
            text = "\n".join(x for _, x in sorted(lines.get(conv, [])))
            assert sha256(text.encode()).hexdigest() == row[-1]


def undamaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return out


def test_a_conversation_over_many_partitions(spark):
    """One with most of the rows is parsed in pieces, with the result of one piece."""
    random.seed(6)
    rows = [(1, t, random.choice(["user", "assistant", "system"]), random.choice(["Yes.", "no", f"Number {t}."])) for t in range(3_000)]
    rows += [(c, t, "user", "Hello.") for c in (0, 2) for t in range(3)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plain = undamaged(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.conv_id: r for r in conversation_repair.diagnosed(conversation_repair.rows_of(frame)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {k: tuple(r[c] for c in CYK[:-1]) for k, r in found.items()} == {k: v[:-1] for k, v in repaired(plain, by_turn).items()}


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    found = conversation_repair.diagnosed(conversation_repair.damaged(none))
    assert found.collect() == [] and conversation_repair.repaired(conversation_repair.damaged(none), found).collect() == []


def test_any_split_gives_the_cell():
    """All ways to split a span, as the whole chart has them, against the one that is taken."""
    random.seed(7)
    for _ in range(200):
        s = "".join(random.choice("DuasxUASXuaua") for _ in range(random.randrange(2, 9)))
        cells = {}
        for length in range(1, len(s) + 1):
            for i in range(len(s) - length + 1):
                if length == 1:
                    cells[i, 1] = conversation_repair.ROW[s[i]]
                    continue
                splits = [conversation_repair._joined(cells[i, k], cells[i + k, length - k]) for k in range(1, length)]
                assert len(set(splits)) == 1
                cells[i, length] = splits[0]
        assert conversation_repair.parsed(s) == cells[0, len(s)]


# Periodic runs


def plain_runs(words):
    """All runs, by comparing the words with themselves p places on for every p, and the words that stay."""
    n, best = len(words), {}
    for p in range(1, n // 2 + 1):
        start = 0
        while start + p < n:
            end = start
            while end + p < n and words[end] == words[end + p]:
                end += 1
            if end > start and end + p - start >= max(12, 2 * p):
                best.setdefault((start, end + p), p)
            start = max(end, start + 1)
    runs = sorted(((a, b - a, p) for (a, b), p in best.items()), key=lambda r: (r[0], r[2]))
    stays = [True] * n
    for a, length, p in runs:
        stays[a + p : a + length] = [False] * (length - p)
    return runs, stays


def periodic_rest(doc_id, words):
    h = crc(str(doc_id)) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


RUNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def expected_runs(doc_id, text, plant=True):
    words = (text or "").encode().split()
    words = periodic_rest(doc_id, words) if plant else words
    runs, stays = plain_runs(words)
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{a},{length},{p}\n" for a, length, p in runs)
    kept = b" ".join(w for w, stay in zip(words, stays) if stay)
    milli = 1000 * longest[1] // longest[2] if runs else None
    return (len(runs), *longest, milli, sha256(lines.encode()).hexdigest(), sha256(kept).hexdigest())


def test_runs_of_the_documents(spark, small):
    table = pq.read_table(f"{small}/documents.parquet").to_pylist()
    rows = QUERIES["op12_synchronising_runs"](spark, small).collect()
    assert len(rows) == len(table)
    texts = {r["doc_id"]: r["text"] for r in table}
    for r in rows:
        assert tuple(r[c] for c in RUNS) == expected_runs(r.doc_id, texts[r.doc_id])
    assert sum(r.n_runs > 0 for r in rows) > len(rows) / 20


def awkward_texts():
    random.seed(8)
    texts = [[random.choice("ab") for _ in range(200)], list("ab" * 300), list("a" * 500), list("abc" * 3), list("abcdef" * 2), list("a" * 11), list("a" * 12)]
    morse, one, two = ["a"], ["a"], ["a", "b"]
    while len(morse) < 1024:
        morse += ["b" if x == "a" else "a" for x in morse]
    while len(two) < 700:
        one, two = two, two + one
    texts += [morse, two]
    for _ in range(60):
        unit = [random.choice("abc") for _ in range(random.randrange(1, 20))]
        inner = (unit * random.randrange(1, 30) + [random.choice("abcd")] * random.randrange(4)) * random.randrange(1, 5)
        texts.append(inner[:900] + [str(random.randrange(9)) for _ in range(random.randrange(40))] + inner[:300])
    for _ in range(20):
        unit = [str(random.randrange(500)) for _ in range(random.randrange(12, 150))]
        texts.append([*map(str, range(50)), *(unit * 5)[: int(len(unit) * random.uniform(1.9, 4.5))], *map(str, range(20, 70))])
    return texts


def test_runs_of_awkward_texts():
    texts = awkward_texts()
    for block in (texts, [[], *texts[:3], []], [[]], []):
        for words, (runs, mask) in zip(block, repetitions.word_runs(block), strict=True):
            expected, stays = plain_runs(words)
            assert runs == expected
            assert mask is None and all(stays) or mask.tolist() == stays


def test_hashes_that_lie_make_no_false_run(monkeypatch):
    """With hashes of three bits most proposals are wrong; what is returned must still repeat and be maximal."""
    mixed = repetitions._mixed
    monkeypatch.setattr(repetitions, "_mixed", lambda x: mixed(x) & np.uint64(7))
    texts = awkward_texts()[:30]
    for words, (runs, _) in zip(texts, repetitions.word_runs(texts), strict=True):
        for a, length, p in runs:
            b = a + length
            assert length >= max(12, 2 * p) and words[a : b - p] == words[a + p : b]
            assert (a == 0 or words[a - 1] != words[a - 1 + p]) and (b == len(words) or words[b] != words[b - p])


def test_runs_of_odd_rows(spark):
    long = " ".join(f"w{i % 90}" for i in range(400_000))
    rows = [(1, None, "x"), (2, "", "x"), (2, " \t\n", "x"), (None, "a " * 40, "y"), (3, "é\x0bé\x0c" * 10, None), (3, "é\x0bé\x0c" * 10, None), (4, long, "z"), (5, "a\x1cb a\x85b " * 9, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    found = repetitions.periodic_runs(frame)
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect())
    expected = []
    for key, text, _ in rows:
        words = (text or "").encode().split()
        runs, stays = ([(0, 400_000, 90)], [i < 90 for i in range(400_000)]) if text is long else plain_runs(words)
        expected.append((key or 0, len(words), runs, b" ".join(w for w, stay in zip(words, stays) if stay).decode()))
    assert got == sorted(expected)
    assert repetitions.periodic_runs(frame.limit(0)).collect() == []


# Packing


def best_fit_decreasing(lengths, limit):
    rooms, bins = [0] * (limit + 1), 0
    for length in sorted(lengths, reverse=True):
        room = next((r for r in range(length, limit + 1) if rooms[r]), None)
        if room is None:
            bins, room = bins + 1, limit
        else:
            rooms[room] -= 1
        rooms[room - length] += 1
    return bins


def check_places(rows, limit):
    """Sequences without overlap or gap, at most ``limit`` long; their number."""
    by = {}
    for length, sequence, offset in rows:
        by.setdefault(sequence, []).append((offset, length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_documents_are_packed(spark, size):
    folder = f"/root/testdata/{size}"
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    rows = QUERIES["op13_linear_grouping"](spark, folder).collect()
    expected = {}
    for r in pq.read_table(f"{folder}/documents.parquet").to_pylist():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        for piece, start in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[start : first + 1024 * piece]
            expected[r["doc_id"], piece] = (start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert len(rows) == len(expected)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    count = check_places([(r.length, r.sequence_id, r.offset) for r in rows], 1024)
    assert count <= best_fit_decreasing([r.length for r in rows], 1024)


def plan_places(lengths, limit):
    histogram = {}
    for length in lengths:
        histogram[length] = histogram.get(length, 0) + 1
    placed, seen = [], {}
    for length, first, count, sequence, offset, times in packing.plan(histogram, limit):
        assert first == seen.get(length, 0)
        seen[length] = first + count
        placed += [(length, sequence + k // times, offset + k % times * length) for k in range(count)]
    assert {k: v for k, v in histogram.items() if k < limit} == seen
    return check_places(placed, limit)


def test_plans_are_whole_and_no_worse_than_best_fit():
    random.seed(9)
    cases = [[], [5], [1024] * 3, [1] * 5_000, [513] * 40, [341] * 500 + [342] * 500 + [343] * 500, [512] * 7 + [1], list(range(1, 1025))]
    cases += [[random.randint(a, b) for _ in range(n)] for a, b, n in ((200, 700, 3_000), (1, 1023, 4_000), (300, 360, 2_000), (600, 1000, 500), (1, 60, 3_000), (205, 260, 900))]
    for lengths in cases:
        below = [x for x in lengths if x < 1024]
        count = plan_places(below, 1024)
        assert -(-sum(below) // 1024) <= count <= best_fit_decreasing(below, 1024)


def test_groups_beat_best_fit_where_lengths_are_large():
    lengths = [341] * 5_000 + [342] * 5_000 + [343] * 5_000 + [500] * 3_000
    assert plan_places(lengths, 1024) < 0.96 * best_fit_decreasing(lengths, 1024)


def test_the_plan_does_not_grow_with_the_input():
    random.seed(10)
    shares = {length: random.randint(1, 9) for length in range(1, 1024)}
    few, many = (len(packing.plan({k: v * f for k, v in shares.items()})) for f in (1, 100_000))
    assert many < 10_000 and many < 4 * few


def test_words_join_to_the_whole(spark):
    words = packing.Words(packing.tokenizer_bytes(spark))
    plain = Tokenizer.from_file(packing.TOKENIZER)
    plain.encode_special_tokens = True
    random.seed(11)
    some = ["", " ", "  \n\n x", "a  b 　 c", "I'm you'll''s 'S 're", "é\U0001f600\U0001f468‍\U0001f469", "\x00\x1c\x1d\x85 a", "<|endoftext|> a<|endoftext|>", "x" * 30_000, " \t\r\n" * 500, "١٢ ⅷ ²½ 中文", "​﻿ a"]
    some += ["".join(random.choice("ab1 '\n\t.,-é中\U0001f600") for _ in range(300)) for _ in range(200)]
    pattern = regex.compile(public_tokenizers.PATTERN)
    for text, body in zip(some, map(words.ids, some), strict=True):
        assert words.split(text) == pattern.findall(text)
        assert np.frombuffer(body, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_forgotten_words_are_learnt_again(spark, monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 3)
    words = packing.Words(packing.tokenizer_bytes(spark))
    texts = ["a b c d e f", "f e d", "a", "x y z a"]
    got = [words.ids(t) for t in texts]
    monkeypatch.undo()
    assert len(words) <= 3 and got == [*map(packing.Words(packing.tokenizer_bytes(spark)).ids, texts)]


def test_packing_odd_rows(spark):
    rows = [(None, None, "a"), (None, None, "a"), (1, "", "b"), (1, "word " * 5_000, "c"), (1, "word " * 5_000, "c"), *[(2, "same text", None)] * 50]
    frame = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string").repartition(5)
    cut = packing.pieces(frame)
    packed = packing.pack(cut.withColumn("offset", cut.start))
    got = packed.collect()
    assert packed.columns == [*cut.columns, "sequence_id", "offset"]
    check_places([(r.length, r.sequence_id, r.offset) for r in got], 1024)
    assert len(got) == 2 + 1 + 2 * 5 + 50
    whole = packing.sequences(packed).collect()
    assert sum(r.n_tokens for r in whole) == sum(r.length for r in got) and all(len(r.ids) == 4 * r.n_tokens for r in whole)
    assert packing.pack(packing.pieces(frame.limit(0))).collect() == []
    for length in (0, 1025, None):
        with pytest.raises(Exception, match="length not in"):
            packing.pack(spark.createDataFrame([(length,)], "length long")).collect()
