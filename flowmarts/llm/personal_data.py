"""Personal data: fixed formats, and candidates that boosted trees judge by format and context.

The four base formats are always redacted. Beyond them, generators with a high recall propose spans: addresses
with words for their marks, numbers with unusual separators, telephone numbers without a plus. Boosted trees,
trained on rewritten copies of the base spans of all documents and on the candidates that no format
bears out, score each proposal by its form and by the words before it. Thresholds per kind are set where
held-out precision reaches 90 in a hundred. All of it is built-in functions on columns.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmarts.llm.common import checkpointed, let, read

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH, SEED = 10, 3, 7
PRECISION = 0.9
LEAST_HELD_OUT = 3
BEFORE = 24

# The base patterns. Loops are possessive and a run is entered at its start or where the last match ended, which
# changes no match and keeps the search linear for any text.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
AT = r"(?:@|\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20)"
DOT = r"(?:\.|\x20?[\[({]\x20?(?:dot|\.)\x20?[\])}]\x20?|\x20dot\x20)"
GENERATORS = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)++",
    "ip": rf"(?<![0-9.])[0-9]{{1,3}}+{DOT}[0-9]{{1,3}}+{DOT}[0-9]{{1,3}}+{DOT}[0-9]{{1,3}}+(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20._/-]{0,2}[0-9]){14,20}+(?![0-9])",
    "phone": r"(?<![0-9])\(?+[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}+(?![0-9])",
}
CUES = {
    "email": r"(?i)(?:mail|contact|write|courriel|correo|kontakt)\W*(?:\w+\W+)?$",
    "ip": r"(?i)(?:\bip\b|host|server|address|addr)\W*(?:\w+\W+)?$",
    "card": r"(?i)(?:card|visa|mastercard|credit|carte|tarjeta|karte)\W*(?:\w+\W+)?$",
    "phone": r"(?i)(?:tel|phone|call|fax|mobile|cell|appel|llama|ruf)\w*\W*(?:\w+\W+)?$",
}
CUE_WORDS = {"email": " mail: ", "ip": " host ", "card": " card ", "phone": " call "}
SPAN = "array<struct<start:int,end:int,hit:string>>"


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their places in code points, the end exclusive."""

    def placed(hits: Column, gaps: Column) -> Column:
        def add(state: Column, i: Column) -> Column:
            start = state.at + F.length(F.get(gaps, i))
            end = start + F.length(F.get(hits, i))
            span = F.struct(start.alias("start"), end.alias("end"), F.get(hits, i).alias("hit"))
            return F.struct(end.alias("at"), F.concat(state.out, F.array(span)).alias("out"))

        empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), empty, add, lambda state: state.out)

    def of(hits: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        return F.when(F.size(hits) == 0, F.array().cast(SPAN)).otherwise(let(gaps, lambda g: placed(hits, g)))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of)


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the check: every second from the right doubled, the sum divisible by ten."""

    def share(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    total = F.aggregate(F.transform(places, share), F.lit(0), lambda a, b: a + b)
    return (F.length(digits) > 0) & (total % 10 == 0)


def byte_parts(hit: Column) -> Column:
    """Whether all numbers in ``hit`` are at most 255, leading zeros set aside."""
    parts = F.regexp_extract_all(hit, F.lit("[0-9]+"), F.lit(0))
    bare = F.transform(parts, lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(bare, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda hit: F.lit(True),
    "ip": byte_parts,
    "card": lambda hit: let(digits_of(hit), lambda d: F.length(d).between(16, 19) & luhn(d)),
    "phone": lambda hit: F.length(digits_of(hit)).between(8, 15),
}
# Texts without these hold no match.
NEEDED = {"email": "@", "ip": ".", "card": None, "phone": "+"}


def base_spans(text: Column, kind: str) -> Column:
    spans = F.filter(located(text, BASE[kind]), lambda s: VALID[kind](s.hit))
    mark = NEEDED[kind]
    return spans if mark is None else F.when(F.instr(text, mark) > 0, spans).otherwise(F.array().cast(SPAN))


def candidates(text: Column, kind: str) -> Column:
    """Proposed spans of a kind with the text before them and the characters beside them."""

    def described(s: Column) -> Column:
        low = F.greatest(s.start - BEFORE, F.lit(0))
        return F.struct(
            s.start.alias("start"),
            s.end.alias("end"),
            s.hit.alias("hit"),
            F.substring(text, low + 1, s.start - low).alias("before"),
            F.substring(text, s.end + 1, F.lit(1)).alias("after"),
        )

    return F.transform(located(text, GENERATORS[kind]), described)


def form_and_context(kind: str, hit: Column, before: Column, after: Column) -> list[Column]:
    """Numbers that the trees see, the same for all kinds."""
    digits = digits_of(hit)
    groups = F.regexp_extract_all(hit, F.lit("[0-9]+"), F.lit(0))

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("double")

    return [
        F.lit(float(KINDS.index(kind))),
        F.length(hit).cast("double"),
        F.length(digits).cast("double"),
        F.size(groups).cast("double"),
        F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)).cast("double"),
        F.length(F.regexp_replace(hit, "[^A-Za-z]", "")).cast("double"),
        flag(hit.rlike(r"[\[({]\x20?(?:at|dot|\.)\x20?[\])}]")),
        flag(hit.rlike(r"\x20at\x20")),
        flag(hit.rlike(r"\x20dot\x20")),
        flag(hit.contains("@")),
        flag(hit.rlike(r"[()]")),
        flag(luhn(digits)),
        flag(byte_parts(hit)),
        flag(before.rlike(CUES[kind])),
        flag(before.rlike(r"[A-Za-z0-9_.\"=#$/-]$")),
        flag(after.rlike(r"[A-Za-z0-9_\"/-]")),
        flag(hit.rlike(r"\.[A-Za-z]{2,6}$|(?:dot|\.)[\x20\])}]+[A-Za-z]{2,6}$")),
    ]


def rewritten(kind: str, hit: Column, draw: Column) -> Column:
    """The same item as someone writes it who hides it from programs, or is careless."""

    def chosen(*forms: Column) -> Column:
        out = forms[-1]
        for k, form in enumerate(forms[:-1]):
            out = F.when(draw % len(forms) == k, form).otherwise(out)
        return out

    def with_marks(at: str, dot: str) -> Column:
        host = F.substring_index(hit, "@", -1)
        return F.concat(F.substring_index(hit, "@", 1), F.lit(at), F.regexp_replace(host, r"\.", dot))

    if kind == "email":
        return chosen(with_marks(" [at] ", " [dot] "), with_marks("(at)", "(dot)"), with_marks(" at ", " dot "), with_marks(" [at] ", "."))
    if kind == "ip":
        return chosen(*[F.regexp_replace(hit, r"\.", to) for to in ("[.]", " dot ", "(dot)")])
    if kind == "card":
        return chosen(*[F.rtrim(F.regexp_replace(digits_of(hit), "(.{4})(?=.)", f"$1{to}")) for to in (".", "/", "_", " - ")])
    return chosen(F.ltrim(F.regexp_replace(hit, r"^\+", "")), F.regexp_replace(F.regexp_replace(hit, r"^\+", ""), r"[\x20()-]+", "."), F.regexp_replace(hit, r"^\+[0-9]+\x20?", ""))


def written_out(kind: str, hit: Column) -> Column:
    """Whether a proposal reads as an item of its kind with other marks."""
    marked = hit.rlike(r"[\[({]|\x20dot\x20")
    if kind == "email":
        return marked
    if kind == "ip":
        return marked & byte_parts(hit)
    return VALID["card"](hit) if kind == "card" else F.lit(False)


def overlaps(s: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o.start < s.end) & (s.start < o.end))


def examples(docs: DataFrame) -> DataFrame:
    """``features, label, kind, draw, n`` from all documents; ``n`` is the number of equal examples, which are one row.

    Ones: rewritten base spans in their place, a third of them after a word that announces them. Zeros: proposals
    that touch no base span, that nothing announces, and that aren't an item of their kind once unusual marks are
    read as the usual ones; proposals that fail these have no label.
    """
    texts = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    parts = []
    for kind in KINDS:
        before = F.substring("text", F.greatest(F.col("s.start") - BEFORE, F.lit(0)) + 1, F.least(F.col("s.start"), F.lit(BEFORE)))
        based = texts.select("text", base_spans(F.col("text"), kind).alias("base"))
        ones = based.select("text", F.explode("base").alias("s")).select(
            rewritten(kind, F.col("s.hit"), F.pmod(F.xxhash64("s.hit"), F.lit(97))).alias("hit"),
            F.when(F.pmod(F.xxhash64("s.hit", F.lit(1)), F.lit(3)) == 0, F.concat(before, F.lit(CUE_WORDS[kind]))).otherwise(before).alias("before"),
            F.substring("text", F.col("s.end") + 1, F.lit(1)).alias("after"),
            F.lit(1.0).alias("label"),
        )
        every = F.concat(*[base_spans(F.col("text"), k) for k in KINDS])
        proposed = texts.select(candidates(F.col("text"), kind).alias("found"), every.alias("base"))
        zeros = proposed.select(F.explode("found").alias("s"), "base").where(~overlaps(F.col("s"), F.col("base")))
        zeros = zeros.where(~written_out(kind, F.col("s.hit")) & ~F.col("s.before").rlike(CUES[kind]))
        zeros = zeros.select("s.hit", "s.before", "s.after", F.lit(0.0).alias("label"))
        rows = ones.union(zeros)
        measured = F.array(*form_and_context(kind, F.col("hit"), F.col("before"), F.col("after")))
        parts.append(rows.select(measured.alias("features"), "label", F.lit(kind).alias("kind"), F.xxhash64("hit", "before").alias("draw")))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    counted = out.groupBy("features", "label", "kind", "draw").agg(F.count("*").alias("n"))
    return checkpointed(counted.repartition("draw"))


def as_column(model: GBTClassificationModel, features: Column) -> Column:
    """The model's probability of a one as a column: each tree as nested conditions."""
    total = F.lit(0.0)
    weights = list(model.treeWeights)
    for tree, weight in zip(re.split(r"\n\s*Tree \d+[^\n]*:\n", model.toDebugString)[1:], weights, strict=True):
        lines = [line.strip() for line in tree.strip("\n").split("\n") if line.strip()]

        def grown() -> Column:
            line = lines.pop(0)
            if line.startswith("Predict:"):
                return F.lit(float(line.split(":")[1]))
            name, bound = re.fullmatch(r"If \(feature (\d+) <= ([-+0-9.eE]+)\)", line).groups()
            yes = grown()
            lines.pop(0)
            return F.when(F.get(features, F.lit(int(name))) <= float(bound), yes).otherwise(grown())

        total = total + F.lit(float(weight)) * grown()
    return 1 / (1 + F.exp(-2 * total))


class Judge:
    """Trees and thresholds; without examples of both labels nothing is added to the base spans."""

    def __init__(self, docs: DataFrame) -> None:
        self.thresholds: dict[str, float] = {}
        rows = examples(docs)
        fitting = rows.where(F.pmod("draw", F.lit(4)) > 0)
        kinds = {r.label for r in fitting.select("label").distinct().collect()}
        if kinds != {0.0, 1.0}:
            return
        fit = GBTClassifier(featuresCol="x", labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED)
        self.model = fit.fit(fitting.withColumn("x", array_to_vector("features")))
        held = rows.where(F.pmod("draw", F.lit(4)) == 0).withColumn("p", as_column(self.model, F.col("features")))
        bins = held.groupBy("kind", F.floor(F.col("p") * 100).alias("bin")).agg(F.sum(F.col("label") * F.col("n")).alias("ones"), F.sum("n").alias("n")).collect()
        pooled = self.calibrated(bins)
        for kind in KINDS:
            own = [r for r in bins if r.kind == kind]
            # A kind with few held-out examples takes the threshold of all kinds together.
            enough = sum(r.n for r in own if r.bin >= 50) >= LEAST_HELD_OUT
            found = self.calibrated(own) if enough else pooled
            if found is not None:
                self.thresholds[kind] = found

    @staticmethod
    def calibrated(bins: list) -> float | None:
        """The least score from which on held-out examples are right often enough."""
        ones = n = 0.0
        best = None
        for r in sorted((r for r in bins if r.bin >= 50), key=lambda r: -r.bin):
            ones, n = ones + r.ones, n + r.n
            if n >= LEAST_HELD_OUT and ones >= PRECISION * n:
                best = r.bin / 100
        return best

    def added(self, text: Column, base: Column, kind: str) -> Column:
        """Proposals of a kind that pass its threshold and touch no base span."""
        if kind not in self.thresholds:
            return F.array().cast(SPAN)

        def passes(s: Column) -> Column:
            measured = F.array(*form_and_context(kind, s.hit, s.before, s.after))
            return ~overlaps(s, base) & let(measured, lambda x: as_column(self.model, x) >= self.thresholds[kind])

        return F.transform(F.filter(candidates(text, kind), passes), lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), s.hit.alias("hit")))


def listed(spans: list[tuple[str, Column]]) -> Column:
    """``kind:start:end`` of the spans of each kind, joined by commas, by kind and then by start."""

    def named(kind: str, column: Column) -> Column:
        return F.transform(F.array_sort(column), lambda s: F.concat_ws(":", F.lit(kind), s.start.cast("string"), s.end.cast("string")))

    return F.array_join(F.concat(*[named(kind, column) for kind, column in spans]), ",")


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with ``found``: a struct of the lists ``email, ip, card, phone`` of base spans and ``added_*`` of
    further ones, each span with ``start``, ``end`` (exclusive, code points) and ``hit``.

    A null text has no spans. Added spans touch no base span; those of two kinds may touch each other, and
    redaction takes their union. A column called ``found`` is replaced; an empty table gives an empty result.
    """
    docs = docs.drop("found")
    judge = Judge(docs)
    text = F.coalesce(F.col("text"), F.lit(""))

    def whole(base: Column) -> Column:
        every = F.concat(*[base[k] for k in KINDS])
        return let(
            every,
            lambda spans: F.struct(
                *[base[k].alias(k) for k in KINDS], *[judge.added(text, spans, k).alias(f"added_{k}") for k in KINDS]
            ),
        )

    base = F.struct(*[base_spans(text, k).alias(k) for k in KINDS])
    return docs.withColumn("found", let(base, whole))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets."""
    found = find(docs)

    def tagged(name: str) -> Column:
        tag = F.lit(f"[{name.removeprefix('added_')}]").alias("tag")
        return F.transform(F.col(f"found.{name}"), lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), tag))


    def step(state: Column, s: Column) -> Column:
        kept = F.substring(F.col("text"), state.at + 1, F.greatest(s.start - state.at, F.lit(0)))
        tag = F.when(s.start >= state.at, F.concat(kept, s.tag)).otherwise(F.lit(""))
        return F.struct(F.greatest(state.at, s.end).alias("at"), F.concat(state.out, tag).alias("out"))

    spans = F.array_sort(F.concat(*[tagged(f"{prefix}{k}") for k in KINDS for prefix in ("", "added_")]))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = F.aggregate(spans, start, step, lambda s: F.concat(s.out, F.substring(F.col("text"), s.at + 1, F.length("text"))))
    return found.withColumn("text", rest).drop("found")


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, the numbers of base spans, ``base_sha256``, ``spans`` (all of them) and ``n_added``."""
    found = find(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    base = [(k, F.col(f"found.{k}")) for k in KINDS]
    every = [(k, F.concat(F.col(f"found.{k}"), F.col(f"found.added_{k}"))) for k in KINDS]
    return found.select(
        "doc_id",
        *[F.size(c).cast("long").alias(f"n_{k}") for k, c in base],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(every).alias("spans"),
        sum((F.size(f"found.added_{k}") for k in KINDS), F.lit(0)).cast("long").alias("n_added"),
    )


def op6_boosted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(read(spark, sf_dir, "documents"))
