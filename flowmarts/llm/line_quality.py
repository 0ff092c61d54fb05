"""Quality rules with cross-document line frequency.

Lines are normalised and hashed, and the distinct documents that hold each are counted for every host (the
``source`` column). Lines above the host's limit are furniture and are removed; a document that loses more than
half of its words with them is depleted and rejected, as is one that fails the base rules.

Only line hashes are shuffled. The lines above a limit come back as one short list per host, joined to the
documents without shuffling them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmarts.llm.common import BLANKS, ascii_lower, checkpointed, join_table, let, read, words

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
MIN_LINE_DOCS = 20
LINE_SHARE_PERCENT = 10
DEPLETED_PERCENT = 50
FEW_REPEATS = 64
BIN_SHIFT = 26
BANDS = 21
ALIKE_PERCENT = 60


def normalised(line: Column) -> Column:
    """ASCII lower case, runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(ascii_lower(line), BLANKS, " "))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def repeated_window_words(found: Column) -> Column:
    """Words inside three-word windows that occur twice or more, the first occurrence included.

    Windows are compared by a 64-bit hash. Sorting brings equal ones together; with many repeated windows a
    second sort carries their positions, so the work is n log n for any text.
    """
    last = F.size(found) - 3

    def counted(hashes: Column) -> Column:
        def of(repeated: Column) -> Column:
            listed = F.filter(F.sequence(F.lit(0), last), lambda i: F.array_contains(repeated, F.get(hashes, i)))
            placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
            beside = let(
                placed,
                lambda p: F.sort_array(
                    F.transform(
                        F.filter(
                            p,
                            lambda x, k: ((k > 0) & (F.get(p, k - 1).h == x.h)) | F.coalesce(F.get(p, k + 1).h == x.h, F.lit(False)),
                        ),
                        lambda x: x.i,
                    )
                ),
            )
            positions = F.when(F.size(repeated) <= FEW_REPEATS, listed).otherwise(beside)
            spans = let(
                positions,
                lambda p: F.aggregate(
                    F.transform(p, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1), at + 3) - at)),
                    F.lit(0),
                    lambda a, b: a + b,
                ),
            )
            return F.when(F.size(repeated) == 0, 0).otherwise(spans)

        doubled = let(
            F.sort_array(hashes),
            lambda s: F.array_distinct(F.filter(s, lambda h, k: (k > 0) & (F.get(s, k - 1) == h))),
        )
        return let(doubled, of)

    hashed = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2))
    )
    return F.when(last < 1, 0).otherwise(let(hashed, counted))


def base_measures(text: Column) -> Column:
    """Struct of ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a whole text."""
    plain = F.coalesce(text, F.lit(""))
    symbols = F.length(plain) - F.length(F.translate(plain, SYMBOLS, ""))
    filled = F.filter(lines_of(text), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    repeated_lines = let(filled, lambda kept: F.size(kept) - F.size(F.array_distinct(kept)))
    chars = F.length(F.regexp_replace(plain, BLANKS, ""))
    return let(
        words(text),
        lambda found: F.struct(
            F.size(found).cast("long").alias("n_words"),
            chars.cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            repeated_lines.cast("long").alias("n_dup_lines"),
            repeated_window_words(found).cast("long").alias("n_repeat_words"),
        ),
    )


def sketch(text: Column) -> Column:
    """The least hash of each of 64 bins over the three-word windows of a text, ascending. Case and white space don't count.

    Windows are compared by 32 bits, the leading six of which are the bin. A text of one or two words is one window; without words it is empty.
    """

    def window(*found: Column) -> Column:
        return F.shiftright(F.xxhash64(*found), 32).cast("int")

    def hashes(found: Column) -> Column:
        last = F.size(found) - 3
        windows = F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: window(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2))
        )
        return F.when(F.size(found) > 0, windows).otherwise(F.array().cast("array<int>"))

    return let(
        F.sort_array(let(words(F.lower(text)), hashes)),
        lambda s: F.filter(s, lambda h, k: (k == 0) | (F.shiftright(F.get(s, k - 1), BIN_SHIFT) != F.shiftright(h, BIN_SHIFT))),
    )


def near_copies(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All ``host, document``, and ``host, document, label`` of those that are near copies of another text of the host.

    Texts that agree in a band of three bins meet in a bucket and are compared with a drawn member of it; those
    alike in 60 of 100 bins are linked. Two steps along the links give a group one label; nothing is formed in pairs.
    """
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.struct(b.alias("band"), F.filter("sketch", lambda h: F.pmod(F.shiftright(h, BIN_SHIFT), F.lit(BANDS)) == b).alias("part")),
    )
    buckets = F.transform(F.filter(parts, lambda x: F.size(x.part) > 0), lambda x: F.xxhash64(x))
    made = texts.select("host", "document", sketch(F.col("text")).alias("sketch")).distinct()
    made = checkpointed(made.withColumn("buckets", buckets))
    held = made.select("host", "document", F.explode("buckets").alias("bucket"))
    least = F.min(F.col("document").bitwiseXOR(F.col("bucket")))
    counts = held.groupBy("host", "bucket").agg(F.count("*").alias("n"), least.alias("least")).where("n > 1")
    drawn = checkpointed(counts.select("host", "bucket", F.col("least").bitwiseXOR(F.col("bucket")).alias("twin")))
    pairs = join_table(held, drawn, ["host", "bucket"]).where("twin is not null").select("host", "document", "twin").distinct()
    pairs = checkpointed(pairs)
    met = pairs.where("twin <> document").select(F.explode(F.array("document", "twin")).alias("met")).distinct()
    few = made.join(met, made.document == met.met, "left_semi")
    one, two = (few.select(F.col("host").alias("h"), F.col("document").alias("d"), F.col("sketch").alias(name)) for name in ("own", "other"))
    pairs = pairs.join(one, pairs.host.eqNullSafe(one.h) & (pairs.document == one.d)).drop("h", "d")
    pairs = pairs.join(two, pairs.host.eqNullSafe(two.h) & (pairs.twin == two.d)).drop("h", "d")
    alike = 100 * F.size(F.array_intersect("own", "other")) >= ALIKE_PERCENT * F.greatest(F.size("own"), F.size("other"))
    links = checkpointed(pairs.where(alike).select("host", "document", "twin"))
    first = links.groupBy(F.col("host").alias("h"), F.col("document").alias("d")).agg(F.min("twin").alias("label"))
    steps = links.join(first, links.host.eqNullSafe(first.h) & (links.twin == first.d))
    labels = steps.groupBy("host", "document").agg(F.min("label").alias("label")).where("label <> document")
    return made.select("host", "document"), checkpointed(labels)


def frequent_lines(docs: DataFrame, host: str = "source", min_docs: int = MIN_LINE_DOCS, percent: int = LINE_SHARE_PERCENT) -> DataFrame:
    """``host, removed``: hashes of the lines held by at least ``min_docs`` distinct documents of the host and
    by at least ``percent`` in a hundred of them.

    Near copies are one document: a text that was copied a thousand times, with a word changed or not, vouches
    for its lines once. Blank lines don't count. A host has at most ``100 / percent`` times its mean lines per document.
    """
    texts = docs.select(F.col(host).cast("string").alias("host"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    texts = texts.withColumn("document", F.xxhash64("text"))
    documents, labels = near_copies(texts)
    group = F.coalesce("label", "document").alias("document")
    sizes = join_table(documents, labels, ["host", "document"]).select("host", group).distinct().groupBy("host").agg(F.count("*").alias("n"))
    lines = F.array_distinct(F.transform(lines_of(F.col("text")), normalised))
    hashed = F.transform(F.filter(lines, lambda line: line != ""), lambda line: F.xxhash64(line))
    held = join_table(texts.select("host", "document", hashed.alias("lines")), labels, ["host", "document"])
    held = held.select("host", group, F.explode("lines").alias("line")).distinct()
    counts = held.groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    above = join_table(counts, checkpointed(sizes), ["host"]).where(F.col("docs") * 100 >= F.col("n") * percent)
    return checkpointed(above.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("removed")))


def judge(docs: DataFrame, host: str = "source", min_docs: int = MIN_LINE_DOCS, percent: int = LINE_SHARE_PERCENT, depleted: int = DEPLETED_PERCENT) -> DataFrame:
    """``docs`` with a column ``verdict``: struct of the base measures, ``base_failed``, ``kept``,
    ``n_removed_words`` and ``clean_text``, the text without the lines above the limits.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated three-word windows.
    ``kept``: not failed, and at most ``depleted`` in a hundred words removed. A null text has no words and
    fails; a null host is a host of its own; repeated rows are judged alike; an empty table gives an empty
    result. A column called ``verdict`` or ``removed`` is replaced.
    """
    docs = docs.drop("verdict", "removed")
    key = docs.withColumn("__host", F.col(host).cast("string"))
    table = frequent_lines(docs, host, min_docs, percent).withColumnRenamed("host", "__host")
    marked = join_table(key, table, ["__host"])
    text = F.col("text")
    sifted = let(
        F.transform(lines_of(text), lambda line: F.struct(F.array_contains("removed", F.xxhash64(normalised(line))).alias("gone"), line.alias("line"))),
        lambda lines: F.struct(
            F.size(words(F.array_join(F.filter(lines, lambda x: x.gone).line, " "))).cast("long").alias("lost"),
            F.array_join(F.filter(lines, lambda x: ~x.gone).line, "\n").alias("clean"),
        ),
    )
    sifted = F.when(F.col("removed").isNull(), F.struct(F.lit(0).cast("long").alias("lost"), text.alias("clean"))).otherwise(sifted)
    rated = marked.select(
        *[marked[c] for c in docs.columns], base_measures(text).alias("__m"), sifted.alias("__sifted")
    )
    failed = (F.col("__m.n_words") < MIN_WORDS) | (100 * F.col("__m.n_repeat_words") > 50 * F.col("__m.n_words"))
    stays = ~failed & (100 * F.col("__sifted.lost") <= depleted * F.col("__m.n_words"))
    verdict = F.struct(
        "__m.*", failed.alias("base_failed"), stays.alias("kept"), F.col("__sifted.lost").alias("n_removed_words"), F.col("__sifted.clean").alias("clean_text")
    )
    return rated.withColumn("verdict", verdict).drop("__m", "__sifted")


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that stay, without the lines above the limits; ``n_chars``, if there, follows the text."""
    kept = judge(docs, host).where("verdict.kept").withColumn("text", F.col("verdict.clean_text"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*docs.columns)


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return judged.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[f"verdict.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")],
    )
