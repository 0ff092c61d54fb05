"""Near-duplicate groups: SuperMinHash, banding, verification on full shingle sets, union-find grouping.

Documents with equal sets form a class, and only classes go on. Classes that share a band of the signature meet
in a bucket. Classes whose shingles are mostly their own are left out there. A bucket is not expanded into
pairs: in each round its members are compared with one leader, drawn anew by a hash, unless they are already in
the leader's component. After these rounds most of a group is one component. What is left are members of one
bucket in different components. They meet once more by their rarest shingles: a set and one that is no smaller, at
the threshold, must share a shingle among the rarest seventh of the one and the rarest quarter of the other.
Passages that a whole group has in common are its most frequent shingles, so members that share no more do not meet
there. All pairs found are compared in full, so no link between components is lost. Two texts at the threshold of 0.75
miss each other in all bands once in a million times.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmarts.llm import superminhash as smh
from flowmarts.llm.common import BLANKS, ascii_lower, checkpointed, one_row_of_each, read

PERCENT = 75
# Rounds with leaders go on while one pair in FEW_LINKS is linked, two rounds at least; they save work and decide nothing.
LEADER_ROUNDS = (2, 12)
LEADERS_A_ROUND = 3
FEW_LINKS = 50
BROADCAST_IDS = 500_000
# A task joins about so many links by union-find.
LINKS_A_TASK = 100_000
# Labels and compared pairs up to so many rows are broadcast to the members and pairs of a round.
BROADCAST_ROWS = 50_000
NO_ID = (1 << 63) - 1

SIGNED = "doc_id long, digest binary, n_shingles long, f1 long, f2 long, bands array<long>"
BODIES = "f1 long, f2 long, n long, body array<long>"


def plain_words(text: Column) -> Column:
    """ASCII lower case, words separated by one space; null is empty."""
    spaced = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), BLANKS, " ")
    return F.trim(spaced)


def _sets(column: pa.Array) -> list[np.ndarray]:
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    longest = int(np.diff(offsets).max(initial=0)) + 1
    up, down = smh.powers(smh.BASE, longest), smh.powers(smh.BASE_INVERSE, longest)
    return [smh.shingle_hashes(data[a:b], up, down) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = _sets(batch.column("plain"))
        bands = smh.band_hashes(smh.signatures(sets))
        prints = [smh.fingerprint(s) for s in sets]
        starts = np.arange(len(sets) + 1, dtype=np.int32) * bands.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("digest"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([p[0] for p in prints], pa.int64()),
                pa.array([p[1] for p in prints], pa.int64()),
                pa.ListArray.from_arrays(pa.array(starts), pa.array(np.ascontiguousarray(bands).reshape(-1))),
            ],
            names=["doc_id", "digest", "n_shingles", "f1", "f2", "bands"],
        )


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = _sets(batch.column("plain"))
        prints = [smh.fingerprint(s) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p[0] for p in prints], pa.int64()),
                pa.array([p[1] for p in prints], pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)),
                    pa.array(np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)),
                ),
            ],
            names=["f1", "f2", "n", "body"],
        )


@F.pandas_udf(T.LongType())
def shared(one: pd.Series, two: pd.Series) -> pd.Series:
    """Sizes of the intersections of two columns of sorted sets."""
    sizes = []
    for a, b in zip(one, two, strict=True):
        both = np.concatenate((a, b)).view(np.uint64)
        both.sort(kind="stable")
        sizes.append(int(np.count_nonzero(both[1:] == both[:-1])))
    return pd.Series(sizes, dtype="int64")


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over the links of one partition: each of its nodes with the least node it is joined to here."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.setdefault(x, x)) != x:
            above[x] = x = above[up]
        return x

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            one, two = top(a), top(b)
            if one != two:
                above[max(one, two)] = min(one, two)
    nodes = list(above)
    yield pd.DataFrame({"node": pd.Series(nodes, dtype="int64"), "root": pd.Series([top(x) for x in nodes], dtype="int64")})


def components(links: DataFrame, at_most: int | None = None) -> DataFrame:
    """``node, root`` for all ends of ``links`` (``a, b``): the least node of each connected component.

    Links are dealt over as many tasks as their number asks for, by both ends, so that a node with very many is in no
    single task. Each task joins its links by union-find. A node that several tasks have seen links the roots they
    gave it; these links are the next round's, fewer each time, until no node has two roots. ``at_most`` is a bound of
    the number of links, which are counted without it.
    """
    labels, left = None, links.count() if at_most is None else at_most
    while True:
        tasks = max(1, -(-left // LINKS_A_TASK))
        ends = links.select("a", "b")
        dealt = ends.coalesce(1) if tasks == 1 else ends.repartition(tasks, "a", "b")
        forest = checkpointed(dealt.mapInPandas(_forest, "node long, root long"))
        if tasks == 1 and labels is None:
            return forest
        least = forest.groupBy("node").agg(F.min("root").alias("least"))
        if labels is None:
            named = least.select("node", F.col("least").alias("root"))
        else:
            moved = least.select(F.col("node").alias("root"), "least")
            named = labels.join(moved, "root", "left").select("node", F.coalesce("least", "root").alias("root"))
        labels = checkpointed(named)
        if tasks == 1:
            return labels
        both = forest.join(least, "node").where("root <> least")
        links = checkpointed(both.select(F.col("root").alias("a"), F.col("least").alias("b")).distinct())
        left = links.count()
        if not left:
            return labels


def _verified(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """``pairs`` (``a, b``) with ``linked``, by the Jaccard similarity of the full sets."""
    one = bodies.select(F.col("cls").alias("a"), F.col("body").alias("one"))
    two = bodies.select(F.col("cls").alias("b"), F.col("body").alias("two"))
    joined = pairs.join(one, "a").join(two, "b").withColumn("shared", shared("one", "two"))
    union = F.size("one") + F.size("two") - F.col("shared")
    return checkpointed(joined.select("a", "b", (100 * F.col("shared") >= PERCENT * union).alias("linked")))


def _light(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of at most ``rows`` rows, broadcast if these are few, so that what it is joined with isn't shuffled."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _in_components(members: DataFrame, labels: DataFrame | None, links: int) -> DataFrame:
    if labels is None:
        return members.withColumn("component", F.col("cls"))
    named = _light(labels.select(F.col("node").alias("cls"), "root"), 2 * links)
    return members.join(named, "cls", "left").withColumn("component", F.coalesce("root", "cls")).drop("root")


def able_to_link(bodies: DataFrame) -> DataFrame:
    """``cls, common`` of the classes that can have a link: ``common`` counts the shingles that another class
    of ``bodies`` has too.

    No intersection is larger than ``common``, so one with less than 0.75 of the set has no link. That is exact,
    costs a count of shingles, and leaves out texts that share no more than a passage.
    """
    spread = bodies.select("cls", F.explode("body").alias("shingle"))
    single = spread.groupBy("shingle").agg(F.count("*").alias("k"), F.min("cls").alias("cls")).where("k = 1")
    own = single.groupBy("cls").agg(F.count("*").alias("own"))
    sized = bodies.select("cls", F.size("body").alias("n")).join(own, "cls", "left")
    common = (F.col("n") - F.coalesce("own", F.lit(0))).alias("common")
    return sized.select("cls", "n", common).where(100 * F.col("common") >= PERCENT * F.col("n")).select("cls", "common")


def _may_link() -> Column:
    """Bound of the similarity of a member (``n, common``) and another (``m, shared``) by what each has in common."""
    most = F.least("common", "shared")
    return 100 * most >= PERCENT * (F.col("n") + F.col("m") - most)


def _led(members: DataFrame, turn: int) -> DataFrame:
    """Pairs of members with the leader of their bucket, a few for each member."""
    order = F.xxhash64("cls", F.lit(turn))
    leaders = members.groupBy("bucket").agg(
        F.min(F.struct(order.alias("order"), F.col("cls").alias("leader"), F.col("component").alias("led"), F.col("n").alias("m"), F.col("common").alias("shared"))).alias("l"),
        F.min("component").alias("least"),
        F.max("component").alias("greatest"),
    )
    leaders = leaders.where("least <> greatest").select("bucket", "l.*")
    met = members.join(leaders, "bucket").where((F.col("component") != F.col("led")) & _may_link())
    pairs = met.select("cls", "leader").distinct()
    chosen = W.partitionBy("cls").orderBy(F.xxhash64("cls", "leader", F.lit(turn)), "leader")
    few = pairs.withColumn("k", F.row_number().over(chosen)).where(F.col("k") <= LEADERS_A_ROUND)
    return few.select(F.least("cls", "leader").alias("a"), F.greatest("cls", "leader").alias("b")).distinct()


def _rarest(members: DataFrame, bodies: DataFrame) -> DataFrame:
    """``members`` with ``first`` and ``probe``: the shared shingles among the rarest of each set that pairs must meet in.

    Shingles are ordered by the number of members that have them, then by value. Let a set of ``n`` shingles be
    linked with one of ``m >= n``. They share at least 6/7 of ``n`` (twice 0.75 / 1.75) and 0.75 of ``m``, so the rarest
    shingle they share is among the first ``n - 6n/7 + 1`` of the one and the first ``m - 0.75m + 1`` of the other.
    Shingles of one member alone come first and meet nothing, so they are counted and left out. ``rest`` counts the
    shared shingles from one on: past the first that two sets share, they share no more than the lesser ``rest``.
    """
    spread = members.select("cls").join(bodies.select("cls", F.explode("body").alias("shingle")), "cls")
    several = spread.groupBy("shingle").agg(F.count("*").alias("k")).where("k > 1")
    ranked = spread.join(several, "shingle").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("k", "shingle"))).alias("shared_ones"))
    own = F.col("n") - F.size("shared_ones")

    def leading(least: Column) -> Column:
        length = F.greatest(F.col("n") - least + 1 - own, F.lit(0)).cast("int")
        rest = F.size("shared_ones")
        return F.transform(F.slice("shared_ones", F.lit(1), length), lambda x, i: F.struct(x.shingle.alias("shingle"), (rest - i).alias("rest")))

    first, probe = leading(F.ceil(6 * F.col("n") / 7)), leading(F.ceil(F.col("n") * PERCENT / 100))
    return members.join(ranked, "cls").withColumns({"first": first, "probe": probe}).drop("shared_ones")


def _crossing(members: DataFrame, bodies: DataFrame) -> DataFrame:
    """Pairs that may be linked, of classes of one bucket in different components."""
    split = members.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("greatest"))
    rest = members.join(split.where("least <> greatest").select("bucket"), "bucket")
    rest = checkpointed(rest.groupBy("cls").agg(*[F.first(c).alias(c) for c in ("n", "common", "component")]))
    prefixed = checkpointed(_rarest(rest, bodies))
    small = prefixed.select("cls", "n", "common", "component", F.inline("first"))
    large = prefixed.select(F.col("cls").alias("other"), F.col("n").alias("m"), F.col("common").alias("shared"), F.col("component").alias("led"), F.inline("probe")).withColumnRenamed("rest", "left")
    order = (F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("cls") < F.col("other")))
    # 100 * shared >= PERCENT * union, with shared at most the lesser rest.
    enough = (100 + PERCENT) * F.least("rest", "left") >= PERCENT * (F.col("n") + F.col("m"))
    met = small.join(large, "shingle").where(order & enough & (100 * F.col("n") >= PERCENT * F.col("m")) & (F.col("component") != F.col("led")) & _may_link())
    return met.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct()


def _judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per document: ``doc_id, digest, n_shingles, root, component_id``. Null ids count as the largest."""
    plain = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), plain_words(F.col(text_col)).alias("plain"))
    digested = plain.withColumn("digest", F.unhex(F.md5("plain")))
    signed = checkpointed(digested.mapInArrow(_signed, SIGNED))
    usable = signed.where("n_shingles > 0")
    prints = ["f1", "f2", "n"]
    grouped = usable.groupBy("f1", "f2", F.col("n_shingles").alias("n")).agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    # Numbered once they are written, so a class has one number whoever asks.
    classes = checkpointed(grouped).withColumn("cls", F.monotonically_increasing_id())

    exploded = classes.select("cls", "n", F.explode("bands").alias("bucket"))
    crowded = exploded.groupBy("bucket").agg(F.count("*").alias("k")).where("k > 1").select("bucket")
    members = checkpointed(exploded.join(crowded, "bucket").select("bucket", "cls", "n"))

    meeting = members.select("cls").distinct()
    named = classes.select("cls", "doc_id", *prints).join(meeting, "cls")
    wanted = checkpointed(named.select("doc_id").distinct())
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    # An id may stand for several texts: a class takes the body with its own prints.
    found = plain.join(wanted, "doc_id", "left_semi").select("plain").mapInArrow(_bodies, BODIES).dropDuplicates(prints)
    bodies = checkpointed(found.join(named.drop("doc_id"), prints).select("cls", "body"))

    members = checkpointed(members.join(able_to_link(bodies), "cls"))

    done, labels, turn, last, total, seen = None, None, 0, False, 0, 0
    while not last:
        now = _in_components(members, labels, total)
        pairs = _led(now, turn)
        if last := turn == LEADER_ROUNDS[1] or turn >= LEADER_ROUNDS[0] and FEW_LINKS * linked < compared:
            pairs = _crossing(now, bodies)
        if done is not None:
            pairs = pairs.join(_light(done.select("a", "b"), seen), ["a", "b"], "left_anti")
        checked = _verified(pairs, bodies)
        compared, linked = checked.agg(F.count("*"), F.count_if("linked")).first()
        done = checked if done is None else done.union(checked)
        links = checked.where("linked").select("a", "b")
        if labels is not None:
            links = links.union(labels.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
        total, seen = total + linked, seen + compared
        if linked or labels is None:
            # No more nodes have moved to another root than links were found before.
            labels = components(links, at_most=total)
        turn += 1

    joined = classes.select("cls", "doc_id", *prints).join(labels.select(F.col("node").alias("cls"), "root"), "cls", "left")
    rooted = joined.withColumn("root", F.coalesce("root", "cls"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    known = rooted.drop("cls", "doc_id").join(least, "root").withColumnRenamed("n", "n_shingles")
    return signed.drop("bands").join(known, ["f1", "f2", "n_shingles"], "left").select(
        "doc_id", "digest", "n_shingles", "root", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Sets are the distinct five-word shingles of the text in ASCII lower case; fewer words are one shingle; no
    word or no text makes an empty set, linked with nothing. ``component_id`` is the least ``doc_id`` that can
    be reached over links of similarity 0.75 or more. A row without ``doc_id`` links others by its text, and has
    itself no component and counts as kept, as nothing names it; ``deduplicate`` goes by texts there. Repeated rows are in
    one component, each judged by its id. An empty table gives an empty result; other columns play no part.
    """
    nameless = F.col("doc_id") == NO_ID
    return _judged(docs, id_col, text_col).select(
        F.when(~nameless, F.col("doc_id")).alias("doc_id"),
        "n_shingles",
        F.when(~nameless, F.col("component_id")).alias("component_id"),
        (nameless | (F.col("doc_id") == F.col("component_id"))).alias("kept"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, one row of each component, with their columns.

    The row with the least ``doc_id`` stays, null being the largest; of several texts under that id the one with the least
    digest, and of equal rows one. Rows without words are linked with nothing and all stay. An empty table gives none.
    """
    judged = checkpointed(_judged(docs, id_col, text_col))
    place = F.struct("doc_id", "digest")
    kept = judged.where("root is not null").groupBy("root").agg(F.min(place).alias("k")).select("k.*")
    key = {"__id": F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), "__digest": F.unhex(F.md5(plain_words(F.col(text_col))))}
    return one_row_of_each(docs, key, kept.toDF("__id", "__digest"), judged.toDF("__id", "__digest", *judged.columns[2:]), F.col("root").isNull())


def op4_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
