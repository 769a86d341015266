"""MinHash near-duplicates by an inverted join of signature coordinates.

A document's signature has ``coordinates`` minima of its hashed word shingles.
Documents are posted under each coordinate-value pair.  Two documents that are
to agree in ``matches`` coordinates share a posting among the
``coordinates - matches + 1`` rarest of either, so only these lists are merged
(prefix); the long lists are skipped and looked up in the pair's signatures
when its collisions are counted.  Pairs at the match threshold are confirmed on
their full shingle sets.

A pair of similarity 0.8 agrees in fewer than 15 of 32 coordinates about once in
100,000 times; that is the only way to lose a link.

Documents with the same set are one class, so copies are never paired.  A list
of up to ``SHORT`` classes is merged pair by pair.  In a longer one the members
are compared with one leader first, and classes already connected are not
compared again: a list of thousands of near copies costs a star, not all its
pairs.  What stars leave open is compared with those of the list that share
enough of its differences from the leader to be alike; no link is lost by that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.arrays import BLANK, LOWER, U64, flat, lists, mix, pieces, runs
from quayside.llm.components import components
from quayside.llm.store import document_key, written
from quayside.llm.words import hashes

COORDINATES, MATCHES = 32, 15

#: Lists of more classes are merged by stars, in so many rounds, before what is left.
SHORT, STARS = 16, 3

_random = np.random.default_rng(20240101)
_MULTIPLY = _random.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * U64(2) + U64(1)
_XOR = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    Words are runs of bytes other than blanks, A-Z lowered.  A text with fewer
    than ``width`` words has its whole sequence as one shingle, one without
    words has none.
    """
    data, offsets = flat(texts)
    inside = ~BLANK[data]
    starts, ends, of = runs(inside, offsets)
    words = hashes(LOWER[data[inside]], ends - starts)[:, 0]
    first = np.searchsorted(of, np.arange(len(offsets)))
    chained = np.zeros(max(0, len(words) - width + 1), U64)
    for k in range(width):
        chained = mix(chained + words[k : k + len(chained)] * U64(0x9E3779B97F4A7C15))
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if b - a >= width:
            yield np.unique(chained[a : b - width + 1])
        elif b > a:
            whole = U64(b - a)
            for word in words[a:b]:
                whole = mix(np.array([whole + word * U64(0x9E3779B97F4A7C15)], U64))[0]
            yield mix(np.array([whole], U64))
        else:
            yield np.zeros(0, U64)


def _signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, U64)
    for at in range(0, len(shingles), 4096):
        hashed = (shingles[at : at + 4096, None] ^ _XOR) * _MULTIPLY
        np.minimum(least, (hashed ^ (hashed >> U64(32))).min(axis=0), out=least)
    return mix(least + np.arange(COORDINATES, dtype=U64))


def _identity(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that stand for a set."""
    if not len(shingles):
        return 0, 0
    a = mix(shingles).sum(dtype=U64)
    b = np.bitwise_xor.reduce(mix(shingles + U64(0x632BE59BD9B4E019)))
    return tuple(int(x) for x in mix(np.array([a, b + a], U64)).view(np.int64))


_SIGNED = "doc_id bigint, key bigint, n_shingles bigint, class bigint, check bigint, signature array<bigint>"


def _signed(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            sizes, ids, signatures = [], [], []
            with np.errstate(over="ignore"):
                for shingles in shingle_sets(piece.column("text"), width):
                    sizes.append(len(shingles))
                    ids.append(_identity(shingles))
                    if len(shingles):
                        signatures.append(_signature(shingles).view(np.int64))
            sizes = np.array(sizes, np.int64)
            values = np.concatenate(signatures) if signatures else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    piece.column("key"),
                    pa.array(sizes),
                    pa.array([i[0] for i in ids], pa.int64()),
                    pa.array([i[1] for i in ids], pa.int64()),
                    lists(values, np.where(sizes > 0, COORDINATES, 0), pa.int64()),
                ],
                ["doc_id", "key", "n_shingles", "class", "check", "signature"],
            )


def _sets(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            with np.errstate(over="ignore"):
                found = list(shingle_sets(piece.column("text"), width))
                ids = [_identity(s) for s in found]
            counts = np.array([len(s) for s in found], np.int64)
            values = np.concatenate(found).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in zip(*ids, strict=True)), lists(values, counts, pa.int64())],
                ["set", "check", "shingles"],
            )


def _postings(classes: DataFrame, similarity: int) -> DataFrame:
    """``class, n_shingles, central, token`` for the rarest tokens of each class that others share.

    ``central`` says how many share any of its tokens: most with an original, fewer with its changed copies.

    Sets that are alike have sizes of one or of neighbouring steps of a
    geometric scale.  Each class is posted on its own step and the next, and
    what is rare is counted on each step.
    """
    step = F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(100 / similarity) + 1e-9).cast("int")
    tokens = (
        classes.select("class", "signature", F.explode(F.array(step, step + 1)).alias("step"))
        .select("class", "step", F.explode("signature").alias("value"))
        .select("class", "step", F.xxhash64("value", "step").alias("token"))
    )
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # A class's tokens of its own come first in its prefix; they match nobody.
    room = COORDINATES - MATCHES + 1 - (COORDINATES - F.size("held"))
    ranked = (
        tokens.join(shared, "token")
        .groupBy("class", "step")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("held"))
        .where(room > 0)
        .select(
            "class",
            F.aggregate("held.df", F.lit(0).cast("bigint"), lambda n, df: n + df).alias("central"),
            F.explode(F.slice("held", F.lit(1), room)).alias("held"),
        )
        .select("class", "central", "held.token")
    )
    return ranked.join(classes.select("class", "n_shingles"), "class")


def _alike_in_size(similarity: int) -> Column:
    sizes = F.least("a_size", "b_size"), F.greatest("a_size", "b_size")
    return 100 * sizes[0] >= similarity * sizes[1]


def _majors(postings: DataFrame) -> DataFrame:
    """``token, major``: the most frequent component of each list that holds several."""
    return (
        postings.groupBy("token", "component")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("token")
        .agg(F.max(F.struct("n", "component"))["component"].alias("major"), F.count(F.lit(1)).alias("kinds"))
        .where("kinds > 1")
        .select("token", "major")
    )


def _starred(postings: DataFrame, turn: int) -> DataFrame:
    """Every member of a list beside the list's leader, unless connected already.

    The first to lead is the most central member.  Later ones lead those outside the
    list's most frequent component only: the most central one, then any, by a hash.
    Whether these are alike to members of that component is left to the open pairs.
    """
    if turn:
        postings = postings.join(_majors(postings), "token").where("component <> major")
    order = -F.col("central") if turn < 2 else F.xxhash64("class", F.lit(turn))
    leader = (
        postings.groupBy("token")
        .agg(F.min(F.struct(order.alias("order"), "class", "n_shingles", "component")).alias("leader"))
    )
    return (
        postings.join(leader, "token")
        .where("component <> leader.component")
        .select(
            F.col("class").alias("a"),
            F.col("leader.class").alias("b"),
            F.col("n_shingles").alias("a_size"),
            F.col("leader.n_shingles").alias("b_size"),
        )
    )


_PAIR = ("a_class AS a", "b_class AS b", "a_n_shingles AS a_size", "b_n_shingles AS b_size")


def _side(postings: DataFrame, name: str) -> DataFrame:
    return postings.select("token", *(F.col(c).alias(f"{name}_{c}") for c in postings.columns if c != "token"))


def _all_pairs(postings: DataFrame) -> DataFrame:
    """All pairs of lists that are short."""
    pairs = _side(postings, "a").join(_side(postings, "b"), "token").where("a_class < b_class")
    return pairs.selectExpr(*_PAIR)


def _differences(postings: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """How each member of a list that is still open differs from the list's leader.

    The leader is the most central class of the list's most frequent component,
    the same for all lists of that component, so a member is read once for it.
    ``apart`` marks members outside of it.  ``weight`` grows with the difference,
    ``slack`` is the weight up to which a member is alike to the leader.  What the
    leader has and a member has not, ``n_gone`` shingles, comes first in ``differs``.
    A member of which fewer than ``similarity`` percent are in the leader needs
    ``own`` more shingles to be alike to anything; for others that is 0.
    """
    majors = _majors(postings)
    central = F.struct((-F.col("central")).alias("order"), "class")
    leaders = (
        postings.join(majors, "token")
        .where("component = major")
        .groupBy("major")
        .agg(F.min(central)["class"].alias("leader"))
    )
    members = (
        postings.join(majors.join(leaders, "major"), "token")
        .where("class <> leader")
        .select("leader", "class", "n_shingles", "component", (F.col("component") != F.col("major")).alias("apart"))
        .distinct()
    )
    # Written, so that its size is known and it may be sent to the members.
    leading = written(
        sets.select(F.col("class").alias("leader"), F.col("shingles").alias("leading")).join(
            leaders.select("leader"), "leader", "left_semi"
        ),
        "leading",
    )
    read = members.join(sets, "class").join(leading, "leader")
    gone, more = F.array_except("leading", "shingles"), F.array_except("shingles", "leading")
    common = F.size("leading") - F.size(gone)
    return read.select(
        "leader",
        "class",
        "n_shingles",
        "component",
        "apart",
        F.size("leading").cast("bigint").alias("leader_size"),
        F.size(gone).alias("n_gone"),
        common.alias("common"),
        F.greatest(F.lit(0), F.ceil(similarity * F.size("shingles") / 100) - common).alias("own"),
        F.concat(gone, more).alias("differs"),
        (100 * F.size(gone) + similarity * F.size(more)).cast("bigint").alias("weight"),
        ((100 - similarity) * F.size("leading")).cast("bigint").alias("slack"),
    )


def _open_pairs(postings: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs of a list's members that are not connected yet and may be alike.

    With the leader L of the list, A = L - r(A) + d(A), so A and B have
    |L| - |r(A)| - |r(B)| in common, and what their differences from L share.  Sets
    that are alike must then share at least (weight(A) + weight(B) - slack) /
    (100 + similarity) of these differences, and that is positive unless both
    are alike to L.  So members apart are compared with L, and differences are
    posted instead of sets: two changed copies of one text share the text but
    rarely their changes.

    A set of which too little is in L (``own`` > 0) has at least so many of d(A) in
    common with every set that it is alike to.  What L has and such a set lacks
    is the same for all that are unlike L, so of these sets only d(A) is merged.

    Of each member only the rarest, as many as must hold a shared one, are
    merged, and only where enough of both are left behind them.
    """
    apart = written(_differences(postings, sets, similarity), "differences")
    inside = F.when(F.col("own") == 0, F.col("weight"))
    outside = F.when(F.col("own") > 0, F.col("own"))
    # Written, so that its size is known and it may be sent to the members: they stay spread evenly over the tasks then.
    least = written(
        apart.groupBy("leader").agg(
            F.min(inside).alias("inside"),
            F.min(outside).alias("outside"),
            F.min(F.when(F.col("apart"), inside)).alias("inside_apart"),
            F.min(F.when(F.col("apart"), outside)).alias("outside_apart"),
        ),
        "least",
    )

    def shared(weight: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil((weight - F.col("slack")) / (100 + similarity)))

    def needed(beside: str) -> Column:
        """What a member shares at least with any that it is alike to, or with any such apart; null if there are none."""
        with_inside = F.when(F.col(f"inside{beside}").isNotNull(), shared(F.col("weight") + F.col(f"inside{beside}")))
        some = F.least(with_inside, f"outside{beside}")
        return F.when(some.isNotNull() & (F.col("own") > 0), F.col("own")).otherwise(some)

    members = (
        apart.join(least, "leader")
        .withColumn("any", needed(""))
        .withColumn("other", needed("_apart"))
        .drop("inside", "outside", "inside_apart", "outside_apart")
        .withColumn("n", F.size("differs") - F.when(F.col("own") > 0, F.col("n_gone")).otherwise(0))
        .where("other <= n OR (apart AND any <= n)")
    )
    changes = members.select(
        "leader", "class", "component", "apart", "own", "n_gone", F.posexplode("differs").alias("at", "change")
    )
    changes = written(changes, "changed").where("own = 0 OR at >= n_gone")
    # Changes that no member apart shares with another component come first in the order, and meet nobody.
    met = (
        changes.groupBy("leader", "change")
        .agg(
            F.count(F.lit(1)).alias("df"),
            (F.max("apart") & (F.min("component") < F.max("component"))).alias("wanted"),
        )
        .where("wanted")
        .drop("wanted")
    )
    ranked = (
        changes.select("leader", "class", "change")
        .join(met, ["leader", "change"])
        .groupBy("leader", "class")
        .agg(F.sort_array(F.collect_list(F.struct("df", "change"))).alias("held"))
    )
    fields = ("class", "n_shingles", "component", "apart", "weight", "common", "own")
    ranked = written(members.select("leader", "slack", "any", "other", *fields).join(ranked, ["leader", "class"]), "changes")

    def posted(side: str, need: str) -> DataFrame:
        room = F.size("held") - F.col(need) + 1
        return ranked.where(room > 0).select(
            "leader",
            *(F.col(c).alias(f"{side}_{c}") for c in fields),
            *([F.col("slack")] if side == "a" else []),
            F.size("held").alias(f"{side}_held"),
            F.posexplode(F.slice("held", F.lit(1), room.cast("int"))["change"]).alias(f"{side}_at", "change"),
        )

    a_size, b_size = F.col("a_n_shingles"), F.col("b_n_shingles")
    together = F.ceil(similarity * (a_size + b_size) / (100 + similarity))
    must = F.when((F.col("a_own") == 0) & (F.col("b_own") == 0), shared(F.col("a_weight") + F.col("b_weight"))).otherwise(
        F.greatest("a_own", "b_own", together - F.least("a_common", "b_common"))
    )
    # The first difference that two members share has all others behind it, in both.
    behind = F.least(F.col("a_held") - F.col("a_at"), F.col("b_held") - F.col("b_at"))
    beside_leader = apart.where("apart AND weight <= slack").select(
        F.col("class").alias("a"), F.col("leader").alias("b"), F.col("n_shingles").alias("a_size"), F.col("leader_size").alias("b_size")
    )
    pairs = (
        posted("a", "any")
        .where("a_apart")
        .join(posted("b", "other"), ["leader", "change"])
        .where("a_component <> b_component AND (NOT b_apart OR a_class < b_class)")
        .where(100 * F.least(a_size, b_size) >= similarity * F.greatest(a_size, b_size))
        .where(must <= behind)
        .selectExpr(*_PAIR)
    )
    return pairs.unionByName(beside_leader)


def _colliding(pairs: DataFrame, classes: DataFrame, similarity: int) -> DataFrame:
    """Different pairs whose signatures agree often enough."""
    pairs = (
        pairs.where(_alike_in_size(similarity))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    signed = classes.select("class", "signature")
    for side in "ab":
        pairs = pairs.join(signed.select(F.col("class").alias(side), F.col("signature").alias(f"{side}_s")), side)
    collisions = F.size(F.filter(F.zip_with("a_s", "b_s", lambda x, y: x == y), lambda same: same))
    return pairs.where(collisions >= MATCHES).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs whose full sets are alike."""
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("class").alias(side), F.col("shingles").alias(f"{side}_s")), side)
    common = F.size(F.array_intersect("a_s", "b_s"))
    together = F.size("a_s") + F.size("b_s") - common
    return pairs.where(100 * common >= similarity * together).select("a", "b")


def near_duplicates(docs: DataFrame, width: int = 5, similarity: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``.

    Links join documents whose shingle sets have a Jaccard similarity of
    ``similarity`` percent or more; ``component_id`` is the smallest ``doc_id``
    reachable over links, ``kept`` whether it is the row's own.  Texts that are
    null or without words link with nothing.  Repeated rows are each returned,
    with one component.  A row without ``doc_id`` takes part; its component is
    the smallest id among the others, or null, and then it is kept.  An empty
    table gives no rows; other columns are not read.  ``similarity`` is below 100.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), document_key().alias("key"))
    signed = written(texts.mapInArrow(partial(_signed, width), _SIGNED), "signed")
    # Sets are told apart by all of them; later steps name a class by a short number.
    classes = written(
        signed.where("n_shingles > 0")
        .groupBy(F.col("class").alias("set"), "check", "n_shingles")
        .agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"), F.first("signature").alias("signature"))
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    # Smaller sets are alike only if they are the same, and then one class.
    smallest = -(-similarity // (100 - similarity))
    postings = written(_postings(classes.where(F.col("n_shingles") >= smallest), similarity), "postings")
    lists = postings.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    postings = written(postings.join(lists, "token"), "lists")
    short = postings.where(F.col("n") <= SHORT).drop("n")
    long = postings.where(F.col("n") > SHORT).drop("n")
    pairs = written(_colliding(_all_pairs(short), classes, similarity), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).unionByName(long.select("class")).distinct()
    wanted = classes.join(wanted, "class", "left_semi").select("key", "class", "set", "check")
    read = texts.join(wanted.select("key").distinct(), "key", "left_semi").mapInArrow(
        partial(_sets, width), "set bigint, check bigint, shingles array<bigint>"
    )
    sets = written(
        read.dropDuplicates(["set", "check"]).join(wanted, ["set", "check"]).select("class", "shingles"), "sets"
    )

    links = written(_confirmed(pairs, sets, similarity), "confirmed")
    grown = written(components(links), "components")
    for turn in range(0 if long.isEmpty() else STARS + 1):
        current = written(
            long.join(grown.withColumnRenamed("node", "class"), "class", "left").withColumn(
                "component", F.coalesce("component", "class")
            ),
            "open",
        )
        met = _starred(current, turn) if turn < STARS else _open_pairs(current, sets, similarity)
        found = written(_confirmed(_colliding(met, classes, similarity), sets, similarity), "confirmed")
        if not found.isEmpty():
            # What was connected is kept as one link to each component's smallest class.
            links = grown.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(found)
            grown = written(components(links), "components")
    reached = classes.join(grown.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    smallest_id = reached.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    placed = reached.select(F.col("set").alias("class"), "check", "n_shingles", "component").join(
        smallest_id, "component"
    )
    own = F.col("n_shingles") == 0
    component_id = F.when(own, F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        signed.select("doc_id", "n_shingles", "class", "check")
        .join(placed.drop("component"), ["class", "check", "n_shingles"], "left")
        .select(
            "doc_id",
            "n_shingles",
            component_id.alias("component_id"),
            F.col("doc_id").eqNullSafe(component_id).alias("kept"),
        )
    )


def one_of_each(docs: DataFrame, width: int = 5, similarity: int = 80) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, repeated rows once, with all their columns."""
    kept = written(near_duplicates(docs, width, similarity).where("kept").select("doc_id"), "kept")
    ids = kept.select(F.col("doc_id").alias("__kept_doc_id")).distinct()
    rows = docs.join(ids, docs["doc_id"].eqNullSafe(ids["__kept_doc_id"]), "left_semi")
    again = kept.groupBy(F.col("doc_id").alias("__kept_doc_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if again.isEmpty():
        return rows
    same = rows["doc_id"].eqNullSafe(again["__kept_doc_id"])
    return rows.join(again, same, "left_anti").unionByName(
        rows.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    )
