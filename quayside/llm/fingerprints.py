"""SpotSigs document fingerprints.

A spot signature is an anchor, a common word, with the chain of the next
``CHAIN`` content words after it, whatever anchors stand between.  Texts are
lowered and cut at everything but letters and digits.  A text's start counts as an
anchor too, so each text with a content word has a signature; a text without any
has its own whole as its signature.  Where anchors are scarce (tables, code, other
languages), fewer than one for ``SCARCE`` content words, each content word is an
anchor as well, so the signatures cover the whole text.

The fingerprint is the set of signatures.  Two texts are compared by Jaccard
similarity; sets can only be alike if their lengths are, so ``near_pairs`` deals
them out by length and compares neighbouring lengths only.

Everything here is made of Spark's own functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has have he her his in is it its not of on or she that the their they this "
    "to was were will with you "
    "auf aus bei das dem den der des die ein eine einem einen einer er es für im ist mit nicht sich sie sind und "
    "von war werden wie wird zu zum zur "
    "au aux avec ce ces dans de du elle en est et il la le les leur mais ne nous ou par pas plus pour que qui se "
    "ses son sur un une vous "
    "al como con del el ella ellos era ha las lo los más me muy no o para pero por su sus también una y"
).split()

CHAIN = 2
SCARCE = 16

#: Rows are sorted in ranges of so many, up to the square of ``MOST_CUTS`` ranges.
RANGE_IDS, MOST_CUTS = 2000, 32


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _hashed(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("bigint")


def signatures(text: Column) -> Column:
    """The sorted distinct signatures of a text, as 32-bit numbers; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")

    def spotted(w: Column) -> Column:
        content = F.filter(w, lambda x: ~x.isin(ANCHORS))
        places = F.array_compact(F.transform(w, lambda x, i: F.when(x.isin(ANCHORS), i)))
        return _named(content, lambda c: _chains(w, c, places))

    found = _named(words, spotted)
    return F.when(F.size(found) > 0, F.array_sort(F.array_distinct(found))).otherwise(F.array(_hashed(text)))


def _chains(words: Column, content: Column, places: Column) -> Column:
    """The n-th anchor at place p has p - n content words before it."""

    def chain(anchor: Column, at: Column) -> Column:
        follow = [F.coalesce(F.get(content, at + k), F.lit("")) for k in range(CHAIN)]
        return F.when(at < F.size(content), _hashed(F.concat_ws(" ", anchor, *follow)))

    start = F.array(chain(F.lit(""), F.lit(0)))
    spots = F.transform(places, lambda p, n: chain(F.get(words, p), p - n))
    scarce = F.size(places) * SCARCE < F.size(content)
    every = F.when(scarce, F.transform(content, lambda x, n: chain(x, n + 1))).otherwise(F.array().cast("array<bigint>"))
    return F.array_compact(F.concat(start, spots, every))


def fingerprint(found: Column) -> Column:
    """A set of signatures as text: eight hexadecimal digits each, in order."""
    return F.array_join(F.transform(found, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0")), "")


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def _cuts(ids: DataFrame) -> list[list[float]]:
    """Ids that cut the table into ranges of about ``RANGE_IDS`` rows, ``MOST_CUTS`` squared at most, in as many lists."""
    ranges = max(1, min(MOST_CUTS * MOST_CUTS, ids.count() // RANGE_IDS))
    if ranges == 1:
        return []
    bounds = sorted(set(ids.approxQuantile("id", [k / ranges for k in range(1, ranges)], 0.2 / ranges)))
    size = max(1, math.isqrt(len(bounds)))
    return [bounds[k : k + size] for k in range(0, len(bounds), size)]


def _range_of(cuts: list[list[float]]) -> Column:
    """How many cuts are not above the id: first among the lists' first ones, then within one list."""
    if not cuts:
        return F.lit(0)
    value = F.col("id").cast("double")
    outer = F.size(F.filter(F.array(*(F.lit(c[0]) for c in cuts)), lambda c: c <= value))
    inner = F.get(F.array(*(F.array(*(F.lit(x) for x in c)) for c in cuts)), outer - 1)
    within = F.coalesce(F.size(F.filter(inner, lambda c: c <= value)), F.lit(0))
    return F.when(outer == 0, F.lit(0)).otherwise((outer - 1) * len(cuts[0]) + within)


def _with_next(rows: DataFrame) -> DataFrame:
    """``rows(id, doc_id, text)`` with ``signatures`` and the ``next`` document's text and signatures.

    Rows are dealt out once, by ranges of ids.  A range's first document is also
    the guest of the range before, whose last it follows; the first of all
    follows the last of all.  From the largest id down, the next document is the
    last one before that is the smallest text of its id.
    """
    ranged = rows.withColumn("range", _range_of(_cuts(rows.select("id"))))
    # One id for each range.
    firsts = ranged.groupBy("range").agg(F.min("id").alias("id")).orderBy("range").collect()
    hosts = [firsts[k - 1]["range"] for k in range(len(firsts))]
    before = F.lit(None).cast("int")
    if firsts:
        pairs = [F.lit(x) for first, host in zip(firsts, hosts, strict=True) for x in (first["id"], host)]
        before = F.try_element_at(F.create_map(*pairs), F.col("id")).cast("int")
    placed = ranged.withColumn(
        "place",
        F.explode(
            F.when(before.isNull(), F.array(F.struct(F.col("range"), F.lit(False).alias("guest")))).otherwise(
                F.array(
                    F.struct(F.col("range"), F.lit(False).alias("guest")),
                    F.struct(before.alias("range"), F.lit(True).alias("guest")),
                )
            )
        ),
    ).select("id", "doc_id", "text", "place.range", "place.guest")
    signed = placed.repartition("range").withColumn("signatures", signatures(F.col("text")))
    # Guests follow every row of their host, also where the order of ids goes round.
    down = Window.partitionBy("range").orderBy(F.desc("guest"), F.desc("id"), F.desc("text"))
    smallest = F.lead("id").over(down).isNull() | (F.lead("id").over(down) != F.col("id")) | (
        F.lead("guest").over(down) != F.col("guest")
    )
    document = F.when(F.col("smallest"), F.struct("text", "signatures"))
    above = F.last(document, ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, -1))
    return signed.withColumn("smallest", smallest).withColumn("next", above).where(~F.col("guest"))


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs(doc_id, text)``, of its edited text, and their likeness.

    The edited text ends, for its last half, in the beginning of the next
    document by ``doc_id``.  Returns ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, n_signatures``.  Null
    texts are empty.  A null ``doc_id`` comes before all others; of rows with one
    ``doc_id`` the smallest text stands for the next document, and each is
    returned.  An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("id"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int"))
    edited = F.concat(kept, F.substring("next.text", F.lit(1), half))
    return (
        _with_next(rows)
        .withColumn("n_chars", F.char_length("text").cast("bigint"))
        .select("doc_id", "n_chars", "signatures", edited.alias("edited"), F.col("next.signatures").alias("next"))
        .select("*", signatures(F.col("edited")).alias("edited_signatures"))
        .select(
            "doc_id",
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            fingerprint(F.col("signatures")).alias("fingerprint"),
            fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
            jaccard(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
            jaccard(F.col("signatures"), F.col("next")).alias("near_next"),
            F.size("signatures").cast("bigint").alias("n_signatures"),
        )
    )


def near_pairs(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``a, b, near``: pairs of different signature sets in ``docs(doc_id, text)`` of at least ``similarity``.

    Each set is named by its smallest ``doc_id``.  Sets are partitioned by length,
    such that only sets of one or of neighbouring partitions can be alike.  A
    set is posted under its rarest signatures only, as many as a set must hold for
    one of them to be shared; what shares one is pruned by length, then compared.
    """
    sets = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), signatures(F.col("text")).alias("signatures"))
        .groupBy("signatures")
        .agg(F.min("doc_id").alias("id"))
        .where("id IS NOT NULL")
        .withColumn("n", F.size("signatures"))
        .withColumn("part", F.floor(F.log(F.col("n").cast("double")) / -math.log(similarity) + F.lit(1e-9)))
    )
    posted = sets.select("id", "n", "part", F.explode("signatures").alias("signature"))
    common = posted.groupBy("signature").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # Signatures of its own come first among a set's rarest, and are shared with none.
    room = F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - 1e-9) + 1 - (F.col("n") - F.size("held"))
    prefix = (
        posted.join(common, "signature")
        .groupBy("id", "n", "part")
        .agg(F.sort_array(F.collect_list(F.struct("df", "signature"))).alias("held"))
        .where(room > 0)
        .select("id", "n", "part", F.explode(F.slice("held", F.lit(1), room.cast("int"))).alias("held"))
        .select("id", "n", "part", "held.signature")
    )
    left = prefix.select(F.col("id").alias("a"), F.col("n").alias("a_n"), "part", "signature")
    own = prefix.select(F.col("id").alias("b"), F.col("n").alias("b_n"), "part", "signature")
    neighbours = own.unionByName(own.withColumn("part", F.col("part") - 1))
    alike = F.least("a_n", "b_n") >= similarity * F.greatest("a_n", "b_n") - 1e-9
    once = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a") < F.col("b")))
    pairs = left.join(neighbours, ["part", "signature"]).where(alike & once).select("a", "b").distinct()
    held = sets.select("id", "signatures")
    near = jaccard(F.col("x"), F.col("y"))
    return (
        pairs.join(held.select(F.col("id").alias("a"), F.col("signatures").alias("x")), "a")
        .join(held.select(F.col("id").alias("b"), F.col("signatures").alias("y")), "b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), near.alias("near"))
        .where(F.col("near") >= similarity - 1e-12)
    )
