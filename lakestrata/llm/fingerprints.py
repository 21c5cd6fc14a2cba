"""Document fingerprints by spot signatures.

A spot is a common word with the chain of content words that follow it. The set of a
text's spots says what its prose is about and hardly notices navigation and other text
without common words.

Sets are partitioned by length, each partition as wide as the least similarity asked for allows:
sets that are alike are in one partition or in neighbouring ones. Within these they are compared by
Jaccard similarity, which is cut short where the lengths, or one half of the spots, already rule
out the least similarity.

All steps are built-in functions; lambdas read their own item only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import ordered_blocks, shuffle_partitions, stage, text_of

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be been but by can do for from had has have he her his if in is it its "
    "more not of on or our she so than that the their there they this to was we were which who "
    "will with would you "
    "auf aus bei das dem den der des die ein eine einen einer es für hat ich im ist mit nicht "
    "sich sie sind und von vor war wie zu zum zur "
    "au aux avec ce ces dans de du elle en est et il la le les mais ne ou par pas plus pour que "
    "qui sa se ses son sont sur un une "
    "al como con del el esta ha lo los las muy para pero por su sus y ya"
).split()
_NULL_KEY = -(2**63)


def spots(rows: DataFrame, text: str, name: str, chain: int = 3, reach: int = 6) -> DataFrame:
    """Adds ``name``, the sorted distinct spots of ``text``, as 64-bit hashes.

    Words are runs of letters and digits, lower-cased. Anchors are the common words, the
    beginning of the text, and one word in sixteen by its hash, so that languages without
    a list have anchors too. A chain is the first ``chain`` content words among the next
    ``reach`` words; at the end of the text it may be shorter. A text without words has one
    spot, that of the beginning.
    """
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def coded(word: Column) -> Column:
        # Content words are 0 or more, common words below.
        hashed = F.shiftrightunsigned(F.xxhash64(word), 1)
        return F.when(word.isin(ANCHORS), -2 - F.shiftrightunsigned(hashed, 1)).otherwise(hashed)

    start = F.array(F.lit(-1).cast("long"))
    codes = F.concat(start, F.transform(words, coded))
    held = rows.withColumn("_codes", codes)
    ahead = [
        F.slice("_codes", F.lit(i + 1), F.greatest(F.size("_codes") - i, F.lit(0))).alias(f"w{i}")
        for i in range(reach + 1)
    ]

    def spot(w: Column) -> Column:
        following = F.array(*[w[f"w{i}"] for i in range(1, reach + 1)])
        content = F.slice(F.filter(following, lambda x: x >= 0), 1, chain)
        anchor = (w["w0"] < 0) | (F.pmod(w["w0"], F.lit(16)) == 0)
        return F.when(anchor, F.xxhash64(w["w0"], content))

    found = F.filter(F.transform(F.arrays_zip(*ahead), spot), lambda s: s.isNotNull())
    return held.withColumn(name, F.array_sort(F.array_distinct(found))).drop("_codes")


def fingerprint(spots_name: str) -> Column:
    """A fixed-length name of a set of spots."""
    return F.md5(F.array_join(F.transform(spots_name, lambda s: s.cast("string")), ","))


def length_part(n: Column, least: float) -> Column:
    """The partition of a set with ``n`` spots.

    Sets with a similarity of ``least`` have lengths that differ by that factor at most, so they
    are in one partition or in two that follow each other. The width is a trifle larger, so that
    no rounding puts them further apart.
    """
    width = -math.log(least) + 1e-9
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / width)


def likeness(a: str, b: str, least: float = 0.0, halves: bool = False) -> Column:
    """Jaccard similarity of two sets of spots; 0 where it cannot reach ``least``.

    Sets that are not in one partition by length or in neighbouring ones, or whose lengths differ
    by more than ``least``, are decided without a look at the spots. With ``halves`` the negative
    spots are compared first; if these and all others of the smaller rest are too few, the rest
    is not looked at. Two empty sets are alike.
    """
    na, nb = F.size(a), F.size(b)
    common = F.size(F.array_intersect(a, b))
    similarity = common / (na + nb - common)
    decided = F.when((na == 0) & (nb == 0), 1.0)
    if least > 0:
        apart = F.abs(length_part(na, least) - length_part(nb, least)) > 1
        bound = F.least(na, nb) / F.greatest(na, nb, F.lit(1))
        decided = decided.when(apart, 0.0).when(bound < least, 0.0)
    if halves:
        low_a, low_b = (F.filter(s, lambda x: x < 0) for s in (a, b))
        rest = F.least(na - F.size(low_a), nb - F.size(low_b))
        reach = F.size(F.array_intersect(low_a, low_b)) + rest
        decided = decided.when(reach / (na + nb - reach) < least, 0.0)
    return decided.otherwise(similarity).cast("double")


def similar_texts(docs: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """All pairs of different fingerprints with a likeness of ``least``, and who has them.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Returns the members, a row
    for each row of ``docs`` with ``doc_id`` and ``fingerprint``, and the links, ``a, b, likeness``
    with ``a`` the smaller fingerprint. Documents with equal fingerprints are one set and not
    compared, so copies cost nothing. Null and empty texts have the spot of the beginning only
    and are equal. No rows give no members and no links.

    Sets that are alike share one of their rarest spots, as many as may be missing and one more.
    These are joined by spot and partition; a spot that most texts have is rare in none but
    texts that have nothing else. Lost are no links, as the join is exact.
    """
    if not 0 < least <= 1:
        raise ValueError("least is above 0, and at most 1")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    members = stage(
        spots(texts, "text", "spots").select("doc_id", fingerprint("spots").alias("fingerprint"), "spots"),
        "members",
    )
    sets = stage(
        members.groupBy("fingerprint").agg(F.first("spots").alias("spots")).withColumn("n", F.size("spots")),
        "sets",
    )
    single = sets.select("fingerprint", "n", F.explode("spots").alias("spot"))
    counts = single.groupBy("spot").agg(F.count("*").alias("held"))
    rarest = Window.partitionBy("fingerprint").orderBy("held", "spot")
    # A trifle less than asked for, so that no rounding makes the prefix too short.
    missing = F.col("n") - F.ceil(F.col("n") * (least - 1e-9))
    prefix = stage(
        single.join(counts, "spot")
        .withColumn("rank", F.row_number().over(rarest))
        .filter(F.col("rank") <= missing + 1)
        .select("fingerprint", "n", "spot", length_part(F.col("n"), least).alias("part")),
        "prefix",
    )
    shorter = prefix.select(F.col("fingerprint").alias("x"), F.col("n").alias("nx"), "spot", F.col("part").alias("at"))
    longer = prefix.select(
        F.col("fingerprint").alias("y"),
        F.col("n").alias("ny"),
        "spot",
        F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("at"),
        "part",
    )
    once = (F.col("part") > F.col("at")) | (F.col("x") < F.col("y"))
    near = F.least("nx", "ny") >= F.greatest("nx", "ny") * (least - 1e-9)
    candidates = (
        shorter.join(longer, ["spot", "at"])
        .filter(once & near & (F.col("x") != F.col("y")))
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )
    of_a = sets.select(F.col("fingerprint").alias("a"), F.col("spots").alias("spots_a"))
    of_b = sets.select(F.col("fingerprint").alias("b"), F.col("spots").alias("spots_b"))
    links = (
        candidates.join(of_a, "a")
        .join(of_b, "b")
        .select("a", "b", likeness("spots_a", "spots_b", least, halves=True).alias("likeness"))
        .filter(F.col("likeness") >= least)
    )
    return members.drop("spots"), links


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, block, is_guard, ord`` in blocks of ascending numbers.

    Each block also has, marked as guards, the first rows of the block after it (of the
    first block, for the last), so a window over a block finds the next document of every
    row. No task holds more than a block.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    keyed = texts.withColumn("ord", F.coalesce("doc_id", F.lit(_NULL_KEY)))
    block, _ = ordered_blocks(keyed, "ord", 3 * shuffle_partitions(docs.sparkSession))
    blocked = keyed.withColumn("own", block)
    firsts = sorted(
        (r["own"], r["first"])
        for r in blocked.groupBy("own").agg(F.min("ord").alias("first")).collect()
    )
    guard = F.lit(None).cast("int")
    if firsts:
        before = [firsts[i - 1][0] for i in range(len(firsts))]
        table = [F.lit(x) for (_, first), b in zip(firsts, before, strict=True) for x in (first, b)]
        guard = F.try_element_at(F.create_map(*table), F.col("ord"))
    places = F.array(
        F.struct(F.col("own").cast("int").alias("block"), F.lit(False).alias("is_guard")),
        F.struct(guard.cast("int").alias("block"), F.lit(True).alias("is_guard")),
    )
    return (
        blocked.withColumn("place", F.explode(places))
        .filter("place.block IS NOT NULL")
        .select("doc_id", "text", "ord", "place.*")
    )


def fingerprints(docs: DataFrame, least: float = 0.2) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and how alike they are.

    The edited text has its last quarter of code points (rounded down) replaced by the first
    as many of the next document in ascending ``doc_id``; the first follows the last. Null
    texts are empty; null numbers come first; rows that share a number follow each other
    in the order of their texts. Other columns are not read. No rows give no rows.
    Likeness is compared as in ``similar_texts``: 0 where lengths rule out ``least``.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_spots``.
    """
    order = Window.partitionBy("block").orderBy("is_guard", "ord", "text")
    rows = with_next(docs).withColumn("next_text", F.lead("text").over(order))
    rows = spots(rows, "text", "spots").withColumn("next_spots", F.lead("spots").over(order))
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - quarter),
        F.substring(F.col("next_text"), F.lit(1), quarter),
    )
    rows = rows.filter("NOT is_guard").withColumn("edited", edited)
    rows = spots(rows, "edited", "edited_spots")
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("spots").alias("fingerprint"),
        fingerprint("edited_spots").alias("edited_fingerprint"),
        likeness("spots", "edited_spots", least).alias("near_edited"),
        likeness("spots", "next_spots", least).alias("near_next"),
        F.size("spots").alias("n_spots"),
    )
