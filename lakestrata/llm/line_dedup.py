"""Removal of repeated chunks of lines, whose borders the lines themselves choose.

A document's lines are hashed, and a hash that rolls over the last ``window`` line
hashes ends a chunk wherever its first digit is one of ``cuts`` hexadecimal digits, and that of
the line before is not. A
long line is a chunk of its own. So borders depend on the lines near them and on
nothing before, and a passage is cut alike wherever it stands.

Chunks of several lines, or of one long line, that occur more than once are
candidates. Only hashes and counts are shuffled to find them. The text of a candidate is
then compared with that of the chunk's first occurrence, and equal ones go.

All steps are built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .shared import stage, text_of

_DIGITS = "0123456789abcdef"


def _bare(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\r"))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _before(items: Column, first: Column) -> Column:
    """Each place gets the item of the place before it."""
    return F.concat(F.array(first), F.slice(items, F.lit(1), F.size(items) - 1))


def with_chunks(rows: DataFrame, window: int, cuts: int, long_line: int) -> DataFrame:
    """Adds ``chunks``, the chunks of ``body`` in order.

    Lambdas read their own item only, so the work grows with the text and not with its
    square. There is always a chunk; taking them apart with an outer explode keeps Spark
    from filtering by their number, for which it would cut every text twice. Every line is written after a mark that says whether it begins a chunk;
    splitting at one of the marks gives the chunks.
    """
    no = F.lit(False)
    hashed = rows.withColumn("_lines", lines_of(F.col("body"))).withColumn(
        "_hash", F.transform("_lines", F.md5)
    )
    held = [F.col("_hash")]
    for _ in range(window - 1):
        held.append(_before(held[-1], F.lit("")))
    names = [f"h{i}" for i in range(window)]
    windows = F.arrays_zip(*[h.alias(n) for h, n in zip(held, names, strict=True)])

    def rolled(w: Column) -> Column:
        rolling = F.md5(F.concat(*[w[n] for n in reversed(names)]))
        return F.substring(rolling, 1, 1).isin(*_DIGITS[:cuts])

    flagged = (
        hashed.withColumn("_rolled", F.transform(windows, rolled))
        .withColumn("_long", F.transform("_lines", lambda x: F.length(x) >= long_line))
        .withColumn("_rolled_1", _before(F.col("_rolled"), no))
        .withColumn("_rolled_2", _before(F.col("_rolled_1"), no))
        .withColumn("_long_1", _before(F.col("_long"), no))
    )

    def marked(x: Column, i: Column) -> Column:
        # Of borders in a row the first counts, so that no short line is a chunk alone.
        begins = x["_long"] | x["_long_1"] | (x["_rolled_1"] & ~x["_rolled_2"])
        mark = F.when(i == 0, "").when(begins, "\n0").otherwise("\n1")
        return F.concat(mark, x["_lines"])

    parts = F.arrays_zip("_lines", "_long", "_long_1", "_rolled_1", "_rolled_2")
    text = F.array_join(F.transform(parts, marked), "")
    chunks = F.transform(F.split(text, "\n0", -1), lambda c: F.replace(c, F.lit("\n1"), F.lit("\n")))
    return flagged.withColumn("chunks", chunks).select(*rows.columns, "chunks")


def may_go(text: Column, long_line: int) -> Column:
    """Whether a chunk has several lines, not all blank, or is a long line."""
    several = (F.locate("\n", text) > 0) & (F.length(_bare(text)) > 0)
    return several | (F.length(text) >= long_line)


def dedup_lines(
    docs: DataFrame,
    window: int = 2,
    cuts: int = 4,
    long_line: int = 120,
    drop_emptied: bool = False,
    counts: bool = True,
) -> DataFrame:
    """``docs`` with repeated chunks taken out of ``text``.

    Of equal chunks the first stays: that of the smallest ``doc_id``, then of the
    smallest text hash, then the first in its document. ``docs`` has ``doc_id`` and
    ``text``; all its columns are returned; with ``counts``, ``n_chunks,
    removed_chunks, removed_lines`` follow. A null text stays null, an empty one empty; a null
    ``doc_id`` counts as the smallest. Rows that share number and text count as one
    document and are treated alike. ``drop_emptied`` drops documents of which nothing
    is left. No rows give no rows.
    """
    rows = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"),
        text_of().alias("body"),
    ).withColumn("version", F.xxhash64("body"))
    keyed = rows.select("doc", "version", "body")
    chunks = stage(
        with_chunks(keyed, window, cuts, long_line)
        .select("doc", "version", F.posexplode_outer("chunks").alias("at", "chunk"))
        .filter(may_go(F.col("chunk"), long_line))
        .select(
            "doc",
            "version",
            "at",
            F.xxhash64("chunk").alias("hash"),
            F.octet_length("chunk").alias("bytes"),
        )
        .distinct(),
        "chunks",
    )
    place = F.struct("doc", "version", "at")
    repeated = (
        chunks.groupBy("hash", "bytes")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    candidates = (
        chunks.join(repeated, ["hash", "bytes"])
        .groupBy("doc", "version")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("at", F.struct("hash", "bytes", "first")))
            ).alias("candidates")
        )
    )
    # The candidates' texts: only documents that have some go on, and of them only these chunks.
    texts = stage(
        with_chunks(keyed.join(candidates, ["doc", "version"]), window, cuts, long_line)
        .select("doc", "version", "candidates", F.posexplode_outer("chunks").alias("at", "text"))
        .withColumn("c", F.try_element_at("candidates", "at"))
        .filter("c IS NOT NULL")
        .select(
            "c.hash", "c.bytes", "at", "doc", "version", "text", (F.col("c.first") == place).alias("is_first")
        ),
        "texts",
    )
    # Rows of one document may repeat; their texts are equal.
    firsts = texts.filter("is_first").groupBy("hash", "bytes").agg(F.first("text").alias("kept"))
    equal = texts.filter("NOT is_first").join(firsts, ["hash", "bytes"]).filter("text = kept")
    removed = equal.groupBy("doc", "version").agg(F.collect_set("at").alias("removed"))
    joined = rows.join(removed, ["doc", "version"], "left")
    cut = with_chunks(joined, window, cuts, long_line)
    return _without(cut, docs.columns, drop_emptied, counts)


def drop_passages(docs: DataFrame, least_words: int = 50) -> DataFrame:
    """``docs`` with repeated passages of whole lines taken out of ``text``.

    A passage is a run of lines with ``least_words`` words at least. Every line begins and
    ends a shortest passage; longer ones are made of these, so a repeated passage goes as
    a whole, to its last line, wherever it stands and however short its lines are. Of equal
    passages the first stays, in the order of ``dedup_lines``. Lines without words are
    not compared; they go with the passage around them. Lines are equal if 128 bits of their
    SHA-256 are. Rows of which nothing is left go; other texts, null and empty ones too,
    stay as they are.
    """
    rows = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"),
        text_of().alias("body"),
    ).withColumn("version", F.xxhash64("body"))

    def name(x: Column) -> Column:
        return F.substring(F.unhex(F.sha2(x, 256)), 1, 16)

    def words(x: Column) -> Column:
        return F.regexp_count(x, F.lit(r"\S+"))

    lines = (
        rows.select("doc", "version", F.posexplode_outer(lines_of(F.col("body"))).alias("at", "line"))
        .select("doc", "version", "at", name(F.col("line")).alias("name"), words(F.col("line")).alias("n"))
        .filter("n > 0")
        .dropDuplicates(["doc", "version", "at"])
    )
    by = Window.partitionBy("doc", "version")
    ends = lines.withColumn("end", F.sum("n").over(by.orderBy("at"))).withColumn(
        "start", F.col("end") - F.col("n")
    )
    # Every line has a word, so starts and ends ascend and a frame has no line too many.
    ahead = by.orderBy("start").rangeBetween(0, least_words - 1)
    behind = by.orderBy("end").rangeBetween(1 - least_words, 0)

    def passage(frame: WindowSpec) -> Column:
        return F.struct(
            F.substring(F.unhex(F.sha2(F.concat_ws("", F.collect_list(F.hex("name")).over(frame)), 256)), 1, 16).alias("name"),
            F.min("at").over(frame).alias("first"),
            F.max("at").over(frame).alias("last"),
            (F.sum("n").over(frame) >= least_words).alias("whole"),
        )

    both = ends.select("doc", "version", passage(ahead).alias("a"), passage(behind).alias("b"))
    same = (F.col("a.first") == F.col("b.first")) & (F.col("a.last") == F.col("b.last"))
    passages = stage(
        both.select(
            "doc",
            "version",
            F.explode(F.when(same, F.array("a")).otherwise(F.array("a", "b"))).alias("p"),
        )
        .filter("p.whole")
        .select("doc", "version", "p.name", "p.first", "p.last"),
        "passages",
    )
    place = F.struct("doc", "version", "first", "last")
    repeated = (
        passages.groupBy("name")
        .agg(F.min(place).alias("kept"), F.max(place).alias("other"))
        .filter("kept <> other")
        .drop("other")
    )
    gone = (
        passages.join(repeated, "name")
        .filter(place != F.col("kept"))
        .groupBy("doc", "version", "first")
        .agg(F.max("last").alias("last"))
    )

    def flags(s: Column) -> Column:
        return F.concat(
            F.array_repeat(F.lit(False), s["gap"]),
            F.array_repeat(F.lit(True), s["last"] - s["first"] + 1),
        )

    # Spans that overlap become one, so that a text meets each of its lines once.
    before = F.max("last").over(by.orderBy("first").rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first") > before, F.lit(True)).cast("int")
    spans = (
        gone.withColumn("opens", opens)
        .withColumn("span", F.sum("opens").over(by.orderBy("first")))
        .groupBy("doc", "version", "span")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .withColumn("gap", F.col("first") - F.coalesce(F.lag("last").over(by.orderBy("first")), F.lit(-1)) - 1)
        .groupBy("doc", "version")
        .agg(F.array_sort(F.collect_list(F.struct("first", "last", "gap"))).alias("spans"))
        .withColumn("gone", F.flatten(F.transform("spans", flags)))
        .drop("spans")
    )
    zipped = F.arrays_zip(lines_of(F.col("body")).alias("line"), F.col("gone").alias("gone"))
    kept = F.filter(zipped, lambda x: ~F.coalesce(x["gone"], F.lit(False)))
    left = F.transform(kept, lambda x: x["line"])
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(left, "\n"))
    cut = rows.join(spans, ["doc", "version"], "left").select(
        F.col("row").withField("text", text).alias("row"), F.col("gone").isNotNull().alias("changed")
    )
    out = cut.filter(~F.col("changed") | (_bare(F.col("row.text")) != ""))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _without(
    cut: DataFrame, columns: list[str], drop_emptied: bool, counts: bool
) -> DataFrame:
    gone = F.coalesce("removed", F.array().cast("array<int>"))
    kept = F.filter("chunks", lambda c, i: ~F.array_contains(gone, i))
    lost = F.filter("chunks", lambda c, i: F.array_contains(gone, i))
    changed = F.size(gone) > 0
    text = F.when(changed, F.array_join(kept, "\n")).otherwise(F.col("row.text"))
    lines = F.aggregate(lost, F.lit(0), lambda n, c: n + F.size(F.split(c, "\n", -1)))
    out = cut.select(
        F.col("row").withField("text", text).alias("row"),
        F.size("chunks").alias("n_chunks"),
        F.size(gone).alias("removed_chunks"),
        F.when(changed, lines).otherwise(0).alias("removed_lines"),
    )
    if drop_emptied:
        out = out.filter(~((F.col("removed_chunks") > 0) & (_bare(F.col("row.text")) == "")))
    more = ["n_chunks", "removed_chunks", "removed_lines"] if counts else []
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in columns], *more)
