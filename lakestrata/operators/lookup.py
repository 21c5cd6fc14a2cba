"""Keys looked up in documents that have already landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions import has_fields
from lakestrata.session import stage


def enrich(keys: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """The documents of the keys. A key that occurs n times gets its document n times."""
    return keys.join(documents, key, "inner")


def enrich_counted(
    keys: DataFrame, documents: DataFrame, key: str, copies: str = "copies"
) -> DataFrame:
    """The documents of the distinct keys, with the number of times each key occurs.

    Holds what ``enrich`` holds. A key that makes up much of the list joins as one
    row, and its document is not multiplied before something asks for the copies.

    The counted keys are written first. Spark then knows their size when it plans
    the join: if they are few they are broadcast and the documents, much the
    larger side, are not shuffled.
    """
    return documents.join(stage(count_keys(keys, key, copies), "keys"), key, "inner")


# Bits of one bitmap: what Spark's bitmap functions put into one binary value.
_BITMAP_BITS = 32_768


def _places(key: str, bits: int, hashes: int) -> list[Column]:
    """The bits of a key, as many as there are hashes."""
    return [F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(bits)) for i in range(hashes)]


def key_bitmaps(keys: DataFrame, key: str, bits: int, hashes: int = 3) -> DataFrame:
    """A Bloom filter of the keys: ``bucket, bitmap``, at most ``bits / 8`` bytes in all.

    Built by one aggregation, whose bitmaps are merged before the shuffle.
    """
    places = keys.select(F.explode(F.array(*_places(key, bits, hashes))).alias("place"))
    return places.groupBy(F.expr(f"place div {_BITMAP_BITS}").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("place") % _BITMAP_BITS).alias("bitmap")
    )


def may_have_key(
    df: DataFrame, bitmaps: DataFrame, key: str, bits: int, hashes: int = 3
) -> DataFrame:
    """The rows whose key the filter holds: all with one of its keys, and few others.

    The bitmaps are sent to all tasks, as their size is bounded; ``df`` is not shuffled.
    """
    for place in _places(key, bits, hashes):
        held = df.withColumn("_place", place).join(
            F.broadcast(bitmaps), F.expr(f"_place div {_BITMAP_BITS}") == F.col("bucket")
        )
        at = (F.col("_place") % _BITMAP_BITS).cast("int")
        byte = F.substring(F.col("bitmap"), F.expr(f"cast(_place % {_BITMAP_BITS} AS int) div 8 + 1").cast("int"), F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        df = held.filter(F.getbit(value, at % 8) == 1).select(*df.columns)
    return df


def enrich_filtered(
    keys: DataFrame,
    documents: DataFrame,
    key: str,
    copies: str = "copies",
    max_bytes: int = 1 << 25,
    hashes: int = 3,
) -> DataFrame:
    """``enrich_counted`` for keys too many to broadcast: both sides are shuffled, the documents
    only as far as a Bloom filter of the keys lets them.

    The filter has sixteen bits for each key, ``max_bytes`` at most, and lets half a percent of
    the other documents through then; with more keys it lets through more. What it lets through
    is joined, so the result is exact.
    """
    counted = stage(count_keys(keys, key, copies), "keys")
    wanted = 16 * max(counted.count(), 1)
    bits = min(-(-wanted // _BITMAP_BITS) * _BITMAP_BITS, max_bytes * 8)
    bitmaps = stage(key_bitmaps(counted.dropna(subset=[key]), key, bits, hashes), "bitmaps")
    return may_have_key(documents, bitmaps, key, bits, hashes).join(counted, key, "inner")


def count_keys(keys: DataFrame, key: str, copies: str = "copies") -> DataFrame:
    """Each key once, with the number of times it occurs; counted before the shuffle."""
    return keys.groupBy(key).agg(F.count("*").alias(copies))


def unknown_keys(keys: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """The keys without any document.

    Each key of the documents meets the keys once: a key with very many documents would
    otherwise keep one task busy, as only the left side of an anti join can be cut.
    """
    return keys.join(documents.select(key).distinct(), key, "left_anti")


def _is_hit(status: str, payload: str, ok: int) -> Column:
    return F.coalesce(F.col(status) == ok, F.lit(False)) & has_fields(payload)


def found(df: DataFrame, status: str = "status", payload: str = "payload", ok: int = 200) -> DataFrame:
    """Lookups that succeeded and gave a JSON object with at least one field."""
    return df.filter(_is_hit(status, payload, ok))


def failed(df: DataFrame, status: str = "status", payload: str = "payload", ok: int = 200) -> DataFrame:
    """All other lookups, so that together with ``found`` no row is lost."""
    return df.filter(~_is_hit(status, payload, ok))
