"""Exact duplicates by two passes over a Bloom filter of text hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.bitmaps import MAX_BITS, bits_for, packed, position, with_maybe
from driftline.llm.common import attach, text_or_empty
from driftline.session import stored

def repeated_filter(narrow: DataFrame, bits: int) -> DataFrame:
    """The second filter: positions that the first filter had set already when a row came.

    Each task combines its positions before the exchange, and what is sent is one long per
    position, not texts or digests. The result has `bits` / 32768 bitmaps of 4 KB at most.
    """
    seen = narrow.groupBy(position(F.col("h"), bits).alias("position")).agg(F.count(F.lit(1)).alias("times"))
    return packed(seen.filter("times > 1"))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, bits_per_row: int = 32, max_bits: int = MAX_BITS
) -> DataFrame:
    """For each row: the copy that stays, the size of its group, whether it stays, the digest.

    Pass one puts text hashes into a Bloom filter and those that were in it already into a
    second one. Pass two looks each row up in the second filter: rows that are not in it have no
    copy and pass through as they are; only the others are grouped by SHA-256. The filter
    has no false negatives, so no copy is missed, and false positives come out as groups of one.
    It has `bits_per_row` bits a row, up to `max_bits` (64 MB, which is broadcast); past that
    it fills up and more rows take part in the grouping, with the same result.

    Null text counts as empty. Of equal texts the largest id stays, a null id being the smallest;
    among rows equal in both one stays. Other columns of the input are not looked at.
    """
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.sha2(text_or_empty(text_col), 256).alias("text_sha256"),
        F.monotonically_increasing_id().alias("row"),
    )
    narrow = stored(narrow.withColumn("h", F.xxhash64("text_sha256")), "digests")
    total = narrow.count()
    bits = bits_for(total, bits_per_row, max_bits)
    looked = with_maybe(narrow, "h", stored(repeated_filter(narrow, bits), "filter"), bits)
    single = looked.filter("NOT maybe").withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    maybe = looked.filter("maybe").select("doc_id", "text_sha256", "row")
    groups = stored(
        maybe.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")), "groups"
    )
    grouped = attach(maybe, groups, ["text_sha256"], "group_size", total)
    grouped = grouped.withColumns({"keep_id": F.col("keep.doc_id"), "kept": F.col("row") == F.col("keep.row")})
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return single.select(*columns).unionByName(grouped.select(*columns))
