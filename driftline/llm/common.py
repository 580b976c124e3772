"""What the text operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than the six ASCII white spaces.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
HOT_PARTS = 1024


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: str | None) -> list[bytes]:
    """The words as UTF-8. `bytes.split` parts at exactly the six ASCII white spaces."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them as far as columns of the input have them already."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
    return found


def identity(text: str) -> tuple[Column, Column]:
    """128 bits that tell a text from any other, as two longs; null counts as empty."""
    return F.xxhash64(text_or_empty(text)), F.xxhash64(F.lit("second"), text_or_empty(text))


def fold(doc_id: str, folds: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(folds))


def attach(rows: DataFrame, groups: DataFrame, keys: Sequence[str], members: str, total: int, most: int | None = None) -> DataFrame:
    """Rows joined with the one row that `groups` has for their key, hot keys included.

    `members` counts a group's rows, which sum up to `total` at most. Groups above a 1024th of
    that are therefore fewer than 1024: they are broadcast, and their rows never meet in one
    task. All other groups are joined by a shuffle. `groups` should be stored, since it is first asked for the largest group, unless `most` tells it;
    if that is not above the limit, one plain join is all, else both inputs are read twice.
    """
    limit = max(1000, total // HOT_PARTS)
    if most is None:
        most = groups.agg(F.max(members)).first()[0]
    if most is None or most <= limit:
        return rows.join(groups, list(keys))
    (flag,) = unused(rows, "_hot")
    hot = groups.filter(F.col(members) > limit).withColumn(flag, F.lit(True))
    marked = rows.join(F.broadcast(hot), list(keys), "left")
    rest = marked.filter(F.col(flag).isNull()).select(*rows.columns)
    cold = rest.join(groups.filter(F.col(members) <= limit), list(keys))
    return marked.filter(flag).drop(flag).unionByName(cold)

