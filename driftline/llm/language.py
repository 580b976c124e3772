"""Language identification with hyperdimensional profiles of letter sequences."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE, GRAM = 512, 3
UNKNOWN = "und"
SHARPNESS = 25.0
TABLE_ROWS = 20_000


def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


class Encoder:
    """Texts to bundled vectors; one per task, which keeps the vectors of sequences it has seen."""

    def __init__(self) -> None:
        self.letters = _letters()
        self.keys = np.zeros(0, np.int64)
        self.places = np.zeros(0, np.int64)
        self.table = np.empty((TABLE_ROWS, SIZE), np.float32)
        self.points: dict[int, np.ndarray] = {}

    def letter(self, point: int) -> np.ndarray:
        """The random vector of +1 and -1 that stands for a letter, or for what lies between words."""
        if point not in self.points:
            self.points[point] = np.random.default_rng(point).choice(np.array([-1, 1], np.int8), SIZE)
        return self.points[point]

    def bound(self, key: int) -> np.ndarray:
        """A sequence's vector: its letters' vectors, each permuted by its place, multiplied."""
        vector = np.ones(SIZE, np.int8)
        for place in range(GRAM):
            point = (key >> (21 * (GRAM - 1 - place))) & 0x1FFFFF
            vector = vector * np.roll(self.letter(point), GRAM - 1 - place)
        return vector.astype(np.float32)

    def sequences(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """The distinct letter sequences with their counts, or None without a letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        is_letter = self.letters[points]
        if not is_letter.any():
            return None
        points = np.concatenate(([0], np.where(is_letter, points, 0), [0]))
        # One gap between words, however wide.
        points = points[(points != 0) | (np.concatenate(([1], points[:-1])) != 0)]
        keys = points[:-2] << 42 | points[1:-1] << 21 | points[2:]
        return np.unique(keys, return_counts=True)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        if not known.all():
            fresh = keys[~known]
            if len(self.keys) + len(fresh) > TABLE_ROWS:
                self.keys, self.places, fresh = np.zeros(0, np.int64), np.zeros(0, np.int64), keys
            used = len(self.keys)
            for i, key in enumerate(fresh.tolist()):
                self.table[used + i] = self.bound(key)
            merged = np.concatenate((self.keys, fresh))
            order = np.argsort(merged)
            self.keys = merged[order]
            self.places = np.concatenate((self.places, np.arange(used, used + len(fresh))))[order]
            at = np.searchsorted(self.keys, keys)
        return self.table[self.places[at]]

    def __call__(self, text: str | None) -> np.ndarray | None:
        """The text's sequences bundled, each weighing its count; None without a letter."""
        found = self.sequences(text or "")
        if found is None:
            return None
        keys, counts = found
        total = np.zeros(SIZE, np.float64)
        for begin in range(0, len(keys), 4096):
            total += counts[begin : begin + 4096].astype(np.float32) @ self.rows(keys[begin : begin + 4096])
        return total


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """A prototype per language: the signs of its documents' vectors bundled, without what all languages share.

    Sums are of whole numbers, so their order does not matter. One row per language reaches the driver.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sums = Encoder(), {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang"), strict=True):
                vector = encode(text.as_py())
                if vector is not None:
                    sums.setdefault(lang.as_py(), np.zeros(SIZE, np.int64))
                    sums[lang.as_py()] += np.sign(vector).astype(np.int64)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * SIZE), pa.array(np.arange(SIZE, dtype=np.int32)), pa.array(total)], names=["lang", "place", "value"]
            )

    given = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("lang IS NOT NULL")
    parts = given.mapInArrow(work, "lang string, place int, value long")
    rows = parts.groupBy("lang", "place").agg(F.sum("value").alias("value")).groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("place", "value"))).alias("vector")
    ).orderBy("lang").collect()
    units = {r["lang"]: np.array([v["value"] for v in r["vector"]], np.float64) for r in rows}
    units = {k: v / max(1e-9, np.linalg.norm(v)) for k, v in units.items()}
    if len(units) > 1:
        middle = sum(units.values()) / len(units)
        units = {k: (v - middle) / max(1e-9, np.linalg.norm(v - middle)) for k, v in units.items()}
    return units


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """The input's other columns, with `lang_pred` and `score` in place of the text.

    The language whose prototype has the largest cosine with the document's vector; the score is that language's
    share among the cosines' sharpened exponentials. Without a letter, or with nothing learned: `und`, 0. Null and empty texts have
    no letter; very long texts are read whole; repeated rows have equal results. Input columns of the two names are replaced. An
    empty table gives no rows.
    """
    others = [c for c in docs.columns if c not in (text_col, "lang_pred", "score")]
    schema = docs.select(*others, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] for n in names]).reshape(-1, SIZE)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder()
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(text_col):
                vector = encode(text.as_py()) if names else None
                if vector is None:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosines = matrix @ vector / max(1e-9, float(np.linalg.norm(vector)))
                shares = np.exp(SHARPNESS * (cosines - cosines.max()))
                langs.append(names[int(cosines.argmax())])
                scores.append(float(shares.max() / shares.sum()))
            columns = [*[batch.column(c) for c in others], pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, "lang_pred", "score"])

    return docs.mapInArrow(work, schema)


def bounded_sample(docs: DataFrame, id_col: str, lang_col: str, most: int) -> DataFrame:
    """About `most` rows of each language at most, by a hash of the id: all rows where there are fewer.

    The rows counted first are one per language.
    """
    counts = docs.groupBy(lang_col).count().filter(F.col("count") > most).collect()
    keep: Column = F.lit(True)
    for r in counts:
        drawn = F.pmod(F.xxhash64(F.col(id_col), F.lit("language")), F.lit(1 << 30)) < int((1 << 30) * most / r["count"])
        keep = F.when(F.col(lang_col) == r[lang_col], drawn).otherwise(keep)
    return docs.filter(keep)
