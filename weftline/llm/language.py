"""Language identification (7): rank-order n-gram profiles and the out-of-place distance.

Training counts the n-grams (one to three characters, words padded with a blank) of all training texts, keeps
each language's `top` most frequent ones as a ranked profile and nothing else. A document's own `top` n-grams
are ranked in the same way; its distance to a profile is the sum, over its n-grams, of how far each is out of
place, `top` for those that the profile lacks. The nearest profile wins; the score is one minus the share of
the largest possible distance.

Cases: a text that is null or holds no letter is `und` with score 0; ties of counts go to the smaller n-gram,
ties of distance to the smaller language name; rows with a null lang teach nothing; without training rows all
documents are `und` with score 0; repeated rows are predicted each; an empty table gives
no rows; other columns are ignored by training and passed on by predict(), which drops columns of its own names;
very long texts are counted in chunks.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from weftline.llm.common import fold_of, tidied

TOP = 300
UND = "und"
#: A character takes 21 bits of an n-gram's code. The blank is 1, so codes of different lengths differ.
BITS, BLANK = 21, 1
#: Characters counted at a time; distinct n-grams that a task gathers before it hands them on.
CHUNK, GATHERED = 1 << 20, 1 << 21


@lru_cache
def _symbols() -> np.ndarray:
    """Code point -> itself if it is a letter, BLANK otherwise."""
    return np.fromiter((c if chr(c).isalpha() else BLANK for c in range(0x110000)), np.int64, 0x110000)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def letters(text: str) -> np.ndarray:
    """The lower-cased text's letters, each run of other characters as one blank, a blank at both ends."""
    x = _symbols()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    x = np.concatenate([[BLANK], x, [BLANK]])
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != BLANK) | (x[:-1] != BLANK)
    return x[keep]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes, ascending, and counts of a text's n-grams; a blank stands only at an end of one and never alone."""
    x = letters(text)
    got = []
    for a in range(0, len(x), CHUNK):
        y = x[a : a + CHUNK + 2]
        own = min(CHUNK, len(x) - a)
        one = y[:own]
        two = ((y[:-1] << BITS) | y[1:])[:own]
        three = ((y[:-2] << 2 * BITS) | (y[1:-1] << BITS) | y[2:])[:own]
        got.append(np.unique(np.concatenate([one[one != BLANK], two, three[y[1:-1][:own] != BLANK]]), return_counts=True))
    return got[0] if len(got) == 1 else merged(got)


def merged(got: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([c for c, _ in got]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([n for _, n in got]), len(codes)).astype(np.int64)


def ranked(codes: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The `top` codes by falling count; codes come ascending, so ties go to the smaller."""
    return codes[np.argsort(-counts, kind="stable")[:top]]


def train(docs: DataFrame, top: int = TOP) -> dict[str, list[int]]:
    """Ranked profile of each language of docs (text, lang). At most `top` rows a language reach the driver."""

    def count(batches):
        def rows(lang, codes, n):
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], names=["lang", "code", "n"])

        held: dict[str, list] = {}
        for batch in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, found in by.items():
                a = size = 0
                for b, text in enumerate(found, 1):
                    size += len(text)
                    if size >= CHUNK or b == len(found):
                        held.setdefault(lang, []).append(ngrams("\n".join(found[a:b])))
                        a, size = b, 0
                if len(held[lang]) >= 8:
                    held[lang] = [merged(held[lang])]
                    if len(held[lang][0][0]) >= GATHERED:
                        yield rows(lang, *held.pop(lang)[0])
        for lang, parts in held.items():
            yield rows(lang, *merged(parts))

    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = known.mapInArrow(tidied(count), "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    best = counts.withColumn("place", place).where(F.col("place") <= top)
    profiles: dict[str, list[int]] = {}
    for r in sorted(best.collect(), key=lambda r: (r["lang"], r["place"])):
        profiles.setdefault(r["lang"], []).append(r["code"])
    return profiles


class Judge:
    """Distances of documents to all profiles at once."""

    def __init__(self, profiles: dict[str, list[int]], top: int = TOP):
        self.langs, self.top = sorted(profiles), top
        self.codes = np.unique(np.array([c for p in profiles.values() for c in p], np.int64))
        self.place = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int64)  # the last row: in no profile
        for k, lang in enumerate(self.langs):
            self.place[np.searchsorted(self.codes, profiles[lang]), k] = np.arange(len(profiles[lang]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs or not has_letter(text):
            return UND, 0.0
        own = ranked(*ngrams(text), self.top)
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        place = self.place[np.where(self.codes[at] == own, at, len(self.codes))]
        far = np.where(place < 0, self.top, np.abs(place - np.arange(len(own))[:, None])).sum(axis=0)
        k = int(far.argmin())
        return self.langs[k], 1.0 - float(far[k]) / (self.top * len(own))


def predict(docs: DataFrame, profiles: dict[str, list[int]], top: int = TOP) -> DataFrame:
    """docs with lang_pred and score (in place of columns of these names), row by row; no shuffle."""
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def judge(batches):
        by = Judge(shared.value, top)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                said = [by(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x for x, _ in said], pa.string()), pa.array([x for _, x in said], pa.float64())], names=[*part.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(tidied(judge), StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    fold = fold_of(F.col("doc_id"), 5)
    profiles = train(docs.where(fold != 0))
    return predict(docs.select("doc_id", "text"), profiles).select("doc_id", (fold == 0).alias("held_out"), "lang_pred", "score")
