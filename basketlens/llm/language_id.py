"""Language of texts by n-gram filters with a bit per language.

The filter is a Bloom filter sliced by bits: each slot is a mask with one bit per language, and the masks of
an n-gram's slots, ANDed, name all languages that hold it, in one lookup for any number of languages. A
document's masks are counted per language. A language whose slice is full to the share f answers by chance
with probability f ** k; its count is corrected by that, and the largest corrected share decides.

N-grams are four bytes of the text with A-Z lowered and digits and signs turned to blanks, so they hold word
boundaries and need no alphabet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.bytes import binary_column, blocks, byte_class, mix

LETTER = byte_class((0x61, 0x7A), (0x80, 0xFF))
FORM = np.where(LETTER, np.arange(256), 0x20).astype(np.uint64)
FORM[0x41:0x5B] = np.arange(0x61, 0x7B)
N = 4
#: Hashes per n-gram, bits of a slot number.
HASHES, SLOT_BITS = 3, 20
#: Documents per language that the model is learned from, about, and n-grams kept per language.
SAMPLE_DOCS, KEPT_GRAMS = 500, 30_000


def grams(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a block with letters in them, and the place among them where each document begins."""
    sizes = np.diff(offsets) + 2
    starts = np.cumsum(sizes) - sizes
    form = np.full(int(sizes.sum()), 0x20, np.uint64)
    inner = np.ones(len(form), bool)
    inner[starts] = inner[starts + sizes - 1] = False
    form[inner] = FORM[buf]
    n = max(len(form) - N + 1, 0)
    value = np.zeros(n, np.uint64)
    for j in range(N):
        value |= form[j : j + n] << np.uint64(8 * j)
    good = np.ones(n, bool)
    for j in range(1, N):  # n-grams that run into the next document
        last = starts[1:] - j
        good[last[(last >= 0) & (last < n)]] = False
    good &= value != np.uint64(0x20202020)
    places = np.concatenate([[0], np.cumsum(good)])
    return value[good], places[np.minimum(np.append(starts, len(form)), n)]


def slots(values: np.ndarray) -> list[np.ndarray]:
    mixed = mix(values)
    mask = np.uint64((1 << SLOT_BITS) - 1)
    return [((mixed >> np.uint64(SLOT_BITS * h)) & mask).astype(np.int64) for h in range(HASHES)]


class Filter:
    """Masks of languages by slot, and each language's chance of a false answer."""

    def __init__(self, languages: list[str], held: dict[str, np.ndarray]) -> None:
        self.languages = languages
        self.masks = np.zeros((-(-max(len(languages), 1) // 64), 1 << SLOT_BITS), np.uint64)
        self.chance = np.zeros(len(languages))
        for number, language in enumerate(languages):
            bit = np.uint64(1) << np.uint64(number % 64)
            for at in slots(held[language]):
                self.masks[number // 64][at] |= bit
            full = np.count_nonzero(self.masks[number // 64] & bit) / (1 << SLOT_BITS)
            self.chance[number] = full**HASHES

    def shares(self, values: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Per document and language, the corrected share of n-grams that the language holds."""
        at = slots(values)
        total = np.diff(places)
        out = np.zeros((len(total), len(self.languages)))
        for word in range(len(self.masks)):
            mask = self.masks[word][at[0]]
            for other in at[1:]:
                mask &= self.masks[word][other]
            for number in range(64 * word, min(64 * word + 64, len(self.languages))):
                sums = np.concatenate([[0], np.cumsum((mask >> np.uint64(number % 64)) & np.uint64(1))]).astype(np.int64)
                seen = np.diff(sums[places]) / np.maximum(total, 1)
                out[:, number] = np.clip((seen - self.chance[number]) / (1 - self.chance[number]), 0, 1)
        return out


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS, kept_grams: int = KEPT_GRAMS) -> Filter:
    """Filter of the most frequent n-grams of each language in a sample of its documents.

    About ``sample_docs`` documents per language are drawn by a hash of their key; their texts are read
    whole. Rows without language or text teach nothing. Without any, the filter has no language.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    chance = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(101)), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.join(F.broadcast(sizes), "lang").where(chance * F.col("n") < sample_docs).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for low, high, buf, offsets in blocks(binary_column(batch, "text")):
                values, places = grams(buf, offsets)
                for language in sorted(set(names[low:high])):
                    own = [values[places[i - low] : places[i - low + 1]] for i in range(low, high) if names[i] == language]
                    found, counts = np.unique(np.concatenate(own), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([language] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(counts, pa.int64())], ["lang", "gram", "n"]
                    )

    counted = drawn.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    held: dict[str, list[int]] = {r["lang"]: [] for r in sizes.collect()}
    for r in counted.withColumn("place", place).where(F.col("place") <= kept_grams).collect():  # kept_grams per language at most
        held[r["lang"]].append(r["gram"])
    return Filter(sorted(held), {language: np.array(found, np.uint64) for language, found in held.items()})


def identify(docs: DataFrame, model: Filter, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Language and score (corrected share of the text's n-grams) of every row's whole text.

    Returns the key, ``lang_pred`` and ``score``. Null texts and texts without a letter are ``und`` with
    score 0, and so is everything under a filter without languages. Ties go to the first language by name.
    Null and repeated keys are rows like any other; extra columns are ignored.
    """
    column = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{key}`").alias(key), column.cast("binary").alias("text"), F.coalesce(column.rlike(r"\p{L}"), F.lit(False)).alias("lettered"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = np.array(batch.column(2).to_pylist(), bool)
            for low, high, buf, offsets in blocks(binary_column(batch, "text")):
                own = lettered[low:high]
                if model.languages:
                    shares = model.shares(*grams(buf, offsets))
                    best = shares.argmax(axis=1)
                    names = [model.languages[b] if known else "und" for b, known in zip(best.tolist(), own.tolist(), strict=True)]
                    score = np.where(own, shares.max(axis=1), 0.0)
                else:
                    names, score = ["und"] * (high - low), np.zeros(high - low)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(names, pa.string()), pa.array(score)], [key, "lang_pred", "score"])

    return rows.mapInArrow(run, f"`{key}` {dict(rows.dtypes)[key]}, lang_pred string, score double")
