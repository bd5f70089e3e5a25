"""Benchmark passages in documents, by Wu-Manber multi-pattern search.

Texts are brought to one form first: A-Z lowered, every other byte outside words a blank, one blank between
words and one at either end. A pattern is a window of ``window`` words of a benchmark item in that form,
with its blanks, so that a byte match is a match of whole words; an item with fewer words is one pattern.

The patterns of one class share a search length m (their shortest). A table over the hashes of B-byte
blocks tells how far the window of m bytes may move when it ends in a given block; where it may not move,
the bucket of the block's hash lists the patterns whose first m bytes end in that block, the first bytes of
each are compared, and then the whole pattern. Patterns much shorter than the others make a class of their
own, since they would shorten every move. A task searches many stretches of its text side by side with
numpy, one table lookup for all stretches at a time.

The benchmark goes to the tasks in blocks of bounded size (``block_bytes`` of item text); each block is
searched in all documents, and the hits of several blocks are joined by document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.bytes import binary_column, blocks, byte_class, mix
from basketlens.llm.columns import utf8

#: Fixed by the definition of a word: digits, letters a-z after lowering, and every byte from 0x80 on.
IS_WORD = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: What each byte becomes: lower case, a blank for what is in no word.
FORM = np.where(IS_WORD, np.arange(256), 0x20).astype(np.uint8)
FORM[0x41:0x5B] = np.arange(0x61, 0x7B)
FORM_TABLE = FORM.tobytes()
#: Longest block that moves are looked up by, and bits of the hash of a block.
BLOCK, HASH_BITS = 8, 20
#: Bytes that one search handles at a time, and side-by-side stretches that it is cut into.
SEARCH_BYTES, LANE_BYTES = 1 << 21, 512
BENCHMARK_BLOCK_BYTES = 4 << 20


def normal_form(text: bytes) -> bytes:
    words = text.translate(FORM_TABLE).split()
    return b" " + b" ".join(words) + b" " if words else b" "


def item_windows(text: bytes, window: int) -> list[bytes]:
    """The distinct patterns of an item."""
    words = text.translate(FORM_TABLE).split()
    if not words:
        return []
    ranges = range(max(len(words) - window, 0) + 1)
    return sorted({b" " + b" ".join(words[i : i + window]) + b" " for i in ranges})


class PatternClass:
    """Tables for patterns that share a search length."""

    def __init__(self, patterns: list[bytes], numbers: list[int]) -> None:
        self.m = m = min(map(len, patterns))
        self.block = b = min(BLOCK, m)
        heads = np.frombuffer(b"".join(p[:m] for p in patterns), np.uint8).reshape(len(patterns), m)
        self.shift = np.full(1 << HASH_BITS, m - b + 1, np.int32)
        for end in range(b, m + 1):  # later ends leave shorter moves
            np.minimum.at(self.shift, self.hash(heads, np.full(len(patterns), end), rows=True), m - end)
        suffix = self.hash(heads, np.full(len(patterns), m), rows=True)
        order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[order]
        self.patterns = [patterns[i] for i in order]
        self.numbers = np.array(numbers)[order]
        self.first = heads[order][:, : min(8, m)]
        self.lengths = np.array([len(p) for p in self.patterns])

    def hash(self, text: np.ndarray, ends: np.ndarray, rows: bool = False) -> np.ndarray:
        """Hash of the block of bytes before each end; with rows, text has a row for each end."""
        value = np.zeros(len(ends), np.uint64)
        at = np.arange(len(ends))
        for j in range(self.block):
            part = text[at, ends - 1 - j] if rows else text[ends - 1 - j]
            value |= part.astype(np.uint64) << np.uint64(8 * j)
        return (mix(value) >> np.uint64(64 - HASH_BITS)).astype(np.int64)

    def search(self, text: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Starts of occurrences in the text, and the pattern number of each."""
        lanes = np.arange(self.m, len(text) + 1, LANE_BYTES)
        stops = np.minimum(lanes + LANE_BYTES, len(text) + 1)
        ends, found = lanes, []
        while len(ends):
            move = self.shift[self.hash(text, ends)]
            hit = move == 0
            if hit.any():
                found.append(ends[hit])
            ends = ends + np.maximum(move, 1)
            left = ends < stops
            if not left.all():
                ends, stops = ends[left], stops[left]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends = np.concatenate(found)
        key = self.hash(text, ends)
        low, high = np.searchsorted(self.suffix, key, "left"), np.searchsorted(self.suffix, key, "right")
        count = high - low
        ends, low = np.repeat(ends, count), np.repeat(low, count)
        pattern = low + np.arange(len(low)) - np.repeat(np.cumsum(count) - count, count)
        starts = ends - self.m
        same = starts + self.lengths[pattern] <= len(text)
        starts, pattern = starts[same], pattern[same]
        same = np.ones(len(starts), bool)
        for j in range(self.first.shape[1]):
            same &= text[starts + j] == self.first[pattern, j]
        starts, pattern = starts[same], pattern[same]
        same = np.fromiter((raw.startswith(self.patterns[p], s) for s, p in zip(starts.tolist(), pattern.tolist(), strict=True)), bool, len(starts))
        return starts[same], self.numbers[pattern[same]]


def classes(patterns: list[bytes]) -> list[PatternClass]:
    """Classes of patterns by powers of two of their length."""
    groups: dict[int, list[int]] = {}
    for number, pattern in enumerate(patterns):
        groups.setdefault(min(len(pattern).bit_length(), 6), []).append(number)
    return [PatternClass([patterns[i] for i in own], own) for own in groups.values()]


class Searcher:
    """Finds the windows of some items in blocks of texts."""

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        owners: dict[bytes, set[str]] = {}
        for name, text in items:
            for pattern in item_windows(text, window):
                owners.setdefault(pattern, set()).add(name)
        self.patterns = sorted(owners)
        self.owned = [sorted(owners[p]) for p in self.patterns]
        self.lengths = np.array([p.count(b" ") - 1 for p in self.patterns], np.int64)
        self.tables: list[PatternClass] | None = None

    def find(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of words of each document; document, word and pattern of each occurrence, by document."""
        if self.tables is None:  # built in the task, not sent to it
            self.tables = classes(self.patterns)
        data = buf.tobytes()
        forms = [normal_form(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        raw = b"\n".join(forms)  # a line end is in no pattern
        text = np.frombuffer(raw, np.uint8)
        sizes = np.array([len(form) for form in forms])
        starts = np.cumsum(sizes + 1) - sizes - 1
        blanks = np.concatenate([[0], np.cumsum(text == 0x20)])
        counts = blanks[starts + sizes] - blanks[starts] - 1
        at, which = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for table in self.tables:
            one, two = table.search(text, raw)
            at, which = np.concatenate([at, one]), np.concatenate([which, two])
        doc = np.searchsorted(starts, at, "right") - 1
        order = np.argsort(doc, kind="stable")
        doc, at, which = doc[order], at[order], which[order]
        return counts, doc, blanks[at] - blanks[starts[doc]], which


HITS = "row bigint, n_words bigint, froms array<bigint>, tos array<bigint>, items array<string>"


def search_block(docs: DataFrame, items: list[tuple[str, bytes]], window: int) -> DataFrame:
    """Per document: number of words, ranges of hit words, ids of the items that occur.

    ``docs`` has ``row`` and ``text``, and may have ``mark``, which is handed through.
    """
    searcher = Searcher(items, window)
    marked = "mark" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, buf, offsets in blocks(binary_column(batch, "text"), SEARCH_BYTES):
                counts, doc, word, which = searcher.find(buf, offsets)
                cuts = np.searchsorted(doc, np.arange(high - low + 1)).tolist()
                froms, tos, found = [], [], []
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    froms.append(word[a:b])
                    tos.append(word[a:b] + searcher.lengths[which[a:b]])
                    found.append(sorted({name for w in set(which[a:b].tolist()) for name in searcher.owned[w]}))
                columns = [batch.column(0).slice(low, high - low), pa.array(counts, pa.int64()), pa.array(froms, pa.list_(pa.int64())),
                           pa.array(tos, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.string()))]
                names = ["row", "n_words", "froms", "tos", "items"]
                if marked:
                    columns.append(batch.column(2).slice(low, high - low))
                    names.append("mark")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, HITS + (", mark string" if marked else ""))


def covered(froms: list[int], tos: list[int]) -> int:
    """Number of words in the union of the ranges."""
    total, reached = 0, 0
    for low, high in sorted(zip(froms, tos, strict=True)):
        total += max(0, high - max(low, reached))
        reached = max(reached, high)
    return total


def _report(hits: DataFrame) -> DataFrame:
    """Counts and item digest of each row of hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            froms, tos, items = (batch.column(c).to_pylist() for c in (2, 3, 4))
            hit = [covered(low, high) for low, high in zip(froms, tos, strict=True)]
            digests = [hashlib.sha256(",".join(sorted(found)).encode()).hexdigest() for found in items]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hit, pa.int64()), pa.array([len(found) for found in items], pa.int64()), pa.array(digests, pa.string())],
                ["row", "n_words", "n_hit", "n_items", "items_sha256"],
            )

    return hits.mapInArrow(run, "row bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string")


def item_blocks(benchmark: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of bounded size, read to the driver a partition at a time; at least one block."""
    items = benchmark.select(F.col(f"`{key}`").cast("string").alias("name"), F.col(f"`{text}`").cast("binary").alias("body"))
    block, held = [], 0
    for row in items.where("name IS NOT NULL AND body IS NOT NULL").toLocalIterator():
        if block and held + len(row["body"]) > block_bytes:
            yield block
            block, held = [], 0
        block.append((row["name"], bytes(row["body"])))
        held += len(row["body"])
    yield block


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    window: int = 10, block_bytes: int = BENCHMARK_BLOCK_BYTES,
) -> DataFrame:
    """Find windows of benchmark items in whole documents.

    Returns one row per document row: the key, ``n_words``, ``n_hit`` (words inside any occurrence),
    ``n_items`` (ids of items with an occurring window), ``items_sha256`` (of those ids, sorted as strings
    and joined by commas) and ``contaminated`` (n_hit > 0). A null or blank text has no words. Items with
    null id or text, or without words, match nothing; of items with equal texts all count. Null and repeated
    keys are rows like any other. An empty benchmark hits nothing; extra columns are ignored.
    """
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("row"), F.col(f"`{text}`").cast("binary").alias("text"))
    hits, number = None, 0
    for block in item_blocks(benchmark, item_key, item_text, block_bytes):
        number += 1
        if number == 2:  # rows have to meet again: by key and text, so that repeated keys are kept apart
            rows = rows.withColumn("mark", F.sha2(utf8(F.col("text")), 256))
            hits = search_block(rows, first, window)
        found = search_block(rows, block, window)
        hits, first = (hits.unionByName(found), first) if number > 1 else (found, block)
    if number > 1:
        same = hits.groupBy("row", "mark").agg(
            F.first("n_words").alias("n_words"), (F.count("*") / number).cast("int").alias("copies"),
            *(F.flatten(F.collect_list(c)).alias(c) for c in ("froms", "tos")), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
        hits = same.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("row", "n_words", "froms", "tos", "items")
    return _report(hits).withColumnRenamed("row", key).withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    window: int = 10, block_bytes: int = BENCHMARK_BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with all their columns."""
    place = docs.columns.index(text)
    for block in item_blocks(benchmark, item_key, item_text, block_bytes):
        docs = docs.mapInArrow(_clean_rows(Searcher(block, window), place), docs.schema)
    return docs


def _clean_rows(searcher: Searcher, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(len(batch), bool)
            column = pa.RecordBatch.from_arrays([batch.column(place)], ["text"])
            for low, _, buf, offsets in blocks(binary_column(column, "text"), SEARCH_BYTES):
                clean[low + searcher.find(buf, offsets)[1]] = False
            yield batch.filter(pa.array(clean))

    return run


SQL = r"""
WITH words AS (
  SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
), parts AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark
), sizes AS (
  SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM parts WHERE len(w) > 0
), patterns AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM sizes
), lengths AS (SELECT DISTINCT n FROM patterns), starts AS (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM words, lengths WHERE len(w) >= n
), windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p FROM starts
), hits AS (
  SELECT doc_id, item_id, i, windows.n FROM windows JOIN patterns ON windows.p = patterns.p AND windows.n = patterns.n
), places AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at FROM hits), counted AS (
  SELECT doc_id, count(*) AS n_hit FROM places GROUP BY 1
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN counted USING (doc_id) LEFT JOIN named USING (doc_id)
"""
