"""Best-fit packing of tokenized documents into sequences, in bulk-synchronous rounds.

1. One pass tokenizes whole texts and cuts documents that are longer than a sequence into pieces. From then
   on only the narrow table of pieces moves.
2. Pieces of one length are interchangeable, so they are told apart by rank: rows are numbered inside
   (length, salt) and the salts are stacked by their counts, so no task numbers a whole length.
3. Rounds match pieces and gaps. In a round, lengths and gaps are in sorted order and a sweep gives every
   length, longest first, its successors among the gaps (the tightest gaps that hold it). Where more pieces
   than gaps meet, the lower ranks win and the others go on to the next gap. All gaps are updated, and the
   next round begins; when nothing fits any more, new sequences are opened. What a sweep handles are
   stretches of ranks (at most one class per token count, so its size does not grow with the input).
4. The matches are stretches too: (length, ranks from, to) -> (sequences from, offset). Every piece finds
   its own by length and rank in one join with that bounded table.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.tables import keep

CAPACITY, END_ID = 1024, 2
#: Rows of one (length, salt) that a task numbers, about.
SALT_ROWS = 250_000
#: Texts whose pieces a task remembers, for copies.
REMEMBERED = 20_000


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: the first takes the remainder, the others are full."""
    if total <= capacity:
        return [total]
    rest = total % capacity
    return ([rest] if rest else []) + [capacity] * (total // capacity)


def added_tokens(json_path: str) -> dict[str, int]:
    """The added tokens of a tokenizer file, which stand for one id wherever a text holds their string."""
    with open(json_path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
            raise ValueError(f"added token {token['content']!r} is not matched as it stands")
    return {token["content"]: token["id"] for token in added}


def pieces(docs: DataFrame, ranks_path: str, pattern: str, capacity: int, end_id: int, special: dict[str, int]) -> DataFrame:
    """(id, piece, start, length, crc) of every document, tokenized by a byte-level BPE rank file and added tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        known: dict[bytes, list[tuple[int, int, int]]] = {}
        for batch in batches:
            ids, out = batch.column(0), []
            take = []
            for row, text in enumerate(batch.column(1)):
                body = text.as_py() or ""
                mark = hashlib.blake2b(body.encode(), digest_size=16).digest()
                found = known.get(mark)
                if found is None:
                    tokens = np.append(np.array(encoding.encode(body, allowed_special="all"), "<u4"), np.uint32(end_id)).astype("<u4")
                    found, start = [], 0
                    for length in cut_lengths(len(tokens), capacity):
                        found.append((start, length, zlib.crc32(tokens[start : start + length].tobytes())))
                        start += length
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[mark] = found
                take += [row] * len(found)
                out += [(number, *piece) for number, piece in enumerate(found)]
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            typed = [pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(take, pa.int32())), *typed], ["id", "piece", "start", "length", "crc"])

    return docs.mapInArrow(run, "id bigint, piece int, start bigint, length bigint, crc bigint")


def match_rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Matches (length, rank from, rank to, first sequence, offset) for so many pieces of each length."""
    left = dict(counts)  # pieces not placed yet; their ranks are the last ones
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> stretches of sequences
    plan, opened = [], 0

    def place(length: int, first: int, number: int, gap: int, into: dict[int, list[tuple[int, int]]]) -> None:
        low = counts[length] - left[length]
        plan.append((length, low, low + number, first, capacity - gap))
        left[length] -= number
        if not left[length]:
            del left[length]
        if gap > length:
            into.setdefault(gap - length, []).append((first, first + number))

    while left:
        updated: dict[int, list[tuple[int, int]]] = {}
        sizes, matched = sorted(gaps), False
        for length in sorted(left, reverse=True):
            while length in left and sizes and sizes[-1] >= length:
                low, high = 0, len(sizes)
                while low < high:  # the successor of the length among the gaps
                    middle = (low + high) // 2
                    low, high = (middle + 1, high) if sizes[middle] < length else (low, middle)
                gap = sizes[low]
                first, end = gaps[gap].pop()
                number = min(left[length], end - first)
                if number < end - first:
                    gaps[gap].append((first + number, end))
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(low)
                place(length, first, number, gap, updated)
                matched = True
        for gap, stretches in updated.items():
            gaps.setdefault(gap, []).extend(stretches)
        if not matched and left:
            room = -(-sum(length * n for length, n in left.items()) // capacity)
            for length in sorted(left, reverse=True):
                number = min(room, left[length])
                place(length, opened, number, capacity, gaps)
                opened, room = opened + number, room - number
                if not room:
                    break
    return plan


def ranked(table: DataFrame, rows: int) -> DataFrame:
    """The pieces with ``rank``, 0, 1, ... among those of their length."""
    salted = table.withColumn("salt", F.pmod(F.xxhash64("id", "piece"), F.lit(max(8, rows // SALT_ROWS))))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    stacked = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece")) - 1
    return salted.withColumn("inside", inside).join(stacked, ["length", "salt"]).withColumn("rank", F.col("inside") + F.col("before")).drop("salt", "inside", "before")


def pack(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
    special: dict[str, int] | None = None,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    A document's tokens are those of its whole text and then ``end_id``; a null text is empty and so has one
    token. The strings in ``special`` (``added_tokens`` of the vocabulary) have the one id given there, and
    are ordinary text if it is left out, as a rank file does not hold them. Only documents of more than ``capacity`` tokens are cut. Returns one row per piece: the key,
    ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``. Rows with null or repeated
    keys are documents like any other. An empty table gives an empty result; extra columns are ignored.
    """
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    table = keep(pieces(rows, ranks_path, pattern, capacity, end_id, special or {}), "pieces")
    counts = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}  # a row per token count at most
    plan = match_rounds(counts, capacity)
    spark = docs.sparkSession
    matches = spark.createDataFrame(plan, "length bigint, low bigint, high bigint, first bigint, offset bigint")
    met = ranked(table, sum(counts.values())).join(F.broadcast(matches), "length").where("rank >= low AND rank < high")
    return met.select(
        F.col("id").alias(key), "piece", "start", "length", F.col("crc").alias("ids_crc32"), (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset"
    )
