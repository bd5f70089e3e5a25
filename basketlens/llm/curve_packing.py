"""Packing along a space-filling curve: neighbours in a sequence are neighbours in content.

1. One pass tokenizes whole texts. A document's tokens are hashed into a vector of ``BUCKETS`` places,
   each held or not, which is projected to ``AXES`` numbers by fixed random directions; the place of that point on a Hilbert
   curve is the document's key. Documents with much the same tokens get keys that are near each other.
2. Full runs of ``capacity`` tokens from a document's start are sequences of their own. What is left over, less
   than a sequence, goes onto the curve: the narrow rows (key, tokens left) are range-sorted and summed up
   along the curve, so every rest knows its place in one long stream.
3. The stream is cut every ``capacity`` tokens, so no sequence has padding but the last, and that one is
   cut at powers of two, which need none.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.bytes import mix
from basketlens.llm.runs import running
from basketlens.llm.tables import keep

CAPACITY, END_ID = 1024, 0
BUCKETS, AXES, BITS = 4096, 4, 15
#: Projections lie in -REACH to REACH, but for one in some ten thousand, which go to the border.
REACH = 4.0
#: Texts whose tokens a task remembers, for copies.
REMEMBERED = 20_000


def directions() -> np.ndarray:
    """A fixed normal number for each bucket and axis."""
    unit = (mix(np.arange(2 * BUCKETS * AXES, dtype=np.uint64) + np.uint64(0xC04E)) >> np.uint64(11)).astype(np.float64) / 2.0**53
    one, two = unit.reshape(2, BUCKETS, AXES)
    return np.sqrt(-2 * np.log(1 - one)) * np.cos(2 * np.pi * two)


def buckets_of(ids: int) -> np.ndarray:
    """The bucket of each token id below ``ids``."""
    return (mix(np.arange(ids, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)


def point(ids: np.ndarray, buckets: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """The projection of a document's hashed tokens, each counted once, to ``AXES`` numbers of unit spread."""
    held = np.zeros(BUCKETS, bool)
    held[buckets[ids]] = True
    return axes[held].sum(axis=0) / np.sqrt(held.sum())


def on_grid(points: np.ndarray) -> np.ndarray:
    """Points as whole numbers of ``BITS`` bits."""
    return np.clip((points + REACH) / (2 * REACH) * 2**BITS, 0, 2**BITS - 1).astype(np.int64)


def hilbert(points: np.ndarray) -> np.ndarray:
    """Places on the Hilbert curve of points (rows) of ``BITS`` bits on each axis.

    From the highest bit to the lowest, each axis with the bit set turns the lower bits of the first axis
    around, and each without it swaps them with the axis's own; Gray-decoding the bits gives the place.
    """
    x = points.astype(np.int64).T.copy()
    axes = len(x)
    for bit in range(BITS - 1, 0, -1):
        lower = (1 << bit) - 1
        for a in range(axes):
            is_set = (x[a] >> bit) & 1 == 1
            swapped = np.where(is_set, 0, (x[0] ^ x[a]) & lower)
            x[0] ^= np.where(is_set, lower, swapped)
            x[a] ^= swapped
    for a in range(1, axes):
        x[a] ^= x[a - 1]
    turned = np.zeros_like(x[0])
    for bit in range(BITS - 1, 0, -1):
        turned ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= turned
    place = np.zeros_like(x[0])
    for bit in range(BITS - 1, -1, -1):
        for a in range(axes):
            place = place << 1 | (x[a] >> bit) & 1
    return place


def tokenized(docs: DataFrame, ranks_path: str, pattern: str, capacity: int, end_id: int, special: dict[str, int]) -> DataFrame:
    """(id, row, place, tokens, crcs, rest, full, rest_ids) of every document.

    ``row`` is unique, ``place`` lies on the curve, ``crcs`` belong to the ``full`` runs of ``capacity`` tokens from
    the start, and the ``rest`` tokens after them are in ``rest_ids``, as 32-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        from pyspark import TaskContext

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("curve", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        axes, buckets = directions(), buckets_of(max([end_id, *ranks.values(), *special.values()]) + 1)
        known: dict[bytes, tuple] = {}
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for text in batch.column(1):
                body = text.as_py() or ""
                mark = hashlib.blake2b(body.encode(), digest_size=16).digest()
                found = known.get(mark)
                if found is None:
                    ids = np.append(np.array(encoding.encode(body, allowed_special="all"), "<u4"), np.uint32(end_id)).astype("<u4")
                    full = len(ids) // capacity
                    crcs = [zlib.crc32(ids[i * capacity : (i + 1) * capacity].tobytes()) for i in range(full)]
                    rest = ids[full * capacity :]
                    found = (point(ids, buckets, axes), len(ids), crcs, rest.tobytes())
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[mark] = found
                out.append(found)
            size = len(out)
            lengths = np.array([f[1] for f in out], np.int64)
            places = hilbert(on_grid(np.array([f[0] for f in out], np.float64).reshape(size, AXES)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.arange(row, row + size)), pa.array(places), pa.array(lengths), pa.array([f[2] for f in out], pa.list_(pa.int64())),
                 pa.array(lengths % capacity), pa.array(lengths // capacity), pa.array([f[3] for f in out], pa.binary())],
                ["id", "row", "place", "tokens", "crcs", "rest", "full", "rest_ids"],
            )
            row += size

    return docs.mapInArrow(run, "id bigint, row bigint, place bigint, tokens bigint, crcs array<bigint>, rest bigint, full bigint, rest_ids binary")


def stream_cuts(start: int, length: int, total: int, capacity: int) -> list[tuple[int, int, int]]:
    """(sequence, offset, length) of the parts of a stretch of the stream of ``total`` tokens.

    Sequences hold ``capacity`` tokens; those after the last full one hold the powers of two that add up to the rest.
    """
    cuts, whole = [], total // capacity
    while length:
        if start < whole * capacity:
            sequence, offset = divmod(start, capacity)
            room = capacity - offset
        else:
            sequence, low, left = whole, whole * capacity, total % capacity
            while (size := 1 << left.bit_length() - 1) + low <= start:
                sequence, low, left = sequence + 1, low + size, left - size
            offset, room = start - low, size - (start - low)
        part = min(length, room)
        cuts.append((sequence, offset, part))
        start, length = start + part, length - part
    return cuts


def pack_along_curve(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
    special: dict[str, int] | None = None,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens, along a curve through their contents.

    A document's tokens are those of its whole text and then ``end_id``; a null text is empty. The strings in
    ``special`` have the one id given there. Returns a row per piece: the key, ``start`` (tokens of the document
    before it), ``length``, ``ids_crc32`` (of its ids as little-endian 32-bit numbers), ``doc_tokens``,
    ``sequence_id`` and ``offset``. Every sequence is full or holds a power of two of tokens. Copies of a text
    lie side by side, by key; rows with null or repeated keys are documents like any other, an empty
    table gives an empty result, and extra columns are ignored.
    """
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    table = keep(tokenized(rows, ranks_path, pattern, capacity, end_id, special or {}), "tokens")
    curve = table.select(F.lit(0).cast("bigint").alias("curve"), "id", "row", "place", "rest", "full")
    placed = running(curve, "curve", [F.col("place"), F.col("id").asc_nulls_first(), F.col("row")], ["rest", "full"])
    placed = placed.select(F.col("row").alias("at"), "before_rest", "before_full")
    total = table.agg(F.sum("rest")).first()[0] or 0
    opened = total // capacity + (total % capacity).bit_count()  # sequences of the stream; those of full runs are numbered after them

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tokens, crcs, before_rest, before_full = (batch.column(n).to_pylist() for n in ("id", "tokens", "crcs", "before_rest", "before_full"))
            out = []
            for i, rest in enumerate(batch.column("rest_ids")):
                for number, crc in enumerate(crcs[i]):
                    out.append((ids[i], number * capacity, capacity, crc, tokens[i], opened + before_full[i] + number, 0))
                left = np.frombuffer(rest.as_buffer(), "<u4")
                done = 0
                for sequence, offset, part in stream_cuts(before_rest[i], len(left), total, capacity):
                    crc = zlib.crc32(left[done : done + part].tobytes())
                    out.append((ids[i], len(crcs[i]) * capacity + done, part, crc, tokens[i], sequence, offset))
                    done += part
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    met = table.join(placed, table["row"] == placed["at"]).select("id", "tokens", "crcs", "rest_ids", "before_rest", "before_full")
    return met.mapInArrow(run, ", ".join(f"{n} bigint" for n in names)).withColumnRenamed("id", key)
