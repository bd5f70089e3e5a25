"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidate links.

* A document's set is its distinct shingles of ``words`` consecutive words. Shingles are hashed once;
  the top bits of a hash choose a bin and each bin keeps its smallest hash (one permutation). An empty
  bin copies the value of the first full bin in a fixed random order of its own (optimal densification),
  so that small sets collide with the same probability as large ones.
* ``bands`` bands of ``rows`` bins each are the bucket keys. At a similarity of 0.85, 32 bands of 8 miss
  a pair with probability 4e-5, and at 0.8, 64 bands of 8 with 8e-6; the pairs that they find are confirmed on the full sets.
* One bit of each bin makes a bit sketch. Pairs whose sketches differ in more bits than the similarity explains
  by six standard deviations are not worth a comparison of full sets. Small sets fill few bins and the
  others copy these, so the deviation goes by the bins that a set fills (``most_different``).
* An odd sketch has a bit for each of 512 places, the parity of the set's shingles there. A shingle
  that only one of two sets holds changes one bit, so sketches differ in at most as many bits as the sets do
  in shingles, and the similarity bounds that. This drops no link and tells small sets apart best, which have few
  bins to go by: documents that have no more than a passage in common never meet beyond the bucket.
* Documents with equal sets are folded to one row first.
* In a bucket, every member is paired with a centre only. A first round with the first ``OPENING`` bands
  connects large groups, so that most of their buckets in the other bands hold one component and drop out
  before they are joined. A bucket whose members are not all in one component gets more centres,
  ``GROWTH`` times as many in each round, until each of its pairs has been compared or lies in one component. No pair
  is compared twice. So no link that a bucket holds is lost, and pairs inside a group that is already
  connected are never made.
* Tables of the rounds are deleted as soon as nothing reads them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm.bytes import SpanHasher, binary_column, blocks, byte_class, constants, mix, word_spans
from basketlens.llm.components import components
from basketlens.llm.tables import discard, keep

#: Fixed by the definition of a word: neither a blank nor the control characters 9 to 13.
IS_WORD = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Bytes of a shingle hash that are kept for the exact comparison of two sets.
KEPT_BYTES = 6
#: Bins of a signature; the bands use the first ones, the bit sketch all of them. A power of two.
BINS = 512
SKETCH = [f"s{i}" for i in range(BINS // 64)]
#: Words of the odd sketch.
ODD = [f"o{i}" for i in range(8)]
#: Bands of the first round.
OPENING = 8
#: Times as many centres a bucket gets in each further round.
GROWTH = 64
#: Ids that may be broadcast, after a count.
BROADCAST_IDS = 1_000_000
#: Below so many full bins, all of them are ranked for each empty bin; above, the order is walked.
FEW_BINS = 48


def shingle_hashes(hasher: SpanHasher, buf: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The distinct shingles of each document of a block, as sorted 64-bit hashes."""
    starts, ends, first = word_spans(buf, offsets, IS_WORD)
    hasher.read(buf)
    hashed = hasher.spans(starts, ends)
    turns = constants(words, 23)
    n = max(len(hashed) - words + 1, 0)
    joined = np.zeros(n, np.uint64)
    for j in range(words):
        joined += hashed[j : j + n] * turns[j]
    joined = mix(joined)
    found = []
    for low, high in zip(first[:-1], first[1:], strict=True):
        if high - low >= words:
            found.append(np.unique(joined[low : high - words + 1]))
        elif high > low:  # fewer words: the whole sequence, told apart from shingles by its length
            found.append(mix((hashed[low:high] * turns[: high - low]).sum(keepdims=True) + np.uint64(high - low)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def bin_orders(bins: int) -> tuple[np.ndarray, np.ndarray]:
    """For each bin the order in which it asks the others, and the place of each other bin in that order."""
    places = mix(np.arange(bins * bins, dtype=np.uint64) + np.uint64(0x5EED)).reshape(bins, bins)
    order = np.argsort(places, axis=1).astype(np.int32)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(bins, dtype=np.int32)[None, :].repeat(bins, 0), axis=1)
    return order, rank


def signature(hashes: np.ndarray, orders: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One-permutation MinHash of a non-empty sorted set, densified."""
    order, rank = orders
    bins = len(order)
    where = (hashes >> np.uint64(64 - (bins.bit_length() - 1))).astype(np.int64)
    full, at = np.unique(where, return_index=True)
    values = np.zeros(bins, np.uint64)
    values[full] = hashes[at]
    if len(full) < bins:
        is_full = np.zeros(bins, bool)
        is_full[full] = True
        empty = np.flatnonzero(~is_full)
        if len(full) <= FEW_BINS:
            values[empty] = values[full[rank[np.ix_(empty, full)].argmin(axis=1)]]
        else:
            step = 0
            left = empty
            while len(left):
                asked = order[left, step]
                hit = is_full[asked]
                values[left[hit]] = values[asked[hit]]
                left, step = left[~hit], step + 1
    return values


def most_different(least: tuple[int, int], n: Column) -> Column:
    """Bits in which the sketches of two sets at the similarity may differ, with six standard deviations.

    ``n`` is the size of the smaller set. It fills about BINS (1 - exp(-n / BINS)) bins; an empty bin copies a
    full one, so a difference counts as often as its bin is copied, and that varies the more the fewer are full.
    """
    chance = (1 - least[0] / least[1]) / 2
    full = F.lit(float(BINS)) * (1 - F.exp(-n / BINS))
    spread = BINS * F.sqrt(chance * (1 - chance) * (2 - full / BINS) / full)
    return BINS * chance + 6 * spread


def sketch(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """Per document: set size, a fingerprint of the set, the bucket keys (none for an empty set) and both sketches."""
    turns, salts, coins = constants(rows, 37), constants(bands, 41), constants(BINS, 43)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, orders = SpanHasher(11, lower=True), bin_orders(BINS)
        for batch in batches:
            sizes, marks, keys, lengths, bits, odd = [], [], [], [], [], []
            for _, _, buf, offsets in blocks(binary_column(batch, "text")):
                for hashes in shingle_hashes(hasher, buf, offsets, words):
                    sizes.append(len(hashes))
                    marks.append((hashes.sum(dtype=np.uint64), mix(hashes).sum(dtype=np.uint64)))
                    lengths.append(bands if len(hashes) else 0)
                    parity = np.bincount((hashes & np.uint64(64 * len(ODD) - 1)).astype(np.int64), minlength=64 * len(ODD)) & 1
                    odd.append(np.packbits(parity.astype(np.uint8)).view(np.int64))
                    if len(hashes):
                        values = signature(hashes, orders)
                        banded = values[: bands * rows].reshape(bands, rows)
                        keys.append(mix((banded * turns).sum(axis=1, dtype=np.uint64) + salts))
                        bits.append(np.packbits((mix(values ^ coins) & np.uint64(1)).astype(np.uint8)).view(np.int64))
                    else:
                        bits.append(np.zeros(len(SKETCH), np.int64))
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            marked = np.array(marks, np.uint64).reshape(-1, 2).view(np.int64)
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            sketches = np.hstack([np.array(bits, np.int64).reshape(-1, len(SKETCH)), np.array(odd, np.int64).reshape(-1, len(ODD))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(marked[:, 0]), pa.array(marked[:, 1]), pa.ListArray.from_arrays(ends, pa.array(flat)),
                 *(pa.array(np.ascontiguousarray(c)) for c in sketches.T)],
                ["id", "n", "mark1", "mark2", "keys", *SKETCH, *ODD],
            )

    return docs.mapInArrow(run, "id bigint, n bigint, mark1 bigint, mark2 bigint, keys array<bigint>, " + ", ".join(f"{c} bigint" for c in [*SKETCH, *ODD]))


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """Per document the sorted set, as the top bytes of its hashes one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher(11, lower=True)
        for batch in batches:
            for low, high, buf, offsets in blocks(binary_column(batch, "text")):
                packed = [
                    np.unique(hashes >> np.uint64(64 - 8 * KEPT_BYTES)).view(np.uint8).reshape(-1, 8)[:, :KEPT_BYTES].tobytes()
                    for hashes in shingle_hashes(hasher, buf, offsets, words)
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(packed, pa.binary())], ["id", "shingles"])

    return docs.mapInArrow(run, "id bigint, shingles binary")


def _unpack(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // KEPT_BYTES, 8), np.uint8)
    wide[:, :KEPT_BYTES] = np.frombuffer(packed, np.uint8).reshape(-1, KEPT_BYTES)
    return wide.view(np.uint64).ravel()


def confirm(pairs: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity least[0] / least[1]."""
    share, whole = least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                one, two = _unpack(x.as_buffer()), _unpack(y.as_buffer())
                if len(one) > len(two):
                    one, two = two, one
                at = np.searchsorted(two, one)
                at[at == len(two)] = 0
                common = int((two[at] == one).sum())
                keep.append(whole * common >= share * (len(one) + len(two) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return met.mapInArrow(run, "a bigint, b bigint")


def _unsettled(groups: DataFrame, labels: DataFrame, first: int, bands: int) -> DataFrame:
    """Members (bucket, id, component) of the buckets of some bands that hold more than one component."""
    entries = groups.select(F.explode(F.slice("keys", first, bands)).alias("bucket"), F.col("head").alias("id")).join(labels, "id")
    return _mixed(entries)


def _mixed(members: DataFrame) -> DataFrame:
    mixed = members.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    return members.join(mixed, "bucket")


def _candidates(members: DataFrame, slices: int, least: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Pairs of this round, and the centres (bucket, id) that need not be paired again."""
    share, whole = least
    centres = members.groupBy("bucket", F.pmod(F.xxhash64("id"), F.lit(slices)).alias("slice")).agg(F.min(F.struct("id", "n", "component", *SKETCH, *ODD)).alias("centre"))
    centres = centres.select("bucket", "centre")
    different, odd = (reduce(add, [F.bit_count(F.col(c).bitwiseXOR(F.col(f"centre.{c}"))) for c in names]) for names in (SKETCH, ODD))
    met = members.join(centres, "bucket").where(
        (F.col("component") != F.col("centre.component"))
        & (F.col("n") * whole >= F.col("centre.n") * share)
        & (F.col("centre.n") * whole >= F.col("n") * share)
        & (odd * (whole + share) <= (F.col("n") + F.col("centre.n")) * (whole - share))
        & (different <= most_different(least, F.least("n", "centre.n")))
    )
    pairs = met.select(F.least("id", "centre.id").alias("a"), F.greatest("id", "centre.id").alias("b")).distinct()
    return pairs, centres.select("bucket", F.col("centre.id").alias("id"))


def _few(ids: DataFrame) -> DataFrame:
    """The ids, to be broadcast if a count proves them few, so that the texts that they are held against need not move."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, least: tuple[int, int] = (85, 100), bands: int = 32, rows: int = 8
) -> DataFrame:
    """Link documents whose shingle sets have a Jaccard similarity of least[0] / least[1] or more.

    Returns one row per input row: the key, ``n_shingles``, ``component_id`` (smallest key reachable by
    links, itself included) and ``kept`` (key = component_id). Null, empty and blank texts have an empty
    set and link with nothing. A text with fewer words has its whole sequence as its one shingle. Rows
    with equal keys count as one document. A row whose key is null is linked with nothing, has a null
    component and is kept. Extra columns are ignored. ``bands * rows`` may be at most ``BINS``.
    """
    rows_in = docs.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    sketched = keep(sketch(rows_in, words, bands, rows), "sketched")
    plain = keep(sketched.select("id", "n", "mark1", "mark2"), "plain")
    known = plain.where("n > 0 AND id IS NOT NULL")
    groups = sketched.where("n > 0 AND id IS NOT NULL").groupBy("n", "mark1", "mark2")
    groups = keep(groups.agg(F.min("id").alias("head"), F.first("keys").alias("keys"), *(F.first(c).alias(c) for c in [*SKETCH, *ODD])), "groups")
    discard(sketched)

    labels = keep(groups.select(F.col("head").alias("id"), F.col("head").alias("component")).distinct(), "labels")
    sizes = groups.select(F.col("head").alias("id"), "n", *SKETCH, *ODD)
    sets = tested = None
    slices, opening = 1, OPENING < bands
    waiting = keep(_unsettled(groups, labels, 1, OPENING if opening else bands), "waiting")
    while opening or not waiting.isEmpty():
        heads = waiting.select("id").distinct()
        if sets is None or not opening and slices == 1:  # sets of those that can still be paired
            missing = heads if sets is None else heads.join(sets.select("id"), "id", "left_anti")
            found = shingle_sets(rows_in.join(_few(missing), "id", "left_semi"), words).groupBy("id").agg(F.first("shingles").alias("shingles"))
            found = keep(found, "sets")
            sets = found if sets is None else sets.unionByName(found)
        pairs, centres = _candidates(waiting.join(sizes, "id"), slices, least)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = keep(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = keep(confirm(pairs, sets, least), "links")
        old = labels
        if not links.isEmpty():
            named = links
            for end in ("a", "b"):
                named = named.join(labels.select(F.col("id").alias(end), F.col("component").alias(f"{end}_in")), end)
            joined = components(named.select(F.col("a_in").alias("a"), F.col("b_in").alias("b")))
            labels = keep(
                labels.join(joined, labels["component"] == joined["node"], "left").select("id", F.coalesce(joined["component"], labels["component"]).alias("component")), "labels"
            )
            discard(joined)
        spent = waiting
        if opening:
            waiting, opening = keep(_unsettled(groups, labels, 1, bands), "waiting"), False
        else:
            waiting = waiting.drop("component").join(centres, ["bucket", "id"], "left_anti").join(labels, "id")
            waiting, slices = keep(_mixed(waiting), "waiting"), slices * GROWTH
        discard(spent, links, *([old] if labels is not old else []))

    # keys that stand for several texts connect the groups that they are in
    inside = known.select("n", "mark1", "mark2", "id").join(groups.select("n", "mark1", "mark2", "head"), ["n", "mark1", "mark2"])
    inside = inside.join(labels.withColumnRenamed("id", "head"), "head", "left").select("id", F.coalesce("component", "head").alias("component"))
    inside = keep(inside.distinct())
    doubled = inside.groupBy("id").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    if not doubled.isEmpty():
        several = inside.groupBy("id").agg(F.min("component").alias("a"))
        merged = components(inside.join(several, "id").select("a", F.col("component").alias("b")))
        inside = inside.join(merged.withColumnRenamed("component", "whole"), inside["component"] == merged["node"], "left")
        inside = inside.select("id", F.coalesce("whole", "component").alias("component")).distinct()
    final = plain.join(inside, "id", "left")
    component = F.coalesce("component", "id")
    return final.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns."""
    gone = keep(near_duplicates(docs, key, text, **options).where("NOT kept").select(F.col(key).alias("_dropped")).distinct(), "gone")
    return docs.join(_few(gone), docs[key] == gone["_dropped"], "left_anti")
