"""Packing along a curve: round trips, laws, neighbours."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from basketlens.llm import curve_packing, packing


def packed(df, **options):
    special = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return curve_packing.pack_along_curve(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, special=special, **options)


@pytest.mark.parametrize("capacity", [1024, 16])
def test_round_trip_and_padding(spark, docs, texts, cluttered, none, odd, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = packed(docs, capacity=capacity).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for key, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        start = 0
        for r in sorted(by_doc[key], key=lambda r: r["start"]):
            assert r["start"] == start and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[start : start + r["length"]].tobytes())
            start += r["length"]
        assert start == len(ids)
        total += start
    sizes = []
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        sizes.append(end)
    assert all(n <= capacity and n & (n - 1) == 0 for n in sizes)
    assert len(sizes) == total // capacity + (total % capacity).bit_count()
    assert sorted(map(tuple, packed(cluttered, capacity=capacity).collect())) == sorted(map(tuple, found))
    assert packed(none).count() == 0
    rows = packed(odd).collect()
    assert sum(r["start"] == 0 for r in rows) == odd.count()


def test_cuts_of_the_stream():
    for total, capacity in ((0, 16), (5, 16), (16, 16), (47, 16), (3, 1)):
        cuts = curve_packing.stream_cuts(0, total, total, capacity)
        assert sum(n for _, _, n in cuts) == total
        assert all(offset == 0 for _, offset, _ in cuts)
        assert [s for s, _, _ in cuts] == list(range(total // capacity + (total % capacity).bit_count()))
        parts = [c for at in range(total) for c in curve_packing.stream_cuts(at, 1, total, capacity)]
        assert parts == [(s, o, 1) for s, _, n in cuts for o in range(n)]


@pytest.mark.parametrize("axes, bits", [(2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(monkeypatch, axes, bits):
    monkeypatch.setattr(curve_packing, "BITS", bits)
    points = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    places = curve_packing.hilbert(points)
    assert sorted(places) == list(range(len(points)))
    along = points[np.argsort(places)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_like_documents_share_sequences(spark):
    """Documents of few topics, in mixed order: far more neighbours of the same topic than by chance."""
    rng = np.random.default_rng(5)
    topics = [rng.choice(5000, 60, replace=False) for _ in range(8)]
    rows = [(i, " ".join(f"w{w}" for w in rng.choice(topics[i % 8], 80))) for i in range(800)]
    pieces = packed(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    by_sequence = defaultdict(list)
    for r in pieces:
        by_sequence[r["sequence_id"]].append(r["doc_id"] % 8)
    same = [a == b for own in by_sequence.values() for a, b in itertools.combinations(own, 2)]
    assert np.mean(same) > 0.5  # one in eight by chance


def test_copies_lie_side_by_side(spark):
    rows = [(i, "a text that many rows repeat, word for word") for i in range(500)] + [(1000 + i, f"text {i} of its own {i * i}") for i in range(500)]
    pieces = sorted(packed(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)).collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    order = list(dict.fromkeys(r["doc_id"] for r in pieces))
    at = order.index(0)
    assert order[at : at + 500] == list(range(500))
