"""Archives, shards, packing and benchmark search: round trips, laws, brute force, edge cases."""

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from basketlens.llm import decontaminate, packing, sharding, warc  # noqa: E402
from tests.llm import brute  # noqa: E402


def test_archives_give_back_every_payload(spark, tmp_path):
    mark = "x\r\n\r\nWARC/1.1\r\ny"
    pages = [
        (1, "u", "a" * 200_000), (2, "u", mark * 3), (3, None, None), (4, "u", "\r\n\r\n"), (None, "u", "zz"), (5, "u", mark * 3), (6, "é\nx", ""),
        (7, "u", "é" * 70_000 + "\r\n"), (8, "u", "\r\n\r\nWARC/1.1\r\n"), (None, "u", "zz"), (9, "u", "zz"),
    ]
    table = spark.createDataFrame([(*p, "r", 0) for p in pages], "page_id bigint, url string, html string, response_id string, digest int")
    warc.write_archives(table, str(tmp_path / "a"), chunk_bytes=1 << 12)
    found = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert len(found) == len(pages)
    last = {}
    for page, _, html in pages:
        last[html or ""] = max(last.get(html or "", -1), page if page is not None else -1)
    body = {page: html or "" for page, _, html in pages}
    for r in found:
        payload = body[r["page_id"]].encode()
        assert r["payload_bytes"] == len(payload)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        again = r["page_id"] is not None and last[body[r["page_id"]]] != r["page_id"]
        assert (r["record_type"], r["refers_to"]) == (("revisit", last[body[r["page_id"]]]) if again else ("response", None))


def test_long_payloads_under_repeated_and_null_keys(spark, tmp_path):
    """Two rows of one key and payload, two null keys, one key with two payloads, all of several chunks, and copies of one payload."""
    long = {c: c * 200_000 for c in "abcdef"}
    keyed = [(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "c"), (2, "d"), (3, "e"), (4, "e"), (4, "e"), (5, "f")]
    pages = spark.createDataFrame([(k, None, long[c]) for k, c in keyed], "page_id bigint, url string, html string").repartition(3)
    warc.write_archives(pages, str(tmp_path / "a"))
    found = [tuple(r) for r in warc.read_archives(spark, str(tmp_path / "a")).select("page_id", "payload_digest", "payload_bytes", "record_type", "refers_to").collect()]

    def row(key, c, kind="response", refers=None):
        return key, base64.b32encode(hashlib.sha1(long[c].encode()).digest()).decode(), 200_000, kind, refers

    want = [row(3, "e", "revisit", 4) if (k, c) == (3, "e") else row(k, c) for k, c in keyed]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_chunks_of_a_long_payload_are_handed_on_as_they_are_cut():
    pieces = warc.cut(b"x" * (1 << 20) + warc.MARK + b"y", 1 << 16)
    assert len(next(pieces)) == 1 << 16
    assert sum(map(len, pieces)) == (1 << 20) - (1 << 16) + len(warc.MARK) + 1


def test_small_payloads_are_all_responses_and_nothing_is_no_archive(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "same"), (2, "u", "same")], "page_id bigint, url string, html string")
    warc.write_archives(pages, str(tmp_path / "a"), least=5)
    assert {r["record_type"] for r in warc.read_archives(spark, str(tmp_path / "a")).collect()} == {"response"}
    warc.write_archives(pages.where("false"), str(tmp_path / "b"))
    assert warc.read_archives(spark, str(tmp_path / "b")).count() == 0


def test_a_changed_archive_is_refused(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "some payload")], "page_id bigint, url string, html string")
    warc.write_archives(pages, str(tmp_path / "a"))
    lines = spark.read.text(str(tmp_path / "a"), wholetext=True).selectExpr("replace(value, 'some payload', 'sane payload') AS value")
    lines.write.text(str(tmp_path / "b"))
    with pytest.raises(Exception, match="declared"):
        warc.read_archives(spark, str(tmp_path / "b")).collect()


def check_shards(found, rows, shards):
    by = defaultdict(list)
    for r in found:
        by[r["shard"]].append(r)
    assert len(found) == len(rows)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"]) for r in found) == sorted(
        (k if k is not None else -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows
    )
    return [sum(r["size"] for r in by[s]) for s in range(shards)]


def test_shards_are_whole_and_even(spark, docs, texts, cluttered, none, odd):
    check_shards(sharding.shard_by_bytes(docs, 8).collect(), texts, 8)
    check_shards(sharding.shard_by_bytes(cluttered, 8).collect(), texts, 8)
    check_shards(sharding.shard_by_bytes(odd, 3).collect(), [(r["doc_id"], r["text"]) for r in odd.collect()], 3)
    assert sharding.shard_by_bytes(none, 8).count() == 0
    # a third of all rows share one text, some rows are large
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i} " * (i % 17)) for i in range(6000)] + [(9000 + i, "z" * 5000) for i in range(9)]
    sizes = check_shards(sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id bigint, text string"), 8).collect(), rows, 8)
    assert max(sizes) < 1.02 * min(sizes)


def test_overfull_ranges_are_cut_further(spark, monkeypatch):
    rows = [(i, "same" if i % 2 else f"text {i}") for i in range(4000)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    plain = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_by_bytes(table, 4).collect()}
    monkeypatch.setattr(sharding, "FEWEST", 4)
    monkeypatch.setattr(sharding, "OVERFULL", 1)
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_by_bytes(table, 4).collect()} == plain


def packed(df):
    return packing.pack(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_packing_round_trip(spark, docs, texts, cluttered, none, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    found = packed(docs).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for key, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own, start = sorted(by_doc[key], key=lambda r: r["piece"]), 0
        for number, r in enumerate(own):
            assert (r["piece"], r["start"]) == (number, start)
            assert r["ids_crc32"] == zlib.crc32(ids[start : start + r["length"]].tobytes())
            start += r["length"]
        assert start == len(ids)
        assert len(own) == -(-len(ids) // 1024)
    for own in by_sequence.values():
        end = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= 1024
    assert sorted(tuple(r)[:5] for r in packed(cluttered).collect()) == sorted(tuple(r)[:5] for r in found)
    assert packed(none).count() == 0
    assert packed(odd).count() == odd.count()


def test_rounds_of_best_fit_come_near_the_bound():
    rng = np.random.default_rng(0)
    for _ in range(5):
        counts = {int(n): int(c) for n, c in zip(rng.integers(1, 1025, 300), rng.integers(1, 50, 300), strict=True)}
        plan = packing.match_rounds(dict(counts), 1024)
        used, ranks = defaultdict(list), defaultdict(list)
        for length, low, high, first, offset in plan:
            ranks[length] += range(low, high)
            for i in range(high - low):
                used[first + i].append((offset, length))
        assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
        for own in used.values():
            own.sort()
            assert all(a + n == b for (a, n), (b, _) in zip(own[:-1], own[1:], strict=True)) and own[0][0] == 0
            assert own[-1][0] + own[-1][1] <= 1024
        # any packing needs a sequence for each piece over half of one
        bound = max(-(-sum(n * c for n, c in counts.items()) // 1024), sum(c for n, c in counts.items() if n > 512))
        assert len(used) <= 1.05 * bound
    assert packing.match_rounds({}, 1024) == []


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog while seven wizards quietly brew"), (2, "one"), (3, None), (4, "..."), (5, "two words"),
    (6, "potion of old moss and rain the quick brown fox jumps over"), (7, "word12 of12 word13 of13"), (8, "Two, WORDS"), (None, "one"),
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_benchmark_search_equals_brute_force(spark, docs, texts, block_bytes):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontaminate.contamination(docs, benchmark, block_bytes=block_bytes).collect()
    assert len(found) == len(texts)
    rows = {r["doc_id"]: r for r in found}
    for key, text in texts:
        words, hit, items = brute.benchmark_hits(text, [i for i in ITEMS if i[0] is not None])
        r = rows[key]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (words, hit, len(items), hit > 0), key
        assert r["items_sha256"] == hashlib.sha256(",".join(items).encode()).hexdigest()
    clean = {r["doc_id"] for r in decontaminate.drop_contaminated(docs, benchmark, block_bytes=block_bytes).collect()}
    assert clean == {k for k in rows if not rows[k]["contaminated"]}


def test_benchmark_search_edges(spark, docs, cluttered, none, odd):
    benchmark = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id bigint, text string, name string")
    assert decontaminate.contamination(cluttered, benchmark).count() == docs.count()
    assert decontaminate.contamination(none, benchmark).count() == 0
    for size in (1 << 20, 60):
        assert sorted((r["doc_id"] or 0, r["n_items"]) for r in decontaminate.contamination(odd, benchmark, block_bytes=size).collect()) == [
            (0, 0), (0, 2), (1, 2), (1, 2), (2, 0), (2, 0), (3, 2)
        ]
    assert not any(r["contaminated"] for r in decontaminate.contamination(docs, benchmark.where("false")).collect())


def test_packing_takes_added_tokens_as_the_unchanged_tokenizer_does(spark):
    from tokenizers import Tokenizer

    from basketlens.llm import queries

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = ["a <|endoftext|> b", end, end * 3, f"x  {end}\n\n {end}é", f"<|endof{end}text|>", "<|ENDOFTEXT|> <|endoftext|", f"word {end} " * 900, "no token", ""]
    found = defaultdict(list)
    for r in queries.pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect():
        found[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for key, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want, start = [], 0
        for number, length in enumerate(packing.cut_lengths(len(ids), 1024)):
            want.append((number, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            start += length
        assert sorted(found[key]) == want, text
