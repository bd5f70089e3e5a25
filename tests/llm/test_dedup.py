"""Near copies, exact copies and repeated strings against plain definitions, and their edge cases."""

import hashlib
import random

import numpy as np
import pytest

from basketlens.llm import components, exact_dedup, near_dedup, suffix_dedup
from tests.llm import brute


def as_map(df, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in df.collect()}


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (3, 2)]
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {found[i] for i in range(41)} == {0}
    assert {found[100 + i] for i in range(30)} == {100}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_of_long_chains_take_few_rounds(spark, monkeypatch):
    """A chain in the order of its nodes, one in mixed order, and a comb."""
    rounds, real = [], components.keep
    monkeypatch.setattr(components, "keep", lambda df, name="table": rounds.append(name) or real(df, name))
    mixed = list(range(1000, 1300))
    random.Random(2).shuffle(mixed)
    links = [(i, i + 1) for i in range(300)] + list(zip(mixed[:-1], mixed[1:], strict=True)) + [(5000 + i, 5001 + i) for i in range(50)] + [(5000 + i, 9000 - i) for i in range(50)]
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert [found[i] for i in range(301)] == [0] * 301
    assert {found[i] for i in mixed} == {1000}
    assert {found[i] for i in range(5000, 5051)} == {5000} and found[8980] == 5000
    assert rounds.count("links") - 1 <= 2 * np.log2(len(found))


@pytest.mark.parametrize("share", [80, 85])
def test_sketches_lose_no_pair_at_the_similarity(spark, share):
    """Pairs at exactly the similarity, by the size of their union: none differs in more bits than allowed."""
    from pyspark.sql import functions as F

    rng, orders = np.random.default_rng(7), near_dedup.bin_orders(near_dedup.BINS)
    rows = []
    for union, pairs in ((20, 1500), (60, 1000), (100, 1000), (400, 600), (3000, 200)):
        common = union * share // 100
        for _ in range(pairs):
            hashes = rng.integers(0, 2**63, union, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            half = common + (union - common) // 2
            one, two = hashes[:half], np.concatenate([hashes[:common], hashes[half:]])
            bits = [near_dedup.mix(near_dedup.signature(np.sort(x), orders)) & np.uint64(1) for x in (one, two)]
            rows.append((union, int((bits[0] != bits[1]).sum()), min(len(one), len(two))))
    table = spark.createDataFrame(rows, "size bigint, different bigint, n bigint")
    lost = table.where(F.col("different") > near_dedup.most_different((share, 100), F.col("n"))).groupBy("size").count().collect()
    assert lost == []


def test_signature_agrees_as_often_as_the_sets_do():
    orders = near_dedup.bin_orders(near_dedup.BINS)
    rng = np.random.default_rng(1)
    for size in (7, 60, 3000):
        agreed = []
        for _ in range(40):
            common = rng.integers(0, 2**63, size, dtype=np.uint64)
            extra = rng.integers(0, 2**63, 2 * max(size // 12, 1), dtype=np.uint64)
            half = len(extra) // 2
            one, two = (np.unique(np.concatenate([common, e]) * np.uint64(2)) for e in (extra[:half], extra[half:]))
            agreed.append((near_dedup.signature(one, orders) == near_dedup.signature(two, orders)).mean())
        assert abs(np.mean(agreed) - size / (size + len(extra))) < 0.03


def test_near_copies_equal_brute_force(docs, texts):
    found = as_map(near_dedup.near_duplicates(docs), "n_shingles", "component_id")
    assert found == brute.near_components(texts)


def test_near_copies_when_members_of_a_bucket_do_not_link_to_its_centre(spark):
    # 0 and 2 differ too much, both are near 1; a star around 0 alone would lose nothing here, one around each must not add links
    words = [f"w{i}" for i in range(204)]
    rows = [(0, " ".join(words[:200])), (1, " ".join(words[:190] + ["q"] * 10)), (2, " ".join(words[:180] + ["q"] * 20))]
    rows += [(10 + i, " ".join(words[:150] + [f"z{i}y{j}" for j in range(50)])) for i in range(12)]
    found = as_map(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")), "n_shingles", "component_id")
    assert found == brute.near_components(rows)


def test_near_copies_edges(cluttered, none, odd, texts):
    assert as_map(near_dedup.near_duplicates(cluttered), "component_id") == {k: (c,) for k, (_, c) in brute.near_components(texts).items()}
    assert near_dedup.near_duplicates(none).count() == 0
    rows = [tuple(r) for r in near_dedup.near_duplicates(odd).select("doc_id", "component_id", "kept").collect()]
    assert sorted(rows, key=str) == sorted([(None, None, True)] * 2 + [(1, 1, True)] * 2 + [(2, 2, True)] * 2 + [(3, 1, False)], key=str)
    assert near_dedup.drop_near_duplicates(odd).count() == 6


def test_near_copies_when_ids_are_too_many_to_broadcast(cluttered, monkeypatch):
    want = sorted(map(str, near_dedup.near_duplicates(cluttered).collect()))
    kept = sorted(map(str, near_dedup.drop_near_duplicates(cluttered).collect()))
    monkeypatch.setattr(near_dedup, "BROADCAST_IDS", 0)
    assert sorted(map(str, near_dedup.near_duplicates(cluttered).collect())) == want
    assert sorted(map(str, near_dedup.drop_near_duplicates(cluttered).collect())) == kept


def test_exact_copies(docs, texts, cluttered, none, odd):
    found = as_map(exact_dedup.exact_duplicates(docs, fan_in=2), "keep_id", "group_size", "kept", "text_sha256")
    same = {}
    for key, text in texts:
        same.setdefault(text or "", []).append(key)
    assert found == {k: (max(same[t or ""]), len(same[t or ""]), k == max(same[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for k, t in texts}
    assert as_map(exact_dedup.exact_duplicates(cluttered), "keep_id") == {k: v[:1] for k, v in found.items()}
    assert exact_dedup.exact_duplicates(none).count() == 0
    rows = sorted((tuple(r) for r in exact_dedup.exact_duplicates(odd).select("doc_id", "keep_id", "group_size", "kept").collect()), key=str)
    assert rows == sorted([(None, 3, 4, False), (None, None, 1, True), (1, 3, 4, False), (1, 3, 4, False), (2, 2, 1, True), (2, 2, 1, True), (3, 3, 4, True)], key=str)
    assert exact_dedup.drop_exact_duplicates(odd).count() == 4
    assert {r["keep_id"] for r in exact_dedup.exact_duplicates(docs, keep="smallest").collect()} == {min(keys) for keys in same.values()}


def test_digest_runs_merge_in_rounds(docs):
    """Each run is sorted and names a text once; every round leaves half as many runs and merges once."""
    rows, number = exact_dedup.digest_rows(docs.repartition(9), "doc_id", "text")
    assert number > 4 and exact_dedup.rounds(number, 2)[-1] == 1 and exact_dedup.rounds(9, 2) == [5, 3, 2, 1] and exact_dedup.rounds(1, 2) == []
    runs = exact_dedup.cut_lineage(exact_dedup._merged(rows, "largest"))
    for part in runs.rdd.glom().collect():
        marks = [tuple(r[m] for m in ("run", *exact_dedup.MARKS)) for r in part]
        assert marks == sorted(set(marks))
    assert runs.agg({"group_size": "sum"}).first()[0] == docs.count()
    merged = exact_dedup.merge_runs(runs, number, "largest", 2)
    plan = merged._jdf.queryExecution().analyzed().toString()
    assert plan.count("MapInArrow") == len(exact_dedup.rounds(number, 2))
    assert merged.count() == docs.selectExpr("coalesce(text, '')").distinct().count()


def test_equal_digests_of_other_texts_stay_apart(spark):
    """Rows that agree in the digest but not in length or second hash are not merged, also across batches."""
    rows = [(0, b"a", n, c, i, 1) for i, (n, c) in enumerate([(1, 1), (1, 2), (2, 1), (1, 1), (2, 1)] * 40)]
    table = spark.createDataFrame(rows, "run int, digest binary, n_bytes bigint, check bigint, keep_id bigint, group_size bigint").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = exact_dedup._merged(table, "largest").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r.n_bytes, r.check, r.keep_id, r.group_size) for r in found] == [(1, 1, 198, 80), (1, 2, 196, 40), (2, 1, 199, 80)]


@pytest.mark.parametrize("most_stretches", [2048, 2])
def test_repeats_equal_brute_force(spark, texts, most_stretches):
    rng = random.Random(3)
    rows = [(k, (t or "")[:3000] if t else t) for k, t in texts]
    for i in range(30):
        parts = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 200))), hashlib.sha256(str(rng.randint(0, 3)).encode()).hexdigest() * 3, "xyz" * rng.randint(1, 90)]
        rows.append((200 + i, "".join(rng.choices(parts, k=rng.randint(0, 4)))))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = as_map(suffix_dedup.remove_repeats(table, most_stretches=most_stretches), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == brute.without_repeats(rows, 100)


def test_repeated_windows_by_interval_expansion():
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(8, 60))).encode() for _ in range(50)]
    seen, want, at = set(), [], 0
    for text in texts:
        for i in range(len(text) - 8 + 1):
            if text[i : i + 8] in seen:
                want.append(at + i)
            seen.add(text[i : i + 8])
        at += len(text) + 1
    assert suffix_dedup.repeated_windows(texts, 8).tolist() == want


def test_repeats_edges(cluttered, docs, none, odd):
    plain = as_map(suffix_dedup.remove_repeats(docs), "kept_sha256")
    assert as_map(suffix_dedup.remove_repeats(cluttered), "kept_sha256") == plain
    assert suffix_dedup.remove_repeats(none).count() == 0
    rows = sorted((r["doc_id"] or 0, r["n_removed"]) for r in suffix_dedup.remove_repeats(odd).collect())
    n = len(odd.where("doc_id = 3").first()["text"])
    inner = brute.without_repeats([(1, odd.where("doc_id = 3").first()["text"])], 100)[1][1]
    assert rows == [(0, 0), (0, 0), (1, inner), (1, inner), (2, 0), (2, 0), (3, n)]
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs, least=500)


def test_pipeline_links_near_copies_from_080_on(spark):
    import corpus_pipeline

    words = [f"w{i}" for i in range(304)]  # 300 shingles
    rows = [(0, " ".join(words)), (1, " ".join([*words[:272], *(f"q{i}" for i in range(32))])), (5, " ".join([*words[:262], *(f"z{i}" for i in range(42))]))]
    one, two, five = (brute.shingles(text) for _, text in rows)
    assert 0.80 <= len(one & two) / len(one | two) < 0.85
    assert len(one & five) / len(one | five) < 0.80 and len(two & five) / len(two | five) < 0.80
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 5]
