"""Exact duplicates by a tree-merge of sorted digest runs.

Every input partition is sorted to one run of (digest, identifier, count) rows, a row per distinct text. In each
round, ``fan_in`` runs become one: their rows meet by new run and digest, are merged in order, and one row
after the other is compared with the one before it. Rows of one text become one row, that of the winning
identifier, with the number of copies. After ``log(runs) / log(fan_in)`` rounds one run is left. A run is spread
over the partitions by digest, so no task holds a whole one, and a text that a third of all rows share is one
row per run and round. The way back goes over the runs as well: a run's texts learn their winner first, its rows
then learn it from their own run.

A row is identified by SHA-256, length and a second hash of other design; texts are merged only where
all three agree, at every level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.columns import utf8
from basketlens.session import cut_lineage

MARKS = ["digest", "n_bytes", "check"]


def _without_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows, the first of each stretch that agrees in run and marks, with the sum of their counts."""
    held = None  # the last stretch, which may go on in the next batch
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        new = np.zeros(rows.num_rows, bool)
        new[0] = True
        for name in ("run", *MARKS):
            column = rows.column(name)
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        sizes = np.add.reduceat(rows.column("group_size").to_numpy(), starts)
        firsts = rows.take(pa.array(starts))
        columns = [pa.array(sizes) if f.name == "group_size" else c for f, c in zip(rows.schema, firsts.columns, strict=True)]
        firsts = pa.RecordBatch.from_arrays(columns, schema=rows.schema)
        held = firsts.take(pa.array([len(starts) - 1]))
        yield firsts.slice(0, len(starts) - 1)
    if held is not None:
        yield held


def _merged(rows: DataFrame, keep: str) -> DataFrame:
    """Rows of each partition in order of run and marks, the winner of each text first, without repeats."""
    winner = F.desc_nulls_last("keep_id") if keep == "largest" else F.asc_nulls_last("keep_id")
    return rows.sortWithinPartitions("run", *MARKS, winner).mapInArrow(_without_repeats, rows.schema)


def digest_rows(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, int]:
    """(run, digest, n_bytes, check, keep_id, group_size) of every row, and the number of runs."""
    body = utf8(F.col(f"`{text}`"))
    rows = docs.select(
        F.spark_partition_id().alias("run"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        F.octet_length(body).cast("bigint").alias("n_bytes"),
        F.xxhash64(body).alias("check"),
        F.col(f"`{key}`").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
    )
    rows = cut_lineage(rows)
    return rows, (rows.agg(F.max("run")).first()[0] or 0) + 1


def rounds(number: int, fan_in: int) -> list[int]:
    """The number of runs after each round."""
    left = []
    while number > 1:
        number = -(-number // fan_in)
        left.append(number)
    return left


def merge_runs(runs: DataFrame, number: int, keep: str, fan_in: int) -> DataFrame:
    """One row per distinct text: its marks, ``keep_id`` and ``group_size``. ``runs`` are sorted runs without repeats."""
    for _ in rounds(number, fan_in):
        met = runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")).repartition("run", "digest")
        runs = _merged(met, keep)
    return runs.drop("run")


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "largest", fan_in: int = 16) -> DataFrame:
    """Groups of identical texts, with no normalisation.

    Returns one row per input row: the key, ``keep_id`` (largest or smallest key of the group),
    ``group_size``, ``kept`` (the row's key is keep_id) and ``text_sha256``. A null text counts as the
    empty text. Null keys never win over others; in a group without any key, keep_id is null and every row
    is kept. Rows that repeat both key and text are one document: they share ``kept`` and all count in
    ``group_size``. An empty table gives an empty result; extra columns are ignored.
    """
    rows, number = digest_rows(docs, key, text)
    runs = cut_lineage(_merged(rows, keep))
    winners = runs.select("run", *MARKS).join(merge_runs(runs, number, keep, fan_in), MARKS)
    found = rows.select("run", *MARKS, F.col("keep_id").alias("id")).join(winners, ["run", *MARKS])
    kept = F.when(F.col("keep_id").isNull(), True).otherwise(F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False)))
    return found.select(F.col("id").alias(key), "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, with all their columns."""
    gone = exact_duplicates(docs, key, text, **options).where("NOT kept")
    marked = gone.select(F.col(key).alias("_key"), F.col("text_sha256").alias("_digest")).distinct()
    same = docs[key].eqNullSafe(marked["_key"]) & (F.sha2(utf8(docs[text]), 256) == marked["_digest"])
    return docs.join(marked, same, "left_anti")


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
