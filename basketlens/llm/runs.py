"""Running totals along sorted rows, cut over tasks at any row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.tables import keep


def running(df: DataFrame, key: str, order: list[Column], sums: list[str], xors: list[str] = []) -> DataFrame:  # noqa: B006
    """For each row, the totals of the rows before it under the same ``key`` (a bigint without nulls).

    ``before_<name>`` is a sum for each bigint column in ``sums`` and an exclusive or for each in ``xors``.
    Rows are sorted in ranges of (key, order), so a key with very many rows lies in many tasks. A task
    totals its own rows; a key that goes on from one range to the next takes the totals of its earlier
    ranges along. These are at most one row per task, the only thing that passes the driver. Rows that tie
    in key and order are dealt in any order, once. The result is a written table.
    """
    names = [*sums, *xors]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        first = last = None
        totals = {n: np.int64(0) for n in names}
        schema = None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            keys = batch.column(schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.concatenate([[last is None or keys[0] != last], keys[1:] != keys[:-1]]))
            first = keys[0] if first is None else first
            run_of = np.searchsorted(starts, np.arange(len(keys)), side="right") - 1  # -1: the run that the last batch began
            before = []
            for n in names:
                values = batch.column(schema.get_field_index(n)).to_numpy(zero_copy_only=False)
                total, back = (np.cumsum, np.subtract) if n in sums else (np.bitwise_xor.accumulate, np.bitwise_xor)
                upto = np.concatenate([[np.int64(0)], total(values)])
                base = np.concatenate([upto[starts], [back(np.int64(0), totals[n])]])  # the last one, at -1, is for the run begun before
                found = back(upto, np.concatenate([base[run_of], base[run_of[-1:]]]))
                before.append(pa.array(found[:-1], pa.int64()))
                totals[n] = found[-1]
            last = keys[-1]
            size = batch.num_rows
            marks = [pa.array(np.full(size, part, np.int32)), pa.nulls(size, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *before, *marks], [*schema.names, *[f"before_{n}" for n in names], "_part", "_first"])
        if schema is not None:  # what this task leaves: its last run and that run's totals
            own = [pa.array([last], f.type) if f.name == key else pa.nulls(1, f.type) for f in schema]
            left = [pa.array([int(totals[n])], pa.int64()) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*own, *left, pa.array([part], pa.int32()), pa.array([first], pa.int64())], [*schema.names, *[f"before_{n}" for n in names], "_part", "_first"]
            )

    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"before_{n} bigint" for n in names] + ["_part int", "_first bigint"])
    ranged = df.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    table = keep(ranged.mapInArrow(run, fields), "running")
    carried, open_key, open_totals = [], None, [0] * len(names)
    ends = table.where("_first IS NOT NULL").select("_part", "_first", key, *[f"before_{n}" for n in names])
    for part, first, last, *own in sorted(map(tuple, ends.collect())):
        goes_on = first == open_key
        if goes_on:
            carried.append((part, first, *open_totals))
        if goes_on and first == last:
            open_totals = [int(np.int64(a) + np.int64(b)) if n in sums else a ^ b for n, a, b in zip(names, open_totals, own, strict=True)]
        else:
            open_totals = own
        open_key = last
    rows = table.where("_first IS NULL").drop("_first")
    added = df.sparkSession.createDataFrame(carried, ", ".join(["_part int", f"`{key}` bigint", *[f"_add_{n} bigint" for n in names]]))
    met = rows.join(F.broadcast(added), ["_part", key], "left")
    for n in names:
        more = F.coalesce(f"_add_{n}", F.lit(0).cast("bigint"))
        met = met.withColumn(f"before_{n}", F.col(f"before_{n}") + more if n in sums else F.col(f"before_{n}").bitwiseXOR(more))
    return met.drop("_part", *[f"_add_{n}" for n in names])
