"""Neighbour searches in blocks of targets: what a block needs is sent to it once, and no pair is shuffled.

Two rows meet in a column (an item, a user). A join on the column gives every pair as a row, which is then shuffled
to be summed and again to be ranked. Here targets are dealt into blocks by ranges of their id; a block gets the whole
list of each column that its targets have, once. All pairs of a target then lie in its block, so that sums, the k
nearest and what is made of them need no further shuffle. Ids that belong together often lie close together, so
a list goes to few blocks; at worst it goes to as many as it has entries.

So that this does not fill the disk, rows are kept once, packed by column into compressed tables, and blocks get their lists
from them in waves: a wave sends a few times as many entries as there are rows, and its files go before the next one begins.

A block holds its lists in memory and makes its pairs in steps. ``blocks_for`` counts first, and says None where a
column or a target has too many rows for that; callers then use the sliced join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.fixed_values import TINY
from basketlens.operators.skew import GROUP_ROWS, MOST_TASKS, TASK_ROWS, tasks_for
from basketlens.session import cut_lineage, discard, tidy

# pairs that a block makes
BLOCK_PAIRS = 8_000_000
# pairs that one target may make: a block cannot be smaller than its largest target
TARGET_PAIRS = 4_000_000
# pairs that a block makes at once
STEP_PAIRS = 1_000_000
# entries of lists that a block holds
BLOCK_ENTRIES = 3_000_000
# entries of lists that are sent at once: so many, or so many times the kept rows
WAVE_ENTRIES = 20_000_000
WAVE_TIMES = 2
# ranges of ids of which a block takes several, and ids drawn to cut each
FINE = 8
DRAWN = 20


def blocks_for(targets: DataFrame, listed: DataFrame, keys: list[str], target: list[str], group_rows: int = GROUP_ROWS) -> int | None:
    """Blocks to deal the targets into, by counted pairs; None where a list or a target may be too long."""
    left = targets.groupBy(*keys).agg(F.count("*").alias("n_left"))
    right = listed.groupBy(*keys).agg(F.count("*").alias("n_right"))
    with tidy(targets.sparkSession):
        met = left.join(right, keys).agg(
            F.sum(F.col("n_left").cast("double") * F.col("n_right")).alias("pairs"), F.max(F.greatest("n_left", "n_right")).alias("most"), F.max("n_right").alias("list")
        ).first()
        own = targets.groupBy(*target).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if (met["most"] or 0) > group_rows or own * (met["list"] or 0) > TARGET_PAIRS:
        return None
    least = 2 * targets.sparkSession.sparkContext.defaultParallelism
    return min(max(int((met["pairs"] or 0) / BLOCK_PAIRS) + 1, least), MOST_TASKS)


@dataclass(frozen=True)
class Block:
    """Rows of the targets of a block, and the lists of their columns."""

    own: pa.Table
    row: np.ndarray  # the list of each own row
    length: np.ndarray  # entries of each list
    column: pa.Array  # the column of each list
    listed: pa.Table


def _blob(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _table(blob: bytes) -> pa.Table:
    with pa.ipc.open_stream(pa.py_buffer(blob)) as found:
        return found.read_all()


def _plain(values: pa.ChunkedArray) -> pa.Array:
    return values.combine_chunks() if values.num_chunks != 1 else values.chunk(0)


def _range_of(ids: pa.Array, bounds: pa.Array) -> np.ndarray:
    """The range of each id: how many bounds are not above it. A missing id is in the first."""
    if not len(bounds) or ids.null_count == len(ids):
        return np.zeros(len(ids), np.int32)
    filled = ids.fill_null(bounds[0]) if ids.null_count else ids
    found = np.searchsorted(bounds.to_numpy(zero_copy_only=False), filled.to_numpy(zero_copy_only=False), "right").astype(np.int32)
    return np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, found).astype(np.int32)


def _packed(rows: DataFrame, by: list[str], column: str, target: str, n_rows: int, ranges: int) -> DataFrame:
    """(by, part): rows in tables of about ``TASK_ROWS``, those of a column together and listed ones first. ``fine`` is the range of the target's id."""
    own = rows.filter("own").select(target).filter(F.col(target).isNotNull())
    drawn = own.sample(min(1.0, ranges * DRAWN / max(n_rows, 1)), 1).toArrow().column(0).combine_chunks()
    drawn = drawn if isinstance(drawn, pa.Array) else pa.concat_arrays(drawn.chunks)
    drawn = drawn.take(pc.array_sort_indices(drawn))
    places = np.unique(np.linspace(0, len(drawn), ranges + 1)[1:-1].astype(np.int64)) if len(drawn) else np.zeros(0, np.int64)
    bounds = drawn.take(pa.array(places)).unique()
    data = [c for c in rows.columns if c not in by]
    names = [*by, "part"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        table = pa.Table.from_batches(found)
        keys = [_coded(_plain(table.column(c)))[1][0] for c in [*by, column]]
        unlisted = ~_plain(table.column("listed")).to_numpy(zero_copy_only=False)
        order = np.lexsort([unlisted, *keys[::-1]])
        keys = [k[order] for k in keys]
        table = table.take(pa.array(order))
        table = table.append_column("fine", pa.array(_range_of(_plain(table.column(target)), bounds)))
        new = np.concatenate([[True], np.diff(keys[-1]) != 0])
        other = np.zeros(len(order), bool)
        for k in keys[:-1]:
            other |= np.concatenate([[False], np.diff(k) != 0])
        starts = np.flatnonzero(new | other)
        step = starts // TASK_ROWS
        cuts = [0, *[int(s) for s, changed in zip(starts[1:], (step[1:] != step[:-1]) | other[starts[1:]], strict=True) if changed], len(order)]
        for low, high in zip(cuts, cuts[1:]):
            blob = pa.array([_blob(table.slice(low, high - low).select([*data, "fine"]))], pa.large_binary()).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*[_plain(table.column(c).slice(low, 1)) for c in by], blob], names)

    kept = rows.filter(" and ".join(f"{c} is not null" for c in [*by, column]))
    schema = T.StructType([*[rows.schema[c] for c in by], T.StructField("part", T.BinaryType())])
    return cut_lineage(kept.repartition(tasks_for(n_rows, TASK_ROWS, rows), *by, column).mapInArrow(pack, schema))


def _asked(table: pa.Table, column: str, block_of: np.ndarray) -> tuple[np.ndarray, ...]:
    """Own rows that have a block (sorted by it), their blocks and lists; the first row and the length of each list of the table."""
    codes = _coded(_plain(table.column(column)))[1][0]  # rows of a column lie together
    new = np.concatenate([[True], np.diff(codes) != 0])
    starts, group = np.flatnonzero(new), np.cumsum(new) - 1
    length = np.bincount(group[_plain(table.column("listed")).to_numpy(zero_copy_only=False)], minlength=len(starts))
    block = block_of[_plain(table.column("fine")).to_numpy()]
    own = np.flatnonzero(_plain(table.column("own")).to_numpy(zero_copy_only=False) & (block >= 0))
    own = own[np.argsort(block[own], kind="stable")]
    return own, block[own], group[own], starts, length


def _lists(block: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Marks the first own row of each block and list."""
    return np.concatenate([[True], (np.diff(block) != 0) | (np.diff(group) != 0)]) if len(block) else np.zeros(0, bool)


def _entries_of_blocks(packed: DataFrame, column: str, block_of: np.ndarray) -> np.ndarray:
    """Entries of lists that each block gets, and those of the largest: blocks of different ``by`` hold theirs apart."""
    by = [c for c in packed.columns if c != "part"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                _, block, group, _, length = _asked(_table(batch.column("part")[row].as_buffer()), column, block_of)
                first = _lists(block, group)
                found = np.bincount(block[first], length[group[first]]).astype(np.int64)
                some = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays([*[pa.repeat(batch.column(c)[row], len(some)) for c in by], pa.array(some), pa.array(found[some])], [*by, "block", "n"])

    schema = T.StructType([*[packed.schema[c] for c in by], T.StructField("block", T.LongType()), T.StructField("n", T.LongType())])
    with tidy(packed.sparkSession):
        counted = packed.mapInArrow(count, schema).groupBy(*by, "block").agg(F.sum("n").alias("n")).groupBy("block")
        rows = counted.agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect()
    found = np.zeros((2, int(block_of.max(initial=0)) + 1), np.int64)
    for r in rows:
        found[:, r["block"]] = r["n"], r["most"]
    return found


def _sent(packed: DataFrame, by: list[str], column: str, block_of: np.ndarray, own_columns: list[str], list_columns: list[str]) -> DataFrame:
    """(by, block, own, lists, listed): for each block that has a number, parts of its own rows and of its lists."""
    names = [*by, "block", "own", "lists", "listed"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                table = _table(batch.column("part")[row].as_buffer())
                own, block, group, starts, length = _asked(table, column, block_of)
                if not len(own):
                    continue
                first = _lists(block, group)
                asked, place = group[first], np.cumsum(first) - 1
                ends = np.cumsum(length[asked])
                _, entries = _met(starts[asked], length[asked])
                mine, listed = table.select(own_columns).take(pa.array(own)), table.select(list_columns).take(pa.array(entries))
                columns = table.column(column).take(pa.array(starts[asked]))
                cuts = np.flatnonzero(np.concatenate([[True], np.diff(block) != 0, [True]]))
                for low, high in zip(cuts, cuts[1:]):
                    l_low, l_high = int(place[low]), int(place[high - 1]) + 1
                    e_low = int(ends[l_low - 1]) if l_low else 0
                    parts = (
                        mine.slice(low, high - low).append_column("row", pa.array((place[low:high] - l_low).astype(np.int32))),
                        pa.table([columns.slice(l_low, l_high - l_low), pa.array(length[asked[l_low:l_high]].astype(np.int32))], ["column", "length"]),
                        listed.slice(e_low, int(ends[l_high - 1]) - e_low),
                    )
                    keys = [pa.array([batch.column(c)[row].as_py()], batch.schema.field(c).type) for c in by]
                    yield pa.RecordBatch.from_arrays([*keys, pa.array([int(block[low])], pa.int32()), *[pa.array([_blob(p)], pa.binary()) for p in parts]], names)

    binary = [T.StructField(c, T.BinaryType()) for c in names[-3:]]
    return packed.mapInArrow(send, T.StructType([*[packed.schema[c] for c in by], T.StructField("block", T.IntegerType()), *binary]))


def _block(table: pa.Table) -> Block:
    own, lists, listed = ([_table(x.as_buffer()) for x in table.column(c)] for c in ("own", "lists", "listed"))
    before = np.cumsum([0, *[t.num_rows for t in lists[:-1]]])
    row = np.concatenate([t.column("row").to_numpy() + b for t, b in zip(own, before, strict=True)]).astype(np.int64)
    heads = pa.concat_tables(lists).combine_chunks()
    return Block(
        pa.concat_tables(own).drop_columns("row").combine_chunks(), row, heads.column("length").to_numpy().astype(np.int64), _plain(heads.column("column")),
        pa.concat_tables(listed).combine_chunks(),
    )


def _in_waves(
    rows: DataFrame, by: list[str], column: str, target: str, blocks: int, own_columns: list[str], list_columns: list[str],
    work: Callable[[Block], Iterator[list]], fields: list[T.StructField], width: int = 1, spent: tuple[DataFrame, ...] = (),
) -> DataFrame:
    """What ``work`` makes of each block of targets: columns without those of ``by``.

    ``rows`` is (by, column, target, own, listed, ...): ``own`` rows are those of targets, ``listed`` ones stand in the list of their column.
    An entry counts as ``width`` ones. ``spent`` are tables that are not read after the rows are packed.
    """
    n_rows = max(rows.count(), 1)
    if by:
        with tidy(rows.sparkSession):
            blocks = -(-blocks // max(rows.select(*by).distinct().count(), 1))
    ranges = FINE * blocks
    packed = _packed(rows, by, column, target, n_rows, ranges)
    discard(*spent)
    block_of = np.arange(ranges, dtype=np.int64) * blocks // ranges
    total, most = _entries_of_blocks(packed, column, block_of)
    if most.max(initial=0) * width > BLOCK_ENTRIES and blocks < ranges:
        blocks = min(ranges, blocks * -(-int(most.max()) * width // BLOCK_ENTRIES))
        block_of = np.arange(ranges, dtype=np.int64) * blocks // ranges
        total, most = _entries_of_blocks(packed, column, block_of)
    least = 2 * rows.sparkSession.sparkContext.defaultParallelism
    limit, wave, sent, size = max(WAVE_ENTRIES, WAVE_TIMES * n_rows) // width, np.zeros(len(total), np.int64), 0, 0
    for b in range(1, len(total)):
        sent, size = sent + total[b - 1], size + 1
        full = sent + total[b] > limit and size >= least
        wave[b] = wave[b - 1] + full
        sent, size = (0, 0) if full else (sent, size)
    found = []
    for w in range(int(wave[-1]) + 1):
        own_blocks = _sent(packed, by, column, np.where(wave[block_of] == w, block_of, -1), own_columns, list_columns)
        mapped = _mapped(own_blocks.repartition(min(int((wave == w).sum()) * (2 if by else 1), MOST_TASKS), *by, "block"), by, work, fields)
        found.append(mapped if w == wave[-1] else cut_lineage(mapped))
    return reduce(DataFrame.unionByName, found)


def _entries(table: pa.Table, name: str) -> tuple[np.ndarray, pa.Array]:
    """Lengths and joined entries of a column of lists."""
    lists = table.column(name).combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    return pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()


def _numbers(values: pa.Array) -> np.ndarray:
    return values.cast(pa.float64()).to_numpy(zero_copy_only=False)


def _coded(*parts: pa.Array) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct values in their order, and the place of every entry among them."""
    found = pa.concat_arrays(parts).dictionary_encode(null_encoding="encode")
    order = pc.array_sort_indices(found.dictionary, null_placement="at_start")
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    codes = place[found.indices.to_numpy()]
    return found.dictionary.take(order), np.split(codes, np.cumsum([len(p) for p in parts])[:-1])


def _steps(target: np.ndarray, meets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of whole targets (sorted) that meet about ``STEP_PAIRS`` entries."""
    starts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else np.zeros(0, np.int64)
    upto = np.concatenate([[0], np.cumsum(meets)])
    step = upto[starts] // STEP_PAIRS
    cuts = starts[np.concatenate([[True], step[1:] != step[:-1]])] if len(starts) else starts
    yield from zip(cuts.tolist(), [*cuts[1:].tolist(), len(target)], strict=True)


def _met(begin: np.ndarray, meets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own entry and met entry of every pair, of entries that meet ``meets`` listed ones from ``begin`` on."""
    own = np.repeat(np.arange(len(meets)), meets)
    return own, np.arange(len(own)) + np.repeat(begin - (np.cumsum(meets) - meets), meets)


def _ranked(group: np.ndarray, value: np.ndarray, tie: np.ndarray | None, k: int) -> np.ndarray:
    """Marks the k largest values of each group: with those that tie with the k-th, or by ``tie``."""
    order = np.lexsort((-value, group) if tie is None else (tie, -value, group))
    first = np.concatenate([[True], np.diff(group[order]) != 0]) if len(order) else np.zeros(0, bool)
    place = np.arange(len(order))
    rank = place - np.maximum.accumulate(np.where(first, place, 0))
    if tie is None:  # a value equal to the one before it has its rank
        changed = first | np.concatenate([[True], np.diff(value[order]) != 0])[: len(order)]
        rank = np.maximum.accumulate(np.where(changed, place, 0)) - np.maximum.accumulate(np.where(first, place, 0))
    kept = np.zeros(len(order), bool)
    kept[order[rank < k]] = True
    return kept


def _stable(value: np.ndarray) -> np.ndarray:
    return np.rint(value * 1e10) / 1e10


def _field(df: DataFrame, column: str, name: str) -> T.StructField:
    return T.StructField(name, df.schema[column].dataType)


def _mapped(rows: DataFrame, by: list[str], work: Callable[[Block], Iterator[list]], fields: list[T.StructField]) -> DataFrame:
    """One call of ``work`` per block; it yields columns without those of ``by``."""
    schema = T.StructType([*[rows.schema[c] for c in by], *fields])
    names = schema.names

    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = [pa.table([*[pa.repeat(k, len(columns[0])) for k in key[: len(by)]], *columns], names) for columns in work(_block(table))]
        return pa.concat_tables(parts) if parts else pa.table([pa.array([], kind) for kind in _kinds], names)

    from pyspark.sql.pandas.types import to_arrow_schema

    _kinds = to_arrow_schema(schema).types
    return rows.groupBy(*by, "block").applyInArrow(run, schema)


def near_in_blocks(
    rows: DataFrame, by: list[str], blocks: int, k: int, terms: Callable, finish: Callable, predict: bool, ties: bool = True, spent: tuple[DataFrame, ...] = ()
) -> DataFrame:
    """The k nearest of each target, ties kept: (by, target, neighbour, sim), or with ``predict`` the means of their
    values v, weighted by similarity, in the asked cells: (by, target, other, prediction).

    ``rows`` is (by, other, entity, own, listed, x), with ``predict`` also (v, rated, asked, mean), of which ``mean`` is added to
    the prediction of a cell. ``terms`` of two x are summed over the common columns of a pair, ``finish`` makes the similarity
    of the sum and one x of each side. Without ``ties``, similarities are not rounded, and equal ones go in the order of
    the neighbour.
    """

    def work(block: Block) -> Iterator[list]:
        n_len, others = block.length, block.column
        ids, (t_code, n_code) = _coded(_plain(block.own.column("entity")), _plain(block.listed.column("entity")))
        order = np.argsort(t_code, kind="stable")
        t_code, t_row = t_code[order], block.row[order]
        t_x, n_x = _numbers(_plain(block.own.column("x")))[order], _numbers(_plain(block.listed.column("x")))
        rated, asked, mean = (_numbers(_plain(block.own.column(c)))[order] if predict else np.ones(len(order)) for c in ("rated", "asked", "mean"))
        n_v = _numbers(_plain(block.listed.column("v"))) if predict else None
        n_begin = np.cumsum(n_len) - n_len
        for low, high in _steps(t_code, n_len[t_row]):
            own, at = _met(n_begin[t_row[low:high]], n_len[t_row[low:high]])
            own += low
            other_one = t_code[own] != n_code[at]
            own, at = own[other_one], at[other_one]
            pair, back = np.unique(t_code[own] * len(ids) + n_code[at], return_inverse=True)
            both = rated[own] > 0
            total = np.bincount(back[both], terms(t_x[own[both]], n_x[at[both]]), len(pair))
            some = np.zeros(len(pair), np.int64)
            some[back[both]] = np.flatnonzero(both)  # any pair of entries: what finish reads is the same in all
            counted = np.bincount(back[both], minlength=len(pair)) > 0
            sim = finish(total, t_x[own[some]], n_x[at[some]]) if len(pair) else total
            sim = _stable(sim) if ties else sim
            sim = np.where(sim == 0, TINY, sim)
            good = np.flatnonzero(counted & ~np.isnan(sim))
            kept = good[_ranked(pair[good] // len(ids), sim[good], None if ties else pair[good] % len(ids), k)]
            if not predict:
                yield [ids.take(pa.array(pair[kept] // len(ids))), ids.take(pa.array(pair[kept] % len(ids))), pa.array(sim[kept])]
                continue
            near = np.zeros(len(pair), bool)
            near[kept] = True
            used = near[back] & (asked[own] > 0)
            own, at, weight = own[used] - low, at[used], sim[back[used]]
            over = np.bincount(own, n_v[at] * weight, high - low)
            under = np.bincount(own, np.abs(weight), high - low)
            cells = np.flatnonzero((under != 0) & ~np.isnan(under) & (np.bincount(own, minlength=high - low) > 0))
            _, first = np.unique(t_code[cells + low] * len(n_len) + t_row[cells + low], return_index=True)
            cells = cells[first]
            yield [ids.take(pa.array(t_code[cells + low])), others.take(pa.array(t_row[cells + low])), pa.array(over[cells] / under[cells] + mean[cells + low])]

    double = T.DoubleType()
    own = _field(rows, "entity", "target")
    if predict:
        fields = [own, _field(rows, "other", "other"), T.StructField("prediction", double)]
        return _in_waves(rows, by, "other", "entity", blocks, ["entity", "x", "rated", "asked", "mean"], ["entity", "x", "v"], work, fields, spent=spent)
    fields = [own, _field(rows, "entity", "neighbour"), T.StructField("sim", double)]
    return _in_waves(rows, by, "other", "entity", blocks, ["entity", "x"], ["entity", "x"], work, fields, spent=spent)


def basket_items_in_blocks(
    rows: DataFrame, blocks: int, k: int, ties: bool, same_orders: bool, unseen: bool, n: int | None, spent: tuple[DataFrame, ...] = ()
) -> DataFrame:
    """(basket_id, item, n, support_sim) of the items that the k nearest orders of each basket hold.

    ``rows`` is (item, id, fold, size, items, own, listed): of baskets (``own``), and of orders (``listed``) with all items of
    the order. A basket sees orders of other folds, or with ``same_orders`` all but itself. ``unseen`` leaves out what
    the basket holds, and ``n`` keeps as many items with the largest support, equal ones in the order of the item.
    """

    def work(block: Block) -> Iterator[list]:
        n_len = block.length
        held_len, held = _nested(_plain(block.listed.column("items")))
        ids, (t_code, n_code) = _coded(_plain(block.own.column("id")), _plain(block.listed.column("id")))
        orders, baskets_of = ids, ids
        items, (held_code, own_code) = _coded(held, block.column.cast(held.type))
        sort = np.argsort(t_code, kind="stable")
        t_code, t_row = t_code[sort], block.row[sort]
        t_fold, t_size = (_numbers(_plain(block.own.column(c)))[sort] for c in ("fold", "size"))
        n_fold, n_size = (_numbers(_plain(block.listed.column(c))) for c in ("fold", "size"))
        held_begin, n_begin = np.cumsum(held_len) - held_len, np.cumsum(n_len) - n_len
        for low, high in _steps(t_code, n_len[t_row]):
            own, at = _met(n_begin[t_row[low:high]], n_len[t_row[low:high]])
            own += low
            sees = t_code[own] != n_code[at] if same_orders else t_fold[own] != n_fold[at]
            own, at = own[sees], at[sees]
            pair, first, overlap = np.unique(t_code[own] * len(orders) + n_code[at], return_index=True, return_counts=True)
            own, at = own[first], at[first]
            sim = overlap / np.sqrt(t_size[own] * n_size[at])
            near = np.flatnonzero(_ranked(t_code[own], sim, None if ties else n_code[at], k))
            own, at, sim = own[near], at[near], sim[near]
            from_pair, place = _met(held_begin[at], held_len[at])
            cell, back = np.unique(t_code[own[from_pair]] * len(items) + held_code[place], return_inverse=True)
            support, count = _stable(np.bincount(back, sim[from_pair], len(cell))), np.bincount(back, minlength=len(cell))
            kept = np.ones(len(cell), bool)
            if unseen:
                kept = ~np.isin(cell, t_code[low:high] * len(items) + own_code[t_row[low:high]])
            cell, support, count = cell[kept], support[kept], count[kept]
            if n is not None:
                best = _ranked(cell // len(items), support, cell % len(items), n)
                cell, support, count = cell[best], support[best], count[best]
            whose = baskets_of.take(pa.array(cell // max(len(items), 1)))
            yield [whose, items.take(pa.array(cell % max(len(items), 1))), pa.array(count, pa.int64()), pa.array(support)]

    fields = [_field(rows, "id", "basket_id"), _field(rows, "item", "item"), T.StructField("n", T.LongType()), T.StructField("support_sim", T.DoubleType())]
    return _in_waves(rows, [], "item", "id", blocks, ["id", "fold", "size"], ["id", "fold", "size", "items"], work, fields, width=2, spent=spent)


def summed_in_blocks(given: DataFrame, sims: DataFrame, n: int, k: int) -> DataFrame:
    """(basket_id, item, score, rank): the n candidates with the largest sums of similarity to the items of a basket that it does not hold.

    ``given`` is (basket_id, item, fold), ``sims`` (fold, item, candidate, sim) with about k candidates of an item.
    """
    own = given.select("fold", "item", "basket_id").withColumns({"own": F.lit(True), "listed": F.lit(False), "sim": F.lit(None).cast("double")})
    own = own.withColumn("candidate", F.lit(None).cast(sims.schema["candidate"].dataType))
    rows = sims.select("fold", "item", "candidate", "sim").withColumns({"own": F.lit(False), "listed": F.lit(True)})
    rows = rows.withColumn("basket_id", F.lit(None).cast(given.schema["basket_id"].dataType)).unionByName(own)

    def work(block: Block) -> Iterator[list]:
        ids, (t_code,) = _coded(_plain(block.own.column("basket_id")))
        items, (cand_code, own_code) = _coded(_plain(block.listed.column("candidate")), block.column)
        sim, begin = _numbers(_plain(block.listed.column("sim"))), np.cumsum(block.length) - block.length
        order = np.argsort(t_code, kind="stable")
        t_code, t_row = t_code[order], block.row[order]
        named = np.array([i.is_valid for i in ids], bool) if ids.null_count else np.ones(len(ids), bool)
        for low, high in _steps(t_code, block.length[t_row]):
            own, at = _met(begin[t_row[low:high]], block.length[t_row[low:high]])
            cell, back = np.unique(t_code[own + low] * len(items) + cand_code[at], return_inverse=True)
            score = _stable(np.bincount(back, sim[at], len(cell)))
            holds = named[t_code[low:high]]  # a basket without an id holds nothing that could be left out
            unseen = ~np.isin(cell, (t_code[low:high] * len(items) + own_code[t_row[low:high]])[holds])
            cell, score = cell[unseen], score[unseen]
            basket = cell // max(len(items), 1)
            best = np.lexsort((cell, -score, basket))
            place = np.arange(len(best))
            first = np.concatenate([[True], np.diff(basket[best]) != 0])[: len(best)]
            rank = place - np.maximum.accumulate(np.where(first, place, 0)) if len(best) else place
            best, rank = best[rank < n], rank[rank < n]
            yield [ids.take(pa.array(basket[best])), items.take(pa.array(cell[best] % max(len(items), 1))), pa.array(score[best]), pa.array((rank + 1).astype(np.int32))]

    fields = [_field(given, "basket_id", "basket_id"), _field(sims, "candidate", "item"), T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())]
    least = 2 * given.sparkSession.sparkContext.defaultParallelism
    blocks = min(max(k * given.count() // BLOCK_PAIRS + 1, least), MOST_TASKS)
    found = _in_waves(rows, ["fold"], "item", "basket_id", blocks, ["basket_id"], ["candidate", "sim"], work, fields, spent=(sims,))
    return found.drop("fold")


def _nested(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    return pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()
