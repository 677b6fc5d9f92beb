"""All pairs of clusters of rows, by packed cells.

The rows of a cell are one record. Every cell of one side meets every cell of the other in a Cartesian product, which reads
the two packed tables and shuffles no copies of rows. A cluster lies in one cell unless it has more rows than a cell; the
clusters of a cell are folded from their rows by whole columns, because their rows are laid out member by member.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.functions.blocks import as_matrix
from lodestat.session import settle

LONG = 32  # clusters of more rows are folded one by one, the others member by member
TILE = 256  # rows of a cell whose distances to another cell are made at a time
PART_BYTES = 16 << 20  # of vectors in a partition of packed cells

_CELL = "cell int, part boolean, names binary, sizes binary, x binary"
_FOUND = "comp bigint, other bigint, d double, whole boolean"


def items_table(rows: DataFrame, names: np.ndarray) -> DataFrame:
    """Rows (id, v, w, comp) written once as (item, id, w, x): the place of comp in the sorted names, and v as bytes."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                item = np.searchsorted(names, batch.column("comp").to_numpy())
                x = as_matrix(batch.column("v"))
                raw = pa.py_buffer(np.ascontiguousarray(x).tobytes())
                ends = pa.py_buffer((np.arange(len(x) + 1) * x.shape[1] * 8).astype(np.int32).tobytes())
                packed = pa.Array.from_buffers(pa.binary(), len(x), [None, ends, raw])
                yield pa.RecordBatch.from_arrays([pa.array(item), batch.column("id"), batch.column("w"), packed], ["item", "id", "w", "x"])

    return settle(rows.select("id", "v", "w", "comp").mapInArrow(convert, "item bigint, id bigint, w double, x binary"))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of bytes of equally many numbers as a matrix."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    width = np.unique(np.diff(ends))
    if len(width) != 1:
        raise ValueError("vectors differ in length")
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.float64).reshape(len(column), -1)


def places(sizes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Cells of at most 2 x rows for clusters of these sizes: (first cell, number of cells) of each, and all cells."""
    split = sizes > rows
    first, parts = np.zeros(len(sizes), np.int64), np.where(split, -(-sizes // rows), 1)
    whole = sizes[~split]
    first[~split] = (np.cumsum(whole) - whole) // rows
    cells = int(first[~split].max()) + 1 if len(whole) else 0
    first[split] = cells + np.cumsum(parts[split]) - parts[split]
    return first, parts, cells + int(parts[split].sum())


def runs(sizes: np.ndarray) -> np.ndarray:
    """Runs of about TILE rows for the clusters of a left cell, which are folded run by run: their numbers stay in the cache."""
    return (np.cumsum(sizes) - sizes) // TILE


def pack(base: DataFrame, placed, cells: int, partitions: int, left: bool) -> DataFrame:
    """Cells of the rows of ``base`` whose item has one. ``placed``: broadcast (first cell or -1, cells, cluster, weight) by item.

    The product of a left and a right row is their squared distance, times the squares of their shares of their clusters."""

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, parts, comp, weight = placed.value
        for batch in batches:
            item = batch.column("item").to_numpy()
            kept = np.flatnonzero(first[item] >= 0)
            if len(kept):
                batch, item = (batch, item) if len(kept) == len(item) else (batch.take(pa.array(kept)), item[kept])
                mixed = (batch.column("id").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                cell = first[item] + (mixed % parts[item].astype(np.uint64)).astype(np.int64)
                share = batch.column("w").to_numpy() / weight[item]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(parts[item] > 1), pa.array(comp[item]), pa.array(share), batch.column("x")],
                    ["cell", "part", "comp", "share", "x"],
                )

    def one(cell: int, batch: pa.Table) -> pa.RecordBatch:
        comp, share = batch["comp"].to_numpy(), batch["share"].to_numpy()
        names, group, sizes = np.unique(comp, return_inverse=True, return_counts=True)
        by = np.argsort(-sizes, kind="stable")  # clusters by falling size
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        order = np.argsort(rank[group], kind="stable")
        group, sizes = rank[group][order], sizes[by]
        member = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        long = sizes[group] > LONG
        run = runs(sizes)[group] if left else np.zeros(len(group))
        order = order[np.lexsort((np.where(long, member, group), np.where(long, group, member), ~long, run))]
        x = np.concatenate([matrix(c) for c in batch["x"].chunks])[order]
        square, ones = (x * x).sum(1)[:, None], np.ones((len(x), 1))
        x = np.hstack([-2.0 * x, square, ones] if left else [x, ones, square]) * np.square(share[order])[:, None]
        cells = [names[by].astype(np.int64), sizes.astype(np.int64), x]
        return pa.RecordBatch.from_arrays(
            [pa.array([cell], pa.int32()), pa.array([bool(batch["part"][0].as_py())]), *[pa.array([c.tobytes()], pa.binary()) for c in cells]],
            ["cell", "part", "names", "sizes", "x"],
        )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1), len(cell)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if last is not None and cell[begin] != last:
                    yield one(last, pa.Table.from_batches(held))
                    held = []
                last = int(cell[begin])
                held.append(batch.slice(begin, end - begin))
        if held:
            yield one(last, pa.Table.from_batches(held))

    tagged = base.mapInArrow(tag, "cell int, part boolean, comp bigint, share double, x binary")
    partitions = max(1, min(cells, partitions))
    dealt = tagged.repartitionById(partitions, F.pmod("cell", F.lit(partitions)).cast("int")).sortWithinPartitions("cell")
    return dealt.mapInArrow(gather, _CELL)


def fold(m: np.ndarray, sizes: np.ndarray, op: np.ufunc) -> np.ndarray:
    """Rows of m, laid out by ``pack``, folded to clusters in place."""
    if sizes[0] == 1:
        return m
    long, at = int((sizes > LONG).sum()), 0
    for j, size in enumerate(sizes[:long]):
        m[j] = op.reduce(m[at : at + size], axis=0)
        at += size
    short = sizes[long:]
    if len(short):
        if long:
            m[long : len(sizes)] = m[at : at + len(short)]
        at += len(short)
        for member in range(1, short[0]):
            more = int(np.searchsorted(-short, -member))  # clusters of more than ``member`` rows
            op(m[long : long + more], m[at : at + more], out=m[long : long + more])
            at += more
    return m[: len(sizes)]


class _Scratch:
    """Memory that a task uses again for the next pair of cells: fresh pages cost more than the numbers written to them."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def take(self, name: str, rows: int, columns: int) -> np.ndarray:
        if name not in self.held or self.held[name].size < rows * columns:
            self.held[name] = np.empty(rows * columns)
        return self.held[name][: rows * columns].reshape(rows, columns)


def _distances(a: dict, b: dict, linkage: str, scratch: _Scratch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Names of clusters of a, and what the cells know of their distances to the clusters of b: squares for complete linkage."""
    op, other, begin = np.maximum if linkage == "complete" else np.add, b["x"].T, 0
    cuts = [0, *(np.flatnonzero(np.diff(runs(a["sizes"]))) + 1), len(a["sizes"])]
    for first, last in zip(cuts, cuts[1:]):
        sizes = a["sizes"][first:last]
        end = begin + int(sizes.sum())
        d = np.matmul(a["x"][begin:end], other, out=scratch.take("tile", end - begin, other.shape[1]))
        if linkage != "complete":
            np.maximum(d, 0.0, out=d)
            np.sqrt(d, out=d)
        yield a["names"][first:last], fold(fold(d.T, b["sizes"], op).T, sizes, op)
        begin = end


def _length(value: np.ndarray, linkage: str) -> np.ndarray:
    return np.sqrt(np.maximum(value, 0.0)) if linkage == "complete" else value


def _nearest(d: np.ndarray, b: np.ndarray, linkage: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, rounded distance) of the nearest cluster of each row; of equal distances the smallest name. Changes d."""
    rows = np.arange(len(d))
    at = d.argmin(1)
    low = d[rows, at]
    d[rows, at] = np.inf
    tied = np.flatnonzero(_length(d.min(1), linkage) <= _length(low, linkage) + 2e-9)
    d[rows, at] = low
    low = np.round(_length(low, linkage), 9)
    for r in tied[np.isfinite(low[tied])]:
        same = np.flatnonzero(np.round(_length(d[r], linkage), 9) == low[r])
        at[r] = same[b[same].argmin()]
    here = np.flatnonzero(np.isfinite(low))
    return here, at[here], low[here]


def _meet(linkage: str, every: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def side(batch: pa.RecordBatch, r: int, tag: str) -> dict:
        number = lambda c, t: np.frombuffer(batch.column(f"{c}_{tag}")[r].as_buffer(), t)
        sizes = number("sizes", np.int64)
        return {
            "names": number("names", np.int64), "sizes": sizes, "x": number("x", np.float64).reshape(sizes.sum(), -1),
            "part": batch.column(f"part_{tag}")[r].as_py(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scratch = _Scratch()
        for batch in batches:
            for r in range(batch.num_rows):
                a, b = side(batch, r, "a"), side(batch, r, "b")
                parts = a["part"] or b["part"]
                for names, d in _distances(a, b, linkage, scratch):
                    if every or parts:
                        i, j = np.nonzero(names[:, None] < b["names"] if every else names[:, None] != b["names"])
                        value = _length(d[i, j], linkage)
                    else:
                        _, i, j = np.intersect1d(names, b["names"], assume_unique=True, return_indices=True)
                        d[i, j] = np.inf
                        i, j, value = _nearest(d, b["names"], linkage)
                    if len(i):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(names[i]), pa.array(b["names"][j]), pa.array(value), pa.array(np.full(len(i), not parts))],
                            ["comp", "other", "d", "whole"],
                        )

    return run


def cluster_distances(
    base: DataFrame, width: int, label: np.ndarray, sizes: np.ndarray, weight: np.ndarray, asked: np.ndarray, linkage: str,
    block: int, every: bool = False,
) -> pa.Table:
    """Nearest other cluster (comp, other, d) of each asked one, or with ``every`` all pairs comp < other of clusters.

    ``label`` names the cluster of each item of ``base``, whose vectors have ``width`` numbers; sizes, weights and ``asked`` are by cluster, a size of 0 is none.
    """
    spark = base.sparkSession
    cores, broadcasts, tables = spark.sparkContext.defaultParallelism, [], []
    for left, rows in ((True, max(1, block // 2)), (False, block)):
        live = np.flatnonzero((sizes > 0) & asked if left else sizes > 0)
        first, parts = np.full(len(sizes), -1, np.int64), np.ones(len(sizes), np.int64)
        first[live], parts[live], cells = places(sizes[live], rows)
        shares = weight[label] if linkage == "average" else np.ones(len(label))
        broadcasts.append(spark.sparkContext.broadcast((first[label], parts[label], label, shares)))
        partitions = max(3 if left else 2 * cores, int(sizes[live].sum()) * 8 * (width + 2) // PART_BYTES)
        table = pack(base, broadcasts[-1], cells, partitions, left).persist(StorageLevel.MEMORY_AND_DISK)
        tables.append(table)
    both = [t.select(*[F.col(c).alias(f"{c}_{tag}") for c in t.columns if c != "cell"]) for t, tag in zip(tables, "ab")]
    found = both[0].crossJoin(both[1].hint("shuffle_replicate_nl")).mapInArrow(_meet(linkage, every), _FOUND)
    value = F.max("d") if linkage == "complete" else F.when(F.col("whole"), F.max("d")).otherwise(F.sum("d"))
    pairs = found.groupBy("comp", "other", "whole").agg(F.round(value, 9).alias("d"))
    if not every:
        if sizes.max() <= max(1, block // 2):  # no cluster is split
            pairs = found
        best = pairs.groupBy("comp").agg(F.min(F.struct("d", "other")).alias("e"))
        pairs = best.select("comp", "e.other", "e.d")
    try:
        return pairs.select("comp", "other", "d").toArrow()
    finally:
        for table in tables:
            table.unpersist()
        for b in broadcasts:
            b.destroy()


__all__ = ["cluster_distances", "items_table"]
