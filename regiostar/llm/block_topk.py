"""Exact top-k search by inner product: branch and bound over dimension blocks in a vertical layout.

Rows are packed into blocks of a fixed number of vectors. Each query block meets every candidate block in a cell of a
grid (a few query blocks by a candidate block, a bounded amount of work and memory). Blocks are dealt to the cells by a
shuffle, not by a join, which would broadcast every copy of the query blocks as long as their files are small. In a
cell, scores accumulate
one block of dimensions at a time over column-major components. After each block, what the remaining dimensions can
add is bounded by the product of the remaining norms (Cauchy-Schwarz); candidates whose upper bound lies below the
k-th best lower bound leave, and the survivors are compacted before the next block.

Defined results: vectors that are null or hold a null or non-finite component take no part; components are
floor(256 * x) in whole numbers; a shorter vector counts as padded with zeros; ties go to the smaller id, repeated ids each
count as a row, but never against a query with the same id, and repeated queries are answered once; a null id takes no part. Whole-number scores beyond 64 bits are
not defined. Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from regiostar.session import materialize

QUERY_ROWS, CANDIDATE_ROWS, DIMENSIONS = 512, 4096, 8
QUERY_BLOCKS = 8  # query blocks in a cell
PACKED = "block long, ids binary, dims int, data binary"


def whole_vectors(df: DataFrame, id_column: str, vector_column: str, scale: int = 256) -> DataFrame:
    """Columns id, v (array of longs) of the rows that take part."""
    x = F.col(f"`{vector_column}`")
    finite = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return df.where(finite & F.col(f"`{id_column}`").isNotNull()).select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"),
    )


def packed(vectors: DataFrame, rows: int, blocks: int) -> DataFrame:
    """Numbered blocks of at most ``rows`` vectors as little-endian matrices of the narrowest integers that hold them, component by component.

    The number changes if the blocks are computed again, so they must be written once.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), rows):
                ids = batch.column(0).slice(at, rows).to_numpy()
                lists = batch.column(1).slice(at, rows)
                lengths = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy()
                dims = int(lengths.max(initial=0))
                matrix = np.zeros((len(ids), dims), "<i8")
                matrix[np.arange(dims) < lengths[:, None]] = flat
                low, high = int(matrix.min(initial=0)), int(matrix.max(initial=0))
                width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0], pa.int64()), pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([dims], pa.int32()), pa.array([matrix.T.astype(f"<i{width}", order="C").tobytes()], pa.binary())],
                    ["block", "ids", "dims", "data"],
                )

    spread = vectors.repartition(blocks, F.xxhash64("id", "v"))
    return spread.mapInArrow(pack, PACKED).withColumn("block", F.monotonically_increasing_id())


def _dealt(groups: int) -> Column:
    """A group for each block number. The blocks of a partition follow one another, so equal rows, which share a partition, spread too."""
    block = F.col("block")
    return F.pmod(F.shiftright(block, 33) + block.bitwiseAND(F.lit((1 << 33) - 1)), F.lit(groups))


def _every(groups: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))


def _matrix(ids: bytes, dims: int, data: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, "<i8")
    matrix = np.zeros((width, len(found)), np.int64)
    matrix[:dims] = np.frombuffer(data, f"<i{len(data) // max(1, dims * len(found)) or 8}").reshape(dims, len(found))
    return found, matrix


def best(queries: np.ndarray, q: np.ndarray, candidates: np.ndarray, c: np.ndarray, k: int, step: int = DIMENSIONS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its k best (id, score) among the candidates; q and c are dimension by row."""
    width = len(q)
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(width, 1)
    kind = np.float64 if largest < 2.0**52 else np.int64  # sums of whole doubles are exact below
    q, c = q.astype(kind), c.astype(kind)
    cuts = list(range(step, width, step))

    def rest(m):
        squares = np.cumsum((m.astype(np.float64) ** 2)[::-1], axis=0)[::-1]
        return [np.sqrt(squares[x]) * (1 + 1e-9) for x in cuts]

    rest_q, rest_c = rest(q), rest(c)
    first = q[: cuts[0] if cuts else width].T @ c[: cuts[0] if cuts else width]
    order = np.argsort(candidates, kind="stable")
    for i, query in enumerate(queries):
        alive = order[candidates[order] != query]
        score = first[i, alive]
        for n, cut in enumerate(cuts):
            bound = rest_q[n][i] * rest_c[n][alive] + 1
            if len(alive) > k:
                floor = np.partition(score - bound, len(alive) - k)[len(alive) - k]
                keep = score + bound >= floor
                alive, score = alive[keep], score[keep]
            stop = cuts[n + 1] if n + 1 < len(cuts) else width
            score = score + q[cut:stop, i] @ c[cut:stop, alive]
        top = np.lexsort((candidates[alive], -score))[:k]
        yield i, candidates[alive[top]], score[top].astype(np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, query_rows: int = QUERY_ROWS, candidate_rows: int = CANDIDATE_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` for every row of ``queries`` (both id, v)."""
    queries = queries.dropDuplicates(["id", "v"])
    left, right = queries.count(), vectors.count()
    q = materialize(packed(queries, query_rows, max(1, -(-left // query_rows))), "query-blocks")
    c = materialize(packed(vectors, candidate_rows, max(1, -(-right // candidate_rows))), "vector-blocks")
    rows, columns = max(1, -(-left // (query_rows * QUERY_BLOCKS))), max(1, -(-right // candidate_rows))
    packing = ("block", "ids", "dims", "data")
    asked = q.select(F.lit(True).alias("asks"), _dealt(rows).alias("row"), _every(columns).alias("column"), *packing)
    offered = c.select(F.lit(False).alias("asks"), _every(rows).alias("row"), _dealt(columns).alias("column"), *packing)
    cells = asked.unionByName(offered).repartition(rows * columns, "row", "column")

    def search(cell: pa.Table) -> pa.Table:
        blocks = cell.to_pylist()
        found = []
        for there in (b for b in blocks if not b["asks"]):
            for here in (b for b in blocks if b["asks"]):
                width = max(here["dims"], there["dims"])
                asked, q = _matrix(here["ids"], here["dims"], here["data"], width)
                ids, c = _matrix(there["ids"], there["dims"], there["data"], width)
                found += [(np.full(len(top), here["block"]), np.full(len(top), i), np.full(len(top), asked[i]), top, score) for i, top, score in best(asked, q, ids, c, k)]
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 5
        return pa.table([pa.array(x, pa.int64()) for x in columns], ["q_block", "q_row", "query_id", "vec_id", "score"])

    found = cells.groupBy("row", "column").applyInArrow(search, "q_block long, q_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("q_block", "q_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast(T.IntegerType()), "vec_id", "score")
