"""Approximate nearest neighbours over shifted space-filling curves.

Each of several curves has its own random projection to a few dimensions and its own shift; a
projected vector's place on a Hilbert curve is its key. Range partitions put all vectors of a curve in key
order and give each its rank. A query is compared with the vectors whose rank differs from its own by at most
the window, on every curve, and the results of all curves merge into the nearest ones, by exact distance.

How wide the window has to be depends on the data: near-uniform vectors of many dimensions need
far more than clustered ones. It is measured: a bounded sample of the queries is compared with all rows, and
the window is what finds TARGET of their true neighbours.

Equal vectors are searched once and hold one place on a curve: of each, the k + 1 smallest ids are
kept, which is all that can be asked of it, so copies cannot crowd others out of a window.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no
part, neither do those of another length than most (of the shorter, if lengths are equally frequent) and rows
without id. Ties go to the smaller id, repeated rows of an id and vector count once, an id with several vectors is
a candidate with each. An empty table, or one without queries, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm.common import checkpointed, parts_for
from reelhouse.operators.ranking import rank_in_groups

CURVES, DIMENSIONS, BITS = 8, 8, 7
#: Vectors from which the scale of each projected dimension is learnt, and queries that are compared with all rows.
FIT_ROWS, MEASURED_QUERIES = 4000, 64
TARGET = 0.96
#: Vectors of a block: neighbours on a curve that are compared in one go.
BLOCK = 2048
SEED = 20240


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells (n, dimensions), each below 2**bits.

    Axes are turned into the curve's transposed index bit plane by bit plane, from the highest
    (J. Skilling, "Programming the Hilbert curve", 2004), for all cells at once.
    """
    axes = cells.T.astype(np.uint64)
    count = len(axes)
    for bit in range(bits - 1, 0, -1):
        mask = np.uint64(1 << bit)
        below = mask - np.uint64(1)
        for number in range(count):
            set_here = (axes[number] & mask) != 0
            swapped = np.where(set_here, np.uint64(0), (axes[0] ^ axes[number]) & below)
            axes[0] ^= np.where(set_here, below, swapped)
            if number:
                axes[number] ^= swapped
    for number in range(1, count):
        axes[number] ^= axes[number - 1]
    turned = np.zeros_like(axes[0])
    for bit in range(bits - 1, 0, -1):
        mask = np.uint64(1 << bit)
        turned ^= np.where((axes[-1] & mask) != 0, mask - np.uint64(1), np.uint64(0))
    axes ^= turned
    keys = np.zeros(axes.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            keys = (keys << np.uint64(1)) | ((axis >> np.uint64(bit)) & np.uint64(1))
    return keys.astype(np.int64)


class Curves:
    """Projections, scales and shifts of all curves, learnt from a bounded sample."""

    def __init__(self, sample: np.ndarray, curves: int = CURVES, dimensions: int = DIMENSIONS, bits: int = BITS) -> None:
        random = np.random.default_rng(SEED)
        self.bits = bits
        self.projections = random.standard_normal((curves, sample.shape[1], dimensions))
        self.shifts = random.random((curves, dimensions))
        # sorted projected samples: a coordinate becomes its rank among them, so cells fill evenly
        self.scales = [np.sort(_product(sample, projection), axis=0) for projection in self.projections]

    def keys(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        projected, scale = _product(vectors, self.projections[curve]), self.scales[curve]
        places = np.stack(
            [np.searchsorted(scale[:, axis], projected[:, axis]) / len(scale) for axis in range(scale.shape[1])], axis=1
        )
        # the shifted unit cube lies in a cube twice as wide
        cells = (places + self.shifts[curve]) / 2 * (1 << self.bits)
        return hilbert_keys(np.minimum(cells.astype(np.int64), (1 << self.bits) - 1), self.bits)


def _product(vectors: np.ndarray, projection: np.ndarray) -> np.ndarray:
    return np.einsum("ij,jk->ik", vectors, projection, optimize=False)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    rows = df.select(df[id_col].cast("long").alias("vec_id"), df[vector_col].alias("vector"))
    sound = rows.where(
        F.col("vec_id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    # zeros are one value: -0.0 + 0.0 is 0.0
    sound = sound.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0).cast(_element(rows))))
    lengths = sound.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).collect()
    return sound.where(F.size("vector") == (lengths[0]["length"] if lengths else 0))


def _element(rows: DataFrame) -> str:
    return rows.schema["vector"].dataType.elementType.simpleString()


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(rep, vector, ids): each different vector with its `keep` smallest ids, the smallest naming it.

    The window keeps its first rows in each task already, so a vector that fills a third of the table
    reaches its reducer as a few rows a task.
    """
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    first = rows.dropDuplicates(["vec_id", "vector"]).withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= keep)
    return first.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("rep"), "vector", "ids"
    )


def curve_ranks(vectors: DataFrame, curves: Curves) -> DataFrame:
    """(curve, rep, place): the rank of every vector on every curve."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matrix = _matrix(batch.column("vector"))
                for curve in range(len(curves.scales)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(batch.num_rows, curve, np.int32)),
                            pa.array(curves.keys(matrix, curve)),
                            batch.column("rep"),
                        ],
                        ["curve", "key", "rep"],
                    )

    placed = vectors.select("rep", "vector").mapInArrow(keyed, "curve int, key long, rep long")
    # sorted by range over all partitions, so that no curve is sorted in one task
    ranked = rank_in_groups(placed, ["curve"], [F.col("key"), F.col("rep")], "place")
    return ranked.select("curve", "rep", (F.col("place") - 1).alias("place"))


def nearest_of_all(queries: np.ndarray, vectors: DataFrame, k: int) -> DataFrame:
    """(query, rep, square): the k nearest vectors of a few queries among all rows, by comparing all.

    Each task keeps k per query.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(queries)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, int]]] = [[] for _ in shared.value]
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix, reps = _matrix(batch.column("vector")), batch.column("rep").to_numpy()
            for held, query in zip(best, shared.value):
                held.extend(_nearest(query, matrix, reps, k))
                held.sort()
                del held[k:]
        rows = [(number, rep, square) for number, held in enumerate(best) for square, rep in held]
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(("query", "rep", "square"), map(pa.array, zip(*rows)))))

    found = vectors.select("rep", "vector").mapInArrow(compared, "query long, rep long, square double")
    return found.withColumn(
        "rank", F.row_number().over(Window.partitionBy("query").orderBy("square", "rep"))
    ).where(F.col("rank") <= k)


def _nearest(query: np.ndarray, matrix: np.ndarray, reps: np.ndarray, k: int) -> list[tuple[float, int]]:
    """(squared distance, rep) of the k nearest rows, ties to the smaller rep."""
    squares = np.square(matrix - query).sum(axis=1)
    if len(squares) > k:
        close = np.flatnonzero(squares <= np.partition(squares, k - 1)[k - 1])
    else:
        close = np.arange(len(squares))
    return sorted(zip(squares[close].tolist(), reps[close].tolist()))[:k]


def fit_window(asked: DataFrame, vectors: DataFrame, ranks: DataFrame, k: int, target: float) -> int:
    """The window that finds `target` of the true neighbours of the measured queries.

    MEASURED_QUERIES queries and k neighbours each come to the driver, whatever the size of the table. A
    query is among its own k nearest, but does not count: its gap is 0.
    """
    sample = asked.orderBy(F.xxhash64("rep"), "rep").limit(MEASURED_QUERIES).toArrow()
    if not sample.num_rows:
        return 0
    spark = asked.sparkSession
    queries = _matrix(sample["vector"].combine_chunks())
    nearest = [(sample["rep"][row["query"]].as_py(), row["rep"]) for row in nearest_of_all(queries, vectors, k).collect()]
    truth = [(query, rep) for query, rep in nearest if rep != query]
    if not truth:
        return 0
    pairs = F.broadcast(spark.createDataFrame(truth, "query long, rep long"))
    here = ranks.join(pairs, "rep").select("query", "rep", "curve", "place")
    own = ranks.join(pairs.select("query").distinct(), ranks["rep"] == F.col("query")).select(
        "query", "curve", F.col("place").alias("own")
    )
    gaps = [
        row["gap"]
        for row in here.join(own, ["query", "curve"])
        .groupBy("query", "rep")
        .agg(F.min(F.abs(F.col("place") - F.col("own"))).alias("gap"))
        .collect()
    ]
    return int(np.quantile(gaps, target, method="higher"))


def search(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    target: float = TARGET,
    window: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors found for each query.

    `is_query` is a condition on `vec_id`; a query is not its own neighbour. `window` sets the ranks looked
    at on either side instead of measuring them.
    """
    spark = df.sparkSession
    rows = usable(df, id_col, vector_col)
    vectors = checkpointed(distinct_vectors(rows, k + 1))
    sample = vectors.orderBy(F.xxhash64("rep"), "rep").limit(FIT_ROWS).select("vector").toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    curves = Curves(_matrix(sample["vector"].combine_chunks()))
    ranks = checkpointed(curve_ranks(vectors, curves))

    # every query with the name of its vector, and each asked vector once
    queries = rows.where(is_query).distinct().join(vectors.select("rep", "vector"), "vector").select("vec_id", "rep")
    asked = queries.select("rep").distinct().join(vectors, "rep").select("rep", "vector")
    if window is None:
        window = fit_window(asked, vectors, ranks, k + 1, target)

    found = _in_windows(ranks, vectors.select("rep", "vector"), asked, window, k + 1)
    closest = (
        found.join(vectors.select("rep", "ids"), "rep")
        .select("query", "square", F.explode("ids").alias("vec_id"))
        .withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("square", "vec_id")))
        .where(F.col("place") <= k + 1)
        .groupBy("query")
        .agg(F.sort_array(F.collect_list(F.struct("square", "vec_id"))).alias("closest"))
    )
    others = F.filter("closest", lambda near: near["vec_id"] != F.col("query_id"))
    return (
        queries.select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query"))
        .join(closest, "query")
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "near"))
        .select(
            "query_id",
            (F.col("place") + 1).alias("rank"),
            F.col("near.vec_id").alias("vec_id"),
            F.sqrt("near.square").alias("score"),
        )
    )


def _in_windows(ranks: DataFrame, vectors: DataFrame, asked: DataFrame, window: int, k: int) -> DataFrame:
    """(query, rep, square): the k nearest of each window and block; pairs met on several curves once."""
    names = "curve", "block", "kind", "place", "rep", "vector"
    held = ranks.join(vectors, "rep").select(
        "curve", F.floor(F.col("place") / BLOCK).alias("block"), F.lit(0).alias("kind"), "place", "rep", "vector"
    )
    place = F.col("place")
    sent = ranks.join(asked, "rep").select(
        "curve",
        F.explode(
            F.sequence(F.floor(F.greatest(place - window, F.lit(0)) / BLOCK), F.floor((place + window) / BLOCK))
        ).alias("block"),
        F.lit(1).alias("kind"),
        "place",
        "rep",
        "vector",
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by block, its vectors in curve order before the queries sent to it."""
        at, parts, matrix, reps, first = None, [], None, None, 0
        for batch in batches:
            rows = []
            keys = np.stack([batch.column(name).to_numpy() for name in ("curve", "block", "kind")], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys)]
            for begin, end in zip(edges, edges[1:]):
                if begin == end:
                    continue
                curve, block, kind = keys[begin].tolist()
                if (curve, block) != at:
                    at, parts, matrix = (curve, block), [], None
                run = batch.slice(begin, end - begin)
                if kind == 0:
                    parts.append(run)
                    continue
                if not parts:
                    continue  # past the end of the curve
                if matrix is None:
                    matrix = np.concatenate([_matrix(part.column("vector")) for part in parts])
                    reps = np.concatenate([part.column("rep").to_numpy() for part in parts])
                    first = parts[0].column("place")[0].as_py()
                for query, place, vector in zip(
                    run.column("rep").to_pylist(), run.column("place").to_pylist(), _matrix(run.column("vector"))
                ):
                    lo, hi = max(0, place - window - first), max(0, place + window + 1 - first)
                    if lo < len(reps) and hi > 0:
                        rows.extend((query, rep, square) for square, rep in _nearest(vector, matrix[lo:hi], reps[lo:hi], k))
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(("query", "rep", "square"), map(pa.array, zip(*rows)))))

    return (
        held.unionByName(sent)
        .select(*names)
        .repartition(parts_for(ranks), "curve", "block")
        .sortWithinPartitions("curve", "block", "kind", "place")
        .mapInArrow(compared, "query long, rep long, square double")
        .groupBy("query", "rep")
        .agg(F.min("square").alias("square"))
    )
