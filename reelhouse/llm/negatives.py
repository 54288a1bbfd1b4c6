"""Hard negatives of anchors: close rows of another label, found with bounds along spanning trees of the anchors.

The score of a row is its inner product with the anchor. If p and c are anchors and x is a row, then the scores <c, x>
and <p, x> differ by at most |c - p| |x|. So the anchors of a label form a spanning tree of short edges; its root scores
all rows, and every other anchor takes its parent's bounds, widened by edge times norm. Only rows whose bounds
meet the window of scores that the anchor looks for are scored exactly, which makes their bounds exact for the anchor's children.

The window is first that of the positives (rows of the anchor's label which may still be among its best), then that of
the negatives (from LOW to HIGH percent of a positive's score, and not below what has been found already).

Rows are dealt to cells and anchors to blocks, both of bounded size and by hash. Each pair of a block and a cell is one
group: a task holds CELL rows and BLOCK anchors, and keeps a few results per anchor, so no group grows with a label, a
copied vector or the table. Anchors are compared with all rows, as they must be: on vectors without
clusters the bounds exclude little, and the work is anchors x rows.

Defined results: rows with a null id or label, a null vector, or a null, NaN or infinite component take no part, neither do
those of another length than most (of the shorter, if lengths are equally frequent). Rows equal in id, label and
vector count once; no row of the anchor's own id is its positive or negative. Components become floor(SCALE * x). Ties go to the
smaller id. An anchor id with several rows is several anchors. An empty table, or one without anchors, gives no rows;
other columns are ignored. Vectors whose squared norm exceeds 2**52 after scaling are an error: their scores would not be exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm.common import checkpointed, parts_for

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: A negative's score in percent of its positive's.
LOW, HIGH = 50, 95
#: Rows of a cell, anchors of a block (on average, both being dealt by hash), rows that are bounded together.
CELL, BLOCK, ROWS = 4096, 1024, 1024
LARGEST = float(2**52)


def participants(
    df: DataFrame, is_anchor: Column, label: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(row, vec_id, label, vector, is_anchor) of the rows that take part, stored; `row` numbers them.

    `is_anchor` and `label`, which replaces the labels, are written in `vec_id` and `label`.
    """
    rows = df.select(
        df[id_col].cast("long").alias("vec_id"), df[label_col].cast("long").alias("label"), df[vector_col].cast("array<double>").alias("given")
    )
    sound = rows.where(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.forall("given", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    )
    lengths = sound.groupBy(F.size("given").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).collect()
    whole = F.transform("given", lambda x: F.floor(x * F.lit(float(SCALE))))
    square = F.aggregate("given", F.lit(0.0), lambda total, x: total + F.pow(F.floor(x * F.lit(float(SCALE))).cast("double"), 2))
    distinct = (
        sound.where(F.size("given") == (lengths[0]["length"] if lengths else 0))
        .select(
            "vec_id",
            (F.col("label") if label is None else label).cast("long").alias("label"),
            F.when(square <= LARGEST, whole).otherwise(F.raise_error(F.lit("vector too long"))).alias("vector"),
        )
        .dropDuplicates(["vec_id", "label", "vector"])
    )
    return checkpointed(
        distinct.select(
            F.monotonically_increasing_id().alias("row"), "vec_id", "label", "vector", F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")
        )
    )


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): the shortest tree, grown from the first vector.

    `order` lists the vectors as they joined; `parent` is a place in this order, -1 for the first, and `edge` the distance to it.
    """
    count = len(vectors)
    order, parent, edge = np.zeros(count, np.int64), np.full(count, -1), np.zeros(count)
    nearest, via = np.full(count, np.inf), np.zeros(count, np.int64)
    nearest[0] = 0
    for place in range(count):
        joins = int(nearest.argmin())
        order[place] = joins
        if place:
            parent[place], edge[place] = via[joins], np.sqrt(nearest[joins])
        squares = np.square(vectors - vectors[joins]).sum(axis=1)
        closer = squares < nearest
        closer[order[: place + 1]] = False
        nearest[closer], via[closer] = squares[closer], place
        nearest[joins] = np.inf
    return order, parent, edge


def _planted(table: pa.Table) -> pa.Table:
    """The anchors of a block and label in tree order, with their parents' places and edges."""
    table = table.sort_by("row")
    order, parent, edge = spanning_tree(_matrix(table.column("vector")))
    table = table.take(pa.array(order))
    for name, values in (("place", np.arange(len(order))), ("parent", parent), ("edge", edge)):
        table = table.append_column(name, pa.array(values))
    return table


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows of doubles, which hold all scores and sums exactly."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


class Best:
    """The `most` best (score, id) seen: higher scores first, then smaller ids."""

    def __init__(self, most: int) -> None:
        self.most, self.scores, self.ids = most, np.empty(0), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(self.scores) == self.most:
            as_good = scores >= self.scores[-1]
            scores, ids = scores[as_good], ids[as_good]
        if len(scores):
            scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
            kept = np.lexsort((ids, -scores))[: self.most]
            self.scores, self.ids = scores[kept], ids[kept]

    @property
    def least(self) -> float:
        """The score that a further one has to reach."""
        return self.scores[-1] if len(self.scores) == self.most else -np.inf


class Positives:
    """The best rows of an anchor's label."""

    def __init__(self, anchor: dict) -> None:
        self.own, self.best = anchor["vec_id"], Best(POSITIVES)

    def window(self) -> tuple[float, float]:
        return self.best.least, np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        other = ids != self.own
        self.best.add(scores[other], ids[other])

    def results(self) -> Iterator[tuple[int, int, int]]:
        yield from ((0, number, int(score)) for number, score in zip(self.best.ids.tolist(), self.best.scores.tolist()))


class Negatives:
    """For each positive of an anchor, the best rows of other labels within the window of its score."""

    def __init__(self, anchor: dict) -> None:
        self.own = anchor["vec_id"]
        # a negative score has no window
        self.of = [(place, near["score"], Best(NEGATIVES)) for place, near in enumerate(anchor["positives"]) if near["score"] >= 0]

    def window(self) -> tuple[float, float]:
        if not self.of:
            return np.inf, -np.inf
        lowest = min(max(LOW * score / 100 - 1, best.least) for _, score, best in self.of)
        return lowest, max(HIGH * score for _, score, _ in self.of) / 100 + 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        other = ids != self.own
        scores, ids = scores[other], ids[other]
        for _, score, best in self.of:
            within = (LOW * score <= 100 * scores) & (100 * scores <= HIGH * score)
            best.add(scores[within], ids[within])

    def results(self) -> Iterator[tuple[int, int, int]]:
        for place, _, best in self.of:
            yield from ((place, number, int(score)) for number, score in zip(best.ids.tolist(), best.scores.tolist()))


def search(vectors: np.ndarray, ids: np.ndarray, anchors: np.ndarray, parent: np.ndarray, edge: np.ndarray, looked_for: list) -> int:
    """Offer rows to each anchor of a tree; the number of exact scores taken.

    Bounds are kept for ROWS rows at a time. They are widened by a little for rounding of edges and norms.
    """
    taken = 0
    for start in range(0, len(vectors), ROWS):
        rows, names = vectors[start : start + ROWS], ids[start : start + ROWS]
        norms = np.sqrt(np.square(rows).sum(axis=1))
        lower = np.empty((len(anchors), len(rows)))
        upper = np.empty((len(anchors), len(rows)))
        for place, (anchor, wanted) in enumerate(zip(anchors, looked_for)):
            least, most = wanted.window()
            if parent[place] < 0:
                near = np.arange(len(rows))
            else:
                reach = norms * (edge[place] * (1 + 1e-9)) + 1e-3
                np.subtract(lower[parent[place]], reach, out=lower[place])
                np.add(upper[parent[place]], reach, out=upper[place])
                near = np.flatnonzero((lower[place] <= most) & (upper[place] >= least))
            scores = rows[near] @ anchor
            lower[place, near] = upper[place, near] = scores
            wanted.add(scores, names[near])
            taken += len(near)
    return taken


def _offered(rows: DataFrame, trees: DataFrame, cells: int, blocks: int, kind: type, same_label: bool) -> DataFrame:
    """(row, place, other_id, score): what each pair of a block of anchors and a cell of rows finds."""

    def compare(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int, int]] = []
        if len(rows) and len(anchors):
            labels, ids, vectors = rows.column("label").to_numpy(), rows.column("vec_id").to_numpy(), _matrix(rows.column("vector"))
            anchors = anchors.sort_by([("label", "ascending"), ("place", "ascending")])
            matrix, parent, edge = _matrix(anchors.column("vector")), anchors.column("parent").to_numpy(), anchors.column("edge").to_numpy()
            of_label = anchors.column("label").to_numpy()
            described = anchors.drop_columns(["vector"]).to_pylist()
            for label in np.unique(of_label):
                tree = np.flatnonzero(of_label == label)
                chosen = np.flatnonzero((labels == label) == same_label)
                looked_for = [kind(described[place]) for place in tree]
                search(vectors[chosen], ids[chosen], matrix[tree], parent[tree], edge[tree], looked_for)
                for place, wanted in zip(tree, looked_for):
                    found += ((described[place]["row"], *result) for result in wanted.results())
        columns = zip(*found) if found else ([], [], [], [])
        return pa.table([pa.array(column, pa.int64()) for column in columns], ["row", "place", "other_id", "score"])

    parts = parts_for(rows)
    held = rows.select("cell", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "label", "vector")
    sent = trees.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    paired = [side.repartition(parts, "cell", "block").groupBy("cell", "block") for side in (held, sent)]
    return paired[0].cogroup(paired[1]).applyInArrow(compare, "row long, place long, other_id long, score long")


def _ranked(found: DataFrame, most: int) -> DataFrame:
    by_score = Window.partitionBy("row", "place").orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= most)


def mine(
    df: DataFrame, is_anchor: Column, label: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors."""
    everything = participants(df, is_anchor, label, id_col, vector_col, label_col)
    counts = everything.agg(F.count("*").alias("rows"), F.count_if("is_anchor").alias("anchors")).first()
    if not counts["anchors"]:
        return df.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    cells, blocks = -(-counts["rows"] // CELL), -(-counts["anchors"] // BLOCK)
    rows = everything.withColumn("cell", F.pmod(F.xxhash64("row"), F.lit(cells)).cast("int"))
    anchors = everything.where("is_anchor").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    fields = "block int, row long, vec_id long, label long, vector array<long>, place long, parent long, edge double"
    trees = checkpointed(
        anchors.select("block", "row", "vec_id", "label", "vector").groupBy("block", "label").applyInArrow(_planted, fields)
    )

    best = _ranked(_offered(rows, trees, cells, blocks, Positives, True), POSITIVES)
    positives = checkpointed(
        best.groupBy("row").agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("rank", "other_id", "score"))),
                lambda near: F.struct(near["other_id"].alias("vec_id"), near["score"].alias("score")),
            ).alias("positives")
        )
    )
    looking = trees.join(positives, "row", "left").withColumn(
        "positives", F.coalesce("positives", F.array().cast("array<struct<vec_id:bigint,score:bigint>>"))
    )
    found = _ranked(_offered(rows, looking, cells, blocks, Negatives, False), NEGATIVES)
    positive = F.get(F.col("positives"), F.col("place").cast("int"))
    return (
        found.join(looking.select("row", "vec_id", "positives"), "row")
        .select(
            F.col("vec_id").alias("anchor_id"),
            positive["vec_id"].alias("positive_id"),
            F.col("rank").cast("int").alias("rank"),
            F.col("other_id").alias("negative_id"),
            positive["score"].alias("positive_score"),
            F.col("score").alias("negative_score"),
        )
    )
