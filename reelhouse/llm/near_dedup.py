"""Near-duplicate documents: a chosen-path set similarity join, confirmed on full sets.

A document's set holds its distinct word shingles. Equal sets are one class from the start. Each class has a
signature of minwise tokens. In every tree, a node branches its documents by the minwise token of one
coordinate, sometimes of two (1.25 branches on average, the inverse of the similarity sought), so
similar documents go on together and others part. Nodes of at most NODE documents are compared
exhaustively, by signature, and give a spanning forest of likely pairs; larger ones branch again.

After DEPTH branchings all nodes are compared exhaustively, whatever their size, but for those of more than VAST documents that
still shrink: they branch on, always in two, which loses hardly any more pairs. A large node is first dealt in parts that share
pivots, which connects near copies. Documents that are then still apart from the node's largest component are compared with all
documents of the node, in tasks of a part of the ones and a part of the others. So no two documents of a node are left
uncompared unless they are connected already.

Independent trees repeat this until a pair of the sought similarity is missed by all of them with a probability of 1 - TARGET at
most; the number of trees follows from the branchings.

The forests join documents into candidate groups, which are a superset of the true ones. Each group gets the
full sets of its documents, once, and its exact components are found by search over an inverted
index: a document is compared with all that are not yet reached, so no pair of the group is left out and none
within a component is looked at twice. A group too large for a task is dealt in chunks that share
pivots; documents that reach no pivot are then searched for in every chunk.

Defined results: a text with fewer words than a shingle is one shingle of all its words; null, empty and
blank texts have no shingles and are linked with nothing. Rows that repeat an id are the same document,
and one with several texts gets the smallest id that any of them reaches; rows without id are linked with
nothing and kept. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm.common import BoundedCache, blocks, checkpointed, id_and_text, parts_for

WORDS, PERCENT = 5, 80
COORDINATES, DEPTH = 64, 4
#: Least probability that a pair of just the sought similarity meets in some tree.
TARGET = 0.999
#: A second branch is taken by one node in SECOND_OF: 1.25 branches on average.
SECOND_OF = 4
#: Largest node that is compared exhaustively; signatures at least this alike are a likely pair, four
#: standard errors below the sought similarity.
NODE, LIKELY = 256, 0.60
#: Documents of a part of a large node, and of a node that branches on after DEPTH, if a branch leaves SHRINKS of it at most.
PART, VAST, SHRINKS = 2048, 65_536, 0.8
#: Documents that all parts of a large node or group share, and how alike to one of them is likely: with
#: two links of 0.8 between, Jaccard distances add up to 0.4 at most.
PIVOTS, LIKELY_BY_PIVOT = 8, 0.42
#: Shingles of a group that one task searches.
CHUNK_SHINGLES = 2_000_000
SEED = 77

MIX_1, MIX_2, MIX_3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * MIX_2
    values = (values ^ (values >> np.uint64(27))) * MIX_3
    return values ^ (values >> np.uint64(31))


class Shingler:
    """Hashes of the distinct shingles of a text, sorted."""

    def __init__(self, words: int) -> None:
        import xxhash

        self.words = words
        self.hashes = BoundedCache(lambda word: xxhash.xxh3_64_digest(word))

    def __call__(self, text: bytes) -> np.ndarray:
        # bytes: only A-Z are lowered, and words end at space and \x09-\x0d only
        found = np.frombuffer(b"".join(map(self.hashes.__getitem__, text.lower().split())), np.uint64)
        if not len(found):
            return found
        width = min(self.words, len(found))
        size = len(found) - width + 1
        shingles = np.full(size, width, np.uint64) * MIX_1
        for place in range(width):
            shingles = _mixed(shingles * MIX_1 + found[place : place + size])
        return np.unique(shingles)


def _minwise(shingles: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """Signatures (sets, coordinates) of consecutive sets."""
    random = np.random.default_rng(SEED)
    factors = random.integers(0, 2**31, coordinates, np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = random.integers(0, 2**32, coordinates, np.uint32)
    low = (shingles >> np.uint64(16)).astype(np.uint32)
    signature = np.empty((len(starts), coordinates), np.uint32)
    for number in range(coordinates):
        spread = low * factors[number] + shifts[number]
        spread ^= spread >> np.uint32(15)
        spread *= np.uint32(0x2C1B3C6D)
        spread ^= spread >> np.uint32(16)
        signature[:, number] = np.minimum.reduceat(spread, starts)
    return signature


def sketch(df: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, class, signature, short): a narrow pass. Empty sets and rows without id have no class.

    `short` is the signature with a byte for each token, which tells most tokens apart.
    """

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingler = Shingler(words)
        for block in blocks(batches, "text", 1_000_000):
            block = block.combine_chunks()
            ids = block["doc_id"].combine_chunks()
            sets = [shingler(text.as_buffer().to_pybytes()) for text in block["text"].combine_chunks().cast(pa.large_binary())]
            sizes = np.array([len(each) for each in sets])
            some = np.flatnonzero((sizes > 0) & ids.is_valid().to_numpy(zero_copy_only=False))
            names = np.full(len(sets), None, object)
            signatures, short = np.full(len(sets), None, object), np.full(len(sets), None, object)
            if len(some):
                starts = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
                matrix = _minwise(np.concatenate([sets[number] for number in some]), starts, COORDINATES)
                for row, number in enumerate(some):
                    names[number] = xxhash.xxh3_128_digest(sets[number].tobytes())
                    signatures[number] = matrix[row].tobytes()
                    short[number] = (matrix[row] ^ (matrix[row] >> np.uint32(8))).astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), *(pa.array(each, pa.binary()) for each in (names, signatures, short))],
                ["doc_id", "n_shingles", "class", "signature", "short"],
            )
            pa.default_memory_pool().release_unused()

    return id_and_text(df, id_col, text_col).mapInArrow(
        sketched, "doc_id long, n_shingles long, class binary, signature binary, short binary"
    )


# ---- chosen paths


def _token(signature: str, coordinate: Column) -> Column:
    return F.substring(F.col(signature), (coordinate * 4 + 1).cast("int"), F.lit(4))


def _branches(node: Column, both: bool = False) -> Column:
    """The children of a node that a document goes to: one, or two at some nodes, or at all."""

    def child(number: int):
        coordinate = F.pmod(F.xxhash64(node, F.lit(number)), F.lit(COORDINATES))
        return F.xxhash64(node, coordinate, _token("signature", coordinate))

    two = F.array_distinct(F.array(child(0), child(1)))
    if both:
        return F.explode(two)
    second = F.pmod(F.xxhash64(node, F.lit(-1)), F.lit(SECOND_OF)) == 0
    return F.explode(F.when(second, two).otherwise(F.array(child(0))))


def trees_for(target: float, percent: int) -> int:
    """Trees in which a pair of just this similarity meets with probability `target`.

    After a branching, the pair is apart if it was before or if no branch took both; of nodes beyond DEPTH, which have two
    branches, what many more of them lose is added.
    """
    together = percent / 100
    lost = 0.0
    for _ in range(DEPTH):
        parted = 1 - together * (1 - lost)
        lost = parted * (1 - 1 / SECOND_OF) + parted**2 / SECOND_OF
    deeper = 0.0
    for _ in range(100):
        deeper = (1 - together * (1 - deeper)) ** 2
    lost = 1 - (1 - lost) * (1 - deeper)
    return math.ceil(math.log(1 - target) / math.log(lost))


def likely_links(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(left, right): a spanning forest of the likely pairs that the trees bring together."""
    roots = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(trees_for(TARGET, percent)).cast("long")))
    everyone = F.lit(2**62)
    members = classes.select("rep", "signature", roots.alias("tree")).select(
        "rep", _branches(F.col("tree")).alias("node"), everyone.alias("before")
    )
    small = large = None
    depth = 0
    while members is not None:
        depth += 1
        members = checkpointed(members)
        # stored as well: adaptive execution splits a join whose sides are exchanged for it alone
        sizes = checkpointed(members.groupBy("node").agg(F.count("*").alias("size")).where(F.col("size") > 1))
        sized = checkpointed(members.join(sizes, "node"))
        small = _with(small, sized.where(F.col("size") <= NODE).select("node", "rep", F.lit(False).alias("pivot")))
        over = F.col("size") > NODE
        # a large node branches: each one down to DEPTH, and further those that are vast and still shrink
        on = over if depth < DEPTH else (F.col("size") > VAST) & (F.col("size") <= SHRINKS * F.col("before"))
        left = sized.where(over & ~on).select("node", "rep", "size")
        if depth >= DEPTH:
            large = _with(large, left)
        further = sized.where(on).select("node", "rep", F.col("size").alias("before"))
        if further.isEmpty():
            break
        members = further.join(classes.select("rep", "signature"), "rep").select(
            "rep", _branches(F.col("node"), depth >= DEPTH).alias("node"), "before"
        )
    if large is None or large.isEmpty():
        return _compared(small, classes)
    links = checkpointed(_compared(small.unionByName(_parts(large)), classes))
    return links.unionByName(_compared(_apart(large, links), classes, across=True))


def _with(so_far: DataFrame | None, more: DataFrame) -> DataFrame:
    return more if so_far is None else so_far.unionByName(more)


def _compared(nodes: DataFrame, classes: DataFrame, across: bool = False) -> DataFrame:
    """(left, right) of (node, rep, pivot): the likely pairs of each node, or only those of a pivot and another."""
    return (
        nodes.join(classes.select("rep", "short"), "rep")
        .repartition(parts_for(classes), "node")
        .sortWithinPartitions("node", F.desc("pivot"), "rep")
        .mapInArrow(lambda batches: _compare_nodes(batches, across), "left long, right long")
    )


def _parts(large: DataFrame) -> DataFrame:
    """Large nodes dealt in parts of about NODE documents, each with the same pivots."""
    parts = F.ceil(F.col("size") / NODE)
    dealt = large.select(
        F.xxhash64("node", F.pmod(F.xxhash64("rep"), parts)).alias("part"), "rep", F.lit(False).alias("pivot")
    )
    first = Window.partitionBy("node").orderBy(F.xxhash64("rep", F.lit(1)), "rep")
    pivots = (
        large.withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= PIVOTS)
        .select(F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("number"), "node", "rep")
        .select(F.xxhash64("node", F.col("number")).alias("part"), "rep", F.lit(True).alias("pivot"))
    )
    return dealt.unionByName(pivots).withColumnRenamed("part", "node")


def _apart(large: DataFrame, links: DataFrame) -> DataFrame:
    """(node, rep, pivot): of large nodes, what is apart from the largest component, to be compared with all documents.

    Both are dealt in parts, and each pair of parts is a node of its own, in which `pivot` marks the documents that are apart. A
    document is sent on once for each part of the other side.
    """
    roots = components(links).select(F.col("node").alias("rep"), "root")
    labelled = checkpointed(large.join(roots, "rep", "left").select("node", "rep", "size", F.coalesce("root", "rep").alias("root")))
    main = labelled.groupBy("node", "root").agg(F.count("*").alias("held")).groupBy("node").agg(
        F.max_by("root", F.struct("held", "root")).alias("main")
    )
    sides = checkpointed(labelled.join(checkpointed(main), "node").select("node", "rep", "size", (F.col("root") != F.col("main")).alias("pivot")))
    loads = checkpointed(sides.where("pivot").groupBy("node").agg(F.ceil(F.count("*") / PART).alias("loads")))
    parts = F.ceil(F.col("size") / PART)

    def numbers(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long") - 1))

    loaded = sides.join(loads, "node")
    of_all = loaded.select("node", "rep", F.pmod(F.xxhash64("rep"), parts).alias("a"), numbers(F.col("loads")).alias("b"), F.lit(False).alias("pivot"))
    of_apart = loaded.where("pivot").select(
        "node", "rep", numbers(parts).alias("a"), F.pmod(F.xxhash64("rep", F.lit(2)), F.col("loads")).alias("b"), F.lit(True).alias("pivot")
    )
    return of_all.unionByName(of_apart).select(F.xxhash64("node", "a", "b").alias("node"), "rep", "pivot")


def _compare_nodes(batches: Iterator[pa.RecordBatch], across: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node: the likely pairs of whole nodes, as a forest."""
    pending: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes = batch.column("node").to_numpy()
        changes = np.flatnonzero(nodes[1:] != nodes[:-1]) + 1
        if pending and pending[-1].column("node")[-1].as_py() == nodes[0]:
            if not len(changes):
                pending.append(batch)
                continue
            pending.append(batch.slice(0, changes[0]))
            batch, changes = batch.slice(changes[0]), changes[1:] - changes[0]
        if pending:
            yield _forest(pa.Table.from_batches(pending), across)
        if len(changes):
            yield _forest(pa.Table.from_batches([batch.slice(0, changes[-1])]), across)
            batch = batch.slice(changes[-1])
        pending = [batch]
    if pending:
        yield _forest(pa.Table.from_batches(pending), across)


def _forest(table: pa.Table, across: bool) -> pa.RecordBatch:
    """Pairs of a node that are likely, or with `across` those of a pivot and another document, but not of ones already joined.

    To what is a pivot for others, half the similarity is enough; what is apart in `across` is no such pivot.
    """
    nodes, reps, pivot = (table[name].to_numpy() for name in ("node", "rep", "pivot"))
    signatures = np.frombuffer(b"".join(table["short"].to_pylist()), np.uint8).reshape(len(reps), -1)
    parent = np.arange(len(reps))
    left, right = [], []
    at = np.arange(len(reps))
    for shift in range(1, len(reps)):
        at = at[at + shift < len(reps)]
        at = at[nodes[at] == nodes[at + shift]]
        if not len(at):
            break
        apart = at[parent[at] != parent[at + shift]]
        if across:
            apart = apart[(pivot[apart] != pivot[apart + shift]) & (reps[apart] != reps[apart + shift])]
        for begin in range(0, len(apart), 65536):
            some = apart[begin : begin + 65536]
            alike = (signatures[some] == signatures[some + shift]).mean(axis=1)
            wanted = LIKELY if across else np.where(pivot[some] | pivot[some + shift], LIKELY_BY_PIVOT, LIKELY)
            linked = some[alike >= wanted]
            left.append(reps[linked])
            right.append(reps[linked + shift])
            _join(parent, linked, linked + shift)
    left, right = (np.concatenate(side) if side else np.empty(0, np.int64) for side in (left, right))
    return pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], ["left", "right"])


def _join(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Union by smallest row number, for many pairs at once; afterwards every row points to its root."""
    while len(left):
        one, other = parent[left], parent[right]
        apart = one != other
        left, right, one, other = left[apart], right[apart], one[apart], other[apart]
        if not len(left):
            return
        np.minimum.at(parent, np.maximum(one, other), np.minimum(one, other))
        while True:
            further = parent[parent]
            if np.array_equal(further, parent):
                break
            parent[:] = further


# ---- components


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node can reach.

    Every task first joins the links it holds. Then large-star and small-star rounds (Kiveris and
    others, "Connected components in MapReduce and beyond", 2014), until each node hangs on one root. A
    hub's links are aggregated before they are shuffled, and joined back by an exchange that
    Spark's skew join can split.
    """
    edges = checkpointed(_smaller_second(links.toDF("u", "v").mapInArrow(_joined, "u long, v long")).distinct())
    while not _is_stars(edges):
        # large star: neighbours greater than u go to the smallest around u
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _smaller_second(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # small star: u and its smaller neighbours go to the smallest of them
        joined = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = checkpointed(_smaller_second(small).distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _smaller_second(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")


def _is_stars(edges: DataFrame) -> bool:
    """Whether each node has one link to a smaller one, and no node with such a link is linked to itself."""
    ends = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.lit(None).cast("long").alias("v")))
    nodes = ends.groupBy("u").agg(
        F.min("v").alias("least"), F.max("v").alias("most"), F.count("*").alias("ends"), F.count("v").alias("links")
    )
    return nodes.where("least <> most or (links > 0 and links < ends)").isEmpty()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of each batch as stars: each node with the smallest it reaches within the batch."""
    for batch in batches:
        if batch.num_rows:
            ends = np.stack([batch.column("u").to_numpy(), batch.column("v").to_numpy()])
            names, places = np.unique(ends, return_inverse=True)
            left, right = places.reshape(ends.shape)
            parent = np.arange(len(names))
            _join(parent, left, right)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[parent])], ["u", "v"])


# ---- exact confirmation


def confirmed_components(df: DataFrame, classes: DataFrame, groups: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, root): the exact components of every candidate group.

    Only documents of groups are sent on with their sets, each of them once and, in groups of more than a chunk,
    again where chunks share it.
    """
    named = groups.select(F.explode(F.array("node", "root")).alias("rep"), F.col("root").alias("group")).distinct()
    members = checkpointed(named.join(classes.select("rep", "n_shingles"), "rep"))
    chunks = members.groupBy("group").agg(F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES).alias("chunks"))
    wanted = members.select("rep", "group").join(chunks, "group")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            sets = [shingler(text.as_buffer().to_pybytes()).tobytes() for text in batch.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("group"), batch.column("chunks"), pa.array(sets, pa.binary())],
                ["rep", "group", "chunks", "shingles"],
            )

    held = checkpointed(
        df.join(wanted, df["doc_id"] == wanted["rep"])
        .select("rep", "group", "chunks", "text")
        .mapInArrow(shingled, "rep long, group long, chunks long, shingles binary")
    )
    chunk = F.pmod(F.xxhash64("rep"), F.col("chunks"))
    dealt = held.select("group", chunk.alias("a"), F.lit(-1).cast("long").alias("b"), "rep", "shingles")
    many = held.where(F.col("chunks") > 1)
    if many.isEmpty():  # each group was searched whole
        return _searched(dealt, percent)

    first = Window.partitionBy("group").orderBy(F.xxhash64("rep", F.lit(1)), "rep")
    pivots = checkpointed(
        many.select("rep", "group").withColumn("place", F.row_number().over(first)).where(F.col("place") <= PIVOTS)
    )
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("a")
    shared = many.join(pivots.select("rep", "group"), ["rep", "group"]).select(
        "group", everywhere, F.lit(-1).cast("long").alias("b"), "rep", "shingles"
    )
    stars = checkpointed(_searched(dealt.unionByName(shared), percent))
    roots = components(stars)

    # documents outside the largest component that holds a pivot are searched for in every chunk
    labelled = many.join(roots, many["rep"] == roots["node"], "left").select(
        "group", "chunks", "rep", "shingles", F.coalesce("root", "rep").alias("root")
    )
    of_pivots = labelled.join(pivots.select("rep", "group"), ["rep", "group"]).select("group", "root").distinct()
    largest = (
        labelled.groupBy("group", "root").agg(F.count("*").alias("held"))
        .join(of_pivots, ["group", "root"])
        .groupBy("group")
        .agg(F.max_by("root", F.struct("held", "root")).alias("main"))
    )
    outside = checkpointed(labelled.join(largest, "group").where("root <> main").select("group", "chunks", "rep", "shingles"))
    if outside.isEmpty():
        return roots
    loads = outside.groupBy("group").agg(F.ceil(F.sum(F.length("shingles")) / (8 * CHUNK_SHINGLES)).alias("loads"))
    sent = outside.join(loads, "group").select(
        "group", everywhere, F.pmod(F.xxhash64("rep", F.lit(2)), F.col("loads")).alias("b"), "rep", "shingles"
    )
    each_load = F.explode(F.sequence(F.lit(0).cast("long"), F.col("loads") - 1)).alias("b")
    met = many.join(loads, "group").select("group", chunk.alias("a"), each_load, "rep", "shingles")
    return components(stars.unionByName(_searched(sent.unionByName(met), percent)))


def _searched(members: DataFrame, percent: int) -> DataFrame:
    """(node, root) for the components of each part of a group: (group, a, b, rep, shingles)."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reps, sets = None, [], []
        for batch in batches:
            keys = zip(batch.column("group").to_pylist(), batch.column("a").to_pylist(), batch.column("b").to_pylist())
            for key, rep, shingles in zip(keys, batch.column("rep").to_pylist(), batch.column("shingles").to_pylist()):
                if key != at:
                    yield from _exact(reps, sets, percent)
                    at, reps, sets = key, [], []
                reps.append(rep)
                sets.append(np.frombuffer(shingles, np.uint64))
        yield from _exact(reps, sets, percent)

    return (
        members.repartition(parts_for(members), "group", "a", "b")
        .sortWithinPartitions("group", "a", "b", "rep")
        .mapInArrow(searched, "node long, root long")
    )


def _exact(reps: list[int], sets: list[np.ndarray], percent: int) -> Iterator[pa.RecordBatch]:
    """Each document, but the first of each component, with the smallest that a search from it reaches."""
    if len(reps) < 2:
        return
    names, sizes = np.array(reps), np.array([len(each) for each in sets])
    unseen = np.ones(len(sets), bool)
    index = _Index(sets, np.arange(len(sets)))
    nodes, roots = [], []
    for seed in range(len(sets)):
        if not unseen[seed]:
            continue
        unseen[seed] = False
        reached, looked_at = [seed], 0
        while looked_at < len(reached) and index.held:
            here = reached[looked_at]
            looked_at += 1
            common = index.common(sets[here], len(sets))
            near = np.flatnonzero(unseen & (100 * common >= percent * (sizes + sizes[here] - common)) & (common > 0))
            if len(near):
                unseen[near] = False
                reached.extend(near.tolist())
                if 2 * unseen.sum() < index.held:
                    index = _Index(sets, np.flatnonzero(unseen))
        component = names[reached]
        nodes.append(component[component != component.min()])
        roots.append(np.full(len(nodes[-1]), component.min()))
    if any(map(len, nodes)):
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(roots))], ["node", "root"])


class _Index:
    """For every shingle, the documents of a group that have it."""

    def __init__(self, sets: list[np.ndarray], documents: np.ndarray) -> None:
        self.held = len(documents)
        shingles = np.concatenate([sets[number] for number in documents]) if self.held else np.empty(0, np.uint64)
        owners = np.repeat(documents, [len(sets[number]) for number in documents]) if self.held else documents
        order = np.argsort(shingles, kind="stable")
        self.owners, ordered = owners[order], shingles[order]
        self.shingles, self.starts = np.unique(ordered, return_index=True)
        self.ends = np.append(self.starts[1:], len(ordered))

    def common(self, shingles: np.ndarray, count: int) -> np.ndarray:
        """How many of the shingles each document has."""
        if not len(self.shingles):
            return np.zeros(count, np.int64)
        places = np.minimum(np.searchsorted(self.shingles, shingles), len(self.shingles) - 1)
        places = places[self.shingles[places] == shingles]
        lengths = self.ends[places] - self.starts[places]
        total = int(lengths.sum())
        if not total:
            return np.zeros(count, np.int64)
        at = np.repeat(self.starts[places] - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)
        return np.bincount(self.owners[at], minlength=count)


def near_duplicates(
    df: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every document.

    Documents are linked if 100 * |intersection| >= percent * |union| of their shingle sets. component_id is the
    smallest id reachable over links; the document that bears it is kept.
    """
    texts = id_and_text(df, id_col, text_col)
    sketched = checkpointed(sketch(texts, words))
    classes = checkpointed(
        sketched.where(F.col("class").isNotNull())
        .groupBy("class")
        .agg(F.min("doc_id").alias("rep"), *(F.first(name).alias(name) for name in ("n_shingles", "signature", "short")))
    )
    groups = components(likely_links(classes, percent))
    roots = confirmed_components(texts, classes, groups, words, percent).groupBy("node").agg(F.min("root").alias("root"))
    named = classes.select("class", "rep").join(roots, F.col("rep") == F.col("node"), "left").select(
        "class", F.coalesce("root", "rep").alias("component")
    )
    return (
        sketched.select("doc_id", "n_shingles", "class")
        .join(named, "class", "left")
        .withColumn("component_id", F.coalesce("component", "doc_id"))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )
