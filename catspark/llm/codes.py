"""Vector codes (operator 11): product-quantiser codebooks fitted by cover-tree Lloyd rounds.

Vectors become integers and are cut into equal parts.  Each task packs its
vectors into chunks and builds one cover tree per chunk and part: a node has a
centre, the radius of what lies below it, and a contiguous range of the
chunk's points, whose sum is a difference of cumulative sums.  The trees are
written once; every Lloyd round sends them the codebooks and gets counts and
sums per entry back.  In a round a node whose nearest entry is nearer than the
second by more than its diameter gives its whole range to that entry, by the
triangle inequality; other nodes hand over to their children, and the points
of ambiguous leaves are compared one by one.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import ship

CHUNK = 8192      # vectors of one set of trees
LEAF = 24         # points that are not split further
LIMIT = 1 << 28   # components, as integers, stay below this: squares are exact in 64 bits

TREES = ("ids array<long>, labels array<long>, points binary, orders binary, sizes array<int>, "
         "nodes binary, radii binary")
NODE = 5          # start, end, centre, first child, children: int32 each


def whole(vector: Column) -> Column:
    """floor(256 x) of every component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256))


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite."""
    big = F.lit(float("inf"))
    return (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                                           & (F.abs(x) != big))


# ---------------------------------------------------------------------------
# Cover trees
# ---------------------------------------------------------------------------

def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, [points, entries]."""
    d = points[:, None, :] - entries[None, :, :]
    return np.einsum("ijk,ijk->ij", d, d)


def cover_tree(points: np.ndarray):
    """(order, nodes, radii): a cover tree over integer points.

    ``order`` lists the points so that every node is a range of it; node 0 is
    the root; the children of a node are within half its radius of their own
    centre, and their centres are further apart than that.
    """
    def spread(ids, centre):
        d = points[ids] - points[centre]
        return np.einsum("ij,ij->i", d, d)

    n = len(points)
    order = np.arange(n)
    nodes, radii = [[0, n, 0, 0, 0]], [float(np.sqrt(spread(order, 0).max()))]
    at = 0
    while at < len(nodes):
        start, end, centre, _, _ = nodes[at]
        if end - start > LEAF and radii[at] > 0:
            reach = (radii[at] / 2) ** 2
            rest, begin = order[start:end].copy(), start
            first, now = len(nodes), centre
            far = spread(rest, centre)
            while len(rest):
                d = spread(rest, now)
                near = d <= reach
                mine = rest[near]
                order[begin:begin + len(mine)] = mine
                nodes.append([begin, begin + len(mine), int(now), 0, 0])
                radii.append(float(np.sqrt(d[near].max())))
                begin += len(mine)
                rest, far = rest[~near], far[~near]
                if len(rest):
                    now = rest[np.argmax(far)]
            nodes[at][3:] = [first, len(nodes) - first]
        at += 1
    return order, np.array(nodes, np.int32), np.array(radii)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(counts) - counts
    return np.repeat(starts - begin, counts) + np.arange(total)


def descend(points, order, nodes, radii, entries):
    """(whole, single): subtrees given to one entry, and points compared one by one.

    ``whole`` is (start, end, entry) by node; ``single`` (positions, entries).
    Equal distances go to the lower entry, so a subtree is only given away if
    its entry is strictly nearer for every point that may lie in it.
    """
    frontier = np.zeros(1, np.int64)
    whole, leaves = [], []
    while len(frontier):
        node = nodes[frontier]
        d = np.sqrt(squares(points[node[:, 2]], entries).astype(float))
        nearest = d.argmin(1)
        if d.shape[1] > 1:
            two = np.partition(d, 1, axis=1)
            sure = two[:, 1] - two[:, 0] > 2 * radii[frontier] + 1e-9 * (1 + two[:, 1])
        else:
            sure = np.ones(len(d), bool)
        whole.append(np.column_stack([node[sure, 0], node[sure, 1], nearest[sure]]))
        open_ = node[~sure]
        leaves.append(open_[open_[:, 4] == 0, :2])
        inner = open_[open_[:, 4] > 0]
        frontier = ranges(inner[:, 3].astype(np.int64), inner[:, 4].astype(np.int64))
    leaf = np.concatenate(leaves).astype(np.int64)
    at = ranges(leaf[:, 0], leaf[:, 1] - leaf[:, 0])
    best = squares(points[order[at]], entries).argmin(1) if len(at) else at
    return np.concatenate(whole).astype(np.int64), at, best


def assign(points, order, nodes, radii, entries) -> np.ndarray:
    """Nearest entry of every point."""
    given, at, best = descend(points, order, nodes, radii, entries)
    by_place = np.empty(len(points), np.int64)
    counts = given[:, 1] - given[:, 0]
    by_place[ranges(given[:, 0], counts)] = np.repeat(given[:, 2], counts)
    by_place[at] = best
    out = np.empty(len(points), np.int64)
    out[order] = by_place
    return out


def totals(points, order, nodes, radii, entries):
    """(counts, sums) per entry: cumulative sums over whole subtrees, points for the rest."""
    given, at, best = descend(points, order, nodes, radii, entries)
    placed = points[order]
    running = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(placed, axis=0)])
    counts = np.zeros(len(entries), np.int64)
    sums = np.zeros(entries.shape, np.int64)
    np.add.at(counts, given[:, 2], given[:, 1] - given[:, 0])
    np.add.at(sums, given[:, 2], running[given[:, 1]] - running[given[:, 0]])
    np.add.at(counts, best, 1)
    np.add.at(sums, best, placed[at])
    return counts, sums


# ---------------------------------------------------------------------------
# Chunks: one row per set of trees
# ---------------------------------------------------------------------------

def plant(kept: DataFrame, parts: int, chunk: int) -> DataFrame:
    """Chunks of at most ``chunk`` vectors of one task with a cover tree per part, written once."""
    def grow(batches):
        import pyarrow as pa
        held, n = [], 0
        for b in batches:
            for at in range(0, b.num_rows, chunk):
                piece = b.slice(at, chunk)
                if n + piece.num_rows > chunk:
                    yield tree_row(pa.Table.from_batches(held), parts)
                    held, n = [], 0
                held.append(piece)
                n += piece.num_rows
        if n:
            yield tree_row(pa.Table.from_batches(held), parts)

    return materialise(kept.select("id", "label", "vector").mapInArrow(grow, TREES), "cover_trees")


def tree_row(table, parts: int):
    import pyarrow as pa
    n = table.num_rows
    vectors = table.column("vector").combine_chunks()
    points = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)
    width = points.shape[1] // parts
    trees = [cover_tree(points[:, p * width:(p + 1) * width]) for p in range(parts)]
    row = {"ids": table.column("id").to_pylist(), "labels": table.column("label").to_pylist(),
           "points": points.astype("<i4").tobytes(),
           "orders": np.concatenate([t[0] for t in trees]).astype("<i4").tobytes(),
           "sizes": [len(t[1]) for t in trees],
           "nodes": np.concatenate([t[1] for t in trees]).astype("<i4").tobytes(),
           "radii": np.concatenate([t[2] for t in trees]).astype("<f8").tobytes()}
    types = {"ids": pa.list_(pa.int64()), "labels": pa.list_(pa.int64()),
             "sizes": pa.list_(pa.int32())}
    return pa.RecordBatch.from_arrays(
        [pa.array([v], types.get(k, pa.binary())) for k, v in row.items()], list(row))


def read_trees(row: dict, parts: int):
    """(points, order, nodes, radii) by part of a chunk's row."""
    sizes = row["sizes"]
    n = len(row["ids"])
    points = np.frombuffer(row["points"], "<i4").astype(np.int64).reshape(n, -1)
    orders = np.frombuffer(row["orders"], "<i4").astype(np.int64).reshape(parts, n)
    cuts = np.cumsum(sizes)[:-1]
    nodes = np.split(np.frombuffer(row["nodes"], "<i4").reshape(-1, NODE), cuts)
    radii = np.split(np.frombuffer(row["radii"], "<f8"), cuts)
    width = points.shape[1] // parts
    for p in range(parts):
        yield np.ascontiguousarray(points[:, p * width:(p + 1) * width]), orders[p], nodes[p], radii[p]


def lloyd_round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round; entries that nothing is assigned to stay.

    A task returns one row per codebook number, however many chunks it reads.
    """
    parts, size, width = books.shape

    def sums(batches):
        import pyarrow as pa
        counts = np.zeros((parts, size), np.int64)
        total = np.zeros(books.shape, np.int64)
        for b in batches:
            for k in range(b.num_rows):  # a row holds thousands of vectors
                for p, tree in enumerate(read_trees(b.slice(k, 1).to_pylist()[0], parts)):
                    c, s = totals(*tree, books[p])
                    counts[p] += c
                    total[p] += s
        place = np.arange(books.size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place), pa.array(np.repeat(counts.ravel(), width)), pa.array(total.ravel())],
            ["place", "n", "total"])

    found = (trees.mapInArrow(sums, "place long, n long, total long").where("n > 0")
             .groupBy("place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    new = books.copy()
    for r in found.collect():  # as many rows as the codebooks have numbers
        new.flat[r["place"]] = r["total"] // r["n"]
    return new


def encode(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector, written once."""
    parts = len(books)

    def codes(batches):
        import pyarrow as pa
        for b in batches:
            for k in range(b.num_rows):
                row = b.slice(k, 1).to_pylist()[0]
                entry, error = [], 0
                for p, (points, *tree) in enumerate(read_trees(row, parts)):
                    best = assign(points, *tree, books[p])
                    error = error + ((points - books[p][best]) ** 2).sum(1)
                    entry.append(best)
                digits = np.column_stack(entry).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(row["labels"], pa.int64()),
                     pa.array([bytes(d).hex() for d in digits]), pa.array(error, pa.int64())],
                    ["vec_id", "label", "code", "error"])

    return materialise(trees.mapInArrow(
        codes, "vec_id long, label long, code string, error long"), "vector_codes")


def vector_codes(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2,
                 chunk: int = CHUNK) -> tuple[DataFrame, np.ndarray]:
    """(codes, codebooks): codes of all usable vectors and codebooks[part, entry, component].

    Components count as floor(256 x); the codebooks start from the vectors
    with the smallest ids and go through ``rounds`` of Lloyd's method with
    floored means; distances are exact and ties go to the lower entry.

    Vectors that are null or empty or hold a null, NaN or infinite component
    are left out, and so are vectors of another length than that of the
    smallest id (a length that ``parts`` does not divide is an error, as is a
    component of 2^20 or more, whose squares would leave 64 bits).  Null ids
    come last; ids that repeat are vectors of their own, ordered by their
    components; null labels stay null.  Fewer vectors than ``entries``: as many
    entries as vectors.  Empty table: no rows and empty codebooks.  Other
    columns are ignored.
    """
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits: at most 256 entries")
    ship(df.sparkSession)
    vector = F.col(vector_col)
    kept = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long")
                     .alias("label"), F.when(usable(vector), whole(vector)).alias("vector")) \
        .where("vector is not null")
    seeds = [r["vector"] for r in
             kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(1).collect()]
    if not seeds:
        return (df.sparkSession.createDataFrame([], "vec_id long, label long, code string, "
                                                    "error long"), np.zeros((parts, 0, 0), np.int64))
    width, odd = divmod(len(seeds[0]), parts)
    if odd:
        raise ValueError(f"{len(seeds[0])} components cannot be cut into {parts} equal parts")
    fits = F.forall("vector", lambda x: F.abs(x) < LIMIT)
    kept = kept.where(F.size("vector") == len(seeds[0])).withColumn(
        "vector", F.when(fits, F.col("vector")).otherwise(
            F.raise_error(F.lit("a component is too large: 2^20 or more"))))
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    books = np.array([r["vector"] for r in first], np.int64).reshape(len(first), parts, width)
    books = np.ascontiguousarray(books.transpose(1, 0, 2))
    trees = plant(kept, parts, chunk)
    for _ in range(rounds):
        books = lloyd_round(trees, books)
    return encode(trees, books), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error, the error of all vectors of the label (nulls are one label)."""
    sums = codes.groupBy(F.col("label").alias("_l")).agg(F.sum("error").alias("label_error"))
    return codes.join(sums, codes["label"].eqNullSafe(sums["_l"])).drop("_l")


def books_sha256(books: np.ndarray) -> str:
    """Hash of all components in decimal, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()
