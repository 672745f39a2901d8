"""Exact dedup (operator 13): a cuckoo-filter index over digests of live texts.

The index is cut into shards by digest.  A shard holds a cuckoo filter (buckets
of four 16-bit fingerprints) and, bucket by bucket beside it, the stored keys:
one row per live digest with its slot, its number of live rows and its first
row.  A digest whose fingerprint is in neither of its two buckets is new; a
fingerprint hit is verified against the full digests stored in those buckets.
When an insertion finds no free slot, the filter is built again with twice the
buckets from the stored keys.  Deletion takes a live row off its digest and
clears the slot when none is left.

Every change writes a new generation of the index and leaves the old one as it
was, so a failed job loses nothing.  Shards get a bounded number of digests;
an index that outgrows them is dealt to more shards from its stored keys.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import SPACES, parts_for, ship

SLOTS = 4        # fingerprints a bucket
KICKS = 200      # evictions before the filter is taken as full
LOAD = 0.85      # fill that a new filter is sized for
MIX = 0x9E3779B97F4A7C15
#: live digests a shard is meant for
PER_SHARD = 50_000
#: rows of one map task that are combined at a time
COMBINE_ROWS = 500_000

KEYED = "id long, row long, digest binary"
#: a row with a digest is a stored key, a row without one is its shard's filter
STORED = ("shard int, digest binary, slot long, live long, first_id long, first_row long, "
          "buckets long, filter binary")


def normalised(text: Column) -> Column:
    """Text whose runs of white space are one space each; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the normalised text in UTF-8."""
    return F.unhex(F.sha2(normalised(text), 256))


def key_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, digest) of every row, written once; ``row`` tells repeated rows apart.

    The row numbers depend on how the input is read, so only the written table
    is used afterwards.
    """
    return materialise(df.select(
        F.col(id_col).cast("long").alias("id"),
        F.monotonically_increasing_id().alias("row"), digest(F.col(text_col)).alias("digest")),
        "keyed")


def shard_of(digest_col: str, shards: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring(digest_col, 1, 4)), 16, 10).cast("long"),
                  F.lit(shards)).cast("int")


# ---------------------------------------------------------------------------
# One shard
# ---------------------------------------------------------------------------

def fingerprints(digests: list[bytes]) -> tuple[list[int], list[int]]:
    """16-bit fingerprints (never 0) and 64-bit hashes of 32-byte digests."""
    raw = np.frombuffer(b"".join(digests), np.uint8).reshape(len(digests), 32)
    prints = raw[:, 4:6].copy().view(np.uint16)[:, 0].astype(np.int64)
    prints[prints == 0] = 1
    return prints.tolist(), raw[:, 8:16].copy().view(np.uint64)[:, 0].tolist()


class Shard:
    """A cuckoo filter with the stored keys of its buckets."""

    def __init__(self, expected: int):
        self.keys: list[bytes | None] = []
        self.live: list[int] = []
        self.first: list[tuple] = []
        self.resizes = 0
        self._empty(max(8, 1 << (int(expected / (SLOTS * LOAD))).bit_length()))

    def _empty(self, buckets: int):
        self.buckets = buckets  # a power of two
        self.table = [0] * (buckets * SLOTS)    # fingerprints, 0: free
        self.entry = [-1] * (buckets * SLOTS)   # stored key of the slot

    def _pair(self, fp: int, h: int) -> tuple[int, int]:
        one = h & (self.buckets - 1)
        return one, self._other(one, fp)

    def _other(self, bucket: int, fp: int) -> int:
        return bucket ^ ((fp * MIX >> 24) & (self.buckets - 1))

    def find(self, key: bytes, fp: int, h: int) -> int:
        """Slot of a live key, else -1: filter first, its hits against the stored keys."""
        for b in self._pair(fp, h):
            at = b * SLOTS
            for slot in range(at, at + SLOTS):
                if self.table[slot] == fp and self.keys[self.entry[slot]] == key:
                    return slot
        return -1

    def _put(self, e: int, fp: int, h: int) -> bool:
        one, two = self._pair(fp, h)
        bucket = one
        for kick in range(KICKS):
            for b in ((one, two) if not kick else (bucket,)):
                for slot in range(b * SLOTS, b * SLOTS + SLOTS):
                    if not self.table[slot]:
                        self.table[slot], self.entry[slot] = fp, e
                        return True
            slot = bucket * SLOTS + (e + kick) % SLOTS  # evict, go on with the evicted one
            self.table[slot], fp = fp, self.table[slot]
            self.entry[slot], e = e, self.entry[slot]
            bucket = self._other(bucket, fp)
        return False

    def _resize(self):
        """Twice the buckets, filled from the stored keys."""
        self.resizes += 1
        self._empty(2 * self.buckets)
        stored = [e for e, k in enumerate(self.keys) if k is not None]
        for e, fp, h in zip(stored, *fingerprints([self.keys[e] for e in stored]), strict=True):
            if not self._put(e, fp, h):
                return self._resize()

    def restore(self, key, fp, h, slot, live, first, place: bool):
        """A stored key of an earlier generation, in its slot or (``place``) anywhere."""
        self.keys.append(key)
        self.live.append(live)
        self.first.append(first)
        if place:
            if not self._put(len(self.keys) - 1, fp, h):
                self._resize()
        else:
            self.table[slot], self.entry[slot] = fp, len(self.keys) - 1

    def insert(self, key: bytes, fp: int, h: int, n: int, first: tuple):
        """``n`` more live rows of ``key``; ``first`` is the smallest of them."""
        slot = self.find(key, fp, h)
        if slot >= 0:
            e = self.entry[slot]
            self.live[e] += n
            self.first[e] = min(self.first[e], first)
        else:
            self.restore(key, fp, h, None, n, first, place=True)

    def delete(self, key: bytes, fp: int, h: int, n: int):
        """``n`` rows fewer; the last one clears the slot.  Keys that are not live: nothing."""
        slot = self.find(key, fp, h)
        if slot >= 0:
            e = self.entry[slot]
            self.live[e] -= n
            if self.live[e] <= 0:
                self.keys[e] = None
                self.table[slot], self.entry[slot] = 0, -1


def order_of(i, row) -> tuple:
    """Sort key of a row: smallest id first, null ids last, then the row number."""
    return (i is None, i or 0, row)


def apply_changes(state, changes):
    """New stored rows of one shard from its ``state`` and its rows of ``changes``."""
    import pyarrow as pa
    shard_no = (changes if len(changes) else state).column("shard")[0].as_py()
    old = [r for r in state.to_pylist() if r["digest"] is not None]
    buckets = [r["buckets"] for r in state.to_pylist() if r["digest"] is None]
    new = changes.to_pylist()
    shard = Shard(len(old) + len(new))
    in_place = len(buckets) == 1 and all(r["slot"] is not None for r in old)
    if in_place:
        shard._empty(buckets[0])
    for r, fp, h in zip(old, *(fingerprints([r["digest"] for r in old]) if old else ([], [])),
                        strict=True):
        shard.restore(r["digest"], fp, h, r["slot"], r["live"],
                      order_of(r["first_id"], r["first_row"]), place=not in_place)
    for r, fp, h in zip(new, *(fingerprints([r["digest"] for r in new]) if new else ([], [])),
                        strict=True):
        if r["n"] > 0:
            shard.insert(r["digest"], fp, h, r["n"], order_of(r["id"], r["row"]))
        else:
            shard.delete(r["digest"], fp, h, -r["n"])
    at = {e: slot for slot, e in enumerate(shard.entry) if e >= 0}
    rows = [(shard_no, shard.keys[e], slot, shard.live[e],
             None if shard.first[e][0] else shard.first[e][1], shard.first[e][2], None, None)
            for e, slot in sorted(at.items())]
    rows.append((shard_no, None, None, None, None, None, shard.buckets,
                 np.array(shard.table, "<u2").tobytes()))
    types = [pa.int32(), pa.binary()] + [pa.int64()] * 5 + [pa.binary()]
    names = [c.split()[0] for c in STORED.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    names=names)


def combine(batches):
    """Equal digests of one map task as one row: (digest, n, id and row of the first).

    A text that a third of all rows share reaches its shard as one row per
    COMBINE_ROWS of a map task.
    """
    import pyarrow as pa

    def flush(parts):
        t = pa.Table.from_batches(parts)
        t = t.sort_by([("digest", "ascending"), ("id", "ascending"), ("row", "ascending")])
        keys, n = t.column("digest").to_pylist(), t.num_rows
        starts = [k for k in range(n) if not k or keys[k] != keys[k - 1]]
        signed = np.cumsum(t.column("n").to_numpy())
        ends = np.array([*starts[1:], n]) - 1
        sums = np.diff(signed[ends], prepend=0)
        firsts = t.take(pa.array(starts))
        return firsts.set_column(firsts.schema.get_field_index("n"), "n",
                                 pa.array(sums, pa.int64())).combine_chunks().to_batches()

    parts, held = [], 0
    for b in batches:
        if b.num_rows:
            parts.append(b)
            held += b.num_rows
        if held >= COMBINE_ROWS:
            yield from flush(parts)
            parts, held = [], 0
    if parts:
        yield from flush(parts)


# ---------------------------------------------------------------------------
# The index
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class CuckooIndex:
    """One generation: stored keys and filters by shard, and the live rows themselves."""

    stored: DataFrame
    members: DataFrame
    shards: int

    @staticmethod
    def empty(spark: SparkSession) -> CuckooIndex:
        return CuckooIndex(spark.createDataFrame([], STORED), spark.createDataFrame([], KEYED), 1)

    @property
    def keys(self) -> DataFrame:
        """(digest, live, first_id, first_row) of every live digest."""
        return self.stored.where("digest is not null").select(
            "digest", "live", "first_id", "first_row")

    def _change(self, rows: DataFrame, sign: int, n_rows: int,
                live: int) -> tuple[DataFrame, int]:
        spark = rows.sparkSession
        ship(spark)
        shards = max(self.shards, parts_for(live + n_rows, PER_SHARD))
        changes = (rows.select("digest", F.lit(sign).cast("long").alias("n"), "id", "row")
                   .mapInArrow(combine, "digest binary, n long, id long, row long")
                   .withColumn("shard", shard_of("digest", shards)))
        state = self.stored
        if shards != self.shards:  # dealt again, placed from the stored keys
            state = (state.where("digest is not null")
                     .withColumn("shard", shard_of("digest", shards))
                     .withColumn("slot", F.lit(None).cast("long")))

        def each(state, changes):  # a closure: the function travels by value
            return apply_changes(state, changes)

        new = state.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(each, STORED)
        return materialise(new, "cuckoo"), shards

    def insert(self, rows: DataFrame) -> CuckooIndex:
        """Index with the rows of ``key_rows`` added; equal digests share one stored key."""
        offset = (self.members.agg(F.max("row")).first()[0])
        rows = rows if offset is None else materialise(
            rows.withColumn("row", F.col("row") + F.lit(offset + 1)), "keyed")
        stored, shards = self._change(rows, 1, rows.count(),
                                      self.stored.where("digest is not null").count())
        members = rows if offset is None else self.members.unionByName(rows)
        return CuckooIndex(stored, members, shards)

    def delete(self, rows: DataFrame) -> CuckooIndex:
        """Index without the live rows that ``rows`` of ``key_rows`` name by id and digest.

        Each row takes off one live row of its id and text, that with the
        smallest row number first; rows without a live counterpart do nothing.
        """
        match = ["id", "digest"]
        asked = rows.groupBy(*match).agg(F.count(F.lit(1)).alias("asked"))
        # each live row's place among those of its id and text
        mine = self.members.join(asked.withColumnRenamed("id", "_i").withColumnRenamed(
            "digest", "_d"), F.col("id").eqNullSafe(F.col("_i")) & (F.col("digest") == F.col("_d")))
        place = F.row_number().over(Window.partitionBy(*match).orderBy("row"))
        gone = materialise(mine.withColumn("_place", place).where("_place <= asked")
                           .select("id", "digest", "row"), "deleted")
        members = materialise(self.members.join(gone.select("row"), "row", "left_anti")
                              .select("id", "row", "digest"), "members")
        stored, shards = self._change(gone, -1, 0, 0)
        # where the first row went, the next one is found among the live rows
        lost = stored.join(gone.select(F.col("row").alias("first_row")), "first_row", "left_semi") \
            .select("digest")
        first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("f")
        nexts = (members.join(lost, "digest", "left_semi").groupBy("digest").agg(first)
                 .select("digest", F.col("f.id").alias("_id"), F.col("f.row").alias("_row")))
        stored = materialise(
            stored.join(nexts, "digest", "left")
            .select("shard", "digest", "slot", "live",
                    F.when(F.col("_row").isNull(), F.col("first_id")).otherwise(F.col("_id"))
                    .alias("first_id"),
                    F.coalesce("_row", "first_row").alias("first_row"), "buckets", "filter"),
            "cuckoo")
        return CuckooIndex(stored, members, shards)

    def probe(self, rows: DataFrame) -> DataFrame:
        """(id, row, digest) of the rows of ``key_rows`` whose text is live.

        The shards' filters let most absent digests go before anything is read
        of the stored keys; the hits are verified by a join on the digest.
        """
        ship(rows.sparkSession)

        def hits(filters, rows):
            if not len(filters) or not len(rows):
                return rows.slice(0, 0)
            table = np.frombuffer(filters.column("filter")[0].as_py(), "<u2").reshape(-1, SLOTS)
            fp, h = (np.array(x, np.uint64) for x in fingerprints(rows.column("digest").to_pylist()))
            mask = np.uint64(len(table) - 1)
            one = h & mask
            two = one ^ ((fp * np.uint64(MIX)) >> np.uint64(24) & mask)
            found = (table[one] == fp[:, None]).any(1) | (table[two] == fp[:, None]).any(1)
            return rows.filter(found)

        asked = rows.select(shard_of("digest", self.shards).alias("shard"), "digest").distinct()
        filters = self.stored.where("digest is null").select("shard", "filter")
        near = filters.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(
            hits, "shard int, digest binary")
        live = near.select("digest").join(self.keys.select("digest"), "digest", "left_semi")
        return rows.join(live, "digest", "left_semi").select("id", "row", "digest")


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, digest) per row of ``df``: all rows put into an empty index.

    Texts are equal when they are identical after white-space runs became one
    space each (not trimmed); null counts as empty, so null and empty texts are
    one group.  Of equal texts the row with the smallest id stays, null ids
    last; of rows that also share the id just one stays.  Very long texts are
    hashed whole.  Empty table: no rows.  Other columns are ignored.
    """
    rows = key_rows(df, id_col, text_col)
    index = CuckooIndex.empty(df.sparkSession).insert(rows)
    # rows without an equal keep themselves; both sides of the join are read
    # from files, so that Spark can split the rows of a frequent text
    shared = index.keys.where("live > 1")
    return (rows.join(shared, "digest", "left").select(
        F.col("id"),
        F.when(F.col("live").isNull(), F.col("id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("live", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("row") == F.col("first_row"), F.lit(True)).alias("kept"), "digest"))
