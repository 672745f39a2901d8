"""Packing (operator 1): bounded-space online best-fit packing of token sequences.

Every task keeps a fixed number of open windows.  A document longer than a
window is cut into full windows and a rest; the rest (or the short document)
goes into the open window that it fills best.  When it fits none and the space
is used up, the fullest window is emitted.  Finally the part-filled windows of
all tasks (mostly those still open at a task's end) are merged by best fit.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import parts_for, ship
from .tokens import encoder, text_batches

#: a window: its pieces in order, and their ids (little-endian unsigned 32-bit) one after the other
PIECE = "doc_id long, start long, length long, doc_tokens long, offset long"
WINDOW = "sequence_id long, fill long, pieces array<struct<{}>>, ids binary".format(
    ", ".join(c.replace(" ", ": ") for c in PIECE.split(", ")))
#: leftover windows that one merging task gets (16 bytes each)
MERGE_ROWS = 100_000


class OpenWindows:
    """At most ``space`` open windows, ordered by their free room."""

    def __init__(self, size: int, space: int):
        self.size, self.space = size, space
        self.rooms: list[tuple[int, int]] = []  # (free, window), ascending
        self.made = 0
        self.emitted: list[int] = []  # full, or the fullest when none fitted

    def new(self) -> int:
        self.made += 1
        return self.made - 1

    def place(self, n: int) -> tuple[int, int]:
        """(window, offset) for a piece of ``n`` ids."""
        if n == self.size:
            self.emitted.append(self.new())
            return self.emitted[-1], 0
        i = bisect_left(self.rooms, (n, -1))
        if i < len(self.rooms):  # the window with the least room that is enough
            free, window = self.rooms.pop(i)
        else:
            if len(self.rooms) == self.space:
                self.emitted.append(self.rooms.pop(0)[1])  # none fits: emit the fullest
            free, window = self.size, self.new()
        if free > n:
            insort(self.rooms, (free - n, window))
        else:
            self.emitted.append(window)
        return window, self.size - free


def sequences(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
              size: int = 2048, space: int = 256, end_id: int = 1) -> DataFrame:
    """All documents of ``df`` packed into sequences of at most ``size`` ids.

    Returns sequence_id (unique, not gapless), fill (ids before the padding),
    pieces (array of doc_id, start, length, doc_tokens, offset; gapless from
    offset 0) and ids: ``size`` little-endian unsigned 32-bit numbers, padded
    with 0.  Each id of a document lies in exactly one piece.

    Null or empty text: the end id alone.  Null ids and repeated rows are
    documents of their own.  Very long texts: full windows plus a rest.  Empty
    table: no rows.  Other columns are ignored.

    The placement depends on the order of rows, so windows are written once and
    only that table is read afterwards; a lost executor cannot change it.
    """
    def place(batches):
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 32
        codes, windows = encoder(tokenizer_path), OpenWindows(size, space)
        held: dict[int, tuple[list, list]] = {}  # pieces and ids of the open windows
        for ids, texts in text_batches(batches):
            rows = []
            for doc, data in zip(ids, codes.encode(texts, end_id), strict=True):
                n = len(data) // 4
                for start in range(0, n, size):
                    length = min(size, n - start)
                    window, offset = windows.place(length)
                    pieces, parts = held.setdefault(window, ([], []))
                    pieces.append((doc, start, length, n, offset))
                    parts.append(data[4 * start:4 * (start + length)])
                    rows += [(base + w, *held.pop(w)) for w in windows.emitted]
                    windows.emitted.clear()
            yield _batch(rows)
        yield _batch([(base + w, *x) for w, x in held.items()])

    ship(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.col(text_col).cast("string").alias("text"))
    windows = materialise(docs.mapInArrow(place, WINDOW), "windows")
    part = windows.where(F.col("fill") < size)
    left = materialise(part.select(F.col("sequence_id").alias("window_id"), "fill"), "leftovers")
    moves = merge_leftovers(left, left.count(), size)
    # only windows that share a sequence move, most stay where they are; a sequence holds at most
    # ``size`` ids
    stay = part.join(moves.select(F.col("window_id").alias("sequence_id")), "sequence_id",
                     "left_anti")
    moved = part.withColumnRenamed("sequence_id", "window_id").join(moves, "window_id")
    shifted = F.transform("pieces", lambda p: p.withField("offset", p["offset"] + F.col("shift")))
    merged = (moved.groupBy("sequence_id").agg(
        F.sum("fill").alias("fill"),
        F.array_sort(F.collect_list(F.struct("shift", "ids", shifted.alias("pieces")))).alias("w"))
        .select("sequence_id", "fill", F.flatten(F.col("w.pieces")).alias("pieces"),
                F.aggregate("w", F.lit(b""), lambda x, w: F.concat(x, w["ids"])).alias("ids")))
    padding = F.rpad("ids", 4 * size, F.lit(b"\0"))
    return (windows.where(F.col("fill") >= size).unionByName(stay)
            .unionByName(materialise(merged, "merged_windows"))
            .select("sequence_id", "fill", "pieces", padding.alias("ids")))


def pieces(packed: DataFrame, with_ids: bool = True) -> DataFrame:
    """One row per piece of ``sequences``, its checksum computed from the sequence's ids."""
    ids = F.substring(F.col("ids"), 4 * F.col("p.offset") + 1, 4 * F.col("p.length"))
    rows = packed.select("sequence_id", "ids", F.explode("pieces").alias("p")).select(
        "p.doc_id", "p.start", "p.length", F.crc32(ids).alias("ids_crc32"), "p.doc_tokens",
        "sequence_id", "p.offset", ids.alias("ids"))
    return rows if with_ids else rows.drop("ids")


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         size: int = 2048, space: int = 256, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """Pieces of ``sequences``: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and, with ``with_ids``, the piece's ids."""
    return pieces(sequences(df, tokenizer_path, id_col, text_col, size, space, end_id), with_ids)


def merge_leftovers(left: DataFrame, n: int, size: int) -> DataFrame:
    """(window_id, sequence_id, shift) that joins part-filled windows, fullest first, by best fit.

    Tasks get a bounded number of windows each, in random order, so that fills
    of all sizes meet.  A window keeps its own id when it is the first of a sequence; windows
    that share theirs with no other are left out.
    """
    def merge(frames):
        import pandas as pd
        parts = list(frames)  # bounded: about MERGE_ROWS rows
        rows = pd.concat(parts) if parts else pd.DataFrame({"window_id": [], "fill": []})
        rows = rows.sort_values(["fill", "window_id"], ascending=[False, True])
        windows, first, out, times = OpenWindows(size, len(rows)), {}, [], Counter()
        for window_id, fill in zip(rows["window_id"], rows["fill"], strict=True):
            seq, shift = windows.place(int(fill))
            out.append((window_id, first.setdefault(seq, window_id), shift))
            times[out[-1][1]] += 1
        yield pd.DataFrame([x for x in out if times[x[1]] > 1], columns=["window_id", "sequence_id", "shift"])

    dealt = left.repartition(parts_for(n, MERGE_ROWS), F.xxhash64("window_id"))
    return materialise(dealt.mapInPandas(merge, "window_id long, sequence_id long, shift long"),
                       "merged")


def _batch(rows):
    """Rows (window, pieces, parts of ids) as one Arrow batch."""
    import pyarrow as pa
    names = [c.split()[0] for c in PIECE.split(", ")]
    flat = list(zip(*[p for _, ps, _ in rows for p in ps], strict=True)) or [[]] * len(names)
    ends = [0]
    for _, ps, _ in rows:
        ends.append(ends[-1] + len(ps))
    struct = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in flat], names)
    return pa.RecordBatch.from_arrays(
        [pa.array([w for w, _, _ in rows], pa.int64()),
         pa.array([sum(p[2] for p in ps) for _, ps, _ in rows], pa.int64()),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct),
         pa.array([b"".join(x) for _, _, x in rows], pa.binary())],
        ["sequence_id", "fill", "pieces", "ids"])
