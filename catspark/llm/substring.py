"""Substring dedup (operator 7): prefix-partitioned suffix trees over words.

A suffix starts at every word.  Two suffixes that share their first ``window``
words meet in an internal node of the suffix tree at that depth or deeper; the
node's first suffix (smallest document id, then start) stays, the others'
words go, and the words that go in a row are the span of a maximal repeat.
The trees are truncated at ``window`` words: every window inside a longer
repeat is a node of its own, so nothing is lost below that depth.

Copies of whole texts are set aside first: of each only the first is looked at.

1. Leaves are pruned.  A window's anchor is the smallest hash of its shorter
   runs; equal windows have equal anchors, so a window whose anchor no other
   place has is a leaf above the wanted depth.  Anchors are dealt by hash in
   packed arrays, a fifth of the words and a few bytes each.  An anchor that a
   batch holds more than once is sent once a batch, however often it occurs.
2. The suffixes that are left are dealt by prefixes of variable length: the
   first word, or more words where more than ``limit`` suffixes fall into the
   prefix's group, so every group fits a task's memory.
3. Each task sorts its suffixes by their words, takes the common prefix of each
   with the one before, and cuts the order into the nodes at full depth.  A word
   is written as 16 bits of its hash and a suffix also carries 64 bits of its
   window's: different windows are one node only if both agree.  A prefix that
   is still too frequent at full depth is one node; its first suffix comes from
   an aggregate, whatever its size.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialise
from .common import parts_for, ship
from .grams import first_of_runs, mixed, rolling, sliding_min, starts_within, symbols

#: the shorter runs whose smallest hash is a window's anchor, as a share of the window
ANCHOR_SHARE = 0.6
#: prefix lengths tried in turn, in words; the window's length is the last
LEVELS = (1, 2, 4, 8)
NULL_ID = np.iinfo(np.int64).max
#: low bits of an anchor that hold its place
PLACE = np.uint64((1 << 20) - 1)
#: the column that holds the other columns of a row
CARRIED = "row"
BLOB = "bin long, docs binary, counts binary, a binary, b binary, c binary"


def words_of(texts: list[str | None]) -> tuple[list[bytes], np.ndarray]:
    """Words of all texts in a row, and how many each text has."""
    cut = [t.encode().split() if t else [] for t in texts]
    return [w for x in cut for w in x], np.array([len(x) for x in cut], np.int64)


def _slices(batches, columns, max_chars=4_000_000):
    """Batches as lists of columns, the first of which is a text, in bounded pieces; the carried
    column stays an Arrow array."""
    for b in batches:
        cols = [b.column(c) if c == CARRIED else b.column(c).to_pylist() for c in columns]
        start = chars = 0
        for i, t in enumerate(cols[0]):
            chars += len(t or "") + 1
            if chars >= max_chars or i == len(cols[0]) - 1:
                yield [c[start:i + 1] for c in cols]
                start, chars = i + 1, 0


def _rows(names, types, rows):
    import pyarrow as pa
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[t]) for c, t in zip(cols, types, strict=True)], names)


def _blob_rows(bins: np.ndarray, owner: np.ndarray, docs: np.ndarray, *values: np.ndarray):
    """One row per bin: its documents, how many entries each has, and the entries' values.

    ``docs`` has one row of fixed fields per document, ``owner`` is ascending.
    """
    order = np.argsort(bins, kind="stable")
    bins, owner = bins[order], owner[order]
    values = [v[order] for v in values]
    cuts = np.append(first_of_runs(bins, np.zeros(len(bins), np.int8)), len(bins))
    out = []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        own = owner[lo:hi]
        first = first_of_runs(own, np.zeros(hi - lo, np.int8))
        counts = np.diff(np.append(first, hi - lo)).astype("<u4")
        parts = [v[lo:hi].tobytes() for v in values] + [b""] * (3 - len(values))
        out.append((int(bins[lo]), docs[own[first]].tobytes(), counts.tobytes(), *parts))
    names = [c.split()[0] for c in BLOB.split(", ")]
    return _rows(names, [c.split()[1] for c in BLOB.split(", ")], out)


def _entries(table, fields, *types):
    """All entries of a group of blob rows: document fields per entry, and the values."""
    join = lambda c, t: np.frombuffer(
        b"".join(table.column(c).to_pylist()), np.dtype(t))
    docs = join("docs", "<i8").reshape(-1, fields)
    owner = np.repeat(np.arange(len(docs)), join("counts", "<u4"))
    return docs, owner, [join(c, t) for c, t in zip("abc", types, strict=False)]


def _spans_rows(docs: np.ndarray, owner: np.ndarray, a: np.ndarray, b: np.ndarray):
    """(h, a, b): the values of each document, packed."""
    first = first_of_runs(owner, np.zeros(len(owner), np.int8))
    ends = np.append(first, len(owner))[1:]
    rows = [(int(docs[owner[lo], 0]), a[lo:hi].tobytes(), b[lo:hi].tobytes())
            for lo, hi in zip(first, ends, strict=True)]
    return _rows(["h", "a", "b"], ["long", "binary", "binary"], rows)


def repeated_anchors(rows: DataFrame, window: int, n_bins: int) -> DataFrame:
    """(h, a, b): runs of windows (first word, number of windows) whose anchor occurs elsewhere.

    Of texts with equal ``content`` only the first (smallest ``ord``, then h) is reported.
    """
    gram = max(1, round(window * ANCHOR_SHARE))
    span = window - gram + 1

    def anchors(batches):
        for texts, hs, ords, contents in _slices(batches, ["text", "h", "ord", "content"]):
            # later copies within the batch are never reported
            hs, ords, contents = (np.array(x, np.int64) for x in (hs, ords, contents))
            order = np.lexsort((hs, ords, contents))
            of = np.sort(order[first_of_runs(contents[order], np.zeros(len(hs), np.int8))])
            hs, ords, contents = hs[of], ords[of], contents[of]
            flat, counts = words_of([texts[i] for i in of])
            # value and place of each window's anchor: windows in a row that have it from the
            # same place differ, so only runs of such windows are sent
            value = mixed(rolling(symbols(flat), gram))
            place = np.arange(len(value), dtype=np.uint64) & PLACE
            low = sliding_min((value & ~PLACE) | place, span)
            at = starts_within(counts, window)
            owner = np.repeat(np.arange(len(counts)), np.maximum(counts - window + 1, 0))
            first = first_of_runs(low[at], owner) if len(at) else np.zeros(0, np.int64)
            # a run longer than 16 bits is cut; its parts have equal anchors
            n = np.diff(np.append(first, len(at)))
            reps = -(-n // 65535)
            first = np.repeat(first, reps) + 65535 * (
                np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps))
            n = np.diff(np.append(first, len(at)))
            start = at[first] - (np.cumsum(counts) - counts)[owner[first]]
            value = low[at[first]] >> np.uint64(20)
            docs, owner = np.array([hs, ords, contents], "<i8").T, owner[first]
            # what the batch holds twice is known to be shared: its runs are passed on in a bin
            # of the batch's own, and one entry without windows tells the anchor's bin
            _, rep, group, times = np.unique(value, return_index=True, return_inverse=True,
                                             return_counts=True)
            known = (times > 1)[group]
            send = ~known
            send[rep] = True
            cols = [(value >> np.uint64(12)).astype("<u4"), start.astype("<u4"), n.astype("<u2")]
            if known.any():
                own = -1 - int(hs[0]) % n_bins
                yield _blob_rows(np.full(int(known.sum()), own), owner[known], docs,
                                 *[c[known] for c in cols])
            cols[2] = np.where(known, 0, n).astype("<u2")
            yield _blob_rows((value % np.uint64(n_bins)).astype(np.int64)[send], owner[send], docs,
                             *[c[send] for c in cols])

    def shared(key, table):
        docs, owner, (value, start, n) = _entries(table, 3, "<u4", "<u4", "<u2")
        if key[0].as_py() < 0:
            return _spans_rows(docs, owner, start, n.astype("<u4"))
        told = value[n == 0]
        order = np.lexsort((docs[:, 0], docs[:, 1], docs[:, 2]))  # content, ord, h
        first = first_of_runs(docs[order, 2], np.zeros(len(docs), np.int8))
        is_first = np.zeros(len(docs), bool)
        is_first[order[first]] = True
        # the same document may come in several rows: its entries are in the first of them, or
        # were passed on by the batch of the others
        keep = is_first[owner] & (n > 0)
        owner, value, start, n = owner[keep], value[keep], start[keep], n[keep]
        ordered = np.sort(value)
        # an anchor is shared if another run has it, or a batch said so
        twice = np.union1d(ordered[:-1][ordered[1:] == ordered[:-1]], told)
        i = np.searchsorted(twice, value)
        hit = np.zeros(len(value), bool)
        inside = i < len(twice)
        hit[inside] = twice[i[inside]] == value[inside]
        return _spans_rows(docs, owner[hit], start[hit], n[hit].astype("<u4"))

    import pyarrow as pa
    blobs = rows.mapInArrow(anchors, BLOB)
    return blobs.groupBy("bin").applyInArrow(
        lambda key, t: pa.Table.from_batches([shared(key, t)]), "h long, a binary, b binary")


def kept_windows(texts, spans, window):
    """Flat words, counts and, per text, which windows its spans cover (as flat positions)."""
    flat, counts = words_of(texts)
    first = np.cumsum(counts) - counts
    parts = []
    for i, s in enumerate(spans):
        for at, n in s:
            parts.append(np.repeat(first[i] + at.astype(np.int64), n) + _ramps(n))
    at = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
    owner = np.searchsorted(np.cumsum(counts), at, side="right")
    return flat, counts, at, owner


def _ramps(n: np.ndarray) -> np.ndarray:
    n = n.astype(np.int64)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def unpack(pairs) -> list:
    return [(np.frombuffer(p["a"], "<u4"), np.frombuffer(p["b"], "<u4")) for p in pairs or []]


def dedup_substrings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     window: int = 20, limit: int = 1_000_000, carry: bool = False) -> DataFrame:
    """One row per row of ``df``: _id, _h (see ``row_key``), n_words, n_removed,
    spans (removed words as (first word, number) pairs), kept_sha256 and, where words were
    removed, text: the kept words joined by one space.

    A word goes if a window of ``window`` words over it has the same words as a
    window that starts earlier (smaller id, or same id, earlier start).  Words
    are runs of anything but ASCII white space.  Windows are judged on the
    input.  Rows with equal id and text are one document; of different texts
    with the same id the smaller ``_h`` comes first; null ids come last.  Null
    and empty texts have no words.  Empty table: no rows.  Other columns are
    ignored.  ``limit`` is the number of suffixes a task is to hold.  ``carry`` adds
    row, a struct of all columns but the text, and gives every row's text: the
    kept words where some were removed, else the text as it was.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("_id"),
                     F.xxhash64(id_col, text_col).alias("h"),
                     F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("ord"),
                     F.xxhash64(text_col).alias("content"),
                     F.xxhash64(F.lit(1), text_col).alias("content2"),
                     F.col(text_col).cast("string").alias("text"),
                     *([F.struct(*[df[c] for c in df.columns if c != text_col]).alias(CARRIED)]
                       if carry else []))
    carried = [f for f in rows.schema if f.name == CARRIED]
    own = [f.name for f in carried]
    chars = df.agg(F.sum(F.length(text_col))).first()[0]
    # about a word in five characters, an anchor in five words
    suspects = materialise(repeated_anchors(rows.select("h", "ord", "content", "text"), window,
                                            parts_for(chars, 50 * limit)), "anchors")
    known = (suspects.select("h", "a", "b", F.lit(False).alias("copy"))
             .union(later_copies(rows).select("h", F.lit(None), F.lit(None), F.lit(True)))
             .groupBy("h").agg(F.collect_list(F.when(F.col("a").isNotNull(), F.struct("a", "b")))
                               .alias("spans"), F.max("copy").alias("copy")))  # one document's
    held = materialise(
        rows.select("_id", "h", "text", *own).join(known, "h", "left")
        .mapInArrow(_first_pass(window, carry), _with(HELD, carried)), "suffixes")
    some = held.where("at is not null")
    n = some.agg(F.sum(F.octet_length("at") / 4)).first()[0]
    bins = parts_for(n, limit)
    groups = 64 * bins
    heavy = _large_groups(some, window, limit, groups)
    firsts = _first_of_heavy(some, window, heavy, groups)
    doomed = _tree_repeats(some, window, heavy, groups, bins).groupBy("h").agg(
        F.collect_list(F.struct("a", "b")).alias("spans"))
    schema = "_id long, _h long, n_words long, n_removed long, spans binary, sha string, text string"
    # starts of suffixes are read again only for windows above the limit
    cut = (some.select(*(SUFFIX_COLUMNS if firsts else SUFFIX_COLUMNS[:3]), *own)
           .join(doomed, "h", "left")
           .mapInArrow(_last_pass(window, heavy, groups, firsts, carry), _with(schema, carried)))
    rest = held.where("at is null").select(
        "_id", F.col("h").alias("_h"), "n_words", "n_removed", "spans", "sha",
        (F.coalesce("kept", "text") if carry else F.col("kept")).alias("text"), *own)
    return rest.union(cut).withColumnRenamed("sha", "kept_sha256")


def later_copies(rows: DataFrame) -> DataFrame:
    """h of texts that an earlier row (smaller ``ord``, then h) holds as a whole."""
    slim = rows.where("text is not null").select("h", "ord", "content", "content2")
    groups = materialise(slim.groupBy("content", "content2").agg(
        F.min(F.struct("ord", "h")).alias("f"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("content", "content2", F.col("f.h").alias("first")), "copies")
    # both sides are read from files, so that Spark can split the rows of a hot text
    return slim.join(groups, ["content", "content2"]).where("h <> first").select("h").distinct()


HELD = ("_id long, h long, n_words long, n_removed long, spans binary, sha string, kept string, "
        "text string, at binary")


def _with(schema: str, carried: list) -> StructType:
    """A schema and the carried column, if there is one."""
    return StructType([*StructType.fromDDL(schema), *carried])


def _and_row(batch, row: list):
    """A batch of rows and what is carried with them, if anything is."""
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([*batch.columns, *row],
                                      [*batch.schema.names, *[CARRIED] * len(row)])


def _first_pass(window, carry=False):
    """Results of texts without suspected suffixes and of copies; of the others the text and the
    starts of those suffixes."""
    names, types = zip(*(c.split() for c in HELD.split(", ")), strict=True)

    def run(batches):
        for texts, ids, hs, spans, copy, *row in _slices(
                batches, ["text", "_id", "h", "spans", "copy", *[CARRIED] * carry]):
            known = [unpack(x) if not c else [] for x, c in zip(spans, copy, strict=True)]
            flat, counts, at, owner = kept_windows(texts, known, window)
            first = np.cumsum(counts) - counts
            cuts = np.searchsorted(owner, np.arange(len(counts) + 1))
            out = []
            for i, t in enumerate(texts):
                lo, hi, n = cuts[i], cuts[i + 1], int(counts[i])
                if hi > lo:
                    out.append((ids[i], hs[i], n, None, None, None, None, t,
                                (at[lo:hi] - first[i]).astype("<u4").tobytes()))
                elif copy[i] and n >= window:  # every word is in a window that starts earlier
                    out.append((ids[i], hs[i], n, n, np.array([0, n], "<u4").tobytes(),
                                hashlib.sha256().hexdigest(), "", None, None))
                else:
                    words = b" ".join(flat[first[i]:first[i] + n])
                    out.append((ids[i], hs[i], n, 0, None, hashlib.sha256(words).hexdigest(), None,
                                t if carry else None, None))
            yield _and_row(_rows(names, types, out), row)
    return run


class Suffixes:
    """The suspected suffixes of a batch and the prefix group of each."""

    def __init__(self, batch, window):
        texts, ids, hs, at = batch
        flat, counts = words_of(texts)
        self.first = np.cumsum(counts) - counts
        self.owner = np.repeat(np.arange(len(texts)), [len(x) // 4 for x in at])
        self.start = np.frombuffer(b"".join(at), "<u4")
        self.docs = np.array([(h, NULL_ID if d is None else d) for h, d in
                              zip(hs, ids, strict=True)], "<i8").reshape(-1, 2)
        self.flat, self.window, self.symbols, self.texts = flat, window, symbols(flat), texts
        self.words = self.first[self.owner] + self.start.astype(np.int64)
        self.prints = mixed(rolling(self.symbols, window))[self.words]

    def codes(self, which: np.ndarray) -> np.ndarray:
        """Words of the named suffixes down to the window's depth, 16 bits each; one row a suffix."""
        short = (mixed(self.symbols) >> np.uint64(48)).astype(">u2")
        return np.lib.stride_tricks.sliding_window_view(short, self.window)[self.words[which]]

    def prefix(self, level: int) -> np.ndarray:
        return mixed(rolling(self.symbols, level))[self.words] if level < self.window \
            else self.prints

    def prefix_group(self, level: int, n: int) -> np.ndarray:
        """Group of the prefix; a whole window is a group of its own."""
        h = self.prefix(level)
        return h if level == self.window else h % np.uint64(n)

    def groups(self, heavy: dict[int, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the shortest prefix whose group is not too large, whether there is one)."""
        out = np.zeros(len(self.words), np.uint64)
        todo = np.arange(len(self.words))
        for level, frequent in heavy.items():
            is_heavy = np.isin(self.prefix_group(level, n)[todo], frequent)
            out[todo[~is_heavy]] = self.prefix(level)[todo[~is_heavy]]
            todo = todo[is_heavy]
        found = np.ones(len(out), bool)
        found[todo] = False
        return out, found


SUFFIX_COLUMNS = ["text", "_id", "h", "at"]


def _large_groups(some: DataFrame, window: int, limit: int, n: int) -> dict[int, np.ndarray]:
    """By level the groups of prefixes that more than ``limit`` suffixes share; the last level has
    none.  At most (number of suffixes / limit) groups a level come to the driver."""
    large: dict[int, np.ndarray] = {}
    for level in [x for x in LEVELS if x < window] + [window]:
        known = dict(large)

        def count(batches, level=level, known=known):
            for batch in _slices(batches, SUFFIX_COLUMNS):
                s = Suffixes(batch, window)
                h = s.prefix_group(level, n)
                h = h[~s.groups(known, n)[1]] if known else h
                values, sums = np.unique(h, return_counts=True)
                yield _rows(["p", "n"], ["long", "long"],
                            list(zip(values.view(np.int64).tolist(), sums.tolist(), strict=True)))

        sums = (some.mapInArrow(count, "p long, n long").groupBy("p")
                .agg(F.sum("n").alias("n")).where(F.col("n") > limit))
        found = [r["p"] for r in sums.select("p").collect()]
        large[level] = np.array(found, np.int64).view(np.uint64)
        if not found:
            break
    return large


def _first_of_heavy(some: DataFrame, window: int, heavy: dict, n: int) -> dict[int, tuple]:
    """fingerprint -> (id, h, start) of the first suffix of each window above the limit."""
    if window not in heavy or not len(heavy[window]):
        return {}

    def local(batches):
        for batch in _slices(batches, SUFFIX_COLUMNS):
            s = Suffixes(batch, window)
            at = np.flatnonzero(~s.groups(heavy, n)[1])
            docs = s.docs[s.owner[at]]
            order = np.lexsort((s.start[at], docs[:, 0], docs[:, 1], s.prints[at]))
            at, docs = at[order], docs[order]
            first = first_of_runs(s.prints[at], np.zeros(len(at), np.int8))
            yield _rows(["p", "id", "h", "start"], ["long"] * 4, [
                (int(s.prints[at[i]].view(np.int64)), int(docs[i, 1]), int(docs[i, 0]),
                 int(s.start[at[i]])) for i in first])

    found = (some.mapInArrow(local, "p long, id long, h long, start long").groupBy("p")
             .agg(F.min(F.struct("id", "h", "start")).alias("f")).collect())
    return {r["p"]: tuple(r["f"]) for r in found}


def sort_keys(codes: np.ndarray) -> np.ndarray:
    """Rows of 16-bit words as rows of 64-bit numbers in the same order; the rest is zero."""
    n, window = codes.shape
    wide = np.zeros((n, -(-window // 4) * 4), ">u2")
    wide[:, :window] = codes
    return wide.view(">u8").astype(np.uint64)


def common_prefixes(keys: np.ndarray, prints: np.ndarray, window: int) -> np.ndarray:
    """Words that each suffix, in sorted order, shares with the one before (0 for the first).

    ``prints`` decide about the last word where all codes agree.
    """
    out = np.zeros(len(keys), np.int64)
    if len(keys) > 1:
        first = np.full(len(keys) - 1, window)
        for i in reversed(range(keys.shape[1])):
            x = keys[1:, i] ^ keys[:-1, i]
            same = sum((x < np.uint64(1 << bits)).astype(np.int64) for bits in (48, 32, 16))
            first = np.where(x != 0, 4 * i + same, first)
        out[1:] = np.where((first >= window) & (prints[1:] != prints[:-1]), window - 1, first)
    return out


def _tree_repeats(some: DataFrame, window: int, heavy: dict, n: int, bins: int) -> DataFrame:
    """(h, a, b): windows (first word, 1) that are not the first of their node, per document."""
    import pyarrow as pa

    def deal(batches):
        for batch in _slices(batches, SUFFIX_COLUMNS):
            s = Suffixes(batch, window)
            group, found = s.groups(heavy, n)
            yield _blob_rows((group[found] % np.uint64(bins)).astype(np.int64), s.owner[found],
                             s.docs, s.prints[found], s.start[found], s.codes(found))

    def subtrees(key, table):
        docs, owner, (prints, start, codes) = _entries(table, 2, "<u8", "<u4", ">u2")
        keys = sort_keys(codes.reshape(-1, window))
        del codes
        order = np.lexsort((start, docs[owner, 0], docs[owner, 1], prints, *keys.T[::-1]))
        depth = common_prefixes(keys[order], prints[order], window)
        first = np.flatnonzero(depth < window)  # where another node, or a leaf, begins
        head = np.repeat(order[first], np.diff(np.append(first, len(order))))
        # repeated rows are the same document: their suffixes are the first one too
        later = (docs[owner[order], 0] != docs[owner[head], 0]) | (start[order] != start[head])
        hit = np.sort(order[later])
        return pa.Table.from_batches([_spans_rows(
            docs, owner[hit], start[hit], np.ones(len(hit), "<u4"))])

    return some.mapInArrow(deal, BLOB).groupBy("bin").applyInArrow(
        subtrees, "h long, a binary, b binary")


def _last_pass(window: int, heavy: dict, groups: int, firsts: dict, carry: bool = False):
    """Words left of each text, once the repeated windows are known."""
    columns = [*(SUFFIX_COLUMNS if firsts else SUFFIX_COLUMNS[:3]), "spans"]

    def run(batches):
        for cols in _slices(batches, [*columns, *[CARRIED] * carry]):
            (*batch, spans), row = cols[:len(columns)], cols[len(columns):]
            texts, ids, hs = batch[:3]
            gone = [[a.astype(np.int64) for a, _ in unpack(x)] for x in spans]
            if firsts:
                s = Suffixes(batch, window)
                for j in np.flatnonzero(~s.groups(heavy, groups)[1]):
                    doc = s.docs[s.owner[j]]
                    if firsts[int(s.prints[j].view(np.int64))] != (doc[1], doc[0], s.start[j]):
                        gone[s.owner[j]].append(np.array([s.start[j]], np.int64))
            out = []
            for i, text in enumerate(texts):
                own = text.encode().split()
                marks = np.zeros(len(own) + 1, np.int64)
                if gone[i]:
                    at = np.concatenate(gone[i])
                    np.add.at(marks, at, 1)
                    np.add.at(marks, at + window, -1)
                cut = np.cumsum(marks[:-1]) > 0
                kept = b" ".join(w for w, c in zip(own, cut.tolist(), strict=True) if not c)
                edges = np.flatnonzero(np.diff(np.r_[False, cut, False]))
                spans_ = np.stack([edges[::2], edges[1::2] - edges[::2]], 1).astype("<u4")
                n = int(cut.sum())
                out.append((ids[i], hs[i], len(own), n, spans_.tobytes() if n else None,
                            hashlib.sha256(kept).hexdigest(),
                            kept.decode() if n else text if carry else None))
            yield _and_row(_rows(
                ["_id", "_h", "n_words", "n_removed", "spans", "sha", "text"],
                ["long", "long", "long", "long", "binary", "string", "string"], out), row)
    return run
