"""LM scoring (operator 9): prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes with the counts of
the training texts.  A symbol is coded at the longest context that has been
seen; if it is new there, an escape (method C: as many chances as different
symbols seen) leads to the next shorter context, where symbols already ruled
out are excluded; below the empty context all symbols that are left are
equally likely.  One symbol ends a text.

Counting and scoring share one exchange.  Documents are dealt to chunks of a
few megabytes; a chunk sends its distinct (context, symbol) runs with their
training counts, packed, to the bins of the trie.  A bin holds the subtrees
below some three-byte contexts; it adds up the counts and answers each chunk
with the cost of the runs it asked for.  Only counts of three-byte runs (at
most 2^24 of them, whatever the corpus) are gathered and sent to all tasks, for
the short contexts that all bins share.  Words of the unigram base take the
same way.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import parts_for, ship
from .grams import ASCII_LOWER, first_of_runs, symbols

ORDER = 5
#: ends a text and fills the context before it; no UTF-8 text holds this byte
END = 0xFF
CHUNK_CHARS, BLOCK_CHARS = 16_000_000, 3_000_000
#: bytes of packed keys that one task is to hold of a bin; a larger bin is split by chunks
BIN_BYTES = 128_000_000
RUNS, WORDS = 0, 1
BLOB = "kind int, bin long, chunk long, keys binary, counts binary"


def mask(order: int) -> np.uint64:
    """Of a run, the symbol and ``order`` bytes of context."""
    return np.uint64((1 << 8 * (order + 1)) - 1)


def lowered(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode().translate(ASCII_LOWER) for t in texts]


def byte_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ORDER + 1 bytes, one per byte and end of the texts; how many each text has."""
    pad = bytes([END]) * ORDER
    stream = np.frombuffer(b"".join([pad + t + pad[:1] for t in texts]), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    runs = np.zeros(max(0, len(stream) - ORDER), np.uint64)
    for j in range(ORDER + 1):
        runs = (runs << np.uint64(8)) | stream[j:len(stream) - ORDER + j]
    starts = np.cumsum(lengths + ORDER) - (lengths + ORDER)
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    return runs[at], lengths


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = first_of_runs(keys, np.zeros(len(keys), np.int8))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each occurs where ``train`` holds."""
    order = np.sort((keys << np.uint64(1)) | train.astype(np.uint64))
    first = first_of_runs(order, np.zeros(len(order), np.int8))
    n = np.diff(np.append(first, len(order)))
    tagged = order[first]
    return summed(tagged >> np.uint64(1), np.where(tagged & np.uint64(1), n, 0).astype(np.int64))


def word_keys(words: list[bytes]) -> np.ndarray:
    return symbols(words) >> np.uint64(1)  # 63 bits, so that a flag fits beside them


def blocks(cols: list[list]):
    """Rows of a chunk in pieces of bounded text; the first column is the text."""
    start = chars = 0
    for i, t in enumerate(cols[0]):
        chars += len(t or "") + 1
        if chars >= BLOCK_CHARS or i == len(cols[0]) - 1:
            yield [c[start:i + 1] for c in cols]
            start, chars = i + 1, 0


def _table(names, types, rows):
    import pyarrow as pa
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)


def collect_chunk(bins: int):
    def run(key, table):
        import pyarrow as pa
        parts = {RUNS: [], WORDS: []}
        for texts, train in blocks([table["text"].to_pylist(), table["train"].to_pylist()]):
            data, train = lowered(texts), np.array(train, bool)
            runs, lengths = byte_runs(data)
            parts[RUNS].append(counted(runs, np.repeat(train, lengths)))
            cut = [t.split() for t in data]
            keys = word_keys([w for x in cut for w in x])
            parts[WORDS].append(counted(keys, np.repeat(train, [len(x) for x in cut])))
        chunk, rows = key[0].as_py(), []
        for kind, found in parts.items():
            keys, counts = summed(*(np.concatenate(x) for x in zip(*found, strict=True)))
            where = bin_of(kind, keys, bins)
            order = np.argsort(where, kind="stable")
            keys, counts, where = keys[order], counts[order], where[order]
            cuts = np.append(first_of_runs(where, np.zeros(len(where), np.int8)), len(where))
            rows += [(kind, int(where[lo]), chunk,
                      pack(keys[lo:hi]), counts[lo:hi].astype("<u4").tobytes())
                     for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return _table([c.split()[0] for c in BLOB.split(", ")], types, rows)
    return run


def bin_of(kind: int, keys: np.ndarray, bins: int) -> np.ndarray:
    if kind == RUNS:  # the three bytes before the symbol
        keys = (keys >> np.uint64(8)) & np.uint64(0xFFFFFF)
        keys = (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    return (keys % np.uint64(bins)).astype(np.int64)


def pack(keys: np.ndarray) -> bytes:
    """Low halves, then high halves: of ascending runs the latter hardly change, so they compress."""
    return np.concatenate([keys & np.uint64(0xFFFFFFFF), keys >> np.uint64(32)]).astype(
        "<u4").tobytes()


def unpacked(table) -> list[np.ndarray]:
    """The packed keys of each row."""
    halves = [np.frombuffer(x, "<u4").reshape(2, -1).astype(np.uint64)
              for x in table["keys"].to_pylist()]
    return [low | (high << np.uint64(32)) for low, high in halves]


def all_keys(table) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *unpacked(table)])


def _joined(table, column, kind):
    return np.frombuffer(b"".join(table[column].to_pylist()), kind)


def merge_counts(key, table):
    """Trained keys of a bin with the sums of their counts."""
    import pyarrow as pa
    counts = _joined(table, "counts", "<u4" if "salt" in table.column_names else "<i8")
    keys, counts = summed(all_keys(table), counts.astype(np.int64))
    keys, counts = keys[counts > 0], counts[counts > 0]
    row = (key[0].as_py(), key[1].as_py(), len(keys), int(counts.sum()),
           pack(keys), counts.astype("<i8").tobytes())
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return _table(["kind", "bin", "distinct", "total", "keys", "counts"], types, [row])


MODEL = "kind int, bin long, distinct long, total long, keys binary, counts binary"


def short_runs(batches):
    """Sums of the training counts per three-byte run, for each batch of bins."""
    import pyarrow as pa
    for b in batches:
        keys, counts = summed(all_keys(b) & mask(2), _joined(b, "counts", "<i8"))
        yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts)],
                                         ["run", "n"])


class Level:
    """Contexts of one order: the runs seen, and per context total and distinct symbols."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int):
        self.runs, self.n = summed(keys & mask(order), counts)
        ctx = self.runs >> np.uint64(8)
        self.first = first_of_runs(ctx, np.zeros(len(ctx), np.int8))
        self.ctx = ctx[self.first]
        self.total = np.add.reduceat(self.n, self.first) if len(self.first) else self.n[:0]
        self.distinct = np.diff(np.append(self.first, len(self.runs)))
        self.order = order

    def excluded(self, longer: Level) -> np.ndarray:
        """Per context of the next longer order: this order's counts of the symbols seen there."""
        _, at = find(self.runs, longer.runs & mask(self.order))
        return np.add.reduceat(self.n[at], longer.first) if len(longer.first) else self.n[:0]


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether found, where) of each wanted value in ascending ``keys``."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def ppm_costs(runs: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 probability of the last byte of each run after the bytes before it.

    ``levels`` are those of orders 0 .. ORDER.
    """
    cost = np.zeros(len(runs))
    todo = np.arange(len(runs))
    ruled_sum = np.zeros(len(runs), np.int64)  # what longer contexts exclude here
    ruled = np.zeros(len(runs), np.int64)
    for level in reversed(levels):
        wanted = runs[todo] & mask(level.order)
        has, at = find(level.ctx, wanted >> np.uint64(8))
        if len(level.ctx):
            total = np.where(has, level.total[at] - ruled_sum[todo], 0)
            fresh = np.where(has, level.distinct[at] - ruled[todo], 0)
            hit, where = find(level.runs, wanted)
            n = np.where(hit, level.n[where], 0)
            room = np.maximum(total + fresh, 1)
            step = np.where(hit, n / room, np.where(fresh > 0, fresh / room, 1.0))
            cost[todo] += np.log10(step)
        else:
            hit = has
        if level.order and len(level.ctx):
            below = levels[level.order - 1].excluded(level)
            ruled_sum[todo] = np.where(has, below[at], 0)
            ruled[todo] = np.where(has, level.distinct[at], 0)
        elif not level.order:
            ruled[todo] = len(level.runs)
        todo = todo[~hit]
    cost[todo] += -np.log10(np.maximum(256 - ruled[todo], 1))
    return cost


def levels_of(keys, counts, short) -> list[Level]:
    """Orders 0 .. 2 from the shared three-byte runs, the rest from a bin's own runs."""
    runs, n = short
    return ([Level(runs, n, o) for o in range(3)]
            + [Level(keys, counts, o) for o in range(3, ORDER + 1)])


def answer(short):
    """Costs of runs, or training counts of words, for the chunks that ask a bin."""
    def run(key, asked, model):
        import pyarrow as pa
        kind = key[0].as_py()
        keys = all_keys(asked)
        known = all_keys(model), _joined(model, "counts", "<i8")
        distinct, back = np.unique(keys, return_inverse=True)
        if kind == RUNS:
            values = ppm_costs(distinct, levels_of(*known, short))
        else:
            hit, at = find(known[0], distinct)
            values = np.zeros(len(distinct))
            values[hit] = known[1][at[hit]]
        values = values.astype("<f8" if kind else "<f4")[back]
        ends = np.cumsum([len(x) // 8 for x in asked["keys"].to_pylist()]).astype(int)
        rows = [(kind, c, k, values[hi - len(k) // 8:hi].tobytes()) for c, k, hi in zip(
            asked["chunk"].to_pylist(), asked["keys"].to_pylist(), ends, strict=True)]
        return _table(["kind", "chunk", "keys", "vals"],
                      [pa.int32(), pa.int64(), pa.binary(), pa.binary()], rows)
    return run


def score_chunk(docs, answers):
    import pyarrow as pa
    kinds = np.array(answers["kind"].to_pylist(), int)
    found = {}
    for kind, t in ((RUNS, "<f4"), (WORDS, "<f8")):
        part = answers.filter(pa.array(kinds == kind))
        keys, values = all_keys(part), _joined(part, "vals", t)
        order = np.argsort(keys)
        found[kind] = keys[order], values[order]
    rows = []
    for texts, ids, train in blocks([docs[c].to_pylist() for c in ("text", "_id", "train")]):
        data = lowered(texts)
        runs, lengths = byte_runs(data)
        cost = found[RUNS][1][np.searchsorted(found[RUNS][0], runs)].astype(np.float64)
        score = np.add.reduceat(cost, np.cumsum(lengths) - lengths)
        cut = [t.split() for t in data]
        n = np.array([len(x) for x in cut], np.int64)
        at = np.searchsorted(found[WORDS][0], word_keys([w for x in cut for w in x]))
        seen = np.append(found[WORDS][1][at] if len(at) else np.zeros(0), 0)
        ends = np.cumsum(n)
        logs, known = (np.append(0, np.cumsum(x)) for x in (np.log10(seen + 1), seen > 0))
        rows += zip(ids, train, (n + 1).tolist(), (known[ends] - known[ends - n]).tolist(),
                    (logs[ends] - logs[ends - n]).tolist(), score.tolist(), strict=True)
    return _table(["_id", "train", "n_tokens", "n_known", "logs", "score"],
                  [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()],
                  rows)


def salted(blobs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(blobs with a salt, (kind, bin, salts) of the bins that need more than one, or None).

    A bin of a very common context gets keys from all chunks: it is split by
    chunk into as many tasks as its measured bytes ask for.
    """
    sizes = blobs.groupBy("kind", "bin").agg(F.sum(F.length("keys")).alias("bytes"))
    large = materialise(sizes.where(F.col("bytes") > BIN_BYTES).select(
        "kind", "bin", F.ceil(F.col("bytes") / F.lit(BIN_BYTES)).alias("salts")), "large_bins")
    if not large.limit(1).count():
        return blobs.withColumn("salt", F.lit(0).cast("long")), None
    own = F.pmod("chunk", F.coalesce("salts", F.lit(1).cast("long")))
    return (blobs.join(large, ["kind", "bin"], "left").withColumn("salt", own).drop("salts"), large)


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          folds: int = 7, held_fold: int = 2) -> DataFrame:
    """One row per row of ``df``: _id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows whose crc32 of the id as text, modulo
    ``folds``, is not ``held_fold``, and scores all.  ``score`` is the log10
    probability of the text's bytes and its end, after lower-casing A-Z;
    ``base_score`` that of its words and an end under add-one unigram counts.

    Null or empty texts are an end alone.  Rows with a null id are learned
    from.  Repeated rows count each time and get equal results.  Very long
    texts are scored whole.  Without training rows all bytes are equally likely.
    Empty table: no rows.  Other columns are ignored.
    """
    ship(df.sparkSession)
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds
    docs = df.select(F.col(id_col).cast("long").alias("_id"),
                     F.col(text_col).cast("string").alias("text"),
                     (fold != held_fold).alias("train"))
    size = docs.agg(F.sum(F.length("text") + 1), F.sum(F.col("train").cast("long"))).first()
    chunks = parts_for(size[0], CHUNK_CHARS)
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64("_id", "text"), F.lit(chunks)))
    blobs = materialise(docs.groupBy("chunk").applyInArrow(collect_chunk(chunks), BLOB), "runs")
    blobs, large = salted(blobs)
    partial = blobs.groupBy("kind", "bin", "salt").applyInArrow(merge_counts, MODEL)
    model = materialise(partial.groupBy("kind", "bin").applyInArrow(merge_counts, MODEL), "trie")
    short = (model.where(F.col("kind") == RUNS).mapInArrow(short_runs, "run long, n long")
             .groupBy("run").agg(F.sum("n").alias("n")).orderBy("run").toPandas())  # <= 2^24 rows
    short = short["run"].to_numpy(np.uint64), short["n"].to_numpy(np.int64)
    words = model.where(F.col("kind") == WORDS).agg(F.sum("total"), F.sum("distinct")).first()
    ends = size[1] or 0
    total, vocabulary = (words[0] or 0) + ends, (words[1] or 0) + (ends > 0)

    # only the model of a large bin is sent more than once
    copies = model.withColumn("salt", F.lit(0).cast("long")) if large is None else (
        model.join(large, ["kind", "bin"], "left").withColumn("salt", F.explode(F.sequence(
            F.lit(0).cast("long"), F.coalesce("salts", F.lit(1).cast("long")) - 1))).drop("salts"))
    asked = blobs.drop("counts")
    answers = (asked.groupBy("kind", "bin", "salt").cogroup(copies.groupBy("kind", "bin", "salt"))
               .applyInArrow(answer(short), "kind int, chunk long, keys binary, vals binary"))
    scored = docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score_chunk, "_id long, train boolean, n_tokens long, n_known long, logs double, "
        "score double")
    base = (F.col("logs") + float(np.log10(ends + 1))
            - F.col("n_tokens") * float(np.log10(total + vocabulary + 1)))
    return scored.select(
        "_id", (~F.col("train")).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
