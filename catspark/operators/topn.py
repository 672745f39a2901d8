"""Best categories of a page without scoring every centroid.

Centroids are put into blocks of a few whose largest weights are alike.  For
every word a block knows the largest weight that any of its centroids has, so
the dot product of a page with these maxima is at least the page's score for
each of the block's centroids.  A page scores its blocks from the highest
bound down and stops when no other block can reach the n-th best score that
it has already: the result is exact.

Pages and blocks are dealt to a grid of tasks; each task returns the best of
its blocks for its pages, so products never leave it.

The grid copies both sides, which is cheap for some thousand pages only.  Past
``COPIES`` rows the words are dealt to tasks instead (``summed_scores``): nothing
is copied, and partial scores of each page are added up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ranking import global_rank
from ..session import materialise

#: scores are ranked at 9 digits: what may be equal there is never skipped
MARGIN = 1e-8
#: centroids of a block, blocks and words of a chunk, pages of a chunk
BLOCK, CHUNK_BLOCKS, CHUNK_WORDS, CHUNK_PAGES = 4, 64, 1_000_000, 512
#: rows that the grid may send to its tasks, and centroid entries of a chunk of words
COPIES, CHUNK_ENTRIES = 20_000_000, 12_000_000
#: of a centroid entry in a shuffle
ENTRY_BYTES = 10


def _unit(rows: DataFrame, key: str, names: DataFrame, numbers: list[str]) -> DataFrame:
    """(numbers, word, weight) with unit weights of the keys in ``names(key, numbers, norm)``."""
    return (rows.where(F.col("weight") != 0).join(names, key)
            .select(*numbers, "word", (F.col("weight") / F.col("norm")).alias("weight")))


def _numbered(vectors: DataFrame, cents: DataFrame, pages: DataFrame):
    """(cats, pages, page_rows, words), written, of vectors scaled to unit length.

    ``cats(cat_name, cat, norm)`` and ``pages(title, page, n, norm)`` number both sides,
    ``page_rows(page, n, word, weight)`` are the pages' vectors and ``words(word, w, e)`` has one row
    per word of both sides with its centroids' (cat, weight).  ``pages(title, n)`` asks.
    """
    heads = (cents.where(F.col("weight") != 0).groupBy("cat_name").agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"),
        F.max("weight").alias("_top")))
    cats = global_rank(heads.withColumn("_top", F.col("_top") / F.col("norm")),
                       ["_top", "cat_name"], "cat").select("cat_name", "cat", "norm")
    pages = (vectors.join(pages.select("title", "n"), "title")
             .where(F.col("weight") != 0).groupBy("title").agg(
                 F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"),
                 F.max("n").alias("n")))
    # the numbers are made once and read from the written table
    pages = materialise(pages.withColumn("page", F.monotonically_increasing_id()), "numbered_pages")
    page_rows = materialise(_unit(vectors, "title", pages, ["page", "n"]), "unit_pages")
    own = _unit(cents.join(page_rows.select("word").distinct(), "word", "left_semi"), "cat_name",
                cats, ["cat"])
    # a word has at most one entry per centroid
    words = own.groupBy("word").agg(F.collect_list(F.struct("cat", "weight")).alias("e"))
    words = materialise(words.withColumn("w", F.monotonically_increasing_id()), "centroid_words")
    return cats, pages, page_rows, words


def best_categories(vectors: DataFrame, cents: DataFrame, counts: DataFrame,
                    cent_cats: DataFrame) -> DataFrame:
    """(title, cat_name, score): for each page of ``counts(title, n)`` at least its n best
    categories by cosine among those that share a word with it.

    Pages sharing words with fewer than n centroids have fewer rows.  Ties and
    a few categories below the n-th best may come along.  Weights must not be
    negative.
    """
    cents = cents.join(cent_cats.select("cat_name"), "cat_name", "left_semi")
    cats, pages, page_rows, words = _numbered(vectors, cents, counts.where("n >= 1"))
    size = words.agg(F.sum(F.size("e"))).first()[0] or 0
    n_cats = cats.count()
    n_chunks = max(1, -(-size // CHUNK_WORDS), -(-n_cats // (BLOCK * CHUNK_BLOCKS)))
    n_pages = max(1, -(-pages.count() // CHUNK_PAGES))
    if size * n_pages + page_rows.count() * n_chunks > COPIES:
        found = summed_scores(page_rows, words, size, n_cats, n_pages, best=True)
    else:
        found = _pruned_scores(page_rows, words, n_chunks, n_pages)
    return (found.join(pages.select("page", "title"), "page")
            .join(cats.select("cat", "cat_name"), "cat").select("title", "cat_name", "score"))


def all_scores(vectors: DataFrame, cents: DataFrame) -> DataFrame:
    """(title, cat_name, score): cosine of every page and centroid that share a word."""
    asked = vectors.select("title").distinct().withColumn("n", F.lit(0).cast("long"))
    cats, pages, page_rows, words = _numbered(vectors, cents, asked)
    size = words.agg(F.sum(F.size("e"))).first()[0] or 0
    n_pages = max(1, -(-pages.count() // CHUNK_PAGES))
    found = summed_scores(page_rows, words, size, cats.count(), n_pages, best=False)
    return (found.join(pages.select("page", "title"), "page")
            .join(cats.select("cat", "cat_name"), "cat").select("title", "cat_name", "score"))


def _every(n: int):
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _pruned_scores(page_rows: DataFrame, words: DataFrame, n_chunks: int,
                   n_pages: int) -> DataFrame:
    """(page, cat, score): whole pages meet whole centroids on a grid, and most pairs are skipped."""
    entries = words.select("w", F.explode("e").alias("e"))
    block = F.floor((F.col("e.cat") - 1) / BLOCK)  # ranks start at 1
    right = entries.select(F.pmod(F.xxhash64(block), F.lit(n_chunks)).cast("int").alias("c"),
                           _every(n_pages).alias("p"), F.col("e.cat").alias("cat"),
                           F.col("w").alias("cw"), F.col("e.weight").alias("weight"))
    left = (page_rows.join(words.select("word", F.col("w").alias("pw")), "word")
            .select(_every(n_chunks).alias("c"),
                    F.pmod(F.xxhash64("page"), F.lit(n_pages)).cast("int").alias("p"),
                    "page", "n", "pw", "weight"))

    # the function is sent to the tasks by value, without this package
    def grid(pages, cents):
        import pyarrow as pa
        column = lambda t, k: t.column(k).to_numpy()
        page, cat, score, _ = chunk_best(
            *[column(pages, k) for k in ("page", "n", "pw", "weight")],
            *[column(cents, k) for k in ("cat", "cw", "weight")])
        return pa.table({"page": pa.array(page, pa.int64()), "cat": pa.array(cat, pa.int64()),
                         "score": pa.array(score, pa.float64())})

    chunk_best = make_chunk_best(BLOCK, MARGIN)
    return left.groupBy("c", "p").cogroup(right.groupBy("c", "p")).applyInArrow(
        grid, "page long, cat long, score double")


def deal(size: int, n_cats: int, pages: int, cores: int) -> tuple[int, int, int]:
    """(spans, chunks, parts) of ``summed_scores`` for ``size`` centroid entries.

    Where the least number of chunks leaves cores idle, words are cut into more chunks or pages into
    parts: a part copies the entries of its chunk, a chunk sends a row of partial scores per page.
    What moves less is taken.
    """
    span = BLOCK * CHUNK_BLOCKS
    spans, least = max(1, -(-n_cats // span)), max(1, -(-size // CHUNK_ENTRIES))
    split = lambda chunks: max(1, cores // (spans * chunks))
    moved = lambda chunks: (size * split(chunks) * ENTRY_BYTES
                            + pages * chunks * spans * min(span, n_cats) * 8)
    full = [c for c in range(least + 1, cores // spans + 1) if cores // spans % c == 0]
    chunks = min([least, *full], key=moved)
    return spans, chunks, split(chunks)


def summed_scores(page_rows: DataFrame, words: DataFrame, size: int, n_cats: int, n_pages: int,
                  best: bool) -> DataFrame:
    """(page, cat, score): words are dealt to chunks, and a page's scores are sums over the chunks.

    A chunk holds the centroids' entries of its words (about ``CHUNK_ENTRIES``) and reads the pages'
    entries of these words in page order, so neither side is copied; what moves on is one row of
    partial scores per page and chunk.  More than BLOCK * CHUNK_BLOCKS centroids are cut into spans.
    ``best`` keeps the n best of each span (and ties), else all pairs that share a word.
    """
    span = BLOCK * CHUNK_BLOCKS
    cores = page_rows.sparkSession.sparkContext.defaultParallelism
    spans, chunks, parts = deal(size, n_cats, n_pages * CHUNK_PAGES, cores)
    chunk = F.pmod(F.xxhash64("w"), F.lit(chunks))
    key = ((F.col("c") * chunks + chunk) * parts + F.col("p")).cast("int").alias("k")
    none = lambda kind: F.lit(None).cast(kind)
    mine = F.filter("e", lambda x: F.floor((x["cat"] - 1) / span) == F.col("c"))
    right = (words.select("w", "e", _every(spans).alias("c")).withColumn("e", mine if spans > 1 else F.col("e"))
             .where(F.size("e") > 0).select("w", "e", "c", _every(parts).alias("p"))
             .select(key, none("long").alias("page"), none("long").alias("n"), "w",
                     none("double").alias("x"), "e"))
    left = (page_rows.join(words.select("word", "w"), "word")
            .select("page", "n", "w", F.col("weight").alias("x"), _every(spans).alias("c"),
                    F.pmod(F.xxhash64("page"), F.lit(parts)).alias("p"))
            .select(key, "page", "n", "w", "x", F.lit(None).cast(words.schema["e"].dataType).alias("e")))
    tasks = spans * chunks * parts
    dealt = right.unionByName(left).repartitionById(tasks, "k").sortWithinPartitions("k", "page")
    per_span = chunks * parts

    def partial(batches):
        """Partial scores of each page, nan where no word of the chunk is shared."""
        import numpy as np
        import pyarrow as pa
        at_k, held, table = None, [], None
        for batch in batches:
            ks = batch.column("k").to_numpy()
            for lo, hi in _runs(ks):
                rows = batch.slice(lo, hi - lo)
                if ks[lo] != at_k:
                    at_k, held, table = ks[lo], [], None
                m = rows.column("page").null_count  # nulls come first
                if m:
                    e = rows.column("e").slice(0, m)
                    flat = e.flatten()
                    held.append((rows.column("w").slice(0, m).to_numpy(),
                                 e.value_lengths().to_numpy(),
                                 flat.field("cat").to_numpy() - 1 - at_k // per_span * span,
                                 flat.field("weight").to_numpy()))
                if m == len(rows) or not held and table is None:
                    continue
                if table is None:
                    w, size, cat, weight = (np.concatenate(x) for x in zip(*held, strict=True))
                    held, start = [], np.cumsum(size) - size
                    order = np.argsort(w)
                    table = w[order], start[order], size[order].astype(np.int64), cat, weight
                w, start, size, cat, weight = table
                page, n, pw, x = (rows.column(i).slice(m).to_numpy() for i in ("page", "n", "w", "x"))
                at = np.minimum(np.searchsorted(w, pw), len(w) - 1)
                known = w[at] == pw
                page, n, at, x = page[known], n[known], at[known], x[known]
                if not len(page):
                    continue
                pids, first, row = np.unique(page, return_index=True, return_inverse=True)
                size = size[at]
                entry = np.repeat(start[at] - np.cumsum(size) + size, size) + np.arange(size.sum())
                cell = np.repeat(row * span, size) + cat[entry]
                sums = np.bincount(cell, np.repeat(x, size) * weight[entry], len(pids) * span)
                sums[np.bincount(cell, minlength=len(sums)) == 0] = np.nan
                sums = sums.reshape(len(pids), span)[:, :width]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pids), at_k // per_span, np.int32)), pa.array(pids),
                     pa.array(n[first]), pa.array([r.tobytes() for r in sums], pa.binary())],
                    ["c", "page", "n", "sums"])

    def total(group):
        import numpy as np
        import pyarrow as pa
        page, n = (group.column(i).to_numpy() for i in ("page", "n"))
        sums = np.frombuffer(b"".join(group.column("sums").to_pylist())).reshape(-1, width)
        order = np.argsort(page, kind="stable")
        pids, first = np.unique(page[order], return_index=True)
        sums, n = sums[order], n[order][first]
        shared = np.logical_or.reduceat(~np.isnan(sums), first)
        scores = np.add.reduceat(np.nan_to_num(sums), first)
        if best:
            ranked = -np.sort(-np.where(shared, scores, -np.inf), axis=1)
            last = ranked[np.arange(len(pids)), np.minimum(n, width) - 1]
            shared &= (scores > 0) & (scores >= last[:, None] - margin)
        at, cat = np.nonzero(shared)
        c = group.column("c")[0].as_py()
        return pa.table({"page": pa.array(pids[at]), "cat": pa.array(cat + 1 + c * span),
                         "score": pa.array(scores[at, cat])})

    _runs, margin, width = make_runs(), MARGIN, max(1, min(span, n_cats))
    rows = dealt.mapInArrow(partial, "c int, page long, n long, sums binary")
    return (rows.withColumn("p", F.pmod(F.xxhash64("page"), F.lit(n_pages)))
            .groupBy("c", "p").applyInArrow(total, "page long, cat long, score double"))


def make_runs():
    """The runs of equal numbers in an array, as a function that carries all it needs."""
    def runs(values):
        import numpy as np
        cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
        return [(lo, hi) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True) if hi > lo]

    return runs


def make_chunk_best(size: int, margin: float):
    """The work of one task of the grid, as a function that carries all it needs."""
    def chunk_best(page, n, pw, px, cat, cw, cx):
        """(page, cat, score, scored): the best of these centroids for these pages.

        Rows (page, n, word, weight) and (cat, word, weight); ``scored`` counts
        the (page, centroid) pairs whose score was computed.
        """
        import numpy as np
        none = np.zeros(0, np.int64)
        if not len(page) or not len(cw):
            return none, none, np.zeros(0), 0
        words = np.intersect1d(pw, cw)
        keep = np.isin(pw, words)
        order = np.lexsort((pw[keep], page[keep]))
        page, n, pw, px = (x[keep][order] for x in (page, n, pw, px))
        keep = np.isin(cw, words)
        order = np.argsort(cat[keep], kind="stable")
        cat, cw, cx = (x[keep][order] for x in (cat, cw, cx))
        block = (cat - 1) // size
        if not len(page):
            return none, none, np.zeros(0), 0
        pw, cw = np.searchsorted(words, pw), np.searchsorted(words, cw)
        pids, starts = np.unique(page, return_index=True)
        ends = np.append(starts[1:], len(page))
        want = n[starts]
        bids, bstarts = np.unique(block, return_index=True)
        bends = np.append(bstarts[1:], len(block))
        # bounds[page, block]: page weights times the block's largest weights
        tops = np.zeros((len(words), len(bids)))
        np.maximum.at(tops, (cw, np.repeat(np.arange(len(bids)), bends - bstarts)), cx)
        bounds = np.empty((len(pids), len(bids)))
        for i in range(len(pids)):
            s = slice(starts[i], ends[i])
            bounds[i] = px[s] @ tops[pw[s]]
        del tops
        ranked = np.argsort(-bounds, axis=1)
        best = np.full((len(pids), int(want.max())), -np.inf)
        last = np.full(len(pids), -np.inf)  # the n-th best score so far
        members = [np.unique(cat[s:e]) for s, e in zip(bstarts, bends, strict=True)]
        dense: dict = {}
        out, scored = [], 0
        rows = np.arange(len(pids))
        for turn in range(len(bids)):
            now = ranked[:, turn]
            bound = bounds[rows, now]
            active = rows[(bound > 0) & (bound >= last - margin)]
            if not len(active):
                break
            for b in np.unique(now[active]):
                mine = active[now[active] == b]
                if b not in dense:
                    s = slice(bstarts[b], bends[b])
                    own, row = np.unique(cw[s], return_inverse=True)
                    table = np.zeros((len(own) + 1, len(members[b])))  # the last row: other words
                    table[row, np.searchsorted(members[b], cat[s])] = cx[s]
                    place = np.full(len(words), len(own), np.int32)
                    place[own] = np.arange(len(own))
                    dense[b] = place, table
                place, table = dense[b]
                scores = np.stack([px[starts[i]:ends[i]] @ table[place[pw[starts[i]:ends[i]]]]
                                   for i in mine])
                scored += scores.size
                all_ = np.sort(np.concatenate([best[mine], scores], axis=1), axis=1)[:, ::-1]
                best[mine] = all_[:, :best.shape[1]]
                last[mine] = best[mine, want[mine] - 1]
                at, col = np.nonzero(scores > 0)
                out.append((mine[at], members[b][col], scores[at, col]))
        if not out:
            return none, none, np.zeros(0), scored
        who, cats, score = (np.concatenate(x) for x in zip(*out, strict=True))
        good = score >= last[who] - margin
        return pids[who[good]], cats[good], score[good], scored

    return chunk_best
