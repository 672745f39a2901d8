"""MinHash near-dedup (operator 6): ProbMinHash, banding and exact verification.

A text is the bag of its five-word shingles, weighted by how often they occur.
Each shingle's arrivals form a Poisson process with its weight as rate; every
arrival falls into one of the registers, and a register keeps the shingle that
arrives first.  A shingle stops once its next arrival is later than every
register's, so most stop after few steps.  Registers of two texts agree with
the probability Jaccard similarity of their weighted shingles.  A text that
repeats shingles gets a second sketch with all weights 1, whose registers agree
with the plain Jaccard similarity; without repeats the two sketches are one.

Registers are cut into bands; texts that agree in a band share a bucket.  No
bucket is expanded into pairs: its members are compared with the member that
shares most buckets with others (the likely original of a group of copies),
exactly, on their shingles.  Texts of buckets whose members then still belong
to different classes meet once more, on their rarest shingles: two texts of
similarity 0.8 share one among the fifth of their shingles that is rarest, by
number or by weight.  Of those pairs the ones of different classes are left, a
bitmap of each text's shingles drops the pairs whose similarities are bounded
below the threshold, and the rest is compared exactly.  So no pair of similar
texts in a bucket is lost, and texts that share frequent passages only, do not
meet.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import materialise
from .common import ship
from .grams import ASCII_LOWER, first_of_runs, mixed, rolling, starts_within, symbols

#: two texts of similarity 0.8 agree in 10 of the 48 bands on average, and in none with odds of
#: 1e-5; texts of similarity 0.4 in none with odds of 0.92
SHINGLE, BANDS, ROWS = 5, 48, 7
#: 64-bit words of the bitmap of a text's shingles
WORDS = 32
BITMAP = [f"s{i}" for i in range(WORDS)]
#: most (id, hash) rows that are broadcast, 16 bytes each
BROADCAST_ROWS = 500_000
#: words are runs of a-z, 0-9 and non-ASCII characters, after lower-casing A-Z
WORD_BYTES = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in ASCII_LOWER)
SKETCH = "node long, _id long, _h long, copy binary, bands binary, shingles binary, weights binary"
EXPLODED = "member long, shingle long, weight long, n long, w long"


def shingle_bags(texts: list[str | None], width: int):
    """(word counts, digest per text, owner, shingle, weight): distinct shingles, ascending per text."""
    import xxhash
    cut = [(t or "").encode().translate(WORD_BYTES).split() for t in texts]
    copies = [xxhash.xxh3_128_digest(b" ".join(x)) if x else None for x in cut]
    counts = np.array([len(x) for x in cut], np.int64)
    s = symbols([w for x in cut for w in x])
    runs = mixed(rolling(s, width))
    at = starts_within(counts, width)
    owner = np.repeat(np.arange(len(counts)), np.maximum(counts - width + 1, 0))
    value = runs[at]
    short = np.flatnonzero((counts > 0) & (counts < width))  # all words are one shingle
    if len(short):
        own = [np.frombuffer(copies[i][:8], "<u8")[0] for i in short]
        owner, value = np.r_[owner, short], np.r_[value, np.array(own, np.uint64)]
    tagged = np.sort((owner.astype(np.uint64) << np.uint64(32)) | (value >> np.uint64(32)))
    first = first_of_runs(tagged, np.zeros(len(tagged), np.int8))
    weight = np.diff(np.append(first, len(tagged)))
    tagged = tagged[first]
    return (copies, (tagged >> np.uint64(32)).astype(np.int64),
            (tagged & np.uint64(0xFFFFFFFF)).astype("<u4"), weight.astype("<u4"))


def prob_minhash(shingles, weights, owner, n_texts: int, registers: int) -> np.ndarray:
    """Per text and register the shingle that arrives first; texts without shingles keep 0."""
    best = np.full(n_texts * registers, np.inf)
    sketch = np.zeros(n_texts * registers, "<u4")
    base = shingles.astype(np.uint64) << np.uint64(20)
    time = np.zeros(len(shingles))
    active = np.arange(len(shingles))
    step = 0
    while len(active):
        h = mixed(base[active] + np.uint64(step % (1 << 20)))
        wait = -np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
        time[active] += wait / weights[active]
        t = time[active]
        register = mixed(h ^ np.uint64(0xA5A5A5A55A5A5A5A)) % np.uint64(registers)
        slot = owner[active] * registers + register.astype(np.int64)
        np.minimum.at(best, slot, t)
        won = best[slot] == t
        sketch[slot[won]] = shingles[active[won]]
        # no later arrival of a shingle can win once it is past the text's slowest register
        texts, back = np.unique(owner[active], return_inverse=True)
        slowest = best.reshape(n_texts, registers)[texts].max(axis=1)
        active = active[t < slowest[back]]
        step += 1
    return sketch.reshape(n_texts, registers)


def band_keys(sketch: np.ndarray, bands: int) -> np.ndarray:
    rows = sketch.reshape(len(sketch), bands, -1).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), rows.shape[:2])
    for i in range(rows.shape[2]):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, i])
    return key


def text_keys(shingles, weights, owner, n_texts: int, bands: int, rows: int) -> list[np.ndarray]:
    """Per text the distinct keys of its bands, weighted and with all weights 1."""
    keys = band_keys(prob_minhash(shingles, weights, owner, n_texts, bands * rows), bands)
    repeats = np.unique(owner[weights > 1])
    if not len(repeats):
        return list(keys)
    of = np.isin(owner, repeats)
    plain = band_keys(prob_minhash(shingles[of], np.ones(of.sum(), "<u4"),
                                   np.searchsorted(repeats, owner[of]), len(repeats),
                                   bands * rows), bands)
    out = list(keys)
    for i, k in zip(repeats.tolist(), plain, strict=True):
        out[i] = np.union1d(keys[i], k)
    return out


def probability_jaccard(a, wa, b, wb) -> float:
    """Sum over common shingles of 1 / sum_j max(a_j / a_i, b_j / b_i)."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    x, y = wa[i].astype(float), wb[j].astype(float)
    ratio = x / y
    order = np.argsort(ratio)
    x, y, ratio = x[order], y[order], ratio[order]
    # shingles only one text has always count on its side; common ones by their ratio
    above = np.cumsum(x[::-1])[::-1]
    below = np.cumsum(y) - y
    same = np.searchsorted(ratio, ratio, side="left")
    total = ((above[same] + wa.sum() - x.sum()) / x) + ((below[same] + wb.sum() - y.sum()) / y)
    return float((1 / total).sum())


def similarity(a, wa, b, wb) -> float:
    """The larger of probability and plain Jaccard; without repeated shingles they are equal."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    plain = common / (len(a) + len(b) - common) if common else 0.0
    if wa is None and wb is None:
        return plain
    wa = np.ones(len(a)) if wa is None else wa
    wb = np.ones(len(b)) if wb is None else wb
    return max(plain, probability_jaccard(a, wa, b, wb))


def bitmaps(bags: DataFrame) -> DataFrame:
    """Per member: distinct shingles, total weight, and the bitmap of the shingles with its bits set."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            bags = [np.frombuffer(x, "<u4") for x in b.column("shingles").to_pylist()]
            n = np.array([len(x) for x in bags], np.int64)
            w = [np.frombuffer(x, "<u4").sum() if x else k
                 for x, k in zip(b.column("weights").to_pylist(), n, strict=True)]
            bits = np.zeros((len(bags), 64 * WORDS), bool)
            place = mixed(np.concatenate([*bags, np.zeros(0, "<u4")]).astype(np.uint64))
            bits[np.repeat(np.arange(len(bags)), n), place % np.uint64(64 * WORDS)] = True
            packed = np.packbits(bits, axis=1).view("<i8")
            yield pa.RecordBatch.from_arrays(
                [b.column("member"), pa.array(n), pa.array(np.array(w, np.int64)),
                 pa.array(bits.sum(axis=1, dtype=np.int64)), *map(pa.array, packed.T.copy())],
                ["member", "n", "w", "bits", *BITMAP])

    longs = ", ".join(f"{c} long" for c in ["member", "n", "w", "bits", *BITMAP])
    return bags.mapInArrow(run, longs)


def may_be_similar(threshold: float, other: str) -> Column:
    """False only for texts whose plain and probability Jaccard are both below ``threshold``.

    A bit that one bitmap has alone stands for one or more shingles, of weight 1 or more, that the
    other text lacks.  With x and y the weights left on either side, probability Jaccard is at
    most 1 / (w / x + w' / y - 1): in its sum over common shingles i of 1 / sum_j max(a_j / a_i,
    b_j / b_i) the inner sum is at least (w - x) / a_i + w' / b_i, and 1 / (p / a + q / b) summed
    over pairs is at most its value at the sums.
    """
    both = sum((F.bit_count(F.col(c).bitwiseAND(F.col(other + c))) for c in BITMAP), F.lit(0))
    lack, lack2 = F.col("bits") - both, F.col(f"{other}bits") - both
    n, n2 = F.col("n"), F.col(f"{other}n")
    common = F.least(n - lack, n2 - lack2)
    w, w2 = F.col("w").cast("double"), F.col(f"{other}w").cast("double")
    x, y = w - lack, w2 - lack2
    least = threshold - 1e-9  # for rounding
    return ((common >= least * (n + n2 - common))
            | (x * y >= least * (w * y + w2 * x - x * y)))


def sketches(df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE,
             bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    def run(batches):
        import pyarrow as pa
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("text", "node", "_id", "_h")]
            start = chars = 0
            for end, t in enumerate(cols[0], 1):
                chars += len(t or "") + 1
                if chars < 3_000_000 and end < len(cols[0]):
                    continue
                texts, nodes, ids, hs = (c[start:end] for c in cols)
                start, chars = end, 0
                copies, owner, values, weights = shingle_bags(texts, shingle)
                keys = text_keys(values, weights, owner, len(texts), bands, rows)
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
                out = []
                for i in range(len(texts)):
                    lo, hi = cuts[i], cuts[i + 1]
                    w = weights[lo:hi]
                    out.append((nodes[i], ids[i], hs[i], copies[i],
                                keys[i].astype("<u8").tobytes() if hi > lo else None,
                                values[lo:hi].tobytes() if hi > lo else None,
                                w.tobytes() if (w > 1).any() else None))
                names = [c.split()[0] for c in SKETCH.split(", ")]
                types = [pa.int64()] * 3 + [pa.binary()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    names)

    ship(df.sparkSession)
    # rows without an id get a number of their own, after all ids, from their text
    late = F.xxhash64(text_col).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), late).alias("node"),
                     F.col(id_col).cast("long").alias("_id"),
                     F.xxhash64(id_col, text_col).alias("_h"),
                     F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(run, SKETCH)


def _explode_bands(batches):
    import pyarrow as pa
    for b in batches:
        keys = [np.frombuffer(x, "<i8") for x in b.column("bands").to_pylist()]
        members = np.repeat(b.column("member").to_numpy(), [len(k) for k in keys])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)), pa.array(members)],
            ["bucket", "member"])


def _explode_shingles(batches):
    import pyarrow as pa
    for b in batches:
        for at in range(0, b.num_rows, 1000):  # a text may have very many shingles
            part = b.slice(at, 1000)
            bags = [np.frombuffer(x, "<u4") for x in part.column("shingles").to_pylist()]
            weights = [np.frombuffer(x, "<u4") if x else np.ones(len(k), "<u4") for x, k in
                       zip(part.column("weights").to_pylist(), bags, strict=True)]
            n = np.array([len(k) for k in bags], np.int64)
            w = np.array([int(k.sum(dtype=np.int64)) for k in weights], np.int64)
            flat = lambda parts: np.concatenate(
                [*parts, np.zeros(0, "<u4")]).astype(np.int64)
            columns = [np.repeat(part.column("member").to_numpy(), n), flat(bags), flat(weights),
                       np.repeat(n, n), np.repeat(w, n)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                             ["member", "shingle", "weight", "n", "w"])


def _verify(threshold: float):
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            rows = []
            for a, b, sa, wa, sb, wb in zip(*(batch.column(c).to_pylist() for c in (
                    "a", "b", "sa", "wa", "sb", "wb")), strict=True):
                sa, wa, sb, wb = (x and np.frombuffer(x, "<u4") for x in (sa, wa, sb, wb))
                s = similarity(sa, wa, sb, wb)
                if s >= threshold:
                    rows.append((a, b, s))
            cols = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.float64())], ["a", "b", "similarity"])
    return run


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = 0.8, shingle: int = SHINGLE, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """One row per row of ``df``: _id, _h (see ``row_key``), node, class_id, n_verified.

    ``node`` is the row's id or the number that stands for it; a class is kept
    by keeping the row whose node is the class id.
    ``class_id`` is the smallest node of the class: texts connected by links of
    similarity ``threshold`` or more.  ``n_verified`` counts the pairs of the text
    that were compared and linked, not all that exist (copies share theirs).  Texts with the
    same words are copies.  A text of fewer than ``shingle`` words is one
    shingle; texts without words (null, empty) are linked with nothing.  Rows
    with one id are one document, whatever their texts: each text is compared,
    and what is linked with any of them is in their class.  Rows without an id
    are known by their text and come after all ids.  Very long texts are
    compared whole.  Empty table: no rows.  Other columns are ignored.
    """
    sk = materialise(sketches(df, id_col, text_col, shingle, bands, rows)
                     .withColumn("row", F.monotonically_increasing_id()), "sketches")
    # one member per word sequence, whatever the number of its copies and ids
    copies = materialise(
        sk.where("copy is not null").groupBy("copy").agg(F.min(F.struct("node", "row")).alias("m"))
        .select("copy", "m.*").withColumn("member", F.monotonically_increasing_id()), "copies")
    chosen = copies.select("row", "member")
    members = materialise(
        sk.where("bands is not null").select("bands", "row").join(chosen, "row")
        .select("bands", "member").mapInArrow(_explode_bands, "bucket long, member long"), "members")
    sizes = materialise(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
                        .where(F.col("n") > 1), "sizes")
    shared = materialise(members.join(sizes, "bucket"), "shared")
    central = materialise(shared.groupBy("member").agg(F.sum("n").alias("score")), "central")
    shared = materialise(shared.drop("n").join(central, "member"), "ranked")
    wanted = materialise(chosen.join(central.select("member"), "member"), "wanted")
    # sketches are the large side; what is wanted of them is broadcast if it is small enough
    small = wanted.count() <= BROADCAST_ROWS
    bags = materialise(sk.select("row", "shingles", "weights")
                       .join(F.broadcast(wanted) if small else wanted, "row").drop("row"), "bags")
    links = _links(shared, bags, threshold)
    # different texts under one id are one document
    several = (sk.where("copy is not null").groupBy("node").agg(
        F.min("copy").alias("x"), F.max("copy").alias("y")).where("x <> y").select("node", "x"))
    of_id = sk.where("copy is not null").select("copy", "node").join(several, "node").distinct()
    numbers = copies.select("copy", "member")
    same_id = materialise(
        of_id.join(numbers.withColumnsRenamed({"copy": "x", "member": "a"}), "x")
        .join(numbers.withColumnRenamed("member", "b"), "copy").select("a", "b").where("a <> b"),
        "same_id")
    classes = connected_components(same_id.union(links.select("a", "b")))
    degree = (links.select("a", "b").union(links.select("b", "a")).groupBy("a")
              .agg(F.count(F.lit(1)).alias("n_verified")))
    placed = materialise(
        copies.select("copy", "node", "member")
        .join(classes.withColumnsRenamed({"node": "m2"}), F.col("member") == F.col("m2"), "left")
        .join(degree, F.col("member") == F.col("a"), "left")
        .select("copy", "node", F.coalesce("component", "member").alias("component"),
                F.coalesce("n_verified", F.lit(0)).cast("long").alias("n_verified")), "placed")
    # a class is named after its smallest node
    names = materialise(placed.groupBy("component").agg(F.min("node").alias("class_id")), "names")
    per_copy = materialise(placed.join(names, "component").select("copy", "class_id", "n_verified"),
                           "per_copy")
    return (sk.select("_id", "_h", "node", "copy").join(per_copy, "copy", "left")
            .select("_id", "_h", "node", F.coalesce("class_id", "node").alias("class_id"),
                    F.coalesce("n_verified", F.lit(0)).cast("long").alias("n_verified")))


def _links(shared: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of verified pairs that connect all similar members of each bucket.

    ``shared(bucket, member, score)``: buckets of two and more members.
    """
    best = F.struct(F.col("score"), (-F.col("member")).alias("order"))
    # written, so that both sides of the join are read and Spark can split a hot bucket
    heads = materialise(shared.groupBy("bucket").agg(F.max(best).alias("m")).select(
        "bucket", (-F.col("m.order")).alias("a")), "heads")
    ordered = [F.least("a", "member").alias("a"), F.greatest("a", "member").alias("b")]
    pairs = shared.join(heads, "bucket").where("member <> a").select(*ordered).distinct()
    checked = materialise(pairs, "pairs")
    links = _verified(checked, bags, threshold)
    classes = connected_components(links.select("a", "b")).withColumnsRenamed(
        {"node": "member", "component": "class"})
    placed = materialise(shared.select("bucket", "member").join(classes, "member", "left").select(
        "bucket", "member", F.coalesce("class", "member").alias("class")), "placed")
    # a bucket is open while its members are of different classes
    open_ = materialise(placed.groupBy("bucket").agg(F.min("class").alias("x"), F.max("class").alias("y"))
                        .where("x <> y").select("bucket"), "open")
    live = materialise(placed.join(open_, "bucket").select("member", "class").distinct(), "live")
    rest = materialise(rare_pairs(live, bags, threshold).join(checked, ["a", "b"], "left_anti"), "pairs")
    return links.union(_verified(rest, bags, threshold))


def rare_pairs(live: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of all similar members of ``live(member, class)`` that are of different classes.

    Shingles are ordered from rare to frequent.  Before the first shingle that
    two similar texts share, either has at most 1 - threshold of its shingles
    (plain Jaccard) or of its weight (probability Jaccard), because the other
    lacks them; so both hold that shingle in this first part.  Of the classes
    that meet in a shingle the largest is not paired with itself; bitmaps and the
    numbers of shingles before the common one drop pairs within the join.
    """
    some = materialise(bags.join(live, "member").select("member", "class", "shingles", "weights"), "texts")
    rows = materialise(some.mapInArrow(_explode_shingles, EXPLODED), "shingles")
    df = materialise(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "df")
    held = rows.join(df, "shingle")
    mine = Window.partitionBy("member")  # the shingles of one text
    before = mine.orderBy("df", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    # what no other text has comes first in the order and is not in these rows
    n_before = (F.col("n") - F.count(F.lit(1)).over(mine)
                + F.count(F.lit(1)).over(before))
    w_before = (F.col("w") - F.sum("weight").over(mine)
                + F.coalesce(F.sum("weight").over(before), F.lit(0)))
    room = 1 - threshold + 1e-9
    first = (held.withColumn("nb", n_before).withColumn("wb", w_before)
             .where((F.col("nb") <= room * F.col("n")) | (F.col("wb") <= room * F.col("w")))
             .select("shingle", "member", "nb").join(live, "member"))
    first = materialise(first, "rare")
    per_class = first.groupBy("shingle", "class").agg(F.count(F.lit(1)).alias("k"))
    mixed_ = materialise(per_class.groupBy("shingle").agg(
        F.max_by("class", "k").alias("main"), F.count(F.lit(1)).alias("classes"))
        .where("classes > 1").select("shingle", "main"), "met")
    meeting = materialise(first.join(mixed_, "shingle").join(bitmaps(some), "member"), "meeting")
    others = meeting.where("class <> main").select(
        [F.col(c).alias(f"o_{c}") for c in meeting.columns])
    # two members outside the main class meet twice: the smaller one keeps the pair
    once = (F.col("class") == F.col("main")) | (F.col("member") < F.col("o_member"))
    # at their first common shingle, what comes before it in either text is not common; where
    # shingles repeat, numbers do not bound probability Jaccard
    after = F.least(F.col("n") - F.col("nb"), F.col("o_n") - F.col("o_nb"))
    share = (threshold - 1e-9) / (1 + threshold)
    left = ((after >= share * (F.col("n") + F.col("o_n")))
            | (F.col("w") > F.col("n")) | (F.col("o_w") > F.col("o_n")))
    alike = ((F.col("shingle") == F.col("o_shingle")) & (F.col("class") != F.col("o_class"))
             & once & left & may_be_similar(threshold, "o_"))
    return meeting.join(others, alike).select(
        F.least("member", "o_member").alias("a"), F.greatest("member", "o_member").alias("b")).distinct()


def _verified(pairs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    return materialise(_with_bags(pairs, bags).mapInArrow(
        _verify(threshold), "a long, b long, similarity double"), "links")


def _with_bags(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    left = bags.select(F.col("member").alias("a"), F.col("shingles").alias("sa"),
                       F.col("weights").alias("wa"))
    right = bags.select(F.col("member").alias("b"), F.col("shingles").alias("sb"),
                        F.col("weights").alias("wb"))
    return pairs.join(right, "b").join(left, "a")
