import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from catspark.llm import codes

COLS = "vec_id long, embedding array<float>, label int"


def test_cover_tree_invariants_and_assignment():
    r = np.random.default_rng(3)
    for n, width in ((1, 2), (5, 1), (900, 3), (3000, 4)):
        points = r.integers(-40, 40, (n, width)) if n < 1000 else (r.normal(0, 90, (n, width)) // 1)
        points = points.astype(np.int64)
        order, nodes, radii = codes.cover_tree(points)
        assert sorted(order) == list(range(n))
        for (start, end, centre, child, kids), radius in zip(nodes, radii, strict=True):
            d = np.sqrt(((points[order[start:end]] - points[centre]) ** 2).sum(1))
            assert d.max(initial=0) <= radius + 1e-9
            if kids:
                below = nodes[child:child + kids]
                assert below[0][0] == start and below[-1][1] == end
                assert (below[1:, 0] == below[:-1, 1]).all()
                centres = points[below[:, 2]]
                gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2))
                assert (gaps[~np.eye(kids, dtype=bool)] > radius / 2 - 1e-9).all()
        entries = points[r.choice(n, min(n, 64), replace=False)]
        entries = np.concatenate([entries, entries[:3]])  # ties go to the lower entry
        want = ((points[:, None] - entries[None]) ** 2).sum(2).argmin(1)
        assert (codes.assign(points, order, nodes, radii, entries) == want).all()
        counts, sums = codes.totals(points, order, nodes, radii, entries)
        for e in range(len(entries)):
            assert counts[e] == (want == e).sum() and (sums[e] == points[want == e].sum(0)).all()


def test_subtrees_are_assigned_whole():
    r = np.random.default_rng(1)
    centres = r.integers(-5000, 5000, (20, 4))
    points = (centres[r.integers(0, 20, 4000)] + r.integers(-9, 9, (4000, 4))).astype(np.int64)
    given, single, _ = codes.descend(points, *codes.cover_tree(points), centres.astype(np.int64))
    assert (given[:, 1] - given[:, 0]).sum() + len(single) == 4000 and len(single) < 400


def brute(rows, parts=16, entries=64, rounds=2):
    kept = sorted(((i is None, i or 0), [math.floor(256 * float(np.float32(x))) for x in v], lab)
                  for i, v, lab in rows
                  if v and all(x is not None and math.isfinite(x) for x in v))
    kept = [k for k in kept if len(k[1]) == len(kept[0][1])]
    w = len(kept[0][1]) // parts
    cut = lambda v, p: tuple(v[p * w:(p + 1) * w])
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda q, book: min((dist(q, c), k) for k, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            got = defaultdict(list)
            for _, v, _ in kept:
                got[near(cut(v, p), books[p])[1]].append(cut(v, p))
            for k, qs in got.items():
                books[p][k] = tuple(sum(c) // len(qs) for c in zip(*qs, strict=True))
    out, by_label = [], defaultdict(int)
    for (none, i), v, lab in kept:
        best = [near(cut(v, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        by_label[lab] += error
        out.append((None if none else i, "".join(f"{k:02x}" for _, k in best), error, lab))
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode())
    return ([(i, c, e, by_label[lab]) for i, c, e, lab in out], digest.hexdigest())


def vectors(n, seed=4):
    r = random.Random(seed)
    rows = [(i * 3, [r.gauss(0, 1) for _ in range(32)], r.choice([None, 0, 1, 2])) for i in range(n)]
    if n > 20:
        rows += [(10_000 + i, rows[i][1], 7) for i in range(20)]  # copies
        rows += [rows[5], rows[5], (None, rows[6][1], 1), (2, None, 1), (4, [], 0),
                 (5, [1.0] * 31 + [float("nan")], 0), (7, [float("-inf")] + [0.0] * 31, 0),
                 (8, [None] + [0.0] * 31, 1), (10, [0.5] * 16, 1), (11, [0.0] * 32, None)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("n", [1, 40, 300])
def test_vector_codes_equal_brute_force(spark, n):
    rows = vectors(n)
    df = (spark.createDataFrame(rows, COLS).withColumn("id", F.lit("x"))
          .withColumn("vector", F.lit(1)).repartition(3))
    out, books = codes.vector_codes(df, chunk=64)
    got = [(r["vec_id"], r["code"], r["error"], r["label_error"])
           for r in codes.with_label_error(out).collect()]
    want, digest = brute(rows)
    order = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert codes.books_sha256(books) == digest


def test_no_usable_vector(spark):
    for rows in ([], [(1, None, 1), (2, [float("nan")] * 16, 1)]):
        out, books = codes.vector_codes(spark.createDataFrame(rows, COLS))
        assert out.count() == 0 and books.size == 0
