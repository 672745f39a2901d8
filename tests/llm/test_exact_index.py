import hashlib
import random
import re
from collections import defaultdict

import cases
import pytest
from pyspark.sql import functions as F

from catspark.llm import cuckoo

ROWS = "doc_id long, text string"


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def key(text):
    return hashlib.sha256(norm(text).encode()).digest()


def test_shard_equals_a_dictionary():
    r = random.Random(2)
    shard, want = cuckoo.Shard(4), {}
    # keys that differ in one byte only share their fingerprint, and some their buckets too
    keys = [key(str(i)) for i in range(400)]
    keys += [k[:-1] + bytes([k[-1] ^ 1]) for k in keys[:100]]
    keys += [keys[0][:20] + bytes([i]) * 12 for i in range(6)]
    prints, hashes = cuckoo.fingerprints(keys)
    for step in range(6000):
        i = r.randrange(len(keys))
        if r.random() < 0.6:
            first = (False, r.randrange(50), step)
            shard.insert(keys[i], prints[i], hashes[i], 1, first)
            n, f = want.get(keys[i], (0, first))
            want[keys[i]] = (n + 1, min(f, first))
        else:
            shard.delete(keys[i], prints[i], hashes[i], 1)
            if keys[i] in want:
                n, f = want.pop(keys[i])
                if n > 1:
                    want[keys[i]] = (n - 1, f)
        if step % 500 == 0:
            for k, fp, h in zip(keys, prints, hashes, strict=True):
                slot = shard.find(k, fp, h)
                assert (slot >= 0) == (k in want)
                if slot >= 0:
                    e = shard.entry[slot]
                    assert (shard.live[e], shard.first[e]) == want[k]
    assert shard.resizes > 2
    assert sum(e >= 0 for e in shard.entry) == len(want)


def groups_of(rows):
    """By digest: (live rows, smallest id)."""
    out = defaultdict(list)
    for i, t in rows:
        out[key(t)].append((i is None, i or 0))
    return {k: (len(v), None if min(v)[0] else min(v)[1]) for k, v in out.items()}


def test_exact_duplicates_equal_brute_force(spark):
    df, rows = cases.documents(spark)
    out = cuckoo.exact_duplicates(df)
    got = out.collect()
    want = groups_of([(r[0], r[1]) for r in rows])
    assert len(got) == len(rows)
    stays = defaultdict(int)
    for r in got:
        k = bytes(r["digest"])
        assert (r["group_size"], r["keep_id"]) == want[k]
        assert not r["kept"] or r["id"] == r["keep_id"]
        stays[k] += r["kept"]
    assert set(stays) == set(want) and set(stays.values()) == {1}
    ids = sorted((r["id"] is None, r["id"] or 0, bytes(r["digest"])) for r in got)
    assert ids == sorted((r[0] is None, r[0] or 0, key(r[1])) for r in rows)
    assert cuckoo.exact_duplicates(cases.empty(spark)).count() == 0


def state(index):
    return {bytes(r["digest"]): (r["live"], r["first_id"]) for r in index.keys.collect()}


@pytest.mark.parametrize("per_shard", [20, 10_000])
def test_index_follows_insertions_and_deletions(spark, monkeypatch, per_shard):
    monkeypatch.setattr(cuckoo, "PER_SHARD", per_shard)
    r = random.Random(per_shard)
    texts = [f"text  number {i}" for i in range(60)] + ["", None, " ", "same", "same"]
    make = lambda n: [(r.choice([None, *range(40)]), r.choice(texts)) for _ in range(n)]
    keyed = lambda rows: cuckoo.key_rows(spark.createDataFrame(rows, ROWS).repartition(3))
    one, two = make(80), make(120)
    index = cuckoo.CuckooIndex.empty(spark).insert(keyed(one))
    before = state(index)
    assert before == groups_of(one)
    grown = index.insert(keyed(two))
    live = one + two
    assert state(grown) == groups_of(live) and (grown.shards > index.shards) == (per_shard == 20)
    gone = r.sample(live, 90) + [(999, "never there"), (0, "nor this")]
    left = list(live)
    for x in gone:
        for y in left:  # by id and normalised text
            if y[0] == x[0] and norm(y[1]) == norm(x[1]):
                left.remove(y)
                break
    less = grown.delete(keyed(gone))
    assert state(less) == groups_of(left)
    assert state(index) == before  # an earlier generation stays as it was
    again = less.insert(keyed(gone))
    assert state(again) == groups_of(left + gone)
    asked = [(i, t) for i, t in enumerate([*texts, "unknown", "text number 3"])]
    found = {x["id"] for x in less.probe(keyed(asked)).collect()}
    have = groups_of(left)
    assert found == {i for i, t in asked if key(t) in have}
    filters = less.stored.where("digest is null")
    assert filters.count() == less.shards
    sizes = filters.select((F.length("filter") / 2 / cuckoo.SLOTS).alias("n"), "buckets").collect()
    assert all(s["n"] == s["buckets"] for s in sizes)
