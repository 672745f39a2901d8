import hashlib
import math
import random
import struct
import time
import zlib
from collections import Counter, defaultdict

import cases
import corpus_pipeline
import numpy as np
import public_tokenizers as P
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from catspark.llm import html_text, kdtree, packing, ppm, queries, token_files, warc
from catspark.session import materialise, scratch_path

BYTE, WORDS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")


def ids_of(path, text):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def key(r):
    return tuple((x is None, x) for x in r)


def test_packing_holds_every_id_once(spark):
    df, rows = cases.documents(spark)
    got = packing.pack(df, BYTE, size=256, space=8).collect()
    want = Counter((r[0], zlib.crc32(np.array(ids_of(BYTE, r[1]), "<u4").tobytes())) for r in rows)
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"]
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"], r["doc_tokens"]].append(r)
    rebuilt = Counter()
    for (doc, n), pieces in docs.items():
        starts = defaultdict(list)
        for r in pieces:
            starts[r["start"]].append(bytes(r["ids"]))
        copies = len(starts[0])
        if copies == 1:
            body = b"".join(starts[s][0] for s in sorted(starts))
            assert len(body) == 4 * n
            rebuilt[doc, zlib.crc32(body)] += 1
        else:  # repeated rows: equal ids, so equal pieces
            assert all(len(set(x)) == 1 and len(x) == copies for x in starts.values()) or n <= 256
            for i in range(copies):
                rebuilt[doc, zlib.crc32(b"".join(sorted(starts[s])[i] for s in sorted(starts)))] += 1
    assert rebuilt == want
    for s in seqs.values():
        end = 0
        for offset, length in sorted(s):
            assert offset == end
            end += length
        assert end <= 256
    whole = packing.sequences(df, BYTE, size=256, space=8).collect()
    for r in whole:  # padded, and the pieces lie in it one after the other
        assert len(r["ids"]) == 4 * 256 and sum(p["length"] for p in r["pieces"]) == r["fill"]
        assert not any(r["ids"][4 * r["fill"]:])
        assert [p["offset"] for p in r["pieces"]] == list(
            np.cumsum([0] + [p["length"] for p in r["pieces"]])[:-1])
    assert len({r["sequence_id"] for r in whole}) == len(whole)
    assert sum(r["fill"] for r in whole) == sum(r["length"] for r in got)
    padding = 1 - sum(r["length"] for r in got) / (256 * len(seqs))
    assert padding < 0.05
    assert packing.pack(cases.empty(spark), BYTE).count() == 0


def test_open_windows_follow_best_fit():
    w = packing.OpenWindows(10, 2)
    assert [w.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    w = packing.OpenWindows(10, 2)
    assert [w.place(n) for n in (6, 7, 5)] == [(0, 0), (1, 0), (2, 0)]  # the fullest, 1, is emitted
    assert w.place(3) == (0, 6) and w.place(10) == (3, 0)


def test_token_files_round_trip(spark):
    df, rows = cases.documents(spark)
    path = token_files.write_tokens(df, scratch_path(spark, "t"), WORDS, text_bytes_per_file=20_000)
    read = token_files.read_tokens(spark, path)
    assert read.select("part").distinct().count() > 1
    got = token_files.with_starts(read, read).collect()
    want = sorted(((r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""), ids_of(WORDS, r[1]))
                  for r in rows)
    got = sorted(got, key=lambda r: r["start"])
    assert [(r["doc_id"], r["ids"]) for r in got] == [
        (k[1] if k[0] else None, ids) for k, ids in want]
    starts = np.cumsum([0] + [len(i) for _, i in want])[:-1].tolist()
    assert [r["start"] for r in got] == starts
    one = token_files.read_tokens(spark, path).where("doc_id = 9")
    assert [r["ids"] for r in one.collect()] == [ids_of(WORDS, dict(
        (r[0], r[1]) for r in rows)[9])]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,9)]" in plan
    empty = token_files.write_tokens(cases.empty(spark), scratch_path(spark, "t"), WORDS)
    assert token_files.read_tokens(spark, empty).count() == 0


def pages(spark):
    r = random.Random(4)
    body = lambda i: f"<html><p>page {i} " + "lorem ipsum dolor " * r.randint(5, 60)
    rows = [(i, f"http://x.org/{i}", body(i)) for i in range(40)]
    rows += [(100 + i, f"http://y.org/{i}", rows[3][2]) for i in range(5)]
    rows += [(200, None, None), (201, "u", ""), (202, "u\r\nX: y", "tiny"), (203, "v", "tiny"),
             (None, "n", rows[3][2]), (204, "é", "ü" * 5000 + "\r\n\r\nWARC/1.1"), rows[7], rows[7]]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "refers_to", F.lit("clash")).withColumn("n", F.lit(1)).repartition(3), rows


def test_warc_round_trip(spark):
    df, rows = pages(spark)
    path = warc.write_warc(df, scratch_path(spark, "w"), archive_bytes=20_000)
    got = warc.read_warc(spark, path).collect()
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        rev = i is not None and first.get(h, i) != i
        want.append((i, None if rev else data, len(data), hashlib.sha256(data).hexdigest(),
                     "revisit" if rev else "response", first[h] if rev else None))
    drop = lambda r: (r["page_id"], None if r["payload"] is None else bytes(r["payload"]),
                      *r[3:])
    assert sorted(map(drop, got), key=key) == sorted(want, key=key)
    assert {r["url"] for r in got} >= {"uX: y", "é", ""}
    none = warc.write_warc(df.limit(0), scratch_path(spark, "w"))
    assert warc.read_warc(spark, none).count() == 0


def test_warc_files_are_plain_zstandard(spark):
    df, rows = pages(spark)
    path = warc.write_warc(df, scratch_path(spark, "w"), archive_bytes=1 << 20)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    records = 0
    for f in files:
        data = bytes(f["content"])
        if not data:
            continue
        magic, size = struct.unpack_from("<II", data)
        assert magic == 0x184D2A5D  # the dictionary comes first
        book = zstandard.ZstdCompressionDict(data[8:8 + size])
        reader = zstandard.ZstdDecompressor(dict_data=book).stream_reader(
            data, read_across_frames=True)
        records += reader.read().count(b"WARC/1.1\r\nWARC-Type: ")
    assert records == len(rows)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";
</script></head><body><header><h1>Site</h1><a href=/>Home</a></header><nav><ul><li><a href=/a>
Menu entry</a></ul></nav><div class="cookie-notice">We use cookies, please accept all of them.
</div><article><h1>Real  title</h1><p>First paragraph &amp; more,&nbsp;with <a href=x>a link</a>
&quot;here&quot;.<p>Second one<br>goes on &#233; &lt;tag&gt;.<div class="ad">Buy this thing now, it
is very good indeed.</div><table><tr><td>a<td>b</table><blockquote>Said by someone.</blockquote>
<section id="comments"><p>I disagree with this article, it is wrong.</p></section></article>
<aside>Other stories to read today.</aside><form>Subscribe <input value=x></form>
<div style="display:none">Hidden words that nobody sees on the page.</div>
<footer>&copy; 2020 Someone</footer><p>cut o"""


def test_html_main_text(spark):
    want = ("Real title\nFirst paragraph & more, with a link \"here\".\nSecond one goes on é <tag>."
            "\na b\nSaid by someone.")
    plain = "<div id=content><p>" + "Long enough words to be a text. " * 4 + "</p></div>"
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", ""), (4, "w", plain), (4, "w", plain),
            (5, "x", "<nav><a href=x>only</a> <a href=y>links</a></nav>"), (6, "y", "<p"),
            (7, "z", "<article>" + "<p>Some words of a long page, number one.</p>" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "text", F.lit("clash"))
    got = html_text.extract(df).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == want
    assert by[2] == by[None] == by[5] == by[6] == ""
    assert by[4] == ("Long enough words to be a text. " * 4).strip()
    assert by[7].count("\n") == 2999


PROSE = "The committee met on Tuesday and agreed that the plan should go ahead next year."


@pytest.mark.parametrize("block,kept", [
    ('<p class="share">{}</p>', True), ('<p class="text-tag tag">{}</p>', True),
    ('<section class="search"><p>{}</p></section>', True),
    ('<div id="header-1"><h2>Second part</h2><p>{}</p></div>', True),
    ('<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> {}</p>', True),
    ('<div class="comments"><p>{}</p></div>', False), ('<div class="ad">{}</div>', False),
    ('<div class="notice"><p>{}</p></div>', False), ('<form><p>{}</p></form>', False),
    ('<div class="related"><ul><li><a href="1">{}</a></li><li><a href="2">{}</a></li></ul></div>', False),
])
def test_names_of_article_blocks(block, kept):
    html = (f'<html><body><nav><a href="x">Home</a> <a href="y">News</a></nav><article><h1>A title</h1>'
            f'<p>{PROSE}</p>{block.format("Middle: " + PROSE, PROSE)}<p>{PROSE}</p></article>'
            f'<footer>Copyright 2020</footer></body></html>')
    text = html_text.main_text(html)
    assert ("Middle: " in text or "so x=2 Middle" in text) == kept
    assert text.startswith(f"A title\n{PROSE}\n") and text.endswith(f"\n{PROSE}")


@pytest.mark.parametrize("html", ["<div>text here " * 30_000, "<div>" * 20_000 + "x" + "</b></q></section>" * 20_000,
                                  "<p class=ad><article>" * 20_000 + "y"])
def test_deep_pages_take_time_by_length(html):
    t0 = time.time()
    html_text.main_text(html)
    assert time.time() - t0 < 20


def test_minimum_cut_equals_all_labellings():
    r = random.Random(2)
    for _ in range(60):
        n = r.randint(1, 9)
        cost = [(r.randint(0, 20), r.randint(0, 20)) for _ in range(n)]  # boilerplate, content
        edges = [(a, b, r.randint(0, 12)) for a in range(n) for b in range(a) if r.random() < 0.5]
        graph = html_text.FlowGraph(n + 2)
        for i, (x, y) in enumerate(cost):
            graph.edge(n, i, x, 0)
            graph.edge(i, n + 1, y, 0)
        for a, b, w in edges:
            graph.edge(a, b, w, w)
        energy = lambda s: (sum(y if c else x for c, (x, y) in zip(s, cost, strict=True))
                            + sum(w for a, b, w in edges if s[a] != s[b]))
        got = graph.source_side(n, n + 1)[:n]
        assert energy(got) == min(energy([m >> i & 1 for i in range(n)]) for m in range(2 ** n))


def brute_ppm(train):
    seen = defaultdict(Counter)
    for t in train:
        b = b"\xff" * 5 + cases.lower(t).encode() + b"\xff"
        for k in range(5, len(b)):
            for o in range(6):
                seen[b[k - o:k]][b[k]] += 1

    def score(t):
        b, total = b"\xff" * 5 + cases.lower(t).encode() + b"\xff", 0.0
        for k in range(5, len(b)):
            gone = set()
            for o in range(5, -1, -1):
                left = {s: n for s, n in seen.get(b[k - o:k], {}).items() if s not in gone}
                if not left:
                    continue
                room = sum(left.values()) + len(left)
                if b[k] in left:
                    total += math.log10(left[b[k]] / room)
                    break
                total += math.log10(len(left) / room)
                gone |= set(left)
            else:
                total -= math.log10(256 - len(gone))
        return total
    return score


def test_ppm_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ppm, "CHUNK_CHARS", 9000)  # several chunks, and bins that are split
    monkeypatch.setattr(ppm, "BIN_BYTES", 20_000)
    df, rows = cases.documents(spark)
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    train = [r[1] for r in rows if not held(r[0])]
    counts = Counter(w for t in train for w in cases.SPACED.findall(cases.lower(t)))
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    model = brute_ppm(train)
    want = []
    for r in rows:
        w = cases.SPACED.findall(cases.lower(r[1]))
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in [*(counts[x] for x in w), len(train)])
        want.append((r[0], held(r[0]), len(w) + 1, sum(counts[x] > 0 for x in w) + 1, n,
                     base, model(r[1])))
    got = ppm.score(df).collect()
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert abs(a[5] - b[5]) < 1e-6 * abs(b[5]) and abs(a[6] - b[6]) < 1e-5 * abs(b[6])
    assert ppm.score(cases.empty(spark)).count() == 0


def test_only_large_bins_are_split(spark, monkeypatch):
    monkeypatch.setattr(ppm, "BIN_BYTES", 100)
    rows = [(0, 0, c, bytes(80 if c < 5 else 0), b"") for c in range(9)]
    rows += [(0, 1, c, bytes(8), b"") for c in range(9)]
    blobs, large = ppm.salted(spark.createDataFrame(rows, ppm.BLOB))
    assert [tuple(r) for r in large.collect()] == [(0, 0, 4)]
    salts = {(r["bin"], r["chunk"]): r["salt"] for r in blobs.collect()}
    assert salts == {(b, c): c % 4 if b == 0 else 0 for b in (0, 1) for c in range(9)}


def test_ppm_without_training_rows(spark):
    rows = [(i, "ab", "", "", 0) for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    got = ppm.score(spark.createDataFrame(rows, cases.DOC)).collect()
    assert all(abs(r["score"] + 3 * math.log10(256)) < 1e-4 and r["n_known"] == 0 for r in got)


def brute_tree(points, dims, k):
    """points: key -> (weight, tie, values); the leaf of each key."""
    spread = {d: max(1, max(p[2][d] for p in points.values()) - min(p[2][d] for p in points.values()))
              for d in dims}
    leaf = {}

    def split(keys, k, node):
        if k == 1 or not keys:
            leaf.update((x, node) for x in keys)
            return
        width = {d: (max(points[x][2][d] for x in keys) - min(points[x][2][d] for x in keys))
                 / spread[d] for d in dims}
        axis = next(d for d in dims if width[d] == max(width.values()))
        want = sum(points[x][0] for x in keys) * (k // 2) // k
        place = lambda x: (points[x][2][axis], points[x][1])
        total, cut = 0, None
        for x in sorted(keys, key=place):
            total += points[x][0]
            if total >= want:
                cut = place(x)
                break
        split([x for x in keys if place(x) < cut], k // 2, node)
        split([x for x in keys if place(x) >= cut], k - k // 2, node + k // 2)

    split(list(points), k, 0)
    return leaf


def test_kd_shards_equal_brute_force(spark):
    df, rows = cases.documents(spark)
    dims = {"a": F.coalesce(F.octet_length("text"), F.lit(0)), "b": F.length("lang") * 7}
    for k in (8, 5, 1):
        got = {r["key"]: r["shard"] for r in kdtree.kd_shards(df, "text", dims, shards=k).collect()}
        points = {}
        for r in rows:
            data = (r[1] or "").encode()
            h = hashlib.md5(data).hexdigest()
            w, tie, v = points.get(h, (0, int(h[:kdtree.HASH_BITS // 4], 16), None))
            lang = None if r[2] is None else len(r[2]) * 7
            b = min([x for x in (lang, v["b"] if v else None) if x is not None], default=None)
            points[h] = (w + len(data) + 1, tie, {"a": len(data), "b": b})
        points = {h: (w, t, {d: x or 0 for d, x in v.items()}) for h, (w, t, v) in points.items()}
        assert got == brute_tree(points, list(dims), k)


def test_kd_target_bytes_and_empty(spark):
    df = spark.range(3000).select(F.repeat(F.md5(F.col("id").cast("string")), 4).alias("text"))
    got = kdtree.kd_shards(df, "text", {"x": F.crc32("text") % 97}, target_bytes=30_000)
    sizes = [r["b"] for r in got.groupBy("shard").agg(F.sum("weight").alias("b")).collect()]
    assert len(sizes) == -(-3000 * 129 // 30_000) and max(sizes) < 1.02 * 30_000
    none = cases.empty(spark)
    assert kdtree.kd_shards(none, "text", {"x": F.length("text")}, shards=8).count() == 0


def test_sharding_query(spark, tmp_path):
    df, rows = cases.documents(spark)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op10_kd_sharding(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    shards = defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in shards.values())
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got if r["doc_id"] is not None) \
        == sorted((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()))
                  for r in rows if r[0] is not None)


def test_pipeline_stages_equal_brute_force(spark, tmp_path):
    """Each stage on its own input, against the operators' plain versions."""
    df, rows = cases.documents(spark)
    bench = [(1, " ".join(cases.make_texts()[3].split()[4:40]))]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "substring_dedup", "decontamination", "packing"]
    kept = stages["quality"](spark, df, str(tmp_path))
    assert kept.columns == df.columns
    plain = [r for r in rows if len(cases.SPACED.findall(r[1] or "")) >= 10]
    assert {r["text"] for r in kept.collect()} <= {r[1] for r in plain}
    assert kept.count() > 0.8 * len(plain) - 4

    docs = materialise(df, "in")
    one = stages["near_dedup"](spark, docs, str(tmp_path))
    assert one.columns == df.columns
    ids = [r["doc_id"] for r in one.collect()]
    with_id = [(r[0], r[1]) for r in rows if r[0] is not None]
    roots = cases.classes(with_id)
    assert sorted(i for i in ids if i is not None) == sorted(
        {n for n, t in with_id if roots[n] == n})
    assert ids.count(None) <= 1  # the text without id that has no copy with one

    cut = stages["substring_dedup"](spark, docs, str(tmp_path))
    assert cut.columns == df.columns
    gone = cases.removed_words(rows, 20)
    want = []
    for r in rows:
        w, g = gone[r[0] is None, r[0] or 0, r[1] or ""]
        text = " ".join(x for x, y in zip(w, g, strict=True) if not y) if any(g) else r[1]
        want.append((r[0], text, len(text) if any(g) else r[4]))
    got = [(r["doc_id"], r["text"], r["n_chars"]) for r in cut.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)

    clean = stages["decontamination"](spark, docs, str(tmp_path))
    assert clean.columns == df.columns
    bad = [c for *_, c in cases.contamination(rows, bench)]
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=key) == sorted(
        ((r[0], r[1]) for r, b in zip(rows, bad, strict=True) if not b), key=key)
    assert stages["packing"](spark, docs, str(tmp_path)).agg(F.sum("length")).first()[0] == sum(
        len(ids_of(BYTE, r[1])) for r in rows)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    cases.empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
