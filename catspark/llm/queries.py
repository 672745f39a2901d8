"""Registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ranking import global_rank
from ..session import materialise
from . import (codes, cuckoo, decontamination, dialogue, html_text, kdtree, neardup, packing, ppm,
               quality, substring, token_files, warc)


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = packing.sequences(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return packing.pieces(written, with_ids=False)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.decontaminate(_table(spark, sf_dir, "documents"),
                                        _table(spark, sf_dir, "benchmark"))
    return out.select(F.col("_id").alias("doc_id"), "n_words", "n_hit",
                      F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                      "contaminated")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS l,
         array_to_string(w[p + 1 : p + least(len(w), 13)], ' ') AS k
  FROM i, unnest(range(0, greatest(len(w) - 12, 1))) t(p) WHERE len(w) > 0),
ls AS (SELECT DISTINCT l FROM win),
dw AS (
  SELECT rid, p, l, array_to_string(w[p + 1 : p + l], ' ') AS k
  FROM d, ls, unnest(range(0, greatest(len(w) - l + 1, 0))) t(p)),
hit AS (SELECT rid, p, l, item_id FROM dw JOIN win USING (l, k)),
pos AS (SELECT rid, count(DISTINCT q) AS n_hit
        FROM hit, unnest(range(p, p + l)) u(q) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
        FROM (SELECT DISTINCT rid, item_id::VARCHAR AS s FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_digest(spark, _table(spark, sf_dir, "pages"))


OP3_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n,
                  sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (digest)
"""


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(spark, _table(spark, sf_dir, "documents"),
                                    tokenizer("word_bpe_49k.json"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality(_table(spark, sf_dir, "documents"))
    return out.select(F.col("_id").alias("doc_id"), "n_words", "word_chars", "n_symbols",
                      "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = neardup.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select(F.col("_id").alias("doc_id"), "class_id", "n_verified")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = substring.dedup_substrings(docs)
    return out.select(F.col("_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


OP7_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
             coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT rid, doc_id, p, array_to_string(w[p + 1 : p + 20], ' ') AS k
        FROM d, unnest(range(0, greatest(len(w) - 19, 0))) t(p)),
rep AS (SELECT rid, p FROM (SELECT rid, p, row_number() OVER (
          PARTITION BY k ORDER BY doc_id, p) AS r FROM win) WHERE r > 1),
cut AS (SELECT DISTINCT rid, q FROM rep, unnest(range(p, p + 20)) u(q)),
cuts AS (SELECT rid, count(*) AS n, list(q) AS qs FROM cut GROUP BY rid),
wd AS (SELECT rid, q, w[q + 1] AS x FROM d, unnest(range(0, len(w))) v(q)),
kept AS (SELECT wd.rid, string_agg(x, ' ' ORDER BY wd.q) AS s
         FROM wd LEFT JOIN cut ON wd.rid = cut.rid AND wd.q = cut.q
         WHERE cut.q IS NULL GROUP BY wd.rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN cuts USING (rid) LEFT JOIN kept USING (rid)
"""


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ppm.score(_table(spark, sf_dir, "documents"))
    return out.withColumnRenamed("_id", "doc_id")


def op10_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    placed = docs
    for name in ("lang", "source"):  # in name order, so that a median parts neighbours by name
        ranks = global_rank(docs.select(name).where(F.col(name).isNotNull()).distinct(), [name],
                            f"{name}_rank")
        placed = placed.join(ranks, name, "left")
    dims = {"size": F.floor(F.log2(F.octet_length(text) + 1) * 1000),
            "lang": F.col("lang_rank"), "source": F.col("source_rank")}
    shards = materialise(kdtree.kd_shards(placed, "text", dims, shards=8), "shards")
    rows = docs.select(
        "doc_id", F.coalesce(F.octet_length("text") + 1, F.lit(1)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), kdtree.group_key("text").alias("key"))
    # both sides are read from files, so that Spark can split a hot group's rows
    placed = materialise(rows.join(shards.select("key", "shard"), "key"), "placed")
    out = kdtree.number_rows(placed, "shard", ["doc_id", "key"], docs.count(), "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = codes.vector_codes(_table(spark, sf_dir, "embeddings"))
    return codes.with_label_error(out).select(
        "vec_id", "code", "error", "label_error",
        F.lit(codes.books_sha256(books)).alias("codebooks_sha256"))


def _lloyd_sql(rounds: int) -> str:
    """Codebook b{i} and assignment a{i} of every round, then the final assignment."""
    near = ("SELECT rid, part, any_value(q) AS q, min({{'d': list_sum(list_transform(range(1, len(q) + 1), "
            "lambda i: (q[i] - c[i]) * (q[i] - c[i])))::BIGINT, 'k': entry}}) AS m "
            "FROM p JOIN b{0} USING (part) GROUP BY rid, part")
    mean = ("SELECT part, k AS entry, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS c FROM ("
            "SELECT part, m.k AS k, pos, sum(q[pos])::BIGINT AS s, count(*) AS n "
            "FROM a{0}, unnest(range(1, len(q) + 1)) u(pos) GROUP BY part, m.k, pos) GROUP BY part, k")
    parts = []
    for i in range(rounds):
        parts += [f"a{i} AS ({near.format(i)})", f"m{i} AS ({mean.format(i)})",
                  f"b{i + 1} AS (SELECT b{i}.part, b{i}.entry, coalesce(m{i}.c, b{i}.c) AS c "
                  f"FROM b{i} LEFT JOIN m{i} USING (part, entry))"]
    return ",\n".join([*parts, f"a{rounds} AS ({near.format(rounds)})"])


OP11_SQL = f"""
WITH v AS (
  SELECT vec_id, label, row_number() OVER () AS rid,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
f AS (SELECT rid, len(e) AS n, row_number() OVER (ORDER BY vec_id NULLS LAST, e) - 1 AS entry FROM v),
w AS (SELECT n // 16 AS w, n FROM f WHERE entry = 0),
p AS (SELECT rid, j AS part, e[j * w + 1 : (j + 1) * w] AS q
      FROM v, w, unnest(range(16)) t(j) WHERE len(e) = w.n),
b0 AS (SELECT part, entry, q AS c FROM p JOIN f USING (rid) WHERE entry < 64),
{_lloyd_sql(2)},
codes AS (SELECT rid, string_agg(printf('%02x', m.k), '' ORDER BY part) AS code,
                 sum(m.d)::BIGINT AS error FROM a2 GROUP BY rid)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b2)
         AS codebooks_sha256
FROM v JOIN codes USING (rid)
"""


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dialogue.repair_digest(_table(spark, sf_dir, "conversations"))
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                      "audit", "repaired_sha256")


def _edits_sql() -> str:
    """Rows (state, edits, initial needed, next state, cost, inserted role, new role).

    States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
    """
    after, role = {0: 2, 1: 2, 2: 3, 3: 2}, {2: "user", 3: "assistant"}
    rows = []
    for s in range(4):
        for put in (False, True):
            at, lead, cost = (after[s], "I", 3) if put else (s, "", 0)
            new = f"'{role[at]}'" if put else "NULL"
            to = after[at]
            rows.append((s, lead + "D", "", at, cost + 4, new, "NULL"))
            rows.append((s, lead + "R", "", to, cost + 3, new, f"'{role[to]}'"))
            rows.append((s, lead + "K", role[to][0], to, cost, new, "NULL"))
            if at == 0:
                rows.append((s, lead + "K", "s", 1, cost, new, "NULL"))
    return ", ".join(f"({s}, '{e}', '{need}', {to}, {c}, {put}, {new})"
                     for s, e, need, to, c, put, new in rows)


_CRC_SQL = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), "
            "lambda x: ascii(x)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), "
            "[0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 "
            "THEN 3988292384::BIGINT ELSE 0::BIGINT END))))")
OP12_SQL = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
hashed AS (SELECT *, {_CRC_SQL} % 20 AS r FROM raw),
damaged AS (
  SELECT conv_id AS conv, turn, CASE WHEN r = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN r = 1 THEN '' WHEN r = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, unnest(CASE WHEN r = 3 THEN [0, 1] ELSE [0] END) c(copy) WHERE r <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS pos,
         CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE '?' END AS initial,
         regexp_replace(text, '[\x20\x09-\x0D]+\z', '') AS body FROM damaged),
rows_ AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1
                 THEN 'duplicate' WHEN body[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv ORDER BY pos) AS before FROM ordered),
edits(s, e, need, ns, c, put, new) AS (VALUES {_edits_sql()}),
dp(conv, i, s, cost, audit, lines) AS (
  SELECT DISTINCT conv, 0::BIGINT, 0, 0, '', []::VARCHAR[] FROM rows_
  UNION ALL
  SELECT conv, i, s, cost, audit, lines FROM (
    SELECT d.conv, d.i + 1 AS i, t.ns AS s,
           d.cost + t.c + CASE WHEN r.fault = 'truncated' AND t.e[-1] <> 'D' THEN 3 ELSE 0 END AS cost,
           d.audit || t.e AS audit,
           d.lines || CASE WHEN t.put IS NULL THEN []::VARCHAR[] ELSE [t.put || ':'] END
             || CASE t.e[-1] WHEN 'D' THEN []::VARCHAR[]
                             ELSE [coalesce(t.new, r.role) || ':' || r.text] END AS lines
    FROM dp d JOIN rows_ r ON r.conv IS NOT DISTINCT FROM d.conv AND r.pos = d.i + 1
    JOIN edits t ON t.s = d.s AND (t.need = '' OR t.need = r.initial)
     AND (t.e[-1] = 'D' OR r.fault NOT IN ('blank', 'duplicate')))
  QUALIFY row_number() OVER (PARTITION BY conv, s ORDER BY cost, audit) = 1),
counts AS (
  SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pos > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv),
ends AS (
  SELECT d.conv, d.cost + f.c AS cost, d.audit || f.e AS audit, d.lines || f.l AS lines
  FROM dp d JOIN counts k ON k.conv IS NOT DISTINCT FROM d.conv AND k.n = d.i
  JOIN (VALUES (0, '', 0, []::VARCHAR[]), (3, '', 0, []::VARCHAR[]), (2, 'I', 3, ['assistant:']),
               (1, 'II', 6, ['user:', 'assistant:'])) f(s, e, c, l) ON f.s = d.s
  QUALIFY row_number() OVER (PARTITION BY d.conv ORDER BY d.cost + f.c, d.audit || f.e) = 1)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit,
       sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts k ON k.conv IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends x ON x.conv IS NOT DISTINCT FROM o.conv_id
"""


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cuckoo.exact_duplicates(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                  AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


QUERIES = {"op1_packing": op1_packing, "op2_decontamination": op2_decontamination,
           "op3_warc": op3_warc, "op4_token_files": op4_token_files,
           "op5_quality": op5_quality, "op6_near_duplicates": op6_near_duplicates,
           "op7_substring_dedup": op7_substring_dedup,
           "op8_html_text": op8_html_text, "op9_ppm": op9_ppm, "op10_kd_sharding": op10_kd_sharding,
           "op11_vector_codes": op11_vector_codes,
           "op12_conversation_repair": op12_conversation_repair,
           "op13_exact_dedup": op13_exact_dedup}
SQL: dict[str, str] = {"op2_decontamination": OP2_SQL, "op3_warc": OP3_SQL,
                       "op7_substring_dedup": OP7_SQL,
                       "op11_vector_codes": OP11_SQL, "op12_conversation_repair": OP12_SQL,
                       "op13_exact_dedup": OP13_SQL}
