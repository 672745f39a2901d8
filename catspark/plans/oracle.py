"""DuckDB SQL for the correctness oracle.

Each operator's SQL twin is a named CTE; a query is a list of CTEs plus a
final SELECT.  Regex, tokeniser and stemmer steps come from the same rule
lists the Spark operators use (``functions.text``, ``functions.porter``).
Every float is rounded to 6 digits in the final SELECT, as on the Spark side.
"""

from __future__ import annotations

from ..functions import text as T
from ..functions.porter import stem_words_sql
from ..sources.tables import CATEGORIES_SQL, CATPAGE_SQL, CATSUB_SQL, PAGES_SQL, TEXTS_SQL

BASE = [("texts", TEXTS_SQL), ("catpage", CATPAGE_SQL), ("catsub", CATSUB_SQL),
        ("page_titles", PAGES_SQL), ("categories", CATEGORIES_SQL)]


def render(ctes: list[tuple[str, str]], final: str) -> str:
    seen, body = set(), []
    for name, sql in ctes:
        if name in seen:
            continue
        seen.add(name)
        body.append(f"{name} AS (\n{sql}\n)")
    return "WITH " + ",\n".join(body) + "\n" + final


def index_ctes(text_table: str = "texts", prefix: str = "") -> list[tuple[str, str]]:
    p = prefix
    return [
        (f"{p}toks", f"SELECT title, unnest({T.split_contractions_sql('token')}) AS token "
                     f"FROM (SELECT title, unnest({T.token_array_sql('text')}) AS token "
                     f"FROM {text_table} WHERE text IS NOT NULL) WHERE token <> ''"),
        (f"{p}ctoks", f"SELECT title, token FROM {p}toks WHERE {T.content_word_sql('token')}"),
        (f"{p}raw", f"SELECT title, token, count(*) AS n FROM {p}ctoks GROUP BY title, token"),
        (f"{p}stems", stem_words_sql(f"SELECT DISTINCT token FROM {p}raw", "token", "word")),
        (f"{p}counts", f"SELECT title, word, CAST(sum(n) AS BIGINT) AS n FROM {p}raw "
                       f"JOIN {p}stems USING (token) GROUP BY title, word"),
    ]


INDEX = BASE + index_ctes() + [
    ("postings", "SELECT word, title, n / sum(n) OVER (PARTITION BY title) AS tf FROM counts"),
    ("n_docs", "SELECT count(DISTINCT title) AS n FROM texts"),
    ("vocab", "SELECT word, count(*) AS df, ln((SELECT n FROM n_docs) / count(*)) AS idf "
              "FROM postings GROUP BY word"),
    ("vectors", "SELECT title, word, tf * idf AS weight FROM postings JOIN vocab USING (word)"),
]

HOLDOUT = [
    ("holdout", "SELECT title FROM (SELECT title, row_number() OVER "
                "(ORDER BY md5(concat(title, '42')), title) AS r FROM page_titles) "
                "WHERE r <= (SELECT floor(count(*) * CAST(0.2 AS DOUBLE)) FROM page_titles)"),
]


def centroid_ctes(min_pages: int = 5, holdout: bool = True, name: str = "centroids",
                  cats: str = "cent_cats") -> list[tuple[str, str]]:
    excl = "WHERE cp.pag_title NOT IN (SELECT title FROM holdout)" if holdout else ""
    return [
        ("sizes", "SELECT cat_name, count(*) AS size FROM catpage GROUP BY cat_name"),
        (cats, f"SELECT cat_name, size FROM sizes WHERE size >= {min_pages}"),
        (name, "SELECT cat_name, word, sum(weight / size) AS weight FROM vectors "
               "JOIN (SELECT cp.cat_name, cp.pag_title AS title, cc.size FROM catpage cp "
               f"JOIN {cats} cc USING (cat_name) {excl}) m USING (title) "
               "GROUP BY cat_name, word"),
    ]


def scoring_ctes(pages: str, page_vectors: str = "vectors", cents: str = "centroids",
                 cats: str = "cent_cats", catpage: str = "catpage") -> list[tuple[str, str]]:
    """K3-K5 for the titles of table ``pages``: scores, counts_n, recs."""
    return [
        ("pv", f"SELECT title, word, weight / sqrt(sum(weight * weight) OVER "
               f"(PARTITION BY title)) AS w FROM {page_vectors} "
               f"WHERE weight <> 0 AND title IN (SELECT title FROM {pages})"),
        ("cv", f"SELECT cat_name, word, weight / sqrt(sum(weight * weight) OVER "
               f"(PARTITION BY cat_name)) AS w FROM {cents} WHERE weight <> 0"),
        ("scores", "SELECT pv.title, cv.cat_name, sum(pv.w * cv.w) AS score "
                   "FROM pv JOIN cv USING (word) GROUP BY pv.title, cv.cat_name"),
        ("counts_n", f"SELECT pag_title AS title, count(*) AS n_actual, least(count(*), "
                     f"(SELECT count(*) FROM {cats})) AS n FROM {catpage} "
                     f"WHERE pag_title IN (SELECT title FROM {pages}) GROUP BY pag_title"),
        ("name_rank", f"SELECT cat_name, row_number() OVER (ORDER BY cat_name) AS slot "
                      f"FROM {cats}"),
        ("padding", "SELECT c.title, r.cat_name, CAST(0.0 AS DOUBLE) AS score FROM "
                    "(SELECT title, unnest(generate_series(1, n)) AS slot FROM counts_n "
                    "WHERE n >= 1) c JOIN name_rank r USING (slot)"),
        ("cands", "SELECT title, cat_name, max(score) AS score FROM ("
                  f"SELECT title, cat_name, score FROM scores WHERE cat_name IN "
                  f"(SELECT cat_name FROM {cats}) UNION ALL SELECT title, cat_name, score "
                  "FROM padding) GROUP BY title, cat_name"),
        ("recs", "SELECT title, rank, cat_name, score FROM (SELECT c.title, c.cat_name, "
                 "c.score, k.n, row_number() OVER (PARTITION BY c.title ORDER BY "
                 "round(c.score, 9) DESC, c.cat_name) AS rank FROM cands c "
                 "JOIN counts_n k USING (title)) WHERE rank <= n"),
    ]


def measure_ctes(catpage: str = "catpage", group: list[str] | None = None
                 ) -> list[tuple[str, str]]:
    """K6-K8 over recs / counts_n, per ([group], title)."""
    g = list(group or [])
    gsel = "".join(f"f.{c}, " for c in g)
    keys = ", ".join([*g, "title"])
    return [
        ("actual", f"SELECT pag_title AS title, cat_name AS actual FROM {catpage} "
                   "WHERE pag_title IN (SELECT title FROM counts_n)"),
        ("flagged", "SELECT r.*, CASE WHEN a.actual IS NULL "
                    "THEN 0 ELSE 1 END AS hit FROM recs r LEFT JOIN actual a "
                    "ON a.title = r.title AND a.actual = r.cat_name"),
        ("per_page", f"SELECT {keys}, max(hit) AS boolean, sum(hit) AS hits, "
                     f"sum(1 - hit) AS misses FROM flagged GROUP BY {keys}"),
        ("pairs", f"SELECT {gsel}f.title, a.actual AS cat_a, f.cat_name AS cat_b FROM flagged f "
                  "JOIN actual a ON a.title = f.title WHERE f.hit = 0"),
        ("edges", "SELECT DISTINCT cat_a, cat_b, 1 AS fs FROM (SELECT cat_name AS cat_a, "
                  "cat_name_sub AS cat_b FROM catsub UNION ALL SELECT cat_name_sub, cat_name "
                  "FROM catsub)"),
        ("sibs", "SELECT DISTINCT p.cat_a, p.cat_b, 1 AS br FROM (SELECT DISTINCT cat_a, "
                 "cat_b FROM pairs) p JOIN catsub s1 ON s1.cat_name_sub = p.cat_a "
                 "JOIN catsub s2 ON s2.cat_name = s1.cat_name AND s2.cat_name_sub = p.cat_b "
                 "WHERE p.cat_a <> p.cat_b"),
        ("credit", f"SELECT {', '.join('p.' + c for c in [*g, 'title'])}, "
                   "sum(CASE WHEN e.fs IS NOT NULL THEN CAST(0.5 AS DOUBLE) "
                   "WHEN s.br IS NOT NULL THEN CAST(0.25 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) "
                   "END) AS credit FROM pairs p LEFT JOIN edges e ON e.cat_a = p.cat_a AND "
                   "e.cat_b = p.cat_b LEFT JOIN sibs s ON s.cat_a = p.cat_a AND "
                   f"s.cat_b = p.cat_b GROUP BY {', '.join('p.' + c for c in [*g, 'title'])}"),
        ("measures", f"SELECT {keys}, CAST(boolean AS INTEGER) AS boolean, "
                     "CAST(hits AS DOUBLE) / n AS fractional, "
                     "CAST(hits AS DOUBLE) / n + coalesce(credit, CAST(0.0 AS DOUBLE)) / "
                     "CAST(n_actual AS DOUBLE) / CAST(n AS DOUBLE) AS hierarchical, "
                     "CAST(hits AS DOUBLE) / n + (CASE WHEN n_actual = 1 THEN 0.5 * "
                     "CAST(misses AS DOUBLE) ELSE 0.5 * (1 - pow(CAST(n_actual AS DOUBLE), "
                     "-CAST(misses AS DOUBLE))) / (1 - 1 / CAST(n_actual AS DOUBLE)) END) / "
                     "CAST(n AS DOUBLE) AS hierarchical_as_written "
                     f"FROM per_page JOIN counts_n USING ({keys}) LEFT JOIN credit "
                     f"USING ({keys})"),
    ]


def sweep_ctes(min_pag: int = 4, max_pag: int = 50, n_pages: int = 100
               ) -> list[tuple[str, str]]:
    """Per-threshold samples, scores once, top-n per (t, title), measures."""
    return INDEX + HOLDOUT + centroid_ctes(min_pag, True, "centroids_m", "cats_m") + [
        ("thr", f"SELECT unnest(generate_series({min_pag}, {max_pag})) AS t"),
        ("samp", "SELECT t, title FROM (SELECT thr.t, h.title, row_number() OVER (PARTITION "
                 "BY thr.t ORDER BY md5(concat(h.title, '42', CAST(thr.t AS VARCHAR))), "
                 f"h.title) AS rn FROM holdout h CROSS JOIN thr) WHERE rn <= {n_pages}"),
        ("pv", "SELECT title, word, weight / sqrt(sum(weight * weight) OVER "
               "(PARTITION BY title)) AS w FROM vectors "
               "WHERE weight <> 0 AND title IN (SELECT title FROM samp)"),
        ("cv", "SELECT cat_name, word, weight / sqrt(sum(weight * weight) OVER "
               "(PARTITION BY cat_name)) AS w FROM centroids_m WHERE weight <> 0"),
        ("scores", "SELECT pv.title, cv.cat_name, sum(pv.w * cv.w) AS score "
                   "FROM pv JOIN cv USING (word) GROUP BY pv.title, cv.cat_name"),
        ("cats_t", "SELECT thr.t, c.cat_name FROM cats_m c JOIN thr ON c.size >= thr.t"),
        ("n_cent", "SELECT t, count(*) AS n_centroids FROM cats_t GROUP BY t"),
        ("actual_n", "SELECT pag_title AS title, count(*) AS n_actual FROM catpage "
                     "WHERE pag_title IN (SELECT title FROM samp) GROUP BY pag_title"),
        ("counts_n", "SELECT s.t, s.title, a.n_actual, least(a.n_actual, c.n_centroids) AS n "
                     "FROM samp s JOIN actual_n a USING (title) JOIN n_cent c USING (t)"),
        ("name_rank", "SELECT t, cat_name, row_number() OVER (PARTITION BY t ORDER BY "
                      "cat_name) AS slot FROM cats_t"),
        ("padding", "SELECT c.t, c.title, r.cat_name, CAST(0.0 AS DOUBLE) AS score FROM "
                    "(SELECT t, title, unnest(generate_series(1, n)) AS slot FROM counts_n "
                    "WHERE n >= 1) c JOIN name_rank r USING (t, slot)"),
        ("cands", "SELECT t, title, cat_name, max(score) AS score FROM (SELECT c.t, s.title, "
                  "s.cat_name, s.score FROM scores s JOIN counts_n c ON c.title = s.title "
                  "JOIN cats_t k ON k.t = c.t AND k.cat_name = s.cat_name UNION ALL "
                  "SELECT t, title, cat_name, score FROM padding) GROUP BY t, title, cat_name"),
        ("recs", "SELECT t, title, rank, cat_name, score FROM (SELECT c.t, c.title, "
                 "c.cat_name, c.score, k.n, row_number() OVER (PARTITION BY c.t, c.title "
                 "ORDER BY round(c.score, 9) DESC, c.cat_name) AS rank FROM cands c "
                 "JOIN counts_n k USING (t, title)) WHERE rank <= n"),
    ] + measure_ctes(group=["t"]) + [
        ("sweep", "SELECT CAST(m.t AS INTEGER) AS n_pages, n_centroids, "
                  "avg(boolean) AS mean_boolean, stddev_pop(boolean) AS std_boolean, "
                  "avg(fractional) AS mean_fractional, stddev_pop(fractional) AS "
                  "std_fractional, avg(hierarchical) AS mean_hierarchical, "
                  "stddev_pop(hierarchical) AS std_hierarchical FROM measures m "
                  "JOIN n_cent USING (t) GROUP BY m.t, n_centroids"),
    ]


RECOMMEND = INDEX + HOLDOUT + centroid_ctes(5, True) + scoring_ctes("holdout") + measure_ctes()


def r6(col: str, alias: str | None = None) -> str:
    return f"round({col}, 6) AS {alias or col}"
