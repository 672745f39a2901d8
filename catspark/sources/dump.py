"""Scan an encyclopedia XML dump, one record per ``<page>``, split over tasks.

A dump is one huge file.  ``format("xml")`` reads it in a single task, so the
file is read as text with ``</page>`` as the record separator (markup inside
``<text>`` is entity-escaped, so the separator cannot occur in a page), the
piece before ``<page>`` is cut off, and each record is parsed with
``from_xml`` against a fixed schema.  Any block-splittable codec works.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DUMP_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("ns", T.IntegerType()),
    T.StructField("id", T.LongType()),
    T.StructField("redirect", T.StructType([T.StructField("_title", T.StringType())])),
    T.StructField("revision", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StructType([
            T.StructField("_VALUE", T.StringType()),
            T.StructField("_bytes", T.LongType()),
        ])),
    ]))),
    T.StructField("_malformed", T.StringType()),
])

XML_OPTIONS = {"rowTag": "page", "ignoreSurroundingSpaces": "false",
               "ignoreNamespace": "true", "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": "_malformed"}


def read_dump(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """(title, ns, id, redirect, text, malformed) per page; ``text`` = last revision.

    A record that is not well-formed XML has only ``malformed``, its raw text:
    it is counted by ``ingest_stats`` and is no valid page.

    ``prefix`` is the namespace prefix of the page elements if the dump uses
    one (``<mw:page>`` -> ``prefix="mw"``); namespaces are ignored when the
    record is parsed, so ``{uri}page`` and ``mw:page`` both read as ``page``.
    """
    tag = f"{prefix}:page" if prefix else "page"
    raw = spark.read.option("lineSep", f"</{tag}>").text(path)
    start = F.instr("value", f"<{tag}>")
    record = F.concat(F.expr(f"substr(value, instr(value, '<{tag}>'))"), F.lit(f"</{tag}>"))
    if prefix:
        # bind the prefix so the isolated record is well-formed XML
        record = F.regexp_replace(record, f"^<{tag}>",
                                  f'<{tag} xmlns:{prefix}="urn:dump-prefix">')
    options = dict(XML_OPTIONS, rowTag=tag)
    parsed = (raw.where(start > 0)
              .select(F.from_xml(record, DUMP_SCHEMA, options).alias("p")))
    return parsed.select(
        "p.title", "p.ns", "p.id", "p.redirect",
        F.element_at("p.revision", -1).getField("text").getField("_VALUE").alias("text"),
        F.col("p._malformed").alias("malformed"))


# ---------------------------------------------------------------------------
# Writing a dump (used to round-trip pages derived from tables)
# ---------------------------------------------------------------------------

def _escape(col):
    # XML 1.0 cannot carry most C0 controls; drop them, then escape markup.
    col = F.regexp_replace(col, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "")
    for ch, ent in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        col = F.replace(col, F.lit(ch), F.lit(ent))
    return col


def page_xml(pages: DataFrame, prefix: str = "") -> DataFrame:
    """One ``<page>`` element per row of (title, ns, id, redirect_title, text).

    With ``prefix`` every element name carries that namespace prefix.
    """
    redirect = F.when(F.col("redirect_title").isNotNull(),
                      F.concat(F.lit('    <redirect title="'), _escape(F.col("redirect_title")),
                               F.lit('" />\n'))).otherwise(F.lit(""))
    text = F.when(F.col("text").isNull(), F.lit('      <text bytes="0" />\n')).otherwise(
        F.concat(F.lit('      <text bytes="'), F.length("text").cast("string"),
                 F.lit('" xml:space="preserve">'), _escape(F.col("text")), F.lit("</text>\n")))
    return pages.select(F.concat(
        F.lit("  <page>\n    <title>"), _escape(F.col("title")), F.lit("</title>\n    <ns>"),
        F.col("ns").cast("string"), F.lit("</ns>\n    <id>"), F.col("id").cast("string"),
        F.lit("</id>\n"), redirect, F.lit("    <revision>\n      <id>"),
        F.col("id").cast("string"), F.lit("</id>\n"), text,
        F.lit("    </revision>\n  </page>")).alias("value")) if not prefix else page_xml(
            pages).select(F.regexp_replace(
                "value", "(</?)(page|title|ns|id|redirect|revision|text)(?=[ >])",
                f"$1{prefix}:$2").alias("value"))


HEADER = ('<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/" '
          'version="0.10" xml:lang="en">\n  <siteinfo><sitename>corpus</sitename></siteinfo>')


def write_dump(pages: DataFrame, path: str, prefix: str = "") -> str:
    """Write pages as a dump directory (header, pages, footer) and return it."""
    spark = pages.sparkSession
    head = spark.range(1).select(F.lit(HEADER).alias("value"))
    foot = spark.range(1).select(F.lit("</mediawiki>").alias("value"))
    head.unionByName(page_xml(pages, prefix)).unionByName(foot).write.mode("overwrite").text(path)
    return path
