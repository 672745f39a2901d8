"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: word classes of the contracts, as patterns of what separates words
SPACES = r"[\x20\x09-\x0D]+"
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda variable is a name that the optimizer cannot inline: an array used
    inside another higher-order function would else be built again for each of
    its elements.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column, separators: str = SPACES) -> Column:
    """Non-empty words of ``text``; null text has none."""
    ends = F.lit("".join(c for c in map(chr, range(128)) if re.fullmatch(separators, c)))
    inner = F.btrim(F.coalesce(text, F.lit("")), ends)  # else the first or last part is empty
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, separators))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Columns that identify a row's content: rows that agree in both get equal results."""
    return [F.col(id_col).alias("_id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("_h")]


def same_key(left: DataFrame, right: DataFrame) -> Column:
    return left["_id"].eqNullSafe(right["_id"]) & (left["_h"] == right["_h"])


def parts_for(total: int, per_part: int) -> int:
    return max(1, -(-int(total or 0) // per_part))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, whatever their import path is."""
    root = Path(__file__).resolve().parents[1]
    context = spark.sparkContext
    if context.applicationId in _SHIPPED or not root.is_dir():  # installed as an archive: there
        return
    archive = Path(tempfile.mkdtemp(prefix="catspark-ship-")) / "catspark_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(archive))  # the driver serves it to the executors
    _SHIPPED.add(context.applicationId)
