"""Pieces shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notesmith.session import load_table, ship_package

#: White space between words: space and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "documents")


def text_of(name: str = "text") -> Column:
    """The text, null counted as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Plain ``lower`` does the same on a text of ASCII characters, and faster."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words_of(c: Column) -> Column:
    """Words of a text in order: runs of anything but ``SPACE``."""
    return F.array_remove(F.split(c, SPACE + "+"), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, inside an expression."""
    return F.transform(F.array(value), body)[0]


def packed(docs: DataFrame) -> Column:
    """The whole row as one struct: ``select("doc.*")`` gives it back whatever its columns are called."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns under exactly these names (other columns of the table, also clashing ones, are left out)."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def ship(spark: SparkSession) -> None:
    """Python workers can import this package."""
    ship_package(spark)

