"""Append-only tables looked up by key (seen URLs, model replies, taken names) without reading them whole.

A store is a folder of parquet files partitioned by the first ``DIGITS`` hexadecimal digits of the key's MD5 (``prefix=p3f``). Every
append adds Bloom filters first and rows second, so a row never lacks its filter, whatever fails in between. A filter is a table of
bitmaps of 32,768 bits, one per (prefix, slot); a key sets ``BITS`` bits of one bitmap, all taken from its digest, and appends choose their
number of slots by their number of keys. Bitmaps of equal layout merge by OR (``compacted``).

A lookup tests the asked keys against the bitmaps of their prefixes and reads rows only of the prefixes in which a key may be stored;
that join sees the few possibly known keys, not the batch. Results never depend on the filters' errors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notesmith.session import cut_lineage, holds_files, path_exists

#: Bits of a bitmap (fixed by the bitmap functions), bits set per key, and bits held per key.
WIDTH, BITS, PER_KEY = 32_768, 6, 10
#: Hexadecimal digits of a prefix: 16 folders, 256 for two digits (stores of billions of keys). A store keeps the number it was made with.
DIGITS = 1
FILTERS = "prefix string, slots int, slot int, bitmap binary"


def _hex(digest: Column, at: int, digits: int) -> Column:
    return F.conv(F.substring(digest, at, digits), 16, 10).cast("long")


def prefix_of(digest: Column, digits: int) -> Column:
    return F.concat(F.lit("p"), F.substring(digest, 1, digits))


def slot_of(digest: Column, slots: Column) -> Column:
    return (_hex(digest, 3, 6) % slots).cast("int")


def bits_of(digest: Column) -> Column:
    return F.array(*[_hex(digest, 9 + 4 * i, 4) % WIDTH for i in range(BITS)])


def _set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


class KeyStore:
    """Rows of ``schema`` under ``path``, looked up by the string column ``key``. Null keys are not stored and not found."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: str | T.StructType, digits: int | None = None):
        self.spark, self.path, self.key, self.digits = spark, path.rstrip("/"), key, digits or DIGITS
        self.schema = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)

    def _read(self, path: str, schema: T.StructType, prefixes: list[str] | None = None) -> DataFrame:
        """The folder, or only its parts of the given prefixes (others are not even listed)."""
        if not path_exists(self.spark, path):  # an unreadable one is an error
            return self.spark.createDataFrame([], schema)
        parts = [path] if prefixes is None else [p for p in (f"{path}/prefix={x}" for x in sorted(prefixes)) if path_exists(self.spark, p)]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", path).parquet(*parts)

    def rows(self, prefixes: list[str] | None = None) -> DataFrame:
        """All rows, or those of some prefixes."""
        return self._read(self.path, T.StructType([*self.schema.fields, T.StructField("prefix", T.StringType())]), prefixes)

    def filters(self, prefixes: list[str] | None = None) -> DataFrame:
        return self._read(f"{self.path}/_filters", T._parse_datatype_string(FILTERS), prefixes)

    def _check(self) -> None:
        """A folder that holds something else than a store is an error, not an empty store."""
        if holds_files(self.spark, self.path) and not path_exists(self.spark, f"{self.path}/_filters"):
            raise ValueError(f"{self.path} holds files but no filters: not a key store (append its rows to a new one)")

    def maybe(self, keys: DataFrame) -> DataFrame:
        """(key, prefix) of the keys that some filter does not rule out. Written."""
        self._check()
        digest = F.md5(F.col(self.key).cast("binary"))
        asked = cut_lineage(keys.select(self.key).dropna().distinct().select(self.key, digest.alias("_d"), prefix_of(digest, self.digits).alias("prefix")))
        prefixes = [r[0] for r in asked.select("prefix").distinct().collect()]  # at most 16 ** digits
        known = self.filters(prefixes)
        layouts = [r[0] for r in known.select("slots").distinct().collect()]  # powers of two: a few
        if not layouts:
            return asked.limit(0).select(self.key, "prefix")
        placed = asked.withColumn("slots", F.explode(F.array(*[F.lit(n) for n in layouts]))).withColumn("slot", slot_of(F.col("_d"), F.col("slots")))
        hit = placed.join(known, ["prefix", "slots", "slot"]).where(F.forall(bits_of(F.col("_d")), lambda b: _set(F.col("bitmap"), b)))
        return cut_lineage(hit.select(self.key, "prefix").distinct())

    def known(self, keys: DataFrame) -> DataFrame:
        """The store's rows whose key is among ``keys``; only files of prefixes with a possibly known key are read."""
        maybe = self.maybe(keys)
        prefixes = [r[0] for r in maybe.select("prefix").distinct().collect()]
        return self.rows(prefixes).join(maybe, [self.key, "prefix"], "left_semi").select(*self.schema.names)

    def unseen(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` whose key is not stored (rows with a null key stay)."""
        return batch.join(self.known(batch).select(self.key).distinct(), self.key, "left_anti").select(*batch.columns)

    def append(self, rows: DataFrame) -> int:
        """Adds rows (of ``schema``, a null key left out); returns how many."""
        self._check()
        own = cut_lineage(rows.select(*self.schema.names).where(F.col(self.key).isNotNull()))
        n = own.count()
        if n:
            self._write(own, n, self.path)
        return n

    def _write(self, own: DataFrame, n: int, path: str) -> None:
        digest = F.md5(F.col(self.key).cast("binary"))
        slots = 1 << max(0, math.ceil(math.log2(n * PER_KEY / (WIDTH * 16 ** self.digits))))
        keyed = own.withColumn("_d", digest).withColumn("prefix", prefix_of(F.col("_d"), self.digits))
        bits = keyed.select("prefix", F.lit(slots).alias("slots"), slot_of(F.col("_d"), F.lit(slots)).alias("slot"), F.explode(bits_of(F.col("_d"))).alias("bit"))
        maps = bits.groupBy("prefix", "slots", "slot").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
        maps.repartition("prefix").write.mode("append").partitionBy("prefix").parquet(f"{path}/_filters")
        keyed.drop("_d").repartition("prefix").write.mode("append").partitionBy("prefix").parquet(path)

    def insert(self, rows: DataFrame) -> int:
        """Insert or ignore: adds the rows whose key is not stored. ``rows`` hold each key once."""
        return self.append(self.unseen(rows))

    def compacted(self, path: str) -> KeyStore:
        """The same store in another folder with few files: rows rewritten per prefix, filters built anew for all keys at once."""
        own = self.rows().select(*self.schema.names)
        n = own.count()
        if n:
            self._write(own, n, path.rstrip("/"))
        return KeyStore(self.spark, path, self.key, self.schema, self.digits)


def merged_filters(filters: DataFrame) -> DataFrame:
    """Filters of several appends as one per layout and slot."""
    return filters.groupBy("prefix", "slots", "slot").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


# ---- the stores of an ingest -----------------------------------------------------------

SEEN = "url_hash string, url string, title string, content_hash string, first_seen string, source string"
REPLIES = "digest string, model string, level string, raw string"
NAMES = "family string, dir string, filename string, run string"


def seen_store(spark: SparkSession, path: str) -> KeyStore:
    return KeyStore(spark, path, "url_hash", SEEN)


def reply_store(spark: SparkSession, path: str) -> KeyStore:
    return KeyStore(spark, path, "digest", REPLIES)


def name_store(spark: SparkSession, path: str) -> KeyStore:
    return KeyStore(spark, path, "family", NAMES)
