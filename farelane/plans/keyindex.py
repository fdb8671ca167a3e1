"""Key index of a load target: one blocked Bloom filter per pickup date and load.

A filter is a set of 4 KB bitmaps (``bits``).  A key falls into one bitmap of its date and sets ``HASHES`` bits in it, so one
row of the index answers for a key.  The number of bitmaps follows the date's keys (``BITS_PER_KEY``), so a date that holds
a third of all rows is spread over as many rows as its size asks for.  Everything is built-in functions: bitmaps are
built by a partial aggregate and probed by an equi-join on (date, bitmap number).

A key that was added is always found; a key that was not is found with a probability of about 1 %.  The caller
confirms what is found against the target itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAP_BITS = 32768  # fixed by the bitmap functions
BITS_PER_KEY = 14
HASHES = 6
NO_DATE = "0001-01-01"  # stands for a missing date, so that the index is joined by plain equality


def _date(c) -> Column:
    return F.coalesce(F.col(c), F.lit(NO_DATE).cast("date"))


def _places(key: str) -> Column:
    """Bit places of a key inside its bitmap, from two independent hashes."""
    a, b = F.xxhash64(F.col(key), F.lit(1)), F.xxhash64(F.col(key), F.lit(2))
    # The step is odd, so the places of one key differ.
    step = F.pmod(b, F.lit(BITMAP_BITS // 2)) * 2 + 1
    return F.array(*[F.pmod(F.pmod(a, F.lit(BITMAP_BITS)) + i * step, F.lit(BITMAP_BITS)) for i in range(HASHES)])


def build_filters(keys: DataFrame, date: str, key: str) -> DataFrame:
    """(index_date, bitmaps, bitmap, bits) of the (date, key) rows of one load."""
    rows = keys.select(_date(date).alias("index_date"), F.col(key).alias("k")).where(F.col("k").isNotNull())
    sizes = rows.groupBy("index_date").agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / BITMAP_BITS)).cast("int").alias("bitmaps"))
    # Date and bitmap number in one long: the bitmap aggregate sorts its rows, which is a radix sort by a single long.
    slot = F.shiftleft(F.unix_date("index_date").cast("long"), 32) + F.pmod(F.xxhash64("k"), F.col("bitmaps"))
    placed = rows.join(sizes, "index_date").select(slot.alias("slot"), "bitmaps", F.explode(_places("k")).alias("p"))
    built = placed.groupBy("slot").agg(F.max("bitmaps").alias("bitmaps"), F.bitmap_construct_agg("p").alias("bits"))
    return built.select(F.date_from_unix_date(F.shiftright("slot", 32).cast("int")).alias("index_date"), "bitmaps",
                        F.col("slot").bitwiseAND(F.lit(2 ** 32 - 1)).cast("int").alias("bitmap"), "bits")


def _bit(bits: str, place: Column) -> Column:
    byte = F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    return F.bit_get(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1


def possible_keys(keys: DataFrame, filters: DataFrame, date: str, key: str, load: str) -> DataFrame:
    """Distinct (date, key) that some load's filter holds: all known keys and about 1 % of the others.

    ``load`` names the column of ``filters`` that tells the loads apart.  A key is looked up once per load that has its date.
    """
    asked = keys.select(_date(date).alias("index_date"), F.col(key).alias("k")).where(F.col("k").isNotNull()).distinct()
    sizes = filters.select("index_date", load, "bitmaps").distinct()
    looked = asked.join(sizes, "index_date").withColumn("bitmap", F.pmod(F.xxhash64("k"), F.col("bitmaps")).cast("int"))
    hit = looked.join(filters.drop("bitmaps"), ["index_date", load, "bitmap"])
    found = F.forall(_places("k"), lambda p: _bit("bits", p))
    real = F.when(F.col("index_date") == F.lit(NO_DATE).cast("date"), F.lit(None)).otherwise(F.col("index_date"))
    return hit.where(found).select(real.alias(date), F.col("k").alias(key)).distinct()
