"""Address tables and matching of two sources through standard addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltstone.functions.address import COLUMNS, standardize
from siltstone.operators.joins import HOT_ROWS, salted_join
from siltstone.sources.files import exists
from siltstone.sources.stage import stage


def distinct_addresses(column: str, *frames: DataFrame) -> DataFrame:
    """The distinct values of one column over several frames, each de-duplicated before the shuffle."""
    union = frames[0].select(column)
    for df in frames[1:]:
        union = union.union(df.select(column))
    return union.distinct()


def address_table(column: str, *frames: DataFrame) -> DataFrame:
    """One row per distinct address with its standard form."""
    return standardize(distinct_addresses(column, *frames), column).select(column, *COLUMNS)


class AddressDictionary:
    """Standard forms of all addresses met so far, kept under ``root``: each is parsed once, however many rows and
    runs bring it.

    One row per distinct address, with the MD5 of its text as ``address_key``.  A run looks its addresses up by
    the key, sixteen bytes whatever the text, and appends those that are new.  One run at a time may add.
    """

    def __init__(self, spark: SparkSession, root: str, address: str = "clean_address"):
        self.spark, self.root, self.address = spark, root, address

    def _key(self):
        return F.unhex(F.md5(F.col(self.address).cast("binary"))).alias("address_key")

    def add(self, *frames: DataFrame) -> int:
        """Parse the addresses of the frames that are not known yet; how many these were."""
        met = distinct_addresses(self.address, *frames).where(F.col(self.address).isNotNull()).select(self.address, self._key())
        if exists(self.spark, f"{self.root}/_SUCCESS"):
            met = met.join(self._rows().select("address_key"), "address_key", "left_anti")
        unseen = stage(met, "unseen_addresses")
        n = unseen.count()
        if n:
            parsed = standardize(unseen, self.address).select("address_key", self.address, *COLUMNS)
            parsed.write.mode("append").parquet(self.root)
        return n

    def _rows(self) -> DataFrame:
        return self.spark.read.parquet(self.root)

    def read(self) -> DataFrame:
        """All known addresses, as ``address_table`` gives them."""
        return self._rows().select(self.address, *COLUMNS)

    def of(self, *frames: DataFrame) -> DataFrame:
        """The address table of the frames, as ``address_table`` gives it; what is not known yet is added first."""
        self.add(*frames)
        met = distinct_addresses(self.address, *frames).withColumnRenamed(self.address, "__met")
        if not exists(self.spark, f"{self.root}/_SUCCESS"):  # nothing but NULLs so far
            return address_table(self.address, *frames)
        known = self._rows().drop(self.address)
        found = met.join(known, F.unhex(F.md5(F.col("__met").cast("binary"))) == F.col("address_key"), "left")
        standard = [F.coalesce(c, F.lit("")).alias(c) if c == "mapped_address" else F.col(c) for c in COLUMNS]
        return found.select(F.col("__met").alias(self.address), *standard)


def with_standard_address(df: DataFrame, address: str, bridge: DataFrame | None = None) -> DataFrame:
    """Replace the address column by ``mapped_address``.

    With ``bridge``, a stored address table, this is an inner join on the address.  Without, the standard
    form is computed in place, which needs no shuffle and gives the same rows.
    """
    if bridge is not None:
        return df.join(bridge.select(address, "mapped_address"), address, "inner").drop(address)
    # the other columns travel as one struct, since their names may be those of address parts
    others = F.struct(*[f"`{c}`" for c in df.columns if c != address])
    known = df.where(F.col(address).isNotNull()).select(address, others.alias("__row"))
    return standardize(known, address).select("__row.*", "mapped_address")


def address_bridge(left: DataFrame, right: DataFrame, address: str, bridge: DataFrame | None = None,
                   match_blank: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Full outer join of two sources on the standard form of their addresses.

    The join key comes out as ``mapped_address``, taken from whichever side has it.  Blank addresses match
    nothing and stay as unmatched rows of their side.  ``match_blank=True`` takes them for equal, which gives
    every blank row of one side with every one of the other.  Runs jobs: both sides are written once with
    their keys, since the join looks at them more than once, and the long expression chain behind a key is
    dear to plan under a join.
    """
    lhs = stage(with_standard_address(left, address, bridge), "addressed")
    rhs = stage(with_standard_address(right, address, bridge), "addressed")
    key = F.col("mapped_address") if match_blank else F.nullif("mapped_address", F.lit(""))
    lhs, rhs = lhs.withColumn("__lk", key), rhs.withColumn("__rk", key).drop("mapped_address")
    joined = salted_join(lhs, rhs, "__lk", "__rk", "full", hot_rows)
    merged = F.coalesce("mapped_address", "__rk", F.lit("")).alias("mapped_address")
    return joined.select(merged, *[f"`{c}`" for c in joined.columns if c not in ("mapped_address", "__lk", "__rk")])
