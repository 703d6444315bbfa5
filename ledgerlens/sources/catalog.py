"""The four input tables of a run, and how to load or materialize them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schemas as S
from ledgerlens.session import stored
from ledgerlens.sources import fixtures

TABLE_NAMES = ("sales_lines", "taxes", "fees", "accounts")
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def checked(name: str, df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` in its types; other columns stay.

    Raises when a column is missing or can't be held exactly: the report sums are
    sized for the declared types, and a wider money column would be rounded
    without a sign. Narrower decimals and integers are widened."""
    types = {f.name: f.dataType for f in df.schema.fields}
    wrong, casts = [], {}
    for field in schema.fields:
        have, want = types.get(field.name), field.dataType
        if have == want:
            continue
        if isinstance(want, T.DecimalType):
            fits = isinstance(have, _INTEGERS) or (
                isinstance(have, T.DecimalType) and have.scale <= want.scale
                and have.precision - have.scale <= want.precision - want.scale)
        else:
            fits = isinstance(want, T.LongType) and isinstance(have, _INTEGERS)
        if fits:
            casts[field.name] = F.col(field.name).cast(want)
        else:
            wrong.append(f"{field.name}: expected {want.simpleString()}, found "
                         f"{have.simpleString() if have else 'no such column'}")
    if wrong:
        raise ValueError(f"table {name}: " + "; ".join(wrong))
    return df.withColumns(casts) if casts else df


@dataclass(frozen=True)
class Tables:
    """Lazy DataFrames for sales lines, taxes, fees and accounts, checked against
    :mod:`ledgerlens.schemas` however they were made."""

    sales: DataFrame
    taxes: DataFrame
    fees: DataFrame
    accounts: DataFrame

    def __post_init__(self) -> None:
        for field, name, schema in (("sales", "sales_lines", S.SALES_LINES),
                                    ("taxes", "taxes", S.TAXES), ("fees", "fees", S.FEES),
                                    ("accounts", "accounts", S.ACCOUNTS)):
            object.__setattr__(self, field, checked(name, getattr(self, field), schema))

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        """Derive the tables from the driver's TPC-H-style parquet on the fly."""
        sales = fixtures.sales_lines(spark, sf_dir)
        return cls(
            sales=sales,
            taxes=fixtures.taxes(spark, sf_dir, sales),
            fees=fixtures.fees(spark, sf_dir),
            accounts=fixtures.accounts(spark, sf_dir),
        )

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> "Tables":
        """Load tables written by :meth:`materialize` (or any parquet with the
        schemas of :mod:`ledgerlens.schemas`)."""
        root = root.rstrip("/")
        return cls(*(spark.read.parquet(f"{root}/{n}") for n in TABLE_NAMES))

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str | None = None) -> "Tables":
        prefix = f"{database}." if database else ""
        return cls(*(spark.table(prefix + n) for n in TABLE_NAMES))

    def materialize(self, root: str, files: int | None = None) -> "Tables":
        """Write all four tables as parquet under ``root`` and return them re-read.

        The sales history also stores the normalized ``partner_id`` so partner
        filters reach Parquet statistics, and it is clustered: see
        :func:`_write_sales`. ``files`` (optional) fixes the number of sales files;
        left unset, it is the number of shuffle partitions, which
        :func:`~ledgerlens.session.cluster_conf` sizes from the data. AQE merges
        small ones.
        """
        root = root.rstrip("/")
        _write_sales(self.sales, f"{root}/sales_lines", files)
        self.taxes.write.mode("overwrite").parquet(f"{root}/taxes")
        self.fees.write.mode("overwrite").parquet(f"{root}/fees")
        self.accounts.write.mode("overwrite").parquet(f"{root}/accounts")
        return Tables.from_parquet(self.sales.sparkSession, root)

    @classmethod
    def ingest(cls, spark: SparkSession, sf_dir: str, root: str,
               files: int | None = None) -> "Tables":
        """Derive the tables from the driver data and write them under ``root``.

        The sales lines are joined and stored once: the clustering reads them twice
        (a sample, then all), and the tax rows are derived from the written table.
        The fee table joins one row an order."""
        root = root.rstrip("/")
        _write_sales(stored(fixtures.sales_lines(spark, sf_dir), "sales-lines"),
                     f"{root}/sales_lines", files)
        written = spark.read.parquet(f"{root}/sales_lines")
        fixtures.taxes(spark, sf_dir, written).write.mode("overwrite").parquet(f"{root}/taxes")
        fixtures.fees(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/fees")
        fixtures.accounts(spark, sf_dir).write.mode("overwrite").parquet(f"{root}/accounts")
        return cls.from_parquet(spark, root)

    def with_sales(self, sales: DataFrame) -> "Tables":
        return Tables(sales, self.taxes, self.fees, self.accounts)


def _write_sales(sales: DataFrame, path: str, files: int | None) -> None:
    """Write the sales history clustered by (partner, contract), with its ``partner_id``.

    The files are ranges of (partner, contract, item), cut at quantiles of a sample, so
    they are about equally large whatever the keys' sizes: a partner with a third of the
    rows fills a third of the files, split by its contracts and, within a hot contract,
    by item. A run of one partner then reads the files whose range holds it and skips
    the others by their statistics, and so does a contract filter within a partner; the
    sort inside a file does the same for its row groups."""
    from ledgerlens.functions.columns import partner_id

    range_keys = ("partner_id", "contract_code", "item_id")
    sales = sales.withColumn("partner_id", partner_id())
    ranged = (sales.repartitionByRange(int(files), *range_keys) if files
              else sales.repartitionByRange(*range_keys))
    ranged.sortWithinPartitions(*range_keys).write.mode("overwrite").parquet(path)
