"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a maximal run of code points other than space, tab, \n, \v, \f, \r.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores appended until it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(df: DataFrame, name: str) -> Column:
    """Column of ``df`` by its plain name, also when that name holds dots or backticks."""
    return df[quoted(name)]


def words_of(text: Column) -> Column:
    """Words of a text as an array; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
