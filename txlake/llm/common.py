"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space is these six characters everywhere in this subpackage.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` with underscores added until none is a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let no Arrow batch of texts hold more than ``BATCH_BYTES`` (Spark's default is 64 MB), so that
    a worker's memory does not depend on how long the texts are. Results do not depend on it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name).lower().removesuffix("b")
    if not held.isdigit() or int(held) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def column(df: DataFrame, name: str) -> Column:
    """The column of that very name; dots and odd characters are part of the name."""
    return df["`" + name.replace("`", "``") + "`"]


def text_of(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """All words of a text as an array; none where it is null."""
    return F.regexp_extract_all(text_of(text), F.lit(f"({WORD})"), F.lit(1))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other letters as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where lambdas of ``body`` use it."""
    return F.transform(F.array(value), body)[0]
