"""CSV sources: inferred or explicit schema, Latin-1, encoding fallback,
and the gazetteer file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schema import to_snake

GAZETTEER_SCHEMA = T.StructType([
    T.StructField("Order City", T.StringType()),
    T.StructField("Order State", T.StringType()),
    T.StructField("Dest_Lat", T.DoubleType()),
    T.StructField("Dest_Lon", T.DoubleType()),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             encoding: str = "UTF-8", header: bool = True, sep: str = ",") -> DataFrame:
    """CSV scan. With ``schema`` there is no inference pass over the data
    (preferred at scale); without, the schema is inferred as the reference
    does."""
    r = spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def decode_cell(cell: Column) -> Column:
    """A cell that was read as ISO-8859-1: its UTF-8 decoding if its bytes are
    valid UTF-8, else the Latin-1 text itself."""
    raw = F.encode(cell, "ISO-8859-1")
    return F.when(F.is_valid_utf8(raw.cast("string")), F.decode(raw, "UTF-8")).otherwise(cell)


def read_csv_fallback(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read text of either encoding in one scan.

    Every byte is an ISO-8859-1 character, so reading as ISO-8859-1 loses
    nothing; each string cell is then decoded on its own. A folder may mix
    files of both encodings, and one odd cell does not change the others.
    """
    df = read_csv(spark, path, schema, encoding="ISO-8859-1")
    return df.select(*[decode_cell(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def read_gazetteer(spark: SparkSession, path: str | None, unique: bool = False) -> DataFrame | None:
    """The four gazetteer columns, renamed to ours; None when no path is
    configured (the caller then skips the join, by configuration).

    A malformed coordinate is null. ``unique=True`` keeps one row per key (a
    row with coordinates wins), which is what a folder holds after a retried
    append; the joins do the same on their own.
    """
    if not path:
        return None
    df = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    cols = [f.name for f in GAZETTEER_SCHEMA.fields]
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"gazetteer {path} lacks columns {missing}")
    typed = df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
                        for f in GAZETTEER_SCHEMA.fields])
    from ..operators.geo import dedup_gazetteer
    return dedup_gazetteer(to_snake(typed)) if unique else to_snake(typed)
