"""Reading a folder of landed files in which some are broken: the rest goes on, and what is left out is told."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_isolated(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType, **options: str
) -> tuple[DataFrame, DataFrame]:
    """The rows that can be read, and one row (file, line, reason) for each line and each file that can't.

    A file that breaks off, is no file of its format or can't be unpacked does not stop the others; rows that come before the
    place where it breaks are kept. Files without rows are looked at themselves: a Parquet file that ends as one should, and a
    file of blanks, are empty and not refused. Only names and sizes of the others are listed.
    """
    text = fmt in ("json", "xml")
    plain = T.StructType([f for f in schema.fields if f.name != CORRUPT])
    reader = spark.read.option("ignoreCorruptFiles", "true").options(**options)
    if text:
        whole = T.StructType([*plain.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).schema(whole)
    else:
        reader = reader.schema(plain)
    found = reader.format(fmt).load(path).select("*", F.col("_metadata.file_path").alias("_file"))
    broken = found.where(F.col(CORRUPT).isNotNull()) if text else found.where(F.lit(False)).withColumn(CORRUPT, F.lit(None).cast("string"))
    # Spark refuses to read broken lines alone, so another column has to be looked at with them.
    some = F.to_json(F.struct(*[F.col(f.name) for f in plain.fields]))
    lines = broken.select(
        F.col("_file").alias("file"), F.col(CORRUPT).alias("line"), F.when(some.isNull(), "").otherwise("does not parse").alias("reason")
    )
    rows = found.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file") if text else found.drop("_file")

    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    seen = found.groupBy(F.col("_file").alias("file")).agg(F.count(F.lit(1)).alias("n")).select("file")
    unseen = listing.where("length > 0").select(_uri(F.col("path")).alias("file"), "path").join(
        seen.select(_uri(F.col("file")).alias("file")), "file", "left_anti"
    )
    names = [r.path for r in unseen.select("path").collect()]  # of files without rows alone
    if not names:
        return rows, lines
    content = spark.read.format("binaryFile").load(names)
    if fmt == "parquet":
        is_empty = F.substring(F.col("content"), -4, 4) == F.lit(b"PAR1")
    else:
        is_empty = F.decode("content", "ISO-8859-1").rlike(r"\A\s*\z")
    files = content.where(~is_empty).select(
        F.col("path").alias("file"), F.lit(None).cast("string").alias("line"), F.lit(f"no readable {fmt} file").alias("reason")
    )
    return rows, lines.unionByName(files)


def _uri(path: Column) -> Column:
    """Paths as both listings spell them: one slash or three after the scheme, escaped or not."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(path, r"\+", "%2B")), "^file:/+", "file:/")
