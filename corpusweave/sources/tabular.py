"""Tables in text files: tab-separated values with explicit string schemas, per-project folders, and count tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusweave.operators.expect import ExpectationError


def read_tsv(spark: SparkSession, path: str, columns: Sequence[str], header: bool = True, encoding: str = "UTF-8", null: str = "", comment_key: str | None = None, sep: str = "\t") -> DataFrame:
    """All columns as strings, nothing inferred; only ``null`` reads as NULL. Columns are named by position.

    ``encoding`` may be UTF-16LE with a byte order mark. ``comment_key`` drops the first row of a file if its value there
    starts with ``#``, as a line of column types below the header does; later rows are data, whatever they start with.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    r = spark.read.schema(schema).option("sep", sep).option("header", header).option("nullValue", null).option("emptyValue", "").option("encoding", encoding).option("enforceSchema", True)
    if encoding.upper().startswith("UTF-16"):
        r = r.option("lineSep", "\n")
    out = r.csv(path)
    if not comment_key:
        return out
    # a file's first row is the one of least number in its first block; numbers follow the order of the file within a block
    marked = out.select("*", F.col("_metadata.file_path").alias("__cw_f"), F.col("_metadata.file_block_start").alias("__cw_b")).withColumn("__cw_i", F.monotonically_increasing_id())
    first = marked.filter("__cw_b = 0").groupBy(F.col("__cw_f").alias("__cw_g")).agg(F.min("__cw_i").alias("__cw_i0"))
    both = marked.join(first, (F.col("__cw_f") == F.col("__cw_g")) & (F.col("__cw_i") == F.col("__cw_i0")), "left")
    comment = F.col("__cw_i0").isNotNull() & F.coalesce(F.col(comment_key).startswith("#"), F.lit(False))
    return both.filter(~comment).select(*columns)


def write_tsv(df: DataFrame, path: str, digits: int | None = None, encoding: str = "UTF-8", sep: str = "\t") -> None:
    """Tab-separated values with a header, NULL as an empty field; ``digits`` fixes the decimals of floating numbers."""
    if digits is not None:
        df = df.select(*(F.format_string(f"%.{digits}f", c).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))
    df.write.option("sep", sep).option("header", True).option("nullValue", "").option("emptyValue", "").option("encoding", encoding).csv(path)


def read_projects(spark: SparkSession, glob: str, columns: Sequence[str], pattern: str) -> DataFrame:
    """The files of many project folders in one scan, with ``project`` taken from the path by ``pattern``'s first group."""
    out = read_tsv(spark, glob, columns)
    return out.withColumn("project", F.regexp_extract(F.input_file_name(), pattern, 1))


def missing_inputs(expected: DataFrame, present: DataFrame, key: str = "project") -> DataFrame:
    """Expected projects of which no file is present."""
    return expected.select(key).distinct().join(present.select(key).distinct(), key, "left_anti")


def require_inputs(expected: DataFrame, present: DataFrame, key: str = "project") -> DataFrame:
    """``present`` itself, after every expected project was found in it."""
    lost = [r[0] for r in missing_inputs(expected, present, key).orderBy(key).limit(20).collect()]
    if lost:
        raise ExpectationError(f"no input for {', '.join(map(str, lost))}")
    return present


def unpivot_counts(df: DataFrame, feature: str, fixed: Sequence[str] = ()) -> DataFrame:
    """A dense table with one column per sample as facts ``feature, sample, n`` without zeros."""
    samples = [c for c in df.columns if c != feature and c not in fixed]
    long = df.unpivot([feature, *fixed], samples, "sample", "n").withColumn("n", F.col("n").try_cast("bigint"))
    return long.filter(F.col("n") > 0)


def fasta_lines(df: DataFrame, name: str, sequence: str) -> DataFrame:
    """One text value per record: the name after its last semicolon, and the sequence; empty sequences are skipped."""
    s = df.filter(F.coalesce(F.col(sequence), F.lit("")) != "")
    return s.select(F.concat(F.lit(">"), F.element_at(F.split(F.col(name), ";"), -1), F.lit("\n"), F.col(sequence)).alias("value"))


def count_fasta(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).filter(F.col("value").startswith(">")).count()


def biosample_records(texts: DataFrame, key: str, text: str) -> DataFrame:
    """``key, title, identifiers, attribute, value`` of record texts: a numbered title, identifiers, quoted attributes.

    Of an attribute given twice the last counts. Texts of another form give no rows.
    """
    t = texts.select(F.col(key).alias(key), F.col(text).alias("t")).filter(F.col("t").rlike(r"^\d+: [^\n]*\nIdentifiers: "))
    pairs = F.transform(F.regexp_extract_all("t", F.lit(r'(?m)^\s*(/[^=\n]+="[^"\n]*")\s*$'), F.lit(1)), lambda p: F.struct(F.regexp_extract(p, r'^/([^=]+)="', 1).alias("attribute"), F.regexp_extract(p, r'="([^"]*)"$', 1).alias("value")))
    out = t.select(key, F.regexp_extract("t", r"^\d+: ([^\n]*)", 1).alias("title"), F.regexp_extract("t", r"Identifiers: ([^\n]*)", 1).alias("identifiers"), F.posexplode(pairs).alias("at", "p"))
    return out.groupBy(key, "title", "identifiers", F.col("p.attribute").alias("attribute")).agg(F.max_by("p.value", "at").alias("value"))
