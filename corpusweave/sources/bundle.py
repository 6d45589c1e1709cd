"""A corpus as a bundle of parquet tables with provenance: writing, reading back, verifying, and named-array files."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.operators.expect import ExpectationError


def write_bundle(tables: Mapping[str, DataFrame], path: str, provenance: Mapping[str, object], codec: str = "zstd", partition_by: Mapping[str, str] | None = None) -> None:
    """Every table below ``path``, and one row that says what they are: schemas, rows and the given provenance."""
    spark = next(iter(tables.values())).sparkSession
    rows = {}
    for name, df in tables.items():
        w = df.write.option("compression", codec)
        (w.partitionBy(partition_by[name]) if partition_by and name in partition_by else w).parquet(f"{path}/{name}")
        rows[name] = {"columns": dict(df.dtypes), "rows": spark.read.parquet(f"{path}/{name}").count()}
    spark.createDataFrame([(json.dumps({"provenance": dict(provenance), "tables": rows}, sort_keys=True),)], "value string").coalesce(1).write.text(f"{path}/_manifest_text")


def manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/_manifest_text").head()[0])


def read_bundle(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of a bundle after a check of columns and rows against its manifest."""
    out = {}
    for name, want in manifest(spark, path)["tables"].items():
        df = spark.read.parquet(f"{path}/{name}")
        if dict(df.dtypes) != want["columns"] or df.count() != want["rows"]:
            raise ExpectationError(f"{name} is not as it was written")
        out[name] = df
    return out


def read_npz_pairs(spark: SparkSession, glob: str, matrix: str = "dist", names: str = "var_id") -> DataFrame:
    """``file, i, j, dist`` (upper triangle) of square matrices in named-array files; a file is read in one task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                with np.load(io.BytesIO(content), allow_pickle=False) as z:
                    m, ids = z[matrix], [str(x) for x in z[names]]
                for a in range(len(ids)):  # a row at a time keeps a large matrix out of one frame
                    k = len(ids) - a - 1
                    if k:
                        yield pd.DataFrame({"file": [path] * k, "i": [ids[a]] * k, "j": ids[a + 1 :], "dist": m[a, a + 1 :].astype(float)})

    src = spark.read.format("binaryFile").load(glob).select("path", "content")
    return src.mapInPandas(run, "file string, i string, j string, dist double")


def done_work(all_: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work that is still to do: not listed as done, or done with another number of rows than expected."""
    d = done.select(key, F.col("rows").alias("__cw_rows"))
    return all_.join(d, key, "left").filter(F.col("__cw_rows").isNull() | (F.col("__cw_rows") != F.col("rows"))).drop("__cw_rows")
