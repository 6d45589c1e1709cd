"""Count tables in BIOM files as a Python data source: ``spark.read.format("biom").load(path)`` gives facts.

Rows are ``file, feature, sample, n`` for every count that is not zero. Version 1 of the format is JSON, with sparse triples
or dense rows; version 2 is HDF5 and needs ``h5py``, without which such a file raises. Every file is read by one task, files
in parallel. ``path`` is a folder or a pattern of files that all executors can reach.

Defined cases: a file without counts gives no rows; positions outside the lists of names, or a form the file does not
state, raise.
"""

from __future__ import annotations

import glob
import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_NAMES = ["file", "feature", "sample", "n"]
_ROWS = 65_536


def _json_counts(text: str) -> Iterator[tuple[str, str, float]]:
    t = json.loads(text)
    rows, cols = [r["id"] for r in t["rows"]], [c["id"] for c in t["columns"]]
    if t["matrix_type"] == "sparse":
        triples = iter(t["data"])
    elif t["matrix_type"] == "dense":
        triples = ((i, j, v) for i, row in enumerate(t["data"]) for j, v in enumerate(row))
    else:
        raise ValueError(f"unknown matrix type {t['matrix_type']!r}")
    for i, j, v in triples:
        if not (0 <= i < len(rows) and 0 <= j < len(cols)):
            raise ValueError(f"position {i}, {j} has no name")
        if v:
            yield rows[i], cols[j], float(v)


def _hdf5_counts(path: str) -> Iterator[tuple[str, str, float]]:
    try:
        import h5py
    except ImportError as e:
        raise ImportError("reading version 2 of the format needs h5py") from e
    with h5py.File(path, "r") as f:
        rows, cols = ([x.decode() if isinstance(x, bytes) else str(x) for x in f[f"{axis}/ids"][:]] for axis in ("observation", "sample"))
        m = f["observation/matrix"]
        start = m["indptr"][:]
        for i, name in enumerate(rows):  # a feature at a time
            part = slice(int(start[i]), int(start[i + 1]))
            for j, v in zip(m["indices"][part], m["data"][part], strict=True):
                if v:
                    yield name, cols[j], float(v)


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        at = self.path.removeprefix("file:")
        found = sorted(glob.glob(os.path.join(at, "*.biom") if os.path.isdir(at) else at))
        if not found:
            raise FileNotFoundError(self.path)
        return [InputPartition(f) for f in found]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path = partition.value
        with open(path, "rb") as f:
            start = f.read(8)
        if start == b"\x89HDF\r\n\x1a\n":
            counts = _hdf5_counts(path)
        else:
            with open(path, encoding="utf-8") as f:
                counts = _json_counts(f.read())
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*held, strict=True))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.string(), pa.string(), pa.string(), pa.float64()), strict=True)], names=_NAMES)

        for c in counts:
            held.append((os.path.basename(path), *c))
            if len(held) == _ROWS:
                yield batch()
        if held:
            yield batch()


class BiomSource(DataSource):
    """The format ``biom``."""

    @classmethod
    def name(cls) -> str:
        return "biom"

    def schema(self) -> str:
        return "file string, feature string, sample string, n double"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BiomSource)


def biom_text(features: list[str], samples: list[str], triples: list[tuple[int, int, float]]) -> str:
    """A table in version 1 of the format, with sparse triples."""
    return json.dumps({"id": None, "format": "Biological Observation Matrix 1.0.0", "format_url": "http://biom-format.org", "type": "OTU table", "matrix_type": "sparse", "matrix_element_type": "float", "shape": [len(features), len(samples)], "rows": [{"id": f, "metadata": None} for f in features], "columns": [{"id": s, "metadata": None} for s in samples], "data": [list(t) for t in triples]})
