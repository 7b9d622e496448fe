"""SHA-256 of files of any size: paths are dealt to tasks, each file is read in pieces by one of them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that are read at a time, and about so many bytes of files for a task.
PIECE, SHARE = 1 << 20, 1 << 30


def sha256_of(path: str) -> str:
    """Of a file that Arrow's file systems reach: a local or mounted path, or an address of a store (s3, gs, hdfs, abfs). Paths are as listings write them, without escapes."""
    from pyarrow import fs

    scheme, place, inner = re.fullmatch("(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(/.*)", path).groups()
    if scheme in (None, "file"):
        store = fs.LocalFileSystem()
    else:
        store, base = fs.FileSystem.from_uri(f"{scheme}://{place or ''}/")
        inner = base.rstrip("/") + inner
    digest = hashlib.sha256()
    with store.open_input_stream(inner) as stream:
        while piece := stream.read(PIECE):
            digest.update(piece)
    return digest.hexdigest()


def file_digests(files: DataFrame) -> DataFrame:
    """files (file, size, modified, ...) with file_hash. Tasks are about SHARE bytes each, or as many as there are cores."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(file_hash=[sha256_of(f) for f in pdf["file"]])

    total = files.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-total // SHARE))
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema) + ", file_hash string"
    return files.repartition(tasks, F.xxhash64("file")).mapInPandas(read, kind)
