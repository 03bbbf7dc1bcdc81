"""Token ids as flat binary files, with 64-bit document offsets.

A folder holds, for every partition p of the documents in ascending order of
their id, ``tokens-p.bin`` (unsigned 16- or 32-bit little-endian ids, nothing
else) and ``offsets-p.bin`` (64-bit: where each document starts in that file,
and its end), ``docs-p.bin`` (64-bit document ids), and a Parquet table
``manifest`` with one row per partition: how many documents and ids it has, and
how many come before it. Files are read back through memory maps.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from crystalflow.llm.helpers import chunks, id_and_text
from crystalflow.llm.tokens import Splitter, worker_encoder

MANIFEST = "part int, n_docs long, n_tokens long, width int"
FLUSH_BYTES = 1 << 23


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's address, and the path in it."""
    if urlparse(folder).scheme:
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def _name(root: str, kind: str, part: int) -> str:
    return f"{root}/{kind}-{part:06d}.bin"


@dataclass
class _Writer:
    """The three files of one partition, renamed into place when complete."""

    folder: str
    part: int
    attempt: int
    width: int

    def __post_init__(self):
        self.fs, self.root = _open(self.folder)
        self.files = {k: self.fs.open_output_stream(self._draft(k)) for k in ("tokens", "offsets", "docs")}
        self.n_docs = self.n_tokens = 0
        self.put("offsets", np.zeros(1, "<i8"))

    def _draft(self, kind: str) -> str:
        return f"{_name(self.root, kind, self.part)}.{self.attempt}"

    def put(self, kind: str, values: np.ndarray) -> None:
        self.files[kind].write(values.tobytes())

    def add(self, ids: list[int], encoded: list[bytes]) -> None:
        ends = self.n_tokens + np.cumsum([len(e) // 4 for e in encoded])
        self.put("tokens", np.frombuffer(b"".join(encoded), "<u4").astype(f"<u{self.width}"))
        self.put("offsets", ends.astype("<i8"))
        self.put("docs", np.array(ids, "<i8"))
        self.n_docs += len(ids)
        self.n_tokens = int(ends[-1])

    def close(self) -> None:
        for kind, file in self.files.items():
            file.close()
            self.fs.move(self._draft(kind), _name(self.root, kind, self.part))


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, splitter: Splitter, end_id: int,
    id_col: str = "doc_id", text_col: str = "text", vocabulary: int = 1 << 16,
) -> None:
    """Encode every text, append ``end_id`` and write the files to the shared ``folder``.

    A null or empty text has the end id alone. Documents with equal ids stand in
    the order of their texts. Ids are integers, and rows without one are left
    out, as nothing could name them; other columns are not read. Ids take 16 bits if the ``vocabulary`` allows. A task writes
    drafts under its own attempt's number and renames them at its end, so a
    repeated or lost attempt leaves whole files. No rows give an empty manifest.
    """
    width = 2 if vocabulary <= 1 << 16 else 4
    end = np.array([end_id], "<u4").tobytes()
    where, root = _open(folder)
    where.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, encoder = TaskContext.get(), None, None
        for batch in chunks(batches):
            if out is None:
                encoder = worker_encoder(tokenizer, splitter)
                out = _Writer(folder, task.partitionId(), task.taskAttemptId(), width)
            out.add(batch.column("id").to_pylist(), [e + end for e in encoder.encode(batch.column("text").to_pylist())])
        if out is not None:
            out.close()
            values = (out.part, out.n_docs, out.n_tokens, width)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, (pa.int32(), pa.int64(), pa.int64(), pa.int32()), strict=True)],
                names=["part", "n_docs", "n_tokens", "width"],
            )

    rows = id_and_text(docs, id_col, text_col).select(F.col("id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).where("id IS NOT NULL")
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/written")
    # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/written").withColumns(
        {f"first_{k}": F.coalesce(F.sum(f"n_{k}s").over(before), F.lit(0)) for k in ("doc", "token")}
    )
    manifest.write.parquet(f"{folder}/manifest")


def _mapped(where: pafs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file's values: memory-mapped on a local or mounted file system, else read."""
    if isinstance(where, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)
    with where.open_input_file(path) as file:
        return np.frombuffer(file.read_buffer(), kind)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """One row per document of the files: doc_id, start (over all files), n_tokens, ids_crc32 and, if asked, ids.

    ``ids`` and the CRC are over little-endian unsigned 32-bit values.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                tokens = _mapped(where, _name(root, "tokens", row["part"]), f"<u{row['width']}")
                offsets = _mapped(where, _name(root, "offsets", row["part"]), "<i8")
                names = _mapped(where, _name(root, "docs", row["part"]), "<i8")
                at = 0
                while at < len(names):
                    stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + FLUSH_BYTES // 4)) - 1)
                    stop = min(stop, len(names))
                    ids = [tokens[offsets[i] : offsets[i + 1]].astype("<u4").tobytes() for i in range(at, stop)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names[at:stop]),
                            pa.array(offsets[at:stop] + row["first_token"]),
                            pa.array(np.diff(offsets[at : stop + 1])),
                            pa.array(list(map(zlib.crc32, ids)), pa.int64()),
                            *[pa.array(ids, pa.binary())] * with_ids,
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids,
                    )
                    at = stop

    manifest = spark.read.parquet(f"{folder}/manifest")
    parts = max(1, manifest.count())
    return manifest.repartition(parts, "part").mapInArrow(read, schema)
