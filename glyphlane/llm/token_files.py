"""Token ids in Arrow files of fixed-size lists, written in id order and read back.

A file is an Arrow IPC file. Each row is one sequence of ``seq_len`` ids, its
mask (a bit each: 1 for ids, 0 for the filling of the file's last row), and the
documents that begin in it: id, place in the row, number of ids. Batches hold a
number of rows that the file states, so the batch of a row is known, and a mapped
file gives ids and masks of any row without a copy. Ids are 16 bits wide if the
vocabulary allows it, else 32.

Documents are dealt by id ranges to sorted tasks; a task writes its files one
after the other, each of bounded size. A file is written under a name of its
own and counts once the task's manifest row counts, so a repeated or speculative
task leaves nothing that is read twice. Places of files in the whole order come
from the manifest, one small row per file.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_folder, slices, written
from .word_ids import definition_of, encoder

STARTING = pa.list_(pa.struct([("doc_id", pa.int64()), ("place", pa.int32()), ("n_tokens", pa.int64())]))
#: Files that one task reads, one after the other, where there are very many.
FILES_PER_TASK = 16
MANIFEST = "path string, part int, number int, n_docs bigint, n_tokens bigint"


def file_schema(dtype: np.dtype, seq_len: int, batch_rows: int) -> pa.Schema:
    return pa.schema([
        pa.field("ids", pa.list_(pa.from_numpy_dtype(dtype), seq_len)),
        pa.field("mask", pa.list_(pa.bool_(), seq_len)),
        pa.field("starting", STARTING),
    ], {"batch_rows": str(batch_rows)})


class _File:
    """One file in the making: whole batches are written as soon as they are full."""

    def __init__(self, path: str, dtype: np.dtype, seq_len: int, batch_rows: int):
        self.path, self.dtype, self.seq_len, self.batch_rows = path, dtype, seq_len, batch_rows
        filesystem, inner = pafs.FileSystem.from_uri(path)
        filesystem.create_dir(inner.rpartition("/")[0], recursive=True)
        self.sink = filesystem.open_output_stream(inner)
        self.schema = file_schema(dtype, seq_len, batch_rows)
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int, int]] = []
        self.waiting = self.n_docs = self.n_tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, self.waiting, len(ids)))
        self.parts.append(ids)
        self.waiting += len(ids)
        self.n_docs += 1
        self.n_tokens += len(ids)
        full = self.batch_rows * self.seq_len
        if self.waiting >= full:
            self._write(self.waiting // full * full)

    def _write(self, n: int) -> None:
        """The first ``n`` waiting ids; a rest that fills no row is filled up."""
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, self.dtype)
        now, rest = ids[:n], ids[n:]
        rows = -(-len(now) // self.seq_len)
        flat = np.zeros(rows * self.seq_len, self.dtype)
        flat[: len(now)] = now
        mask = np.arange(len(flat)) < len(now)
        begun: list[list[dict]] = [[] for _ in range(rows)]
        for doc_id, at, size in self.docs:
            if at < n:
                begun[at // self.seq_len].append({"doc_id": doc_id, "place": at % self.seq_len, "n_tokens": size})
        self.docs = [(d, at - n, size) for d, at, size in self.docs if at >= n]
        table = pa.RecordBatch.from_arrays([
            pa.FixedSizeListArray.from_arrays(pa.array(flat), self.seq_len),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.seq_len),
            pa.array(begun, STARTING),
        ], schema=self.schema)
        for row in range(0, rows, self.batch_rows):
            self.out.write_batch(table.slice(row, self.batch_rows))
        self.parts, self.waiting = ([rest] if len(rest) else []), len(rest)

    def close(self) -> tuple[str, int, int]:
        if self.waiting:
            self._write(self.waiting)
        self.out.close()
        self.sink.close()
        return self.path, self.n_docs, self.n_tokens


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, seq_len: int = 2048, batch_rows: int = 256,
    file_tokens: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Writes the files and returns their manifest: path, first_token, n_docs, n_tokens.

    Ids of the whole text by the tokenizers library (null counts as empty),
    then ``end_id``. Documents go in ascending id order, null ids first; rows
    that repeat an id are ordered by a hash of their text. An empty table gives
    an empty manifest. Other columns are not read. ``folder`` is a URI that
    Arrow can write to from every executor.
    """
    definition = definition_of(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, number, out = encoder(definition), TaskContext.get().partitionId(), 0, None
        done: list[tuple] = []
        for batch in slices(batches):
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1).to_pylist())):
                out = out or _File(f"{folder}/{uuid.uuid4().hex}.arrow", coder.dtype, seq_len, batch_rows)
                out.add(doc_id, np.append(ids, coder.dtype.type(end_id)))
                if out.n_tokens >= file_tokens:
                    done.append((part, number, *out.close()))
                    number, out = number + 1, None
        if out:
            done.append((part, number, *out.close()))
        if done:
            parts, numbers, paths, n_docs, n_tokens = map(list, zip(*done))
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths), pa.array(parts, pa.int32()), pa.array(numbers, pa.int32()), pa.array(n_docs), pa.array(n_tokens)],
                ["path", "part", "number", "n_docs", "n_tokens"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # an id that very many rows repeat is cut too: by a hash of the text, and equal rows by their place, which changes nothing
    tied = rows.withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    ordered = tied.repartitionByRange("doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie", "place")
    manifest = written(ordered.select("doc_id", "text").mapInArrow(run, MANIFEST), "token-manifest")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select(
        "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long").alias("first_token"), "n_docs", "n_tokens"
    )


def _open(path: str) -> pa.ipc.RecordBatchFileReader:
    filesystem, inner = pafs.FileSystem.from_uri(path)
    if isinstance(filesystem, pafs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(inner))
    return pa.ipc.open_file(filesystem.open_input_file(inner))


def sequence(path: str, row: int) -> tuple[np.ndarray, pa.BooleanArray]:
    """Ids and mask of one row; of a mapped file neither is copied, the mask's bits stay as they lie."""
    reader = _open(path)
    batch_rows = int(reader.schema.metadata[b"batch_rows"])
    batch = reader.get_batch(row // batch_rows)
    ids, mask = (batch.column(i)[row % batch_rows].values for i in (0, 1))
    return ids.to_numpy(zero_copy_only=True), mask


def _documents(path: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """doc_id, place in the file and ids of each document of a file, batch by batch."""
    reader = _open(path)
    seq_len = reader.schema.field("ids").type.list_size
    begun: list[tuple[int | None, int, int]] = []
    held: list[np.ndarray] = []
    first = until = 0  # the ids held lie from first to until in the file
    for k in range(reader.num_record_batches):
        batch = reader.get_batch(k)
        ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
        for row, docs in enumerate(batch.column(2).to_pylist()):
            begun += [(d["doc_id"], until + row * seq_len + d["place"], d["n_tokens"]) for d in docs]
        held.append(ids)
        until += len(ids)
        flat, last = np.concatenate(held), 0
        while last < len(begun) and begun[last][1] + begun[last][2] <= until:
            doc_id, at, size = begun[last]
            yield doc_id, at, flat[at - first : at - first + size]
            last += 1
        begun = begun[last:]
        keep = begun[0][1] if begun else until
        held, first = ([flat[keep - first :]] if keep < until else []), keep


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[tuple] = []
                for doc_id, at, ids in _documents(path):
                    rows.append((doc_id, first + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 4096:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"]
        )

    # Spark would put thousands of such short rows into one task
    files = manifest.count()
    tasks = max(1, min(files, max(manifest.sparkSession.sparkContext.defaultParallelism * 4, files // FILES_PER_TASK)))
    return manifest.select("path", "first_token").repartition(tasks).mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_files_folder(spark) -> str:
    """A new folder for one set of files in the shared folder."""
    folder = shared_folder(spark)
    return f"{folder if '://' in folder else 'file://' + folder}/token-files-{uuid.uuid4().hex}"
