"""Token ids of a corpus in flat binary files with 64-bit document offsets, read back memory-mapped.

Layout of a folder: `manifest.json` lists the files in order; each entry names a `.bin` file, the ids
of its documents one after the other as unsigned little-endian integers (16 bits when the
vocabulary allows, else 32), and a `.idx` file: five 64-bit words (magic, bytes per id, documents, ids,
0), documents + 1 unsigned 64-bit offsets in ids, the 64-bit document ids, and a byte per
document that is 1 where the document id is given. An entry's `base` is the number of ids in all files before
it (prefix sums over the partitions), so that id number k of the corpus is found by bisection.

Documents are put in order by a range partitioning on their id, so every task sorts and writes one
range. A task writes under a name of its own and reports it; only reported files enter the manifest,
so a lost or repeated task leaves no trace in it. The folder must be reachable by all executors.

Results for odd input: null and empty texts are the end id alone; null ids come first; rows that
share an id follow in order of a hash of their text, and equal rows are all written; a text is in one
row, however long; an empty table gives a manifest without files; further columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.llm.byte_tokens import ByteTokenizer
from msgflow.llm.common import own_columns, release
from msgflow.session import stage

MAGIC = int.from_bytes(b"TOKIDX01", "little")
_HEAD = 5
_ROWS = 10_000  # documents of one batch when files are read
_CRC_IDS = 1 << 20  # ids widened at once
PARTS = "part int, name string, width int, documents bigint, ids bigint"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _index(offsets: np.ndarray, doc_ids: list[int | None], width: int) -> bytes:
    head = np.array([MAGIC, width, len(doc_ids), offsets[-1], 0], "<u8")
    ids = np.array([0 if d is None else d for d in doc_ids], "<i8")
    return head.tobytes() + offsets.astype("<u8").tobytes() + ids.tobytes() + bytes(d is not None for d in doc_ids)


def grouped(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Batches joined until they hold about `size` bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(b.nbytes for b in held) + batch.nbytes > size:
            yield pa.Table.from_batches(held)
            held = []
        if batch.num_rows:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _written(folder: str, tokenizer_path: Callable[[], str], end_id: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokenizer.shared(tokenizer_path())
        kind = np.dtype("<u2" if max(tokens.vocabulary - 1, end_id) < 1 << 16 else "<u4")
        part = TaskContext.get().partitionId()
        files, root = _place(folder)
        name, sink = f"ids-{part:06d}-{uuid.uuid4().hex}", None
        lengths: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        for rows in grouped(batches, tokens.GROUP_BYTES):
            sink = sink or files.open_output_stream(f"{root}/{name}.bin")
            sizes = []
            for ids in tokens.encode(rows.column(1).combine_chunks()):
                sink.write(np.append(ids, np.uint32(end_id)).astype(kind).tobytes())
                sizes.append(len(ids) + 1)
            lengths.append(np.array(sizes, np.int64))
            doc_ids += rows.column(0).to_pylist()
            release()
        if sink is None:
            return
        sink.close()
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        with files.open_output_stream(f"{root}/{name}.idx") as index:
            index.write(_index(offsets, doc_ids, kind.itemsize))
        row = {"part": part, "name": name, "width": kind.itemsize, "documents": len(doc_ids), "ids": int(offsets[-1])}
        kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([value], k) for value, k in zip(row.values(), kinds)], names=list(row))

    return write


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: Callable[[], str], end_id: int, id_col: str = "doc_id", text_col: str = "text",
) -> list[dict]:
    """Encodes all texts and writes them to `folder` in ascending order of their id. Returns the manifest's entries.

    `tokenizer_path` is called by the tasks, as the tokenizer's file may lie elsewhere there. The
    driver sees one row per file.
    """
    rows = own_columns(docs, {"doc_id": id_col, "text": text_col})
    rows = rows.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    # The hash and the row number spread rows that share one id over several ranges.
    rows = rows.withColumns({"spot": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = ["doc_id", "spot", "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    files, root = _place(folder)
    files.create_dir(root, recursive=True)
    parts = stage(rows.mapInArrow(_written(folder, tokenizer_path, end_id), PARTS), "token-files")
    entries = [row.asDict() for row in parts.orderBy("part").collect()]
    bases = np.concatenate([[0], np.cumsum([entry["ids"] for entry in entries], dtype=np.int64)])
    for entry, base in zip(entries, bases.tolist()):
        entry["base"] = base
    named = {f"{root}/{entry['name']}.{kind}" for entry in entries for kind in ("bin", "idx")}
    for info in files.get_file_info(fs.FileSelector(root)):
        if info.base_name.startswith("ids-") and info.path not in named:  # of an attempt that did not report
            files.delete_file(info.path)
    with files.open_output_stream(f"{root}/manifest.json") as sink:
        sink.write(json.dumps({"version": 1, "files": entries}).encode())
    return entries


def read_manifest(folder: str) -> list[dict]:
    files, root = _place(folder)
    with files.open_input_file(f"{root}/manifest.json") as source:
        return json.loads(source.read())["files"]


class _Bytes:
    """Ranges of a file: memory-mapped where the file system is local, else read as asked."""

    def __init__(self, folder: str, name: str):
        files, root = _place(folder)
        local = isinstance(files, fs.LocalFileSystem)
        self.source = pa.memory_map(f"{root}/{name}") if local else files.open_input_file(f"{root}/{name}")

    def array(self, kind: str, start: int, count: int) -> np.ndarray:
        """`count` values from byte `start` on; a view of the mapped pages where there are any."""
        width = np.dtype(kind).itemsize
        return np.frombuffer(self.source.read_at(count * width, start), kind, count)


@dataclass
class TokenFile:
    """One file of the corpus; arrays are views of the mapped files."""

    ids_of: _Bytes
    width: int
    base: int
    offsets: np.ndarray
    doc_ids: np.ndarray
    given: np.ndarray

    @classmethod
    def open(cls, folder: str, name: str, base: int = 0) -> TokenFile:
        index = _Bytes(folder, f"{name}.idx")
        magic, width, documents, _, _ = (int(word) for word in index.array("<u8", 0, _HEAD))
        if magic != MAGIC:
            raise ValueError(f"{name}.idx is no index of token ids")
        start = 8 * _HEAD
        offsets = index.array("<u8", start, documents + 1)
        start += 8 * (documents + 1)
        return cls(
            _Bytes(folder, f"{name}.bin"), width, base, offsets.view(np.int64),
            index.array("<i8", start, documents), index.array("u1", start + 8 * documents, documents),
        )

    def ids(self, start: int, count: int) -> np.ndarray:
        """Ids of a range of the file."""
        return self.ids_of.array(f"<u{self.width}", start * self.width, count)

    def document(self, number: int) -> np.ndarray:
        """Ids of one of the file's documents, with the end id."""
        return self.ids(int(self.offsets[number]), int(self.offsets[number + 1] - self.offsets[number]))


class TokenCorpus:
    """Random access to all files of a folder: documents and ids by their number in the corpus."""

    def __init__(self, folder: str):
        self.folder, self.entries = folder, read_manifest(folder)
        self.bases = np.array([entry["base"] for entry in self.entries], np.int64)
        self.first_documents = np.concatenate([[0], np.cumsum([entry["documents"] for entry in self.entries], dtype=np.int64)])
        self._open: dict[int, TokenFile] = {}

    def __len__(self) -> int:
        return int(self.first_documents[-1])

    @property
    def n_ids(self) -> int:
        return int(self.bases[-1]) + self.entries[-1]["ids"] if self.entries else 0

    def _file(self, place: int) -> TokenFile:
        if place not in self._open:
            self._open[place] = TokenFile.open(self.folder, self.entries[place]["name"], int(self.bases[place]))
        return self._open[place]

    def document(self, number: int) -> np.ndarray:
        place = int(np.searchsorted(self.first_documents, number, "right")) - 1
        return self._file(place).document(number - int(self.first_documents[place]))

    def ids(self, start: int, count: int) -> np.ndarray:
        """A window of ids, which may span documents and files."""
        found, end = [np.zeros(0, np.uint32)], min(start + count, self.n_ids)
        while start < end:
            place = int(np.searchsorted(self.bases, start, "right")) - 1
            file, inside = self._file(place), start - int(self.bases[place])
            step = min(end - start, self.entries[place]["ids"] - inside)
            found.append(file.ids(inside, step).astype(np.uint32))
            start += step
        return np.concatenate(found)


def crc_of(ids: np.ndarray) -> int:
    """Checksum of ids as unsigned little-endian 32-bit integers."""
    crc = 0
    for start in range(0, len(ids), _CRC_IDS):
        crc = zlib.crc32(ids[start : start + _CRC_IDS].astype("<u4").tobytes(), crc)
    return crc


def _documents(folder: str):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in batch.to_pylist():
                file = TokenFile.open(folder, entry["name"], entry["base"])
                for start in range(0, len(file.doc_ids), _ROWS):
                    numbers = range(start, min(start + _ROWS, len(file.doc_ids)))
                    offsets = file.offsets[numbers.start : numbers.stop + 1]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.doc_ids[numbers.start : numbers.stop], mask=file.given[numbers.start : numbers.stop] == 0),
                            pa.array(offsets[:-1] + file.base), pa.array(np.diff(offsets)),
                            pa.array([crc_of(file.document(number)) for number in numbers], pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return read


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens and ids_crc32."""
    entries = [(entry["name"], entry["base"]) for entry in read_manifest(folder)]
    listed = spark.createDataFrame(entries, "name string, base bigint")
    return listed.repartition(max(1, len(entries)), "name").mapInArrow(_documents(folder), DOCUMENTS)
