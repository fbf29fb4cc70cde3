"""Token ids in seekable files.

A file is a row of independent zstandard frames, each holding the ids (little-endian
unsigned 32-bit) of some whole documents; then a skippable frame with the documents'
index; then the seek table of the public seekable format: compressed size,
decompressed size and checksum of every frame before it. A reader takes the end of a
file, finds the frames of the documents it wants, and decompresses those alone.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.bpe import PieceCache, encode_texts
from tickloom.llm.common import ship_code, stored
from tickloom.session import scratch_path

#: Fixed values of the seekable format.
SKIPPABLE, INDEX_MAGIC, FOOTER_MAGIC, CHECKSUM_FLAG = 0x184D2A5E, 0x184D2A5D, 0x8F92EAB1, 0x80
FOOTER, ENTRY, HEADER = struct.Struct("<IBI"), struct.Struct("<III"), struct.Struct("<II")

#: A frame is closed once it has this many ids.
FRAME_IDS = 65_536
LEVEL = 3
#: Pre-tokens given to the tokenizer at once.
CALL_PIECES = 512
#: Files are read by this many tasks at most.
READ_TASKS = 10_000


def checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class SeekableWriter:
    """Writes one file. ``add`` takes a document's ids, ``close`` the index."""

    def __init__(self, out):
        self.out, self.entries = out, []
        self.doc_ids, self.counts, self.frames = [], [], []
        self.open: list[np.ndarray] = []
        self.open_ids = 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))
        self.frames.append(len(self.entries))
        self.open.append(ids)
        self.open_ids += len(ids)
        if self.open_ids >= FRAME_IDS:
            self._frame()

    def _frame(self) -> None:
        raw = np.concatenate(self.open).astype("<u4").tobytes()
        packed = self.packer.compress(raw)
        self.out.write(packed)
        self.entries.append((len(packed), len(raw), checksum(raw)))
        self.open, self.open_ids = [], 0

    def close(self) -> None:
        if self.open:
            self._frame()
        known = np.array([x is not None for x in self.doc_ids], np.uint8)
        numbers = np.array([x or 0 for x in self.doc_ids], "<i8")
        index = b"".join(
            (known.tobytes(), numbers.tobytes(), np.array(self.counts, "<u4").tobytes(),
             np.array(self.frames, "<u4").tobytes())
        )
        packed = self.packer.compress(index)
        self.out.write(HEADER.pack(INDEX_MAGIC, len(packed)))
        self.out.write(packed)
        self.entries.append((len(packed) + HEADER.size, 0, checksum(packed)))
        table = b"".join(ENTRY.pack(*e) for e in self.entries)
        table += FOOTER.pack(len(self.entries), CHECKSUM_FLAG, FOOTER_MAGIC)
        self.out.write(HEADER.pack(SKIPPABLE, len(table)))
        self.out.write(table)


class SeekableReader:
    """Reads one file; ``document`` decompresses its frame alone."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        count, flags, magic = FOOTER.unpack(self._at(end - FOOTER.size, FOOTER.size))
        if magic != FOOTER_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a seekable token file")
        table = self._at(end - FOOTER.size - count * ENTRY.size, count * ENTRY.size)
        self.entries = list(ENTRY.iter_unpack(table))
        sizes = np.array([e[0] for e in self.entries], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        packed = self._at(int(self.starts[-1]) + HEADER.size, self.entries[-1][0] - HEADER.size)
        if checksum(packed) != self.entries[-1][2]:
            raise ValueError("the index of a token file is damaged")
        index = zstandard.decompress(packed)
        n = len(index) // 17
        self.known = np.frombuffer(index, np.uint8, n)
        self.doc_ids = np.frombuffer(index, "<i8", n, n)
        self.counts = np.frombuffer(index, "<u4", n, 9 * n).astype(np.int64)
        self.frames = np.frombuffer(index, "<u4", n, 13 * n)
        self.first = np.cumsum(self.counts) - self.counts
        # Where each frame begins, in ids of the file.
        ids = np.array([e[1] for e in self.entries[:-1]], np.int64) // 4
        self.frame_first = np.cumsum(ids) - ids
        self.last: tuple[int, np.ndarray] = (-1, np.empty(0, np.uint32))

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def frame(self, k: int) -> np.ndarray:
        if self.last[0] != k:
            size, raw_size, wanted = self.entries[k]
            raw = zstandard.decompress(self._at(int(self.starts[k]), size), max_output_size=raw_size)
            if len(raw) != raw_size or checksum(raw) != wanted:
                raise ValueError(f"frame {k} of a token file is damaged")
            self.last = (k, np.frombuffer(raw, "<u4"))
        return self.last[1]

    def document(self, i: int) -> np.ndarray:
        k = int(self.frames[i])
        start = int(self.first[i] - self.frame_first[k])
        return self.frame(k)[start : start + int(self.counts[i])]


class Vocabulary:
    """Ids of whole texts as the library's plain call gives them."""

    def __init__(self, tokenizer, added: list[str], pieces: PieceCache):
        self.tokenizer, self.added, self.pieces = tokenizer, added, pieces

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order.

        Added strings are found before a text is split into pre-tokens, so texts that
        hold one bypass the cache of pre-tokens.
        """
        plain: list[str] = []
        for text in texts:
            if not any(a in text for a in self.added):
                plain.append(text)
                continue
            yield from self._cached(plain)
            plain = []
            yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        yield from self._cached(plain)

    def _cached(self, texts: list[str]) -> Iterator[np.ndarray]:
        for ids, counts in encode_texts(texts, self.pieces):
            stops = np.cumsum(counts)
            for n, stop in zip(counts.tolist(), stops.tolist()):
                yield ids[stop - n : stop]


@cache
def load_tokenizer(path: str) -> Vocabulary:
    """The vocabulary behind a cache of pre-tokens; one per worker process.

    A pre-token by itself is split as inside its text, so only new ones are encoded.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    # Texts that hold one of these are given to the library whole.
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # Words behind a space stay apart when joined, so many take one call.
        words = np.array([p[0] == " " and p[1:].isalpha() for p in pieces], bool)
        counts = np.zeros(len(pieces), np.int64)
        owners, found = [], []
        plain = np.flatnonzero(words)
        for at in range(0, len(plain), CALL_PIECES):
            some = plain[at : at + CALL_PIECES]
            result = tokenizer.encode("".join(pieces[i] for i in some), add_special_tokens=False)
            own = np.array(result.word_ids, np.int64)
            if own[-1] + 1 != len(some):
                raise ValueError("the tokenizer does not split as its words suggest")
            owners.append(some[own])
            found.append(np.array(result.ids, np.uint32))
        for i in np.flatnonzero(~words):
            ids = tokenizer.encode(pieces[i], add_special_tokens=False).ids
            owners.append(np.full(len(ids), i))
            found.append(np.array(ids, np.uint32))
        owner = np.concatenate(owners)
        np.add.at(counts, owner, 1)
        return np.concatenate(found)[np.argsort(owner, kind="stable")], counts

    return Vocabulary(tokenizer, added, PieceCache(encode))


MANIFEST = "part int, path string, documents bigint, n_ids bigint, bytes bigint"
MANIFEST_ARROW = pa.schema(
    {"part": pa.int32(), "path": pa.string(), "documents": pa.int64(), "n_ids": pa.int64(), "bytes": pa.int64()}
)


def write_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    path: str | None = None,
    row_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encodes whole texts and writes them in ascending id order; returns the manifest.

    Ids are those of the library's plain call: strings of added tokens count as such.
    A task writes one file under a name of its own, and only files of finished tasks
    come into the manifest, so repeated or lost tasks do no harm. Null text is empty;
    every document ends with ``end_id``. A null id sorts first; equal ids keep an
    order by their text. An empty table gives an empty manifest. The manifest has
    ``first``: the number of ids in the files before.
    """
    ship_code(docs.sparkSession)
    path = path or scratch_path(docs.sparkSession, "token_files")
    rows = docs.select(
        F.col(row_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_tokenizer(tokenizer_path)
        system, folder = pyarrow.fs.FileSystem.from_uri(path)
        name, writer, out = "", None, None
        end = np.array([end_id], np.uint32)
        for batch in batches:
            if writer is None and batch.num_rows:
                system.create_dir(folder, recursive=True)
                name = f"{uuid.uuid4().hex}.ids.zst"
                out = system.open_output_stream(f"{folder}/{name}", compression=None)
                writer = SeekableWriter(out)
            texts = vocabulary.encode(batch.column(1).to_pylist())
            for number, ids in zip(batch.column(0).to_pylist(), texts):
                writer.add(number, np.concatenate((ids, end)))
        if writer is not None:
            writer.close()
            size = out.tell()
            out.close()
            row = {
                "part": TaskContext.get().partitionId(),
                "path": f"{path}/{name}",
                "documents": len(writer.counts),
                "n_ids": sum(writer.counts),
                "bytes": size,
            }
            yield pa.RecordBatch.from_pylist([row], MANIFEST_ARROW)

    manifest = stored(ordered.mapInArrow(write, MANIFEST), "manifest")
    # One row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_documents(manifest: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """Documents (doc_id, start, n_ids, ids) of the files, all or those wanted.

    ``start`` counts the ids of all documents before. Only frames that hold a wanted
    document are decompressed; a damaged frame or index raises.
    """
    ship_code(manifest.sparkSession)
    schema = "doc_id bigint, start bigint, n_ids bigint, ids binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(*(c.to_pylist() for c in batch.columns)):
                system, file = pyarrow.fs.FileSystem.from_uri(path)
                with system.open_input_file(file) as source:
                    reader = SeekableReader(source)
                    chosen = np.arange(len(reader.counts))
                    if wanted is not None:
                        chosen = chosen[np.isin(reader.doc_ids, wanted) & (reader.known == 1)]
                    for at in range(0, len(chosen), 512):
                        some = chosen[at : at + 512]
                        texts = [reader.document(int(i)).tobytes() for i in some]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(reader.doc_ids[some], pa.int64(), mask=reader.known[some] == 0),
                                pa.array(first + reader.first[some], pa.int64()),
                                pa.array(reader.counts[some], pa.int64()),
                                pa.array(texts, pa.binary()),
                            ],
                            ["doc_id", "start", "n_ids", "ids"],
                        )

    files = manifest.select("path", "first")
    # A number of its own keeps adaptive execution from merging these few small rows
    # into one task that would read all files.
    tasks = min(max(files.count(), 1), READ_TASKS)
    return files.repartition(tasks, "path").mapInArrow(read, schema)
