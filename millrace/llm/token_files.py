"""Token-ID output: independent zstandard frames, a seek table, checksums.

A file holds frames of about 1 MB of little-endian unsigned 32-bit ids, each
with documents whole; then a skippable frame with the document index; last the
seek table of the public seekable format: per frame its compressed size, its
plain size and the low 32 bits of the XXH64 of its content.  A reader takes
the tail, picks the frames of the wanted documents and decompresses only
those.

Documents stand in ascending id order across the files (null ids first, equal
ids by hash of the text; repeated rows stand side by side).  A null text is
empty; every document ends with the end id, so none is without ids.  A long
text is one run and one frame of its own.  An empty table gives no files.
Other columns, whatever their names, are not read.  Executors write to the shared folder under a
name of the attempt and then rename, so a task that runs again leaves the same
file.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kernels import KEPT, SPACE, text_chunks, trim
from .scratch import new_path, stored

FRAME_IDS = 1 << 18
INDEX_MAGIC, TABLE_MAGIC, TABLE_FOOT = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: Pieces of text whose ids an encoder keeps, and bytes of text that it takes at a time.
CACHED_PIECES, RUN_BYTES = 400_000, 1 << 20

#: UTF-8 of white space beyond ASCII, and ASCII separators that some engines call white space.
_ODD = tuple(chr(c).encode() for c in (0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
_IS_SPACE, _IS_ALNUM, _IS_PUNCT, _IS_LEAD = 1, 2, 4, 8


def _byte_classes() -> np.ndarray:
    classes = np.zeros(256, np.uint8)
    classes[SPACE] = _IS_SPACE
    classes[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = _IS_ALNUM
    classes[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = _IS_PUNCT
    classes[sorted({x[0] for x in _ODD})] |= _IS_LEAD
    return classes


_CLASS = _byte_classes()


class Encoder:
    """Encodes whole texts by the pieces between boundaries that no token of the byte-level pattern crosses.

    Such boundaries are before a single space or line feed between
    non-spaces, after that line feed, and between an ASCII letter or digit and
    ASCII punctuation.  Each distinct piece is encoded once by the tokenizers
    library.  Texts with white space beyond ASCII are encoded as one piece.

    With ``added``, the text of an added token becomes that token, as by the
    library's default, and texts that hold one are one piece; else it is
    encoded as plain text.
    """

    def __init__(self, path: str, added: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        tokens = self.tokenizer.get_added_tokens_decoder().values() if added else ()
        self.added = tuple(t.content.encode() for t in tokens)
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if len(feed) == 1 else None
        # Pieces that line feeds beside them leave as they are: no line feed inside, no added token, and at the ends no
        # white space but one space before other text.
        barred = "".join(f"(?!.*{re.escape(t.content)})" for t in tokens)
        self.between = re.compile(barred + r" ?(?![\s\x1c-\x1f]).*(?<![\s\x1c-\x1f])").fullmatch
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, "<u4")
        self.ends = np.zeros(1, np.int64)

    def _keep(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Note the ids of new pieces."""
        had = int(self.ends[-1])
        while len(self.ids) < had + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[had : had + len(ids)] = ids
        self.slot.update(zip(pieces, range(len(self.ends) - 1, len(self.ends) - 1 + len(pieces))))
        self.ends = np.append(self.ends, had + np.cumsum(sizes))

    def _apart(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and how many each has; every piece is a text of its own."""
        found = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.concatenate(found), np.array([len(x) for x in found], np.int64)

    def _joined(self, pieces: list[str], together: int = 300) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`_apart`, of pieces that a line feed can stand between without touching their tokens."""
        texts = ["\n".join(pieces[a : a + together]) + "\n" for a in range(0, len(pieces), together)]
        flat = np.concatenate([np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        feeds = flat == self.feed
        ends = np.flatnonzero(feeds)
        if len(ends) != len(pieces):
            return self._apart(pieces)
        return flat[~feeds], np.diff(ends, prepend=-1) - 1

    def _slots(self, pieces: list[str]) -> np.ndarray:
        """Where the ids of the pieces are kept; unknown ones are encoded."""
        slots = np.array([self.slot.get(p, -1) for p in pieces], np.int64)
        missing = np.flatnonzero(slots < 0)
        if len(self.slot) + len(missing) > CACHED_PIECES and len(self.slot):
            known = np.flatnonzero(slots >= 0)  # the pieces of this run are those of the next ones, too
            sizes = self.ends[slots[known] + 1] - self.ends[slots[known]]
            ids = self.ids[_ranges(self.ends[slots[known]], sizes)]
            self._forget()
            self._keep([pieces[i] for i in known], ids, sizes)
            slots[known] = np.arange(len(known))
        new = [pieces[i] for i in missing]
        apart = [p for p in new if self.feed is None or not self.between(p)]
        alone = set(apart)
        joined = [p for p in new if p not in alone] if alone else new
        for part, encode in ((joined, self._joined), (apart, self._apart)):
            for a in range(0, len(part), 6000):
                self._keep(part[a : a + 6000], *encode(part[a : a + 6000]))
        slots[missing] = [self.slot[p] for p in new]
        return slots

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether a piece begins at each byte."""
        kind = _CLASS[data]
        solid = (kind & _IS_SPACE) == 0
        inner = np.zeros(len(data), bool)
        inner[1:-1] = solid[:-2] & solid[2:]
        line = inner & (data == 0x0A)
        cut = (inner & (data == 0x20)) | line
        cut[1:] |= line[:-1]
        cut[1:] |= (kind[1:] == _IS_PUNCT) & (kind[:-1] == _IS_ALNUM)
        raw = data.tobytes()
        odd = [at for at in np.flatnonzero(kind & _IS_LEAD).tolist() if raw.startswith(_ODD, at)]
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                odd.append(at)
                at = raw.find(token, at + 1)
        for row in set((np.searchsorted(offsets, odd, "right") - 1).tolist()):
            cut[offsets[row] : offsets[row + 1]] = False
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        return cut

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and where each row's ids begin."""
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        starts = np.flatnonzero(self._cuts(data, offsets))
        bounds = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data)).dictionary_encode()
        slots = self._slots(pieces.dictionary.to_pylist())[pieces.indices.to_numpy()]
        begin = self.ends[slots]
        size = self.ends[slots + 1] - begin
        before = np.append(0, np.cumsum(size))
        return self.ids[_ranges(begin, size)], before[np.searchsorted(starts, offsets)]


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of runs, one run after another."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


_encoders: dict[tuple[str, bool], Encoder] = {}
KEPT.append(_encoders)


def encoder(path: str, added: bool = False) -> Encoder:
    """One encoder per worker process, vocabulary file and treatment of added tokens, until :func:`kernels.let_go`."""
    if (path, added) not in _encoders:
        _encoders[path, added] = Encoder(path, added)
    return _encoders[path, added]


class Writer:
    """Writes one file."""

    def __init__(self, out) -> None:
        self.out, self.table, self.rows, self.held, self.count = out, [], [], [], 0
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.rows.append((doc_id is not None, doc_id or 0, len(ids)))
        self.held.append(ids.astype("<u4", copy=False).tobytes())
        self.count += len(ids)
        if self.count >= FRAME_IDS:
            self._frame()

    def _frame(self) -> None:
        if self.held:
            plain = b"".join(self.held)
            packed = self.packer.compress(plain)
            self.out.write(packed)
            self.table.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
            self.held, self.count = [], 0

    def close(self) -> int:
        self._frame()
        index = np.array(self.rows, [("valid", "?"), ("doc_id", "<i8"), ("n_tokens", "<u4")]).tobytes()
        packed = self.packer.compress(index)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(packed) + 4) + packed + struct.pack("<I", len(packed)))
        table = b"".join(struct.pack("<III", *x) for x in self.table) + struct.pack("<IBI", len(self.table), 0x80, TABLE_FOOT)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)
        return len(self.rows)


class Reader:
    """Reads one file; only the frames of the documents asked for are decompressed."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        source.seek(size - 9)
        frames, flags, foot = struct.unpack("<IBI", source.read(9))
        if foot != TABLE_FOOT or flags != 0x80:
            raise ValueError("no seek table")
        at = size - 17 - 12 * frames
        source.seek(at)
        magic, _ = struct.unpack("<II", source.read(8))
        if magic != TABLE_MAGIC:
            raise ValueError("no seek table")
        self.table = np.frombuffer(source.read(12 * frames), "<u4").reshape(-1, 3)
        source.seek(at - 4)
        (length,) = struct.unpack("<I", source.read(4))
        source.seek(at - 4 - length)
        self.rows = np.frombuffer(zstandard.ZstdDecompressor().decompress(source.read(length)), [("valid", "?"), ("doc_id", "<i8"), ("n_tokens", "<u4")])
        self.starts = np.append(0, np.cumsum(self.rows["n_tokens"].astype(np.int64)))
        self.packed_at = np.append(0, np.cumsum(self.table[:, 0].astype(np.int64)))
        self.plain_at = np.append(0, np.cumsum(self.table[:, 1].astype(np.int64))) // 4
        self.held: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def frame(self, k: int) -> np.ndarray:
        if self.held[0] != k:
            self.source.seek(int(self.packed_at[k]))
            plain = zstandard.ZstdDecompressor().decompress(self.source.read(int(self.table[k, 0])), max_output_size=int(self.table[k, 1]))
            if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.table[k, 2]:
                raise ValueError(f"frame {k} is damaged")
            self.held = (k, np.frombuffer(plain, "<u4"))
        return self.held[1]

    def ids(self, row: int) -> np.ndarray:
        k = int(np.searchsorted(self.plain_at, self.starts[row], "right")) - 1
        ids = self.frame(k)
        a = int(self.starts[row] - self.plain_at[k])
        return ids[a : a + int(self.rows["n_tokens"][row])]


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _write(folder: str, vocabulary: str, end_id: int, added: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        files, base = opened(folder)
        writer, tokens, name = None, 0, f"part-{part:06d}.ids.zst"
        temp = f"{base}/.{name}.{uuid.uuid4().hex}"
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, _, data, offsets in text_chunks(batch.column(1), RUN_BYTES):
                if writer is None:
                    files.create_dir(base, recursive=True)
                    writer = Writer(files.open_output_stream(temp))
                flat, at = encoder(vocabulary, added).encode(data, offsets)
                for i, (a, b) in enumerate(zip(at[:-1], at[1:]), first):
                    writer.add(ids[i], np.append(flat[a:b], np.uint32(end_id)))
                    tokens += int(b - a) + 1
            trim()
        if writer is not None:
            docs = writer.close()
            writer.out.close()
            files.move(temp, f"{base}/{name}")
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [f"{folder}/{name}"], "docs": [docs], "tokens": [tokens]}, pa.schema([("part", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]))

    return run


def write_token_files(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 0, text: str = "text", key: str = "doc_id", added: bool = False) -> DataFrame:
    """Write ``docs`` to ``folder`` (an URI all executors reach); the manifest: ``part, path, docs, tokens``."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    return stored(ordered.mapInArrow(_write(folder, vocabulary, end_id, added), "part int, path string, docs long, tokens long"), "manifest", texts=True)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            files, name = opened(path)
            with files.open_input_file(name) as source:
                reader = Reader(source)
                for a in range(0, len(reader.rows), 20_000):
                    rows = reader.rows[a : a + 20_000]
                    sums = [zlib.crc32(reader.ids(i).tobytes()) for i in range(a, a + len(rows))]
                    yield pa.RecordBatch.from_arrays([pa.array(rows["doc_id"], mask=~rows["valid"]), pa.array(base + reader.starts[a : a + len(rows)]), pa.array(rows["n_tokens"].astype(np.int64)), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Read all files of a manifest: ``doc_id, start, n_tokens, ids_crc32``."""
    files = max(1, manifest.count())
    before = F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")  # one row per file
    return manifest.select("path", before.alias("base"), "part").repartitionByRange(files, "part").select("path", "base").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(path: str, doc_ids: Iterable[int]) -> dict[int, np.ndarray]:
    """The ids of some documents of one file."""
    wanted = set(doc_ids)
    files, name = opened(path)
    with files.open_input_file(name) as source:
        reader = Reader(source)
        return {int(r["doc_id"]): reader.ids(i) for i, r in enumerate(reader.rows) if r["valid"] and int(r["doc_id"]) in wanted}


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 0, text: str = "text", key: str = "doc_id", added: bool = False) -> DataFrame:
    """Write ``docs`` to a scratch folder and read the files back."""
    folder = new_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, vocabulary, folder, end_id, text, key, added))
