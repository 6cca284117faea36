"""Token-id files: independent zstandard frames, a trailing seek table, a checksum a frame.

A file holds the ids (little-endian unsigned 32-bit) of documents in ascending doc_id order. It is laid out as the public
zstandard seekable format says, so any zstandard reader can decompress it whole:

    frame 0 .. frame n-1   each for itself, FRAME bytes of ids at most; a frame ends where a document ends, and a document
                           longer than that has frames of its own
    skippable frame        the documents: doc_id, whether it is null, number of ids; its length once more at its end
    skippable frame        the seek table: bytes compressed and raw of each frame, and the low 32 bits of its XXH64; footer

A reader takes the footer, the table and the documents' list, and then only those frames that hold what is asked for; a
frame that doesn't give its checksum is an error that names file and frame.

Documents are dealt by ranges of (doc_id, hash of the text, row), so a doc_id that many rows share is spread over files as
well. Each task writes one file under a name of its own attempt; the stored manifest names the files of the attempts that
counted, so a lost executor leaves a stray file and no wrong one. Files are written and read where the executors are, by a
filesystem client that knows the folder's scheme (local, HDFS, object stores); ids never pass the driver.

Nulls: a null text counts as empty and gives the end id alone; null ids come first. Rows of equal doc_id follow each other
by a hash of their texts, equal rows in any order. Long texts are encoded in parts and cut into many frames. An empty table
gives no rows. Columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, shared_dir, table

END = 2
#: Bytes of ids in a frame at most.
FRAME = 1 << 18
#: Magic numbers of the seekable format: skippable frames for the table and for our list, and the footer's end.
_TABLE, _LIST, _SEEKABLE = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
#: Words whose ids are kept at hand, and the longest of them; texts are split in parts of so many characters.
KNOWN, LONGEST, PART = 1 << 19, 64, 1 << 20
_LATIN, _MARKS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+"), '.,;:!?)"'
#: Marks are cut from words that end in a letter below this one (Latin, Greek, Cyrillic).
_LETTERS_END = "\u0530"
_PACKED = [struct.Struct(f"<{n}I") for n in range(7)]
#: How byte-level vocabularies write bytes: printable ones as they are, the others as the code points from 256 on.
_PRINTED = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_AS_PRINTED = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_DOCUMENT = np.dtype([("doc_id", "<i8"), ("null", "<u1"), ("n", "<i8")])


class WordEncoder(dict):
    """Ids of texts by `tokenizers`, each distinct word once: right for vocabularies that drop white space.

    There no token goes over a blank or line feed, so a text's ids are those of the pieces between them; marks that end a
    word are pieces of their own. Words of Latin letters go to the vocabulary's model at once where it proves to be one of
    lower-case UTF-8 bytes, all other words through all of the tokenizer. Words are kept at hand in two generations of
    KNOWN each, so that frequent ones stay.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.older = Tokenizer.from_file(path), {}
        self.direct = all(self._model(w) == self._all(w) for w in ("Hello", "x", "naïveté", "ÀÿÑß", "lowercasing"))

    def _model(self, word: str) -> list[int] | None:
        try:
            return [t.id for t in self.tokenizer.model.tokenize(word.lower().encode().decode("latin-1").translate(_AS_PRINTED))]
        except Exception:  # the model has no such letters
            return None

    def _all(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            stem = word.rstrip(_MARKS)
            if len(stem) < len(word) and "A" <= stem[-1:] < _LETTERS_END and stem[-1].lower().isalpha():
                ids = self[stem] + self[word[len(stem) :]]
            else:
                found = self._model(word) if self.direct and _LATIN.fullmatch(word) else self._all(word)
                ids = np.array(found, dtype="<u4").tobytes() if len(found) > 6 else _PACKED[len(found)].pack(*found)
        if len(word) <= LONGEST:
            if len(self) >= KNOWN:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def ids(self, text: str, end: int) -> bytes:
        """The ids of a text and the end id."""
        parts, at = [], 0
        while at < len(text):
            cut = text.find(" ", at + PART)
            upto = cut if cut >= 0 else len(text)
            parts.append(b"".join(map(self.__getitem__, text[at:upto].replace("\n", " ").split(" "))))
            at = upto
        return b"".join([*parts, _PACKED[1].pack(end)])


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of a vocabulary file, made once a process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


class Writer:
    """Writes one file to a stream, document by document."""

    def __init__(self, stream, frame: int = FRAME):
        self.stream, self.frame, self.held, self.frames, self.documents = stream, frame, bytearray(), [], []
        self.zstd = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def _flush(self, raw: bytes) -> None:
        packed = self.zstd.compress(raw)
        self.stream.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.documents.append((doc_id or 0, doc_id is None, len(ids) // 4))
        if self.held and len(self.held) + len(ids) > self.frame:
            self._flush(bytes(self.held))
            self.held.clear()
        self.held += ids
        while len(self.held) > self.frame:
            self._flush(bytes(self.held[: self.frame]))
            del self.held[: self.frame]

    def close(self) -> None:
        if self.held:
            self._flush(bytes(self.held))
        listed = self.zstd.compress(np.array(self.documents, dtype=_DOCUMENT).tobytes())
        self.stream.write(_skippable(_LIST, listed + struct.pack("<I", len(listed))))
        entries = np.array(self.frames, dtype="<u4").reshape(-1, 3).tobytes()
        self.stream.write(_skippable(_TABLE, entries + struct.pack("<IBI", len(self.frames), 0x80, _SEEKABLE)))


class Reader:
    """Reads one file from a seekable stream; `name` is for messages, `decompressed` counts the frames taken."""

    def __init__(self, stream, name: str = "file"):
        self.stream, self.name, self.decompressed, self._last = stream, name, 0, (-1, b"")
        self.zstd = zstandard.ZstdDecompressor()
        size = stream.seek(0, 2)
        n, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9)) if size >= 17 else (0, 0, 0)
        begin = size - 17 - 12 * n
        if magic != _SEEKABLE or descriptor != 0x80 or begin < 0 or self._at(begin, 8) != struct.pack("<II", _TABLE, 12 * n + 9):
            raise ValueError(f"{name} has no seek table")
        entries = np.frombuffer(self._at(begin + 8, 12 * n), dtype="<u4").reshape(-1, 3).astype(np.int64)
        self.sums, self.sizes = entries[:, 2], entries[:, :2]
        self.places = np.concatenate([[[0, 0]], np.cumsum(self.sizes, axis=0)])  # where each frame begins, packed and raw
        (length,) = struct.unpack("<I", self._at(begin - 4, 4))
        listed = self.zstd.decompress(self._at(begin - 4 - length, length))
        self.documents = np.frombuffer(listed, dtype=_DOCUMENT)
        self.starts = np.concatenate([[0], np.cumsum(self.documents["n"])])

    def _at(self, place: int, n: int) -> bytes:
        self.stream.seek(place)
        return self.stream.read(n)

    def _frame(self, k: int) -> bytes:
        if self._last[0] != k:
            try:
                raw = self.zstd.decompress(self._at(int(self.places[k, 0]), int(self.sizes[k, 0])), max_output_size=int(self.sizes[k, 1]))
            except zstandard.ZstdError as e:
                raise ValueError(f"{self.name}: frame {k} is damaged") from e
            if len(raw) != self.sizes[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
                raise ValueError(f"{self.name}: frame {k} is damaged")
            self.decompressed += 1
            self._last = (k, raw)
        return self._last[1]

    def ids(self, k: int) -> Iterator[bytes]:
        """The ids of the k-th document, a piece for each frame that holds some."""
        at, end = 4 * int(self.starts[k]), 4 * int(self.starts[k + 1])
        frame = int(np.searchsorted(self.places[:, 1], at, side="right")) - 1
        while at < end:
            begin = int(self.places[frame, 1])
            piece = self._frame(frame)[at - begin : end - begin]
            yield piece
            at, frame = at + len(piece), frame + 1


def _opened(path: str):
    """The filesystem client of a qualified path, and the path on it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


MANIFEST = "part int, file string, n_documents long, n_tokens long"


def write_files(docs: DataFrame, folder: str | None = None, path: str | None = None, end: int = END, frame: int = FRAME) -> DataFrame:
    """Encode all documents and write them to files in `folder` (by default a new one in the shared folder).

    path: the vocabulary. Gives the stored manifest: part (its order is that of the doc_ids), file, n_documents, n_tokens.
    """
    import public_tokenizers

    spark = docs.sparkSession
    vocabulary = path or public_tokenizers.path("word_bpe_49k.json")
    where = spark._jvm.org.apache.hadoop.fs.Path(folder or f"{shared_dir(spark)}/kinweave-tokens-{uuid.uuid4().hex}")
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(where)
    base = system.makeQualified(where).toString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, n, ids_of = TaskContext.get().partitionId(), None, 0, encoder(vocabulary)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                if made is None:
                    client, place = _opened(f"{base}/part-{part:05d}-{uuid.uuid4().hex}.ids.zst")
                    made = Writer(client.open_output_stream(place, compression=None), frame)
                ids = ids_of.ids(text.as_py(), end)
                made.add(doc_id, ids)
                n += len(ids) // 4
        if made is not None:
            made.close()
            made.stream.close()
            row = [[part], [f"{base}/{place.rpartition('/')[2]}"], [len(made.documents)], [n]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=[c.split()[0] for c in MANIFEST.split(", ")])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("row")]
    n_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n_partitions, *order).sortWithinPartitions(*order)
    return materialize(dealt.select("doc_id", "text").mapInArrow(write, MANIFEST), "token-manifest")


DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_files(manifest: DataFrame, wanted: list[int] | None = None, with_ids: bool = False) -> DataFrame:
    """The documents of the files, from the files: doc_id, start (ids before it in all files), n_tokens, ids_crc32, and ids.

    wanted: only the documents of these doc_ids, of which only the frames are decompressed. Each file is one row and is
    read frame by frame.
    """
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row a file
    files = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    chosen = None if wanted is None else np.unique(np.array(wanted, dtype=np.int64))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, begin in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
                client, place = _opened(name)
                with client.open_input_file(place) as stream:
                    file = Reader(stream, name)
                    which = np.arange(len(file.documents))
                    if chosen is not None:
                        which = which[np.isin(file.documents["doc_id"], chosen) & (file.documents["null"] == 0)]
                    for some in np.array_split(which, max(1, len(which) // 4096)):
                        yield _document_batch(file, some, begin, with_ids)

    schema = DOCUMENTS + (", ids binary" if with_ids else "")
    n_partitions = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("part", "file", "before").repartition(n_partitions, "part").mapInArrow(read, schema)


def _document_batch(file: Reader, which: np.ndarray, begin: int, with_ids: bool) -> pa.RecordBatch:
    sums, ids = [], []
    for k in which:
        crc, pieces = 0, []
        for piece in file.ids(k):
            crc = zlib.crc32(piece, crc)
            if with_ids:
                pieces.append(piece)
        sums.append(crc)
        ids.append(b"".join(pieces))
    own = file.documents[which]
    columns = [pa.array(own["doc_id"], mask=own["null"] == 1), pa.array(file.starts[:-1][which] + begin), pa.array(own["n"]), pa.array(sums, pa.int64())]
    names = [c.split()[0] for c in DOCUMENTS.split(", ")]
    return pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())] if with_ids else columns, names=[*names, "ids"] if with_ids else names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_files(write_files(table(spark, sf_dir, "documents")))
