"""Token ids in binary files of independent zstandard frames.

A file holds documents in ascending doc_id. A document's ids, as little-endian unsigned integers of 16 or
32 bits, are one zstandard frame, or several if it has more than ``FRAME_IDS`` ids. After the frames come
two skippable frames: the directory (for each document its id, a null flag and its number of frames) and
the seek table of the public "zstd seekable format": compressed size, decompressed size and the low 32
bits of XXH64 of the decompressed bytes for each frame, then the number of frames, a flag byte and a magic
number. Any zstandard tool can decompress a whole file; a reader that wants some documents reads the two
tables at the end and only those documents' frames, and checks their checksums.

Texts are encoded where they are read; compressed frames are shuffled by range of doc_id, not texts.
A range is one file. Tasks write files under names of their own and report them in a manifest, which Spark
commits, so files of lost or repeated tasks are never read.

Defined results: a null or empty text is the end id alone. Rows of equal doc_id follow each other, ordered
by their ids' bytes; null doc_ids come first. An empty table gives a folder with an empty manifest and
reads as an empty table. Columns other than the id and the text are not written.
"""

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlark.llm.ranges import with_ranges
from ledgerlark.llm.textbytes import pieces

END_ID = 1
FRAME_IDS = 1 << 20
#: Documents of one file, about.
FILE_ROWS = 8192
#: Words whose ids a task remembers, besides those of one text.
REMEMBERED = 250_000
LEVEL = 3

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
DIRECTORY = 0x184D2A50
SEEKABLE = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
PLACE = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("frames", "<u4")])


#: Rules of a tokenizer file under which a text's ids are those of its words in a row. Fixed values.
LETTERS_NUMBERS_SIGNS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
BY_WORD = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": LETTERS_NUMBERS_SIGNS}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
#: Words that those rules leave as they are but for their case: printable ASCII without digits and apostrophes,
#: and letters of Latin scripts in one code point. They are cut between letters and other characters.
_LATIN = "À-ÖØ-öø-įı-ɏ"
_PLAIN = re.compile(f"[!-&(-/:-~{_LATIN}]+")
_PARTS = re.compile(f"[a-z{_LATIN}]+|[^a-z{_LATIN}]+")


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in vocabularies on bytes: itself if it can be printed, else
    the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


_BYTES = _byte_letters()


class WordIds(dict):
    """The ids, as bytes, of texts; of words, which are remembered, if the tokenizer's rules allow that.

    Under ``BY_WORD`` a text's ids are those of its words between white space. Spaces and line breaks are
    cut at, other white space stays inside a word. Plain words go straight to the tokenizer's model, all
    others (and what may hold a special token) through all of its steps. A tokenizer with other rules gets
    whole texts.
    """

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self._whole = any(rules.get(part) != wanted for part, wanted in BY_WORD.items())
        self._tokenizer, self._dtype, self._kind = Tokenizer.from_file(path), dtype, "H" if dtype == "<u2" else "I"
        self._model = self._tokenizer.model.tokenize

    def _encoded(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, self._dtype).tobytes()

    def __missing__(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word) and "<|" not in word:
            parts = _PARTS.findall(word.lower())
            if not word.isascii():
                parts = [p.encode().decode("latin-1").translate(_BYTES) for p in parts]
            ids = array(self._kind, [t.id for part in parts for t in self._model(part)]).tobytes()
        else:
            ids = self._encoded(word)
        self[word] = ids
        return ids

    def texts(self, texts: list[str]) -> list[bytes]:
        end, ids_of, found = np.array([END_ID], self._dtype).tobytes(), self.__getitem__, []
        for text in texts:
            if self._whole:
                found.append(self._encoded(text) + end)
                continue
            if len(self) > REMEMBERED:
                self.clear()
            found.append(b"".join(map(ids_of, text.replace("\n", " ").split(" "))) + end)
        return found


def encode(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", wide: bool = False) -> DataFrame:
    """Rows ``doc_id``, ``n_tokens``, ``entries`` (of the seek table) and ``frames``; ids of 32 bits if
    ``wide``, which a vocabulary beyond 65,536 needs."""
    dtype = "<u4" if wide else "<u2"

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids = WordIds(tokenizer, dtype)
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        step = FRAME_IDS * np.dtype(dtype).itemsize
        for batch in pieces(batches):
            counts, entries, frames = [], [], []
            for whole in ids.texts([t or "" for t in batch.column("text").to_pylist()]):
                parts = [whole[i : i + step] for i in range(0, len(whole), step)]
                small = [compress(p) for p in parts]
                table = [(len(s), len(p), xxhash.xxh64_intdigest(p) & 0xFFFFFFFF) for s, p in zip(small, parts)]
                counts.append(len(whole) // np.dtype(dtype).itemsize)
                entries.append(np.array(table, ENTRY).tobytes())
                frames.append(b"".join(small))
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(entries, pa.binary()), pa.array(frames, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "entries", "frames"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(packed, "doc_id long, n_tokens long, entries binary, frames binary")


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _skippable(magic: int, content: bytes) -> bytes:
    return np.array([magic, len(content)], "<u4").tobytes() + content


def write(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", wide: bool = False) -> DataFrame:
    """Writes the files and the manifest to the new folder ``path``, a path or URI that all executors
    reach, and returns the manifest: one row per file."""
    ranged = with_ranges(encode(docs, tokenizer, doc_id, wide), docs.select(F.col(doc_id).alias("doc_id")), "doc_id", FILE_ROWS)
    dealt = ranged.repartition("_range").sortWithinPartitions("_range", "doc_id", "entries", "frames")

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _folder(f"{path}/files")
        store.create_dir(folder, recursive=True)
        now, out, places, entries, tokens = None, None, [], [], 0

        def closed() -> pa.RecordBatch:
            out.write(_skippable(DIRECTORY, np.array(places, PLACE).tobytes()))
            seek = b"".join(entries)
            tail = np.array([len(seek) // ENTRY.itemsize], "<u4").tobytes() + bytes([CHECKSUM_FLAG])
            out.write(_skippable(SKIPPABLE, seek + tail + np.array([SEEKABLE], "<u4").tobytes()))
            out.close()
            found = {"range": [now], "file": [name], "n_docs": [len(places)], "n_tokens": [tokens], "wide": [wide]}
            return pa.RecordBatch.from_pydict(found, pa.schema([("range", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("wide", pa.bool_())]))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("_range", "doc_id", "n_tokens", "entries", "frames"))
            for at, doc, n, table, frames in zip(*columns):
                if at != now:
                    if out is not None:
                        yield closed()
                    now, places, entries, tokens = at, [], [], 0
                    name = f"{at:06d}-{uuid.uuid4().hex}.zst"
                    out = store.open_output_stream(f"{folder}/{name}", compression=None)
                places.append((doc or 0, doc is None, len(table) // ENTRY.itemsize))
                entries.append(table)
                tokens += n
                out.write(frames)
        if out is not None:
            yield closed()

    manifest = dealt.mapInArrow(files, "range int, file string, n_docs long, n_tokens long, wide boolean")
    manifest.write.parquet(f"{path}/manifest")
    return docs.sparkSession.read.parquet(f"{path}/manifest")


class TokenFile:
    """One open file; only the tables at its end are read until documents are asked for."""

    def __init__(self, path: str, wide: bool = False):
        store, name = _folder(path)
        self._in, self._dtype = store.open_input_file(name), "<u4" if wide else "<u2"
        size = self._in.size()
        tail = self._read(size - 9, 9)
        count = int(np.frombuffer(tail[:4], "<u4")[0])
        if np.frombuffer(tail[5:], "<u4")[0] != SEEKABLE or tail[4] != CHECKSUM_FLAG:
            raise ValueError(f"{path}: no seek table with checksums")
        at = size - 9 - count * ENTRY.itemsize
        self.entries = np.frombuffer(self._read(at, count * ENTRY.itemsize), ENTRY)
        self._begins = np.concatenate(([0], np.cumsum(self.entries["packed"], dtype=np.int64)))
        head = np.frombuffer(self._read(int(self._begins[-1]), 8), "<u4")
        if head[0] != DIRECTORY:
            raise ValueError(f"{path}: no directory of documents")
        self.places = np.frombuffer(self._read(int(self._begins[-1]) + 8, int(head[1])), PLACE)
        self._first = np.concatenate(([0], np.cumsum(self.places["frames"], dtype=np.int64)))
        self._decompress = zstandard.ZstdDecompressor().decompress

    def _read(self, at: int, size: int) -> bytes:
        self._in.seek(at)
        return self._in.read(size)

    def ids(self, i: int) -> np.ndarray:
        """The ids of the file's i-th document."""
        parts = []
        for k in range(self._first[i], self._first[i + 1]):
            part = self._decompress(self._read(int(self._begins[k]), int(self.entries["packed"][k])))
            if xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != self.entries["check"][k]:
                raise ValueError(f"frame {k}: checksum differs")
            parts.append(part)
        return np.frombuffer(b"".join(parts), self._dtype)

    def find(self, doc_id: int) -> list[int]:
        """Places of the documents with this id."""
        return np.flatnonzero((self.places["doc_id"] == doc_id) & (self.places["null"] == 0)).tolist()

    def close(self) -> None:
        self._in.close()


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """Rows ``doc_id``, ``start`` (ids of all documents before it in the folder), ``n_tokens``,
    ``ids_crc32`` (of the ids as 32 bits each) and, if asked for, ``ids``; of all documents, or of a list
    of them, of which only those frames are read."""
    order = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    manifest = spark.read.parquet(f"{path}/manifest")
    manifest = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    wanted = None if doc_ids is None else set(doc_ids)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    plain = [(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")]
    types = pa.schema(plain + [("ids", pa.list_(pa.int64()))] * with_ids)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before, wide in zip(*(batch.column(c).to_pylist() for c in ("file", "before", "wide"))):
                file = TokenFile(f"{path}/files/{name}", wide)
                width = np.dtype(file._dtype).itemsize
                sums = np.concatenate(([0], np.cumsum(file.entries["plain"], dtype=np.int64))) // width
                starts = before + sums[file._first]
                chosen = range(len(file.places)) if wanted is None else [i for i in range(len(file.places)) if int(file.places["doc_id"][i]) in wanted and not file.places["null"][i]]
                rows, held = [], 0
                for i in chosen:
                    ids = file.ids(i)
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    doc = None if file.places["null"][i] else int(file.places["doc_id"][i])
                    rows.append((doc, int(starts[i]), len(ids), crc, ids) if with_ids else (doc, int(starts[i]), len(ids), crc))
                    held += len(ids)
                    if held > FRAME_IDS:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)
                file.close()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)

    # As many tasks as files, up to the shuffle width; a row is a file's name and totals.
    return manifest.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(documents, schema)
