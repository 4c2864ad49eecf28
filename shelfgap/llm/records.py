"""Token ids as length-delimited binary records with a separate offset index.

A record frames one document:

    length of the payload    unsigned 64-bit
    masked crc32 of the 8 length bytes    unsigned 32-bit
    payload
    masked crc32 of the payload    unsigned 32-bit

all little-endian. A masked checksum is the crc32 rotated right by 15 bits plus a constant, so
that checksums of data which holds checksums stay useful. The payload is a flag byte (1: the
document has no id, 2: the token ids take 32 bits instead of 16), the document id as a signed
64-bit integer, and the token ids.

``<folder>/data`` holds the record files, ``<folder>/index`` one Parquet row per record: file,
byte offset, bytes, doc_id, n_tokens and start_in_file. The index names only files of tasks that
succeeded, so files that a lost or repeated task leaves behind are never read. A reader that takes
index rows in any order reads each record by its offset.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfgap.llm.common import text_bytes

MASK_DELTA = 0xA282EAD8  # fixed value of masked checksums
NO_ID, WIDE = 1, 2
FILE_TEXT_BYTES = 16 << 20  # text per record file
CACHED_WORDS = 1_000_000  # per Python worker
READ_AT_ONCE = 4 << 20
LEARN_BYTES = 1 << 20  # of texts whose new words are encoded together
LEARN_WORDS = 10_000
#: Letters that are one code point, and a letter, in any form; each has one small letter.
_PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
#: Signs that are one token run together, whatever they are; the apostrophe is not.
_SIGNS = ".,;:!?*#$%&)"

INDEX = "file string, offset long, n_bytes long, doc_id long, n_tokens long, start_in_file long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17 & 0xFFFFFFFF) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, wide: bool) -> bytes:
    flags = NO_ID * (doc_id is None) | WIDE * wide
    payload = struct.pack("<Bq", flags, doc_id or 0) + ids
    length = struct.pack("<Q", len(payload))
    parts = (length, struct.pack("<I", masked_crc(length)), payload)
    return b"".join((*parts, struct.pack("<I", masked_crc(payload))))


def unframe(record: bytes) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of a record; raises if a length or checksum is wrong."""
    length, check = struct.unpack_from("<QI", record)
    payload = record[12:-4]
    if check != masked_crc(record[:8]) or length != len(payload):
        raise ValueError("the length of a record is damaged")
    if struct.unpack("<I", record[-4:])[0] != masked_crc(payload):
        raise ValueError("the payload of a record is damaged")
    flags, doc_id = struct.unpack_from("<Bq", payload)
    ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=9)
    return (None if flags & NO_ID else doc_id), ids


class _WordIds(dict):
    """Token ids of words as bytes. The tokenizer drops white space, so no token crosses words
    and a text's ids are those of its words in turn."""

    def __init__(self, tokenizer: str, code: str):
        from tokenizers import Tokenizer

        super().__init__()
        known = Tokenizer.from_file(tokenizer)
        self.encode = known.encode
        self.encode_many = known.encode_batch_fast  # without offsets
        self.code = code
        # The tokens that end a run, if the tokenizer marks them.
        vocabulary, suffix = known.get_vocab(), getattr(known.model, "end_of_word_suffix", None)
        self.is_end = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True

    def ids(self, text: str) -> bytes:
        return np.array(self.encode(text, add_special_tokens=False).ids, self.code).tobytes()

    def learn(self, new: Iterable[bytes]) -> None:
        """Encodes the plain letters of new words many at once, which costs half as much as one by one."""
        stems = {w.rstrip(_SIGNS) for w in b" ".join(new).decode("utf-8", "replace").split(" ")}
        plain = [w for w in {w.lower() for w in stems if _PLAIN(w)} if w.encode() not in self]
        for lo in range(0, len(plain), LEARN_WORDS):
            part = plain[lo : lo + LEARN_WORDS]
            (found,) = self.encode_many([" ".join(part)], add_special_tokens=False)
            ids = np.array(found.ids, self.code)
            ends = np.flatnonzero(self.is_end[ids]) + 1
            # Each word is one run, so it has one end at most; if one has none, all are left for later.
            if len(ends) == len(part) and ends[-1] == len(ids):
                data, ends = ids.tobytes(), (ends * ids.itemsize).tolist()
                for word, a, b in zip(part, [0, *ends], ends):
                    self[word.encode()] = data[a:b]

    def of_texts(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text; each known word is looked up once."""
        split = [text.split() for text in texts]
        known = [list(map(self.get, found)) for found in split]
        self.learn({w for found, ids in zip(split, known) for w, x in zip(found, ids) if x is None})
        for found, ids in zip(split, known):
            yield b"".join([self[w] if x is None else x for w, x in zip(found, ids)])

    def __missing__(self, word: bytes) -> bytes:
        # Plain letters are one token run, in small letters, and signs after them another, so that
        # fewer different words reach the tokenizer. Other letters may change their kind when they
        # are normalized, so any other word goes to it as it is.
        letters = word.decode("utf-8", "replace")
        stem = letters.rstrip(_SIGNS)
        if stem != letters and _PLAIN(stem):
            value = self[stem.encode()] + self[letters[len(stem) :].encode()]
        elif _PLAIN(letters) and letters != letters.lower():
            value = self[letters.lower().encode()]
        else:
            value = self.ids(letters)
        self[word] = value
        return value


def _portions(column: pa.Array) -> Iterator[list[bytes]]:
    """The texts in turn, as many at once as ``LEARN_BYTES`` holds, or one; NULL is empty."""
    part, n_bytes = [], 0
    for value in column:
        part.append(value.as_py() or b"")
        n_bytes += len(part[-1])
        if n_bytes >= LEARN_BYTES:
            yield part
            part, n_bytes = [], 0
    if part:
        yield part


_cached: dict[tuple[str, str], _WordIds] = {}


def _word_ids(tokenizer: str, code: str) -> _WordIds:
    key = (tokenizer, code)
    if key not in _cached:
        _cached[key] = _WordIds(tokenizer, code)
    if len(_cached[key]) > CACHED_WORDS:
        _cached[key].clear()
    return _cached[key]


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 1,
    vocabulary: int = 1 << 16,
    text: str = "text",
    file_text_bytes: int = FILE_TEXT_BYTES,
) -> DataFrame:
    """Encodes every text, appends ``end_id`` and writes the records in ascending order of
    doc_id; returns the index.

    ``tokenizer`` is a file of the tokenizers library whose tokenizer drops white space. A NULL
    text counts as empty and gives the end id alone; a NULL doc_id sorts first and stays NULL.
    Equal doc_ids are ordered by text; repeated rows give repeated records. Very long texts are
    one record each. An empty table gives an empty index. Other columns are ignored.
    """
    spark = docs.sparkSession
    wide = vocabulary > 1 << 16
    code = "<u4" if wide else "<u2"
    end = np.array([end_id], code).tobytes()
    data = f"{folder.rstrip('/')}/data"
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")
    )
    files = max(1, -(-text_bytes(rows) // file_text_bytes))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(tokenizer, code)
        item = np.dtype(code).itemsize
        name, out, offset, start = f"{uuid.uuid4().hex}.rec", None, 0, 0
        for batch in batches:
            index: dict[str, list] = {k: [] for k in ("offset", "n_bytes", "doc_id", "n_tokens", "start_in_file")}
            if not batch.num_rows:
                continue
            if out is None:
                fs, path = pafs.FileSystem.from_uri(data)
                fs.create_dir(path, recursive=True)
                out = fs.open_output_stream(f"{path}/{name}", buffer_size=1 << 20)
            doc_ids = iter(batch.column(0).to_pylist())
            for texts in _portions(batch.column(1)):
                # The texts first, or zip takes an id too many.
                for ids, doc_id in zip(words.of_texts(texts), doc_ids):
                    ids += end
                    record = frame(doc_id, ids, wide)
                    out.write(record)
                    n = len(ids) // item
                    for column, x in zip(index.values(), (offset, len(record), doc_id, n, start)):
                        column.append(x)
                    offset += len(record)
                    start += n
            if len(words) > CACHED_WORDS:
                words.clear()
            arrays = [pa.array(v, pa.int64()) for v in index.values()]
            names = pa.array([name] * batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([names, *arrays], ["file", *index])
        if out is not None:
            out.close()

    in_order = rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    index = f"{folder.rstrip('/')}/index"
    in_order.mapInArrow(write, INDEX).write.parquet(index)
    return spark.read.schema(INDEX).parquet(index)


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``: the number of ids of all records before.

    Files follow each other by their first id. Sums per file are added up, of which there are as
    many as files.
    """
    files = index.groupBy("file").agg(
        F.sum("n_tokens").alias("n"),
        F.min_by("doc_id", "start_in_file").alias("first_id"),
        F.max("doc_id").alias("last_id"),
    )
    # Files whose ids are all NULL come first; one that begins with NULL also before the rest.
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), F.col("last_id").asc_nulls_first())
    sums = files.select(
        "file", (F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1))).alias("base")
    )
    base = F.coalesce("base", F.lit(0)).cast("long")
    return index.join(sums, "file").withColumn("start", base + F.col("start_in_file")).drop("base")


def _records(folder: str, index: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray]]:
    """The records of the index rows in turn; neighbours in a file are read together."""
    fs, path = pafs.FileSystem.from_uri(f"{folder.rstrip('/')}/data")
    names = index.column("file").to_pylist()
    offsets = index.column("offset").to_pylist()
    sizes = index.column("n_bytes").to_pylist()
    name, source, i = None, None, 0
    while i < len(names):
        j, end = i, offsets[i]
        while (
            j < len(names)
            and names[j] == names[i]
            and offsets[j] == end
            and (j == i or end + sizes[j] - offsets[i] <= READ_AT_ONCE)
        ):
            end += sizes[j]
            j += 1
        if names[i] != name:
            name, source = names[i], fs.open_input_file(f"{path}/{names[i]}")
        block = memoryview(source.read_at(end - offsets[i], offsets[i]))
        for k in range(i, j):
            at = offsets[k] - offsets[i]
            yield unframe(block[at : at + sizes[k]])
        i = j


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """doc_id and token ids of the index rows, read back from the record files and verified."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                found = list(_records(folder, batch.slice(lo, 256)))
                doc_ids = pa.array([d for d, _ in found], pa.int64())
                ids = pa.array([x.astype(np.int32) for _, x in found], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([doc_ids, ids], ["doc_id", "token_ids"])

    return index.select("file", "offset", "n_bytes").mapInArrow(
        read, "doc_id long, token_ids array<int>"
    )


DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


def record_digests(index: DataFrame, folder: str) -> DataFrame:
    """Per record, read back and verified: doc_id, start, n_tokens and the crc32 of the ids as
    little-endian unsigned 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, counts, checks = [], [], []
            for doc_id, ids in _records(folder, batch):
                doc_ids.append(doc_id)
                counts.append(len(ids))
                checks.append(zlib.crc32(ids.astype("<u4").tobytes()))
            columns = [
                pa.array(doc_ids, pa.int64()),
                batch.column("start"),
                pa.array(counts, pa.int64()),
                pa.array(checks, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    rows = with_starts(index).select("file", "offset", "n_bytes", "start")
    return rows.mapInArrow(read, DIGEST)


def tokenized_digests(
    spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1
) -> DataFrame:
    """Writes the records of all documents to a new folder and reads their digests back."""
    return record_digests(write_records(docs, folder, tokenizer, end_id), folder)
