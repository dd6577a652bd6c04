"""Token ids as length-delimited binary records with an offset index.

A record is one document's ids:

    length    8 bytes, unsigned, little endian: bytes of the payload
    check     4 bytes: masked CRC-32 of the length
    payload   row number (8 bytes), bytes per id (1 byte), ids little endian
    check     4 bytes: masked CRC-32 of the payload
    end       one line feed

The mask rotates a checksum by 15 bits and adds a constant, so that checksums stored inside
data do not pass as checksums of that data. Ids take two bytes where the vocabulary allows.
A second table, stored next to the files, holds file, offset, length, doc_id and start of every
record, for reading in any order (`read_chosen`).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.functions.joins import rows_at_most
from tradewind.llm.common import BROADCAST_KEYS, scratch_path, ship, stored, worker_state

# The mask's constant, and the id that ends a document.
MASK_DELTA = 0xA282EAD8
END_ID = 2
# Records in one file, and their bytes (or a single larger record); a reading task takes one file at once.
FILE_DOCUMENTS = 4_000
FILE_BYTES = 32 << 20
CACHED_PIECES = 300_000
BATCH_CHARS = 3_000_000
ENCODED_PIECES = 20_000

ship(__name__)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame_record(row: int, ids: np.ndarray, width: int) -> bytes:
    """A record without its end mark."""
    payload = struct.pack("<QB", row, width) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def read_records(data: bytes) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(offset, length, row, ids) of each record; raises ValueError where a check fails."""
    at = 0
    while at < len(data):
        start = at
        head = data[at:at + 8]
        (length,) = struct.unpack("<Q", head)
        (check,) = struct.unpack("<I", data[at + 8:at + 12])
        payload = data[at + 12:at + 12 + length]
        at += 12 + length
        if check != masked(head) or len(payload) != length:
            raise ValueError(f"broken length at {start}")
        if struct.unpack("<I", data[at:at + 4])[0] != masked(payload) or data[at + 4:at + 5] != b"\n":
            raise ValueError(f"broken record at {start}")
        at += 5
        row, width = struct.unpack("<QB", payload[:9])
        yield start, at - start, row, np.frombuffer(payload, f"<u{width}", offset=9)


class Encoder:
    """Whole-text ids of a tokenizer file, with each piece between spaces encoded once.

    A byte-level BPE without normalizer never joins text across a space that is followed by a
    character that is no white space. Such texts are cut there; the pieces of many texts are
    encoded together by the tokenizer, and ids of frequent pieces are kept. Every other text,
    one that holds an added token, or any text of another kind of tokenizer, is encoded whole.
    """

    def __init__(self, path: str):
        import json
        import os

        # A task has one core: threads of the library would only wait for one another.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.cuts = (
            model["type"] == "BPE" and not spec.get("normalizer") and not spec.get("post_processor")
            and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space", True))
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        self.starts = np.zeros(size + 1, bool)
        if self.cuts:
            for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
                self.starts[i] = token.startswith("Ġ")
        # Number of each kept piece, and by number where its ids lie and how many they are.
        self.known: dict[str, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.sizes = np.empty(0, np.int64)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and their number per piece, of pieces that each follow a space.

        They are encoded as one text, which splits where a token starts with a space.
        """
        all_ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for i in range(0, len(pieces), ENCODED_PIECES):
            some = pieces[i: i + ENCODED_PIECES]
            ids = self.whole([" " + " ".join(some)])[0]
            at = np.flatnonzero(self.starts[ids])
            if len(at) == len(some):
                all_ids.append(ids)
                sizes.append(np.diff(np.append(at, len(ids))))
            else:
                each = self.whole([" " + p for p in some])
                all_ids += each
                sizes.append(np.array([len(x) for x in each], np.int64))
        return np.concatenate(all_ids), np.concatenate(sizes)

    def batch(self, texts: list[str], end_id: int | None = None) -> list[np.ndarray]:
        """Ids of each text, and the end id if one is given."""
        end = np.array([] if end_id is None else [end_id], np.uint32)
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if self.cuts and not any(a in t for a in self.added)]
        if plain:
            column = pa.array([texts[i] for i in plain])
            # A space before white space or at the end is no place to cut.
            odd = pc.match_substring_regex(column, r"\x20(\s|$|\x{0085}|\p{Z})")
            plain = [i for i, o in zip(plain, odd.to_pylist()) if not o]
        if plain:
            split = pc.split_pattern(pa.array([texts[i] for i in plain]), " ")
            offsets = split.offsets.to_numpy()
            coded = split.flatten().dictionary_encode()
            names, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            first = offsets[:-1] - offsets[0]
            # The first piece follows no space.
            heads = self.whole([names[codes[k]] for k in first])
            number = np.fromiter((self.known.get(n, -1) for n in names), np.int64, len(names))
            missing = np.flatnonzero(number < 0)
            fresh = [names[i] for i in missing]
            ids, count = self._pieces(fresh)
            number[missing] = len(self.sizes) + np.arange(len(fresh))
            flat, all_sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, count])
            begins = np.cumsum(all_sizes) - all_sizes
            sizes, begin = all_sizes[number], begins[number]
            room = min(len(fresh), CACHED_PIECES - len(self.known))
            if room > 0:
                self.known.update(zip(fresh[:room], range(len(self.sizes), len(self.sizes) + room)))
                self.ids = flat[: len(self.ids) + int(count[:room].sum())]
                self.sizes = all_sizes[: len(self.sizes) + room]
            each, where = sizes[codes], begin[codes]
            ends = np.cumsum(each)
            index = np.repeat(where - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
            ids = flat[index]
            for k, i in enumerate(plain):
                a, b = first[k], offsets[k + 1] - offsets[0]
                out[i] = np.concatenate([heads[k], ids[ends[a]:ends[b - 1]], end])
        rest = [i for i, o in enumerate(out) if o is None]
        for i, ids in zip(rest, self.whole([texts[i] for i in rest])):
            out[i] = np.concatenate([ids, end])
        return out


def _writer(path: str, end_id: int, file_documents: int, file_bytes: int):
    """Encodes texts in order; each row returned holds the records of one file, without the last end mark."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = worker_state("encoders")
        if path not in encoders:
            encoders[path] = Encoder(path)
        encoder = encoders[path]

        def framed(rows, texts):
            for r, ids in zip(rows, encoder.batch(texts, end_id)):
                yield frame_record(r, ids, encoder.width)

        def files():
            records, size = [], 0
            for record in encoded():
                if records and (len(records) >= file_documents or size + len(record) > file_bytes):
                    yield b"\n".join(records)
                    records, size = [], 0
                records.append(record)
                size += len(record) + 1
            if records:
                yield b"\n".join(records)

        def encoded():
            rows, texts, held = [], [], 0
            for batch in batches:
                for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    rows.append(row)
                    texts.append(text.as_py() or "")
                    held += len(texts[-1])
                    if held >= BATCH_CHARS:
                        yield from framed(rows, texts)
                        rows, texts, held = [], [], 0
            if rows:
                yield from framed(rows, texts)

        for content in files():
            yield pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["records"])

    return run


def write_tokens(
    docs: DataFrame, folder: str, tokenizer_path: str, *, end_id: int = END_ID,
    file_documents: int = FILE_DOCUMENTS, file_bytes: int = FILE_BYTES,
) -> None:
    """Writes the ids of every (doc_id, text) row into files below `folder`, in ascending doc_id order.

    The texts are range-partitioned and sorted by doc_id, null first, and encoded after that,
    so each is encoded once. Part names follow the order. Spark's writer puts the records down
    as raw bytes, a line per file; a retry replaces a part as a whole. A file holds up to
    `file_documents` records of up to `file_bytes` together, or one larger record. A null text is empty and holds the end id
    only. Equal ids, and equal rows, stay next to each other.
    """
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    # The least long stands for no id.
    rows = ordered.select(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("row"), "text")
    signed = rows.select(F.col("row").cast("long").alias("row"), "text").mapInArrow(
        _signed(_writer(tokenizer_path, end_id, file_documents, file_bytes)), "records binary")
    signed.select(F.col("records").cast("string").alias("value")).write.option("lineSep", "\n").option(
        "maxRecordsPerFile", 1).text(folder)


def _signed(run):
    """Rows as unsigned 64-bit numbers, as they are framed."""

    def unsigned(batches):
        for b in batches:
            rows = b.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(rows), b.column(1)], ["row", "text"])

    return lambda batches: run(unsigned(batches))


def _reader(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = [
                (path, offset, length, int(np.uint64(row).view(np.int64)), len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                for offset, length, row, ids in read_records(data.as_py())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 6,
                 (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
                ["path", "offset", "length", "row", "n_tokens", "ids_crc32"])


def offset_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: file, offset, length, doc_id, n_tokens, ids_crc32, start.

    `start` counts the ids of all records before it, in file order. Sums run within a file,
    and over one row per file.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    records = stored(files.mapInArrow(
        _reader, "path string, offset long, length long, row long, n_tokens long, ids_crc32 long"), "records")
    part = F.regexp_extract("path", r"part-(\d+)-.*?(?:-c(\d+))?(?:\.[a-z0-9.]+)?$", 1).cast("long")
    piece = F.coalesce(F.regexp_extract("path", r"-c(\d+)(?:\.[a-z0-9.]+)?$", 1).try_cast("long"), F.lit(0))
    totals = records.groupBy("path").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy(part, piece).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("path").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(
        bases, "path").select(
            "path", "offset", "length", F.when(F.col("row") != F.lit(-(1 << 63)), F.col("row")).alias("doc_id"),
            "n_tokens", "ids_crc32", (F.col("base") + F.col("inside")).alias("start"))


def write_index(spark: SparkSession, folder: str) -> str:
    """Stores the offset index of token files as a Parquet table next to their folder; returns its path."""
    path = folder.rstrip("/") + "-index"
    offset_index(spark, folder).write.parquet(path)
    return path


def _picker(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, places in zip(batch.column(0), batch.column(1).to_pylist()):
            content, rows = memoryview(data.as_buffer()), []
            for p in places:
                (_, _, row, ids), = read_records(bytes(content[p["offset"]: p["offset"] + p["length"]]))
                if p["doc_id"] is not None and int(np.uint64(row).view(np.int64)) != p["doc_id"]:
                    raise ValueError(f"the index names another record at {p['offset']}")
                rows.append((p["doc_id"], p["start"], ids.tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.list_(pa.int64())))],
                ["doc_id", "start", "ids"])


def read_chosen(chosen: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of the records that rows of a stored index name, in no order.

    Only files that hold one are read, and only the named records are parsed and checked.
    """
    spark, schema = chosen.sparkSession, "doc_id long, start long, ids array<long>"
    places = stored(chosen.select("path", "offset", "length", "doc_id", "start"), "chosen")
    few = rows_at_most(places, BROADCAST_KEYS)
    paths = [r.path for r in places.select("path").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    of_file = places.groupBy("path").agg(F.collect_list(F.struct("offset", "length", "doc_id", "start")).alias("places"))
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.join(F.broadcast(of_file) if few else of_file, "path").select("content", "places").mapInArrow(_picker, schema)


def tokens_and_index(docs: DataFrame, tokenizer_path: str, **options) -> tuple[str, str]:
    """Writes the token files of documents into the shared folder and stores their index; returns both paths."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer_path, **options)
    return folder, write_index(docs.sparkSession, folder)


def tokens_of(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Writes the token files of documents and their index into the shared folder; returns the stored index."""
    return docs.sparkSession.read.parquet(tokens_and_index(docs, tokenizer_path, **options)[1])
