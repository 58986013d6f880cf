"""Token ids in binary files, in ascending document order, and back.

Documents are dealt by range of (id, hash of the text), sorted, tokenised and
collected into segments of about ``per_segment`` tokens (``rans``); a document
lies in one segment.  The files are plain concatenations of segments, each
followed by a line feed: Spark's text writer stores them with its own commit
protocol, so a lost executor repeats a task and leaves no half-written file, on
any file system that Spark knows.  A segment carries (part, seq), its place in
the order of the files; nothing depends on file names.

Reading: Spark reads whole files (each bounded by ``per_file`` segments), tasks
verify the checksums and decode the sections; ``read_range`` decodes only the
sections that hold the tokens asked for.

Defined results: null text is empty and yields the end id alone; rows without
an id come first; rows of one id follow each other by the hash of their text,
each as a document of its own; an empty table yields files without segments and
an empty result; extra columns are not read.  A damaged file raises.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadcast.llm import rans
from loadcast.llm.common import in_small_batches, kept, n_blocks, written
from loadcast.session import work_dir

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
PER_SEGMENT = 1 << 21   # tokens, about; a segment ends after the document that reaches it
PER_FILE = 8            # segments of a file
PER_PART = 48 << 20     # bytes of text dealt to one task, about
CACHE = 1 << 19         # chunks remembered by a worker, in each of two generations

# White space of the tokenizer's own rules (\s of Unicode), as a fixed value.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class ByteEncoder(dict):
    """Token ids of texts as little-endian uint32 bytes; the dictionary holds
    the ids of the chunks that a worker has met.

    No rule of the tokenizer joins a character to white space after it, so a
    text's ids are those of its chunks (white space and what follows up to the
    next) one after the other.  Chunks are remembered in two generations of
    ``cache``.  A chunk of letters is one unit to the tokenizer's rules and goes
    straight to its merges; marks after letters are a unit of their own.

    Texts whose white space is single spaces and line feeds are cut by a plain
    split: there, a chunk's key is its bytes without the leading space.  A tab
    starts the key of a chunk that is taken as it stands."""

    MARKS = b"!#$%&()*+,-./:;<=>?@[]^_{|}~"
    #: White space other than a single space or line feed between two characters, in UTF-8.
    ODD = [b"  ", b" \n", b"\n ", b"\n\n", b"\t", b"\x0b", b"\x0c", b"\r", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x81\x9f",
           b"\xe3\x80\x80"]
    WIDE = rb"\xe2\x80[\x80-\x8a\xa8\xa9\xaf]"

    def __init__(self, tokenizer: str, cache: int = CACHE) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer))
        self.merges = self.encoder.model.tokenize
        # Byte-level vocabularies write a byte that does not print as a letter from U+0100 on.
        shown = [b for b in range(256) if chr(b).isprintable() and b != 32]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.space = self.letters[32]
        self.chunks = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
        self.wide = re.compile(self.WIDE).search
        self.limit, self.old = cache, {}

    def _whole(self, chunk: bytes) -> bytes:
        ids = self.encoder.encode(chunk.decode("utf-8", "replace"), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, key: bytes) -> bytes | None:
        """Ids of a space and letters (of scripts with settled tables)."""
        if key.isalpha():
            word = key.decode("ascii")
        else:
            word = key.decode("utf-8", "replace")
            if not word.isalpha() or max(word) > "\u024f":
                return None
            word = key.decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.merges(self.space + word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _ids(self, key: bytes) -> bytes:
        if key[:1] == b"\t":
            return self._whole(key[1:])
        bare = key.rstrip(self.MARKS)
        if bare == key:
            word = self._word(key)
        else:
            word = None
            if b"<|" not in key:
                word = bare[-1:].isalnum() and self.get(bare) or self._word(bare)
            if word:
                return word + self[b"\t" + key[len(bare):]]
        return word or self._whole(key if key[:1] == b"\n" else b" " + key)

    def __missing__(self, key: bytes) -> bytes:
        ids = self[key] = self.old.get(key) or self._ids(key)
        return ids

    def _cut(self, text: bytes) -> list[bytes]:
        """Keys of a text's chunks."""
        if text[0] in b" \n" or text[-1] in b" \n" or any(map(text.__contains__, self.ODD)) or b"\xe2\x80" in text and self.wide(text):
            return [b"\t" + c.encode() for c in self.chunks(text.decode("utf-8", "replace"))]
        return (b"\t" + text.replace(b"\n", b" \n")).split(b" ")

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
        get = self.__getitem__
        return [b"".join(map(get, self._cut(t))) if t else b"" for t in texts]


def write(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
          end_id: int = END_ID, per_segment: int = PER_SEGMENT, per_file: int = PER_FILE, per_part: int = PER_PART,
          **codec: int) -> None:
    """Write the token ids of ``docs`` to a new folder, ascending by id."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))
    size = own.agg(F.coalesce(F.sum(F.octet_length("t") + 8), F.lit(0))).first()[0]
    own = own.withColumn("h", F.xxhash64("t"))
    ordered = own.repartitionByRange(n_blocks(size, per_part), "doc_id", "h").sortWithinPartitions("doc_id", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = kept(f"bytes:{tokenizer}", lambda: ByteEncoder(tokenizer))
        end, part, seq = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), 0
        ids, names, counts, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            raw = rans.encode(np.frombuffer(b"".join(ids), "<u4"), names, np.array(counts), part=part, seq=seq, **codec)
            return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["segment"])

        for batch in batches:
            for s in range(0, len(batch), 256):
                b = batch.slice(s, 256)
                for doc, own_ids in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist()), strict=True):
                    ids += (own_ids, end)
                    names.append(doc)
                    counts.append(len(own_ids) // 4 + 1)
                    held += counts[-1]
                    if held >= per_segment:
                        yield segment()
                        ids, names, counts, held, seq = [], [], [], 0, seq + 1
        if held:
            yield segment()

    (in_small_batches(ordered.select("doc_id", "t")).mapInArrow(run, "segment binary")
     .select(F.col("segment").cast("string").alias("value"))
     .write.option("lineSep", "\n").option("compression", "none").option("maxRecordsPerFile", per_file).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def read(spark: SparkSession, path: str, *, ids: bool = True) -> DataFrame:
    """``(part, seq, pos, first, doc_id, n_tokens, ids_crc32[, ids])`` of every document: ``first`` counts the
    tokens before it in its segment, ``pos`` the documents; ``ids`` are little-endian uint32."""
    names = ["part", "seq", "pos", "first", "doc_id", "n_tokens", "ids_crc32"] + (["ids"] if ids else [])
    types = [pa.int64()] * 7 + ([pa.binary()] if ids else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib
        for batch in batches:
            for data in batch.column(0):
                for s in rans.segments(data.as_py()):
                    raw = s.ids().tobytes()
                    ends = np.cumsum(s.counts)
                    cuts = [raw[4 * a:4 * z] for a, z in zip((ends - s.counts).tolist(), ends.tolist(), strict=True)]
                    columns = [[s.part] * s.n_docs, [s.seq] * s.n_docs, range(s.n_docs), ends - s.counts, s.doc_ids, s.counts,
                               [zlib.crc32(c) for c in cuts], cuts]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names)

    schema = "part long, seq long, pos long, first long, doc_id long, n_tokens long, ids_crc32 long" + (", ids binary" if ids else "")
    return _files(spark, path).mapInArrow(run, schema)


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """``(start, ids)``: the tokens [start, stop) of the whole sequence of files, one row per segment that holds some;
    other sections are neither verified nor decoded."""
    base = {(r["part"], r["seq"]): r["base"] for r in _bases(_sizes(spark, path))
            .filter((F.col("base") < stop) & (F.col("base") + F.col("n") > start)).collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                for s in rans.segments(data.as_py()):
                    at = base.get((s.part, s.seq))
                    if at is not None:
                        own = s.ids(max(0, start - at), min(s.n, stop - at)).tobytes()
                        yield pa.RecordBatch.from_arrays([pa.array([max(start, at)]), pa.array([own], pa.binary())], ["start", "ids"])

    return _files(spark, path).mapInArrow(run, "start long, ids binary")


def _sizes(spark: SparkSession, path: str) -> DataFrame:
    """``(part, seq, n)`` of every segment, from the headers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                found = [(s.part, s.seq, s.n) for s in rans.segments(data.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(3)], ["part", "seq", "n"])

    return _files(spark, path).mapInArrow(run, "part long, seq long, n long")


def _bases(sizes: DataFrame) -> DataFrame:
    """Add ``base``, the tokens before each segment: a running sum over the parts
    (one row a task of the writer), then over the segments of a part."""
    parts = sizes.groupBy("part").agg(F.sum("n").alias("own"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("p"), F.coalesce(F.sum("own").over(before), F.lit(0)).alias("earlier"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (sizes.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
            .join(parts, F.col("part") == F.col("p"))
            .select("part", "seq", "n", (F.col("earlier") + F.col("inside")).alias("base")))


def report(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read back from the files."""
    spark = docs.sparkSession
    path = f"{work_dir(spark, 'token-files')}/t"
    write(docs, path, **options)
    rows = written(read(spark, path, ids=False), "token-rows")
    base = _bases(rows.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n"))).select("part", "seq", "base")
    return rows.join(base, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
