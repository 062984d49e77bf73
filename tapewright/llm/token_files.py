"""Token ids of whole documents as Parquet list columns.

A tokenised corpus is a Parquet folder with one row per document, in ascending id order over all
files: ``doc_id``, ``part`` (the file's number), ``pos`` (the row's number in its file), ``offset`` (ids before
the document in its file), ``n_tokens`` and ``ids`` (list of 32-bit integers). Ids are dictionary-encoded (16 bits a token before
compression), the sorted metadata columns delta-encoded; row groups and pages are bounded, and the page
index lets a reader skip to the documents it wants and leave out the ids where it only needs metadata.

Documents are dealt to files by ranges of their id and encoded where they are written. The number of
tokens before a document is the sum over earlier files plus its offset in its own; no task sees
more than one file's rows, and only the files' totals (one row a file) are summed in one place.

Defined results: a null or empty text has the end id alone; rows that repeat an id stay, side by side,
ordered by a hash of their texts; a null id sorts first; an empty table gives an empty folder with
the schema; further columns of the input are left out unless named in ``metadata``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapewright.llm.util import named

END_ID = 0
CACHED_PIECES = 400_000  # of each of two generations, per Python worker; about 150 MB together
LONGEST_PIECE = 64  # longer ones are not kept, so that their number bounds the memory

# fixed values: the published pre-tokenisation pattern of byte-level BPE, for texts of these characters;
# words come first, as nothing else begins with a letter or a blank and a letter
_PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
_PIECES = re.compile(
    r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\s+(?!\S)|\s+"
)

WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
}


def _byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    letters = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
    return "".join(letters[b] for b in range(256))


class Encoder(dict):
    """Texts to ids, as bytes of little-endian 32-bit integers.

    The pieces that byte-level pre-tokenisation makes are encoded one by one and independently, so the
    ids of frequent pieces are kept: in this dictionary and, once that has ``most``, in the one before it. A
    new piece goes to the tokenizer's model as the letters that stand for its bytes. Texts with characters
    outside the plain set, texts that hold an added token (such as an end mark) and tokenizers of another
    kind are encoded whole, as the tokenizer is loaded.
    """

    def __init__(self, path: str, most: int = CACHED_PIECES) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.most = most
        self.tokenizer = Tokenizer.from_file(path)
        pre = self.tokenizer.pre_tokenizer
        self.model, self.before = self.tokenizer.model, {}
        self.letters = _byte_letters()
        self.blank = self.letters[32]
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added)) if added else None
        self.by_piece = isinstance(pre, ByteLevel) and not pre.add_prefix_space and self.tokenizer.normalizer is None

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        found = self.before.get(piece)
        if found is None:
            if piece.isascii() and piece[1:].isalpha():  # a blank or a letter, then letters
                letters = piece.replace(" ", self.blank)
            else:
                letters = piece.encode().decode("latin-1").translate(self.letters)
            found = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(letters)])
        if len(piece) <= LONGEST_PIECE:
            self[piece] = found
        return found

    def ids(self, text: str) -> bytes:
        if self.by_piece and _PLAIN.fullmatch(text) and not (self.added and self.added.search(text)):
            return b"".join(map(self.__getitem__, _PIECES.findall(text)))
        return self.whole(text)


_encoders: dict[str, Encoder] = {}


def _encoded(path: str, end_id: int, cached_pieces: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        encoder = _encoders[path]
        encoder.most = cached_pieces
        pos = offset = 0
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for at in range(0, len(batch), 256):
                data = [encoder.ids(text or "") + end for text in texts.slice(at, 256).to_pylist()]
                sizes = np.array([len(x) // 4 for x in data], np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(data), "<i4"))
                part = batch.slice(at, 256)
                columns = {c: part.column(k) for k, c in enumerate(part.schema.names) if c != "text"}
                columns["pos"] = pa.array(np.arange(pos, pos + len(data)))
                columns["offset"] = pa.array(offset + offsets[:-1].astype(np.int64))
                columns["n_tokens"] = pa.array(sizes)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(offsets), values)
                pos += len(data)
                offset += int(offsets[-1])
                yield pa.RecordBatch.from_pydict(columns)

    return run


def encode(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    metadata: Sequence[str] = (),
    end_id: int = END_ID,
    cached_pieces: int = CACHED_PIECES,
) -> DataFrame:
    """Rows in ascending id order: doc_id, metadata, part, pos, offset, n_tokens, ids (list of int).

    ``cached_pieces`` trades a worker's memory for time: the ids are the same.
    """
    id_of, text_of, *others = named(id_column, text_column, *metadata)
    rows = docs.select(
        id_of.cast("long").alias("doc_id"), text_of.alias("text"), *[c.alias(f"meta_{n}") for c, n in zip(others, metadata, strict=True)]
    )
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered = ordered.withColumn("part", F.spark_partition_id())
    kept = [f.name + " " + f.dataType.simpleString() for f in ordered.schema if f.name != "text"]
    encoded = ordered.mapInArrow(_encoded(tokenizer, end_id, cached_pieces), ", ".join([*kept, "pos long, offset long, n_tokens long, ids array<int>"]))
    return encoded


def write_tokens(docs: DataFrame, path: str, tokenizer: str, **options) -> None:
    encode(docs, tokenizer, **options).write.options(**WRITE_OPTIONS).parquet(path)


def read_tokens(spark: SparkSession, path: str, where: Column | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and columns of a token folder; ``where`` on doc_id reaches row groups and pages."""
    tokens = spark.read.parquet(path)
    if where is not None:
        tokens = tokens.where(where)
    return tokens.select(*columns) if columns else tokens


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        offsets = lists.offsets.to_numpy()
        values = np.ascontiguousarray(lists.values.to_numpy(), "<i4")
        sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
            names=["doc_id", "part", "offset", "n_tokens", "ids_crc32"],
        )


def token_report(spark: SparkSession, path: str) -> DataFrame:
    """From the files alone, one row per document: doc_id, start, n_tokens, ids_crc32."""
    rows = read_tokens(spark, path, columns=("doc_id", "part", "offset", "ids"))
    found = rows.mapInArrow(_checked, "doc_id long, part int, offset long, n_tokens long, ids_crc32 long")
    totals = read_tokens(spark, path, columns=("part", "n_tokens")).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # one row a file, so the number of files bounds the window and the broadcast
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    return found.join(F.broadcast(before), "part").select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
