"""Token ids in a binary store with a shared zstandard dictionary.

Layout of a store, all below one folder:

- ``dictionary/``: one row with the dictionary and its SHA-256,
- ``data/``: shard files. A shard begins with ``MAGIC``, the width of an id in bytes and
  the SHA-256 of the dictionary; behind these 38 bytes stand the documents, each a
  zstandard frame of its own that holds its ids as little-endian integers,
- ``index/``: a Parquet table, one row a document: shard, ordinal in it, id, number of
  ids, ids of the shard before it, offset and length of its frame.

A short document is found through the index and is read with one small request;
nothing else of its shard is decompressed. Documents stand in the order of their
ids, over shards and inside them, so the index rows of an id are found by the
minimum and maximum that Parquet keeps.

Texts are encoded piece by piece where a tokenizer normalises, splits and merges inside
runs without white space only: the ids of a text are then those of its pieces, and a
piece that was seen before is looked up. New ASCII words go to the model of the
tokenizer directly where its other steps only lower-case them. Probes tell such
tokenizers from others, which get whole texts. ``tests/llm`` compares both ways.

The dictionary is trained on a bounded sample (``SAMPLE_DOCS`` documents,
``SAMPLE_BYTES`` bytes of ids at most). It has no influence on what is
stored, only on the space it takes.

Defined cases: a null text is an empty one and has the end id only. Null ids come
first. Rows that share an id are ordered by a hash of the text, then the text.
A table without rows makes a store without shards. Other columns are not stored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wordloom.functions.checks import at_least
from wordloom.llm.shipping import send_code
from wordloom.llm.storage import Output, opened
from wordloom.llm.texts import bounded_sample, text_key

MAGIC = b"WLTOK1"
HEADER = len(MAGIC) + 1 + 32
END_ID = 1
LEVEL = 3
SAMPLE_DOCS = 1000
SAMPLE_BYTES = 32 * 1024 * 1024
DICTIONARY_BYTES = 64 * 1024
CACHED_PIECES = 600_000
CACHED_LENGTH = 48
READ_ROWS = 4096
READ_BYTES = 32 * 1024 * 1024
# A text of which the pieces are encoded alone only where white space has no ids.
PROBE = "Well-known Words, 12 of them:\n\tthey're here,  (don't join) unbelievably."
# The most frequent form of a piece: one word and a mark behind it.
PLAIN = re.compile(rb"([A-Za-z]+)([.,]?)\Z")

INDEX = (
    "shard int, ordinal bigint, doc_id {id}, file string, n_tokens bigint, before bigint, "
    "offset bigint, length bigint"
)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, with a cache of pieces.

    The cache has two generations of ``CACHED_PIECES`` short pieces each: a full
    one becomes the older, out of which pieces that are still in use move over.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.marks = {m: np.array(self._encodes(m.decode()), "<u4").tobytes() for m in (b".", b",")}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        pieces = [piece.encode() for piece in PROBE.split()]
        alone = self._encoded(pieces)
        whole = np.array(self._encodes(PROBE), "<u4").tobytes()
        self.by_piece = b"".join(alone[p] for p in pieces) == whole
        # Whether the model alone gives the ids of lower-cased ASCII words.
        self.plain = all(
            self._plain(*plain.groups(), {}) == alone[p]
            for p in pieces
            if (plain := PLAIN.match(p))
        )

    def _plain(self, word: bytes, mark: bytes, learned: dict[bytes, bytes]) -> bytes:
        """Ids of an ASCII word and a mark behind it, by the tokenizer's model alone."""
        word = word.lower()
        ids = self.known.get(word) or self.older.get(word) or learned.get(word)
        if ids is None:
            found = [token.id for token in self.tokenizer.model.tokenize(word.decode())]
            ids = learned[word] = np.array(found, "<u4").tobytes()
        return ids + self.marks[mark] if mark else ids

    def _encodes(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encoded(self, pieces: Sequence[bytes]) -> dict[bytes, bytes]:
        """Ids of ``pieces``, each encoded by itself."""
        found = {}
        for at in range(0, len(pieces), 2048):
            some = pieces[at : at + 2048]
            encoded = self.tokenizer.encode(
                [p.decode() for p in some], is_pretokenized=True, add_special_tokens=False
            )
            owners = np.array(encoded.word_ids, np.int64)
            ids = np.array(encoded.ids, "<u4")
            stops = np.searchsorted(owners, np.arange(1, len(some) + 1)) * 4
            data, start = ids.tobytes(), 0
            for piece, stop in zip(some, stops.tolist()):
                found[piece] = data[start:stop]
                start = stop
        return found

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text."""
        if not self.by_piece:
            whole = self.tokenizer.encode_batch(
                [text or "" for text in texts], add_special_tokens=False
            )
            return [np.array(e.ids, "<u4").tobytes() for e in whole]
        rows, gaps, missing = [], [], set()
        for text in texts:
            pieces = (text or "").encode().split()
            found = list(map(self.known.get, pieces))
            at = [i for i, ids in enumerate(found) if ids is None]
            missing.update([pieces[i] for i in at])
            gaps.append([(i, pieces[i]) for i in at])
            rows.append(found)
        learned = self._learned(missing)
        for found, at in zip(rows, gaps):
            for i, piece in at:
                found[i] = learned[piece]
        return list(map(b"".join, rows))

    def _learned(self, pieces: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids of pieces that are not in the younger half of the cache, where they go."""
        learned = {p: self.older[p] for p in pieces if p in self.older}
        others = []
        for piece in pieces:
            if piece not in learned:
                plain = PLAIN.match(piece) if self.plain else None
                if plain:
                    learned[piece] = self._plain(*plain.groups(), learned)
                else:
                    others.append(piece)
        learned |= self._encoded(others)
        if len(self.known) + len(learned) > CACHED_PIECES:
            self.known, self.older = {}, self.known
        self.known.update((p, ids) for p, ids in learned.items() if len(p) <= CACHED_LENGTH)
        return learned


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder a worker process, so that its cache outlives a task."""
    return Encoder(path)


def _in_groups(values: Sequence, size: int) -> Iterator[Sequence]:
    for at in range(0, len(values), size):
        yield values[at : at + size]


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, width: int) -> bytes:
    """A zstandard dictionary for the ids of ``(doc_id, text)``; empty where there is too little.

    The sample is encoded and the dictionary trained in one task.
    """
    sample = bounded_sample(docs, SAMPLE_DOCS, "doc_id", "text").select("text")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples, size = [], 0
        for batch in batches:
            for texts in _in_groups(batch.column(0).to_pylist(), 64):
                for ids in encoder(tokenizer).encode(texts):
                    data = _narrow(ids + end_id.to_bytes(4, "little"), width)
                    if size + len(data) <= SAMPLE_BYTES:
                        samples.append(data)
                        size += len(data)
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too few samples or too short ones
            trained = b""
        yield pa.RecordBatch.from_pydict({"dictionary": [trained]})

    rows = sample.coalesce(1).mapInArrow(train, "dictionary binary").collect()
    return max((bytes(row["dictionary"]) for row in rows), key=len, default=b"")


def _narrow(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _wide(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write_store(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int | None = None,
) -> None:
    """Write the ids of ``docs`` to a new store in ``folder``.

    Texts are shuffled once, by ranges of id, and encoded in the task that writes
    their shard, document after document.
    """
    spark = docs.sparkSession
    send_code(spark)
    at_least("end_id", end_id, 0)
    vocabulary = Tokenizer.from_file(tokenizer).get_vocab_size()
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    trained = train_dictionary(narrow, tokenizer, end_id, width)
    digest = hashlib.sha256(trained).digest()
    spark.createDataFrame(
        [(bytearray(trained), digest.hex())], "dictionary binary, sha256 string"
    ).coalesce(1).write.parquet(f"{folder}/dictionary")
    order = ["doc_id", text_key(F.col("text"))]
    ranged = (
        narrow.repartitionByRange(shards, *order)
        if shards
        else narrow.repartitionByRange(*order)
    )
    data = f"{folder}/data"
    end = end_id.to_bytes(4, "little")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(trained)).compress
        out, ordinal, before = None, 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                if out is None:
                    out = Output(data, f"shard-{shard:06d}", ".tok")
                    out.write(MAGIC + bytes([width]) + digest)
                counts, offsets, lengths, befores = [], [], [], []
                for ids in encoder(tokenizer).encode(some.column(1).to_pylist()):
                    frame = compress(_narrow(ids + end, width))
                    counts.append(len(ids) // 4 + 1)
                    offsets.append(out.size)
                    lengths.append(len(frame))
                    befores.append(before)
                    before += counts[-1]
                    out.write(frame)
                n = len(counts)
                columns = [
                    pa.array([shard] * n, pa.int32()),
                    pa.array(range(ordinal, ordinal + n), pa.int64()),
                    some.column(0),
                    pa.array([out.name] * n, pa.string()),
                    *[pa.array(c, pa.int64()) for c in (counts, befores, offsets, lengths)],
                ]
                ordinal += n
                names = "shard ordinal doc_id file n_tokens before offset length".split()
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if out is not None:
            out.close()

    kind = narrow.schema["doc_id"].dataType.simpleString()
    rows = ranged.sortWithinPartitions(*order, "text").mapInArrow(write, INDEX.format(id=kind))
    rows.write.parquet(f"{folder}/index")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index of a store with ``start``: the ids of all documents before each one."""
    index = spark.read.parquet(f"{folder}/index")
    sizes = index.groupBy("shard").agg(F.sum("n_tokens").alias("n"))  # a row a shard
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return index.join(bases, "shard").withColumn("start", F.col("base") + F.col("before")).drop("base")


def read_ids(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` for rows of :func:`read_index`, all or some.

    ``ids`` are the bytes of little-endian unsigned 32-bit integers, read from the
    shard files. Rows are dealt out by shard and stretches of ``READ_ROWS``
    documents; of a stretch only the frames asked for are read, neighbours at once.
    """
    send_code(spark)
    held = spark.read.parquet(f"{folder}/dictionary").first()
    trained, digest = bytes(held["dictionary"]), bytes.fromhex(held["sha256"])
    data = f"{folder}/data"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor(dict_data=_dictionary(trained)).decompress
        name, file, width = None, None, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                files, offsets, lengths = (some.column(i).to_pylist() for i in (3, 4, 5))
                ids, cache, low = [], b"", 0
                for k, (own, offset, length) in enumerate(zip(files, offsets, lengths)):
                    if own != name:
                        if file is not None:
                            file.close()
                        store, path = opened(f"{data}/{own}")
                        name, file, cache, low = own, store.open_input_file(path), b"", 0
                        header = file.read_at(HEADER, 0)
                        if header[: len(MAGIC)] != MAGIC or header[-32:] != digest:
                            raise ValueError(f"{own} was not written with this dictionary")
                        width = header[len(MAGIC)]
                    if not low <= offset or offset + length > low + len(cache):
                        stop = k + 1  # frames that follow each other are fetched together
                        while (
                            stop < len(files)
                            and files[stop] == own
                            and offsets[stop] == offsets[stop - 1] + lengths[stop - 1]
                        ):
                            stop += 1
                        low = offset
                        cache = file.read_at(offsets[stop - 1] + lengths[stop - 1] - low, low)
                    ids.append(_wide(expand(cache[offset - low : offset - low + length]), width))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), some.column(2), pa.array(ids, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )
        if file is not None:
            file.close()

    # A number of tasks from the bytes to be read: the index rows themselves are few and
    # small, and adaptive execution would merge them into very few tasks.
    size = index.agg(F.sum("length").alias("n")).first()["n"]
    tasks = 1 + int(size or 0) // READ_BYTES
    stretch = F.floor(F.col("ordinal") / READ_ROWS)
    dealt = index.repartition(tasks, "shard", stretch).sortWithinPartitions("shard", "ordinal")
    kind = index.schema["doc_id"].dataType.simpleString()
    return dealt.select("doc_id", "start", "n_tokens", "file", "offset", "length").mapInArrow(
        read, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary"
    )


def checksums(ids: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of what :func:`read_ids` returns."""
    size = (F.octet_length("ids") / 4).cast("bigint")
    return ids.select("doc_id", "start", size.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def crc32(ids: Sequence[int]) -> int:
    """The checksum of one document, for tests and single look-ups."""
    return zlib.crc32(np.array(ids, "<u4").tobytes())
