"""Token ids as a compressed binary table (operator 10).

Ids are written with one canonical, length-limited Huffman code made from the
counts of all ids.  The table is a folder with two Parquet tables:

``code``    one row per id that occurs: ``id``, ``bits`` (its code length).
            Lengths alone define the canonical code.
``blocks``  independent blocks in ascending (id of document) order:
            ``part``, ``seq``        place of the block: parts ascend, then seq
            ``doc_ids``              the block's documents
            ``doc_tokens``           their numbers of ids
            ``n_tokens``             sum of them
            ``checkpoints``          bit offset of every 256th id
            ``payload``              the code words, padded to bytes

A block decodes alone, and every checkpoint is a place to start from, so a
block is decoded table-driven with all its segments side by side.

Defined results: a null text has no ids but the end id; equal rows are written
each; null ids come first, equal ids in the order of a hash of their ids; a text of any length is encoded
whole, a longer one than a block is a block of its own; an empty table gives two empty tables; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritab.llm import tokens
from veritab.llm.common import scratch_path, written

#: longest code word; a decoding table has 2 ** MAX_BITS entries
MAX_BITS = 18
#: ids between two bit-offset checkpoints
SEGMENT = 256
#: a block is closed when it holds this many ids (a longer document is a block of its own)
BLOCK_TOKENS = 1 << 18
#: ids in one output partition (about), which sets the number of partitions
PART_TOKENS = 1 << 23

BLOCK_SCHEMA = ("part int, seq int, doc_ids array<bigint>, doc_tokens array<bigint>, "
                "n_tokens bigint, checkpoints array<bigint>, payload binary")


# -- code ------------------------------------------------------------------

def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Optimal code lengths of at most ``max_bits`` bits (package-merge).

    Works on the vocabulary, not on the corpus.  Symbols of equal counts are
    ordered by id, so the result depends on the counts alone.
    """
    symbols = sorted((c, s) for s, c in counts.items() if c > 0)
    if len(symbols) > 1 << max_bits:
        raise ValueError("more symbols than code words")
    if len(symbols) == 1:
        return {symbols[0][1]: 1}
    weights = np.array([c for c, _ in symbols], dtype=np.float64)
    n = len(symbols)
    # level by level: merge the packages of the level below with the symbols;
    # remember for each merged list which places are symbols
    levels, packages = [], np.empty(0)
    for _ in range(max_bits):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order < n)
        merged = merged[order]
        even = len(merged) // 2 * 2
        packages = merged[:even:2] + merged[1:even:2]
    lengths = np.zeros(n, dtype=np.int64)
    take = 2 * n - 2
    for is_symbol in reversed(levels):
        used = is_symbol[:take]
        k = int(used.sum())
        lengths[:k] += 1
        take = 2 * (len(used) - k)
    return {s: int(b) for (_, s), b in zip(symbols, lengths)}


def canonical(lengths: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids in code order, their lengths, their code words)."""
    order = sorted((b, s) for s, b in lengths.items())
    ids = np.array([s for _, s in order], dtype=np.int64)
    bits = np.array([b for b, _ in order], dtype=np.int64)
    words = np.zeros(len(order), dtype=np.uint64)
    word = 0
    for i in range(1, len(order)):
        word = (word + 1) << int(bits[i] - bits[i - 1])
        words[i] = word
    return ids, bits, words


def decoding_table(lengths: dict[int, int]) -> tuple[np.ndarray, int]:
    """(id << 8 | length of the code word that starts each ``width``-bit pattern, width)."""
    ids, bits, _ = canonical(lengths)
    width = int(bits.max()) if len(bits) else 1
    entries = np.repeat(ids << 8 | bits, np.left_shift(1, width - bits))
    rest = (1 << width) - len(entries)  # patterns without a code word (a single symbol)
    return np.pad(entries, (0, rest), constant_values=1).astype(np.uint32), width


def pack(ids: np.ndarray, bits_of: np.ndarray, word_of: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(code words of ids, most significant bit first; bit offset of every ``SEGMENT``-th id)."""
    n = bits_of[ids].astype(np.int64)
    end = np.cumsum(n)
    at = end - n
    total = int(end[-1]) if len(end) else 0
    out = np.zeros(total // 64 + 2, dtype=np.uint64)
    if len(ids):
        place = (at & 63).astype(np.uint64)
        values = word_of[ids] << (64 - n).astype(np.uint64)  # at the top of 64 bits
        # code words are shorter than 64 bits: one starts in every 64 bits, the first of them where places fall
        first = np.concatenate([[0], np.flatnonzero(place[1:] < place[:-1]) + 1])
        out[:len(first)] = np.add.reduceat(values >> place, first)  # disjoint bits: a sum is an or
        last = np.append(first[1:], len(ids)) - 1  # may run into the next 64 bits
        out[1:len(first) + 1] += values[last] << (64 - place[last])
    return out.astype(">u8").tobytes()[:(total + 7) // 8], at[::SEGMENT]


def unpack(payload: bytes, checkpoints: np.ndarray, n: int, table: tuple[np.ndarray, int]) -> np.ndarray:
    """The ``n`` ids of a payload, decoding all segments side by side."""
    entries, width = table
    data = np.frombuffer(payload + bytes(8), dtype=np.uint8).astype(np.uint32)
    # 32 bits from every byte on
    window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    at = checkpoints.astype(np.int64)
    out = np.empty((SEGMENT, len(at)), dtype="<u4")
    for k in range(SEGMENT):
        code = (window.take(at >> 3, mode="clip") << (at & 7).astype(np.uint32)) >> np.uint32(32 - width)
        out[k] = entries.take(code, mode="clip")
        at += out[k] & 0xFF
    return np.ascontiguousarray(out.T).reshape(-1)[:n] >> np.uint32(8)


# -- write -----------------------------------------------------------------

class _Rows(tokens.TaskRows):
    """A task's documents as rows, and the counts of its ids as the last one."""

    names = ["doc_id", "ids", "n_tokens", "counts"]

    def __init__(self) -> None:
        self.counts = np.zeros(1 << 16, dtype=np.int64)

    def __call__(self, keys: pa.Array, ids: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if ids.size and ids.max() > 0xFFFF:
            raise ValueError("the vocabulary has ids beyond 16 bits")
        short = ids.astype("<u2")
        self.counts += np.bincount(short, minlength=1 << 16)
        blob = pa.Array.from_buffers(pa.large_binary(), len(keys), [None, pa.py_buffer(starts * 2), pa.py_buffer(short)])
        yield pa.record_batch([keys, blob.cast(pa.binary()), pa.array(np.diff(starts)),
                               pa.nulls(len(keys), pa.binary())], names=self.names)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.counts.any():
            yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()),
                                   pa.array([self.counts.astype("<i8").tobytes()], pa.binary())], names=self.names)


def token_table(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
                text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, counts), one written table: ``doc_id``, ``ids`` (little-endian 16-bit),
    ``n_tokens``, ``tie`` (a hash of the ids); and per task the ``counts`` of all ids (64-bit)."""
    chosen = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    encoded = tokens.map_ids(chosen, vocabulary, "doc_id bigint, ids binary, n_tokens bigint, counts binary", task=_Rows)
    table = written(encoded.withColumn("tie", F.xxhash64("ids")), "ids")
    return (table.where(F.col("counts").isNull()).select("doc_id", "ids", "n_tokens", "tie"),
            table.where(F.col("counts").isNotNull()).select("counts"))


def id_counts(counts: DataFrame) -> dict[int, int]:
    """Occurrences of every id, from those of the tasks; the result is bounded by the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            for blob in batch.column(0):
                n += np.frombuffer(blob.as_buffer(), "<i8")
        seen = np.flatnonzero(n)
        yield pa.record_batch([pa.array(seen), pa.array(n[seen])], names=["id", "n"])

    per_task = counts.mapInArrow(run, "id bigint, n bigint")
    return {r["id"]: r["n"] for r in per_task.groupBy("id").agg(F.sum("n").alias("n")).collect()}


class _Blocks:
    """Cuts a partition's documents into blocks and packs them."""

    def __init__(self, code: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        ids, bits, words = code
        self.bits_of, self.word_of = np.zeros(1 << 16, dtype=np.uint8), np.zeros(1 << 16, dtype=np.uint64)
        self.bits_of[ids], self.word_of[ids] = bits, words
        self.part, self.seq, self.tokens = 0, 0, 0
        self.keys: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Rows (part, id, ids); documents are taken in runs up to the end of a block."""
        if not batch.num_rows:
            return
        self.part = batch.column(0)[0].as_py()
        blob = batch.column(2).cast(pa.large_binary())
        at = np.frombuffer(blob.buffers()[1], "<i8")[blob.offset:blob.offset + len(blob) + 1] >> 1
        data = np.frombuffer(blob.buffers()[2] or b"", "<u2")
        row = 0
        while row < len(blob):
            fits = int(np.searchsorted(at, at[row] + BLOCK_TOKENS - self.tokens, side="right")) - 1 - row
            if fits < 1 and self.tokens:
                yield self.block()
                continue
            upto = row + max(1, min(fits, len(blob) - row))  # a longer document is a block of its own
            self.keys.append(batch.column(1).slice(row, upto - row))
            self.sizes.append(np.diff(at[row:upto + 1]))
            self.ids.append(data[at[row]:at[upto]].copy())
            self.tokens += int(at[upto] - at[row])
            row = upto

    def block(self) -> pa.RecordBatch:
        payload, checkpoints = pack(np.concatenate(self.ids), self.bits_of, self.word_of)
        keys, sizes = pa.concat_arrays(self.keys), np.concatenate(self.sizes)
        whole = pa.array([0, len(sizes)], pa.int32())
        out = pa.record_batch([
            pa.array([self.part], pa.int32()), pa.array([self.seq], pa.int32()),
            pa.ListArray.from_arrays(whole, keys), pa.ListArray.from_arrays(whole, pa.array(sizes)),
            pa.array([int(sizes.sum())], pa.int64()), pa.array([checkpoints], pa.list_(pa.int64())),
            pa.array([payload], pa.binary())],
            names=["part", "seq", "doc_ids", "doc_tokens", "n_tokens", "checkpoints", "payload"])
        self.seq, self.tokens, self.keys, self.sizes, self.ids = self.seq + 1, 0, [], [], []
        return out


def write_ids(docs: DataFrame, path: str, vocabulary: str,
              id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write the ids below ``path`` in ascending id order."""
    spark = docs.sparkSession
    table, per_task = token_table(docs, vocabulary, id_col, text_col)
    counts = id_counts(per_task)
    lengths = code_lengths(counts) if counts else {}
    spark.createDataFrame(pd.DataFrame({"id": list(lengths), "bits": list(lengths.values())}, dtype="int64"),
                          "id bigint, bits bigint").coalesce(1).write.parquet(f"{path}/code")
    code = spark.sparkContext.broadcast(canonical(lengths))  # bounded by the vocabulary

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _Blocks(code.value)
        for batch in batches:
            yield from made.add(batch)
        if made.keys:
            yield made.block()

    parts = max(1, -(-sum(counts.values()) // PART_TOKENS))
    # equal ids of documents: by a hash of their content, which also spreads them
    ordered = table.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    (ordered.select(F.spark_partition_id(), "doc_id", "ids")
     .mapInArrow(blocks, BLOCK_SCHEMA).write.option("compression", "none").parquet(f"{path}/blocks"))


# -- read ------------------------------------------------------------------

def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Decode the files: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids`` (little-endian 32-bit)."""
    return _decoded(spark, path, digest=False)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_ids`, with the ids' crc32 (``ids_crc32``) in place of the ids."""
    return _decoded(spark, path, digest=True)


def _decoded(spark: SparkSession, path: str, digest: bool) -> DataFrame:
    lengths = {r["id"]: r["bits"] for r in spark.read.parquet(f"{path}/code").collect()}  # bounded by the vocabulary
    table = spark.sparkContext.broadcast(decoding_table(lengths))
    stored = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    places = stored.select("part", "seq", "n_tokens")
    # two-level running sum: over the parts (one row each), then over a part's blocks
    parts = places.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = parts.select("part", (F.sum("part_tokens").over(Window.orderBy("part")) - F.col("part_tokens"))
                          .alias("part_start"))
    by_seq = Window.partitionBy("part").orderBy("seq")
    starts = (places.withColumn("within", F.sum("n_tokens").over(by_seq) - F.col("n_tokens"))
              .join(before, "part").select("part", "seq", (F.col("part_start") + F.col("within")).alias("start")))
    # one short row per block: a shuffled join would move the payloads instead
    blocks = (stored.join(_small(starts), ["part", "seq"])
              .select("start", "doc_ids", "doc_tokens", "checkpoints", "payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, keys, per_doc, checkpoints, payload in zip(*batch.columns):
                sizes = per_doc.values.to_numpy()
                ids = unpack(payload.as_buffer().to_pybytes(), checkpoints.values.to_numpy(), int(sizes.sum()), table.value)
                at = np.concatenate([[0], np.cumsum(sizes)])
                docs = [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                last = (pa.array([zlib.crc32(x) for x in docs], pa.int64()) if digest
                        else pa.array([x.tobytes() for x in docs], pa.binary()))
                yield pa.record_batch([keys.values, pa.array(start.as_py() + at[:-1]), pa.array(sizes), last],
                                      names=["doc_id", "start", "n_tokens", name])

    name = "ids_crc32" if digest else "ids"
    kind = "bigint" if digest else "binary"
    return blocks.mapInArrow(run, f"doc_id bigint, start bigint, n_tokens bigint, {name} {kind}")


#: blocks whose places are broadcast (20 bytes each); more are joined by a shuffle
BROADCAST_BLOCKS = 500_000


def _small(starts: DataFrame) -> DataFrame:
    return F.broadcast(starts) if starts.count() <= BROADCAST_BLOCKS else starts


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
               path: str | None = None) -> DataFrame:
    """Write all ids, read the files back and return one row per document."""
    path = path or scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, path, vocabulary, id_col, text_col)
    return read_digests(docs.sparkSession, path)
