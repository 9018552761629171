"""Best-two-fit packing of documents into fixed-length sequences (operator 2).

A document's ids (with the end id) are one piece; a longer document is cut
into pieces of the sequence length, the last one shorter.  A sequence is
filled greedily with the largest piece that fits; then its smallest piece is
replaced by the two unpacked pieces whose sum comes closest to the expanded
gap, if they fit more tightly, until nothing improves.

Packing works on lengths.  Pieces are dealt by a hash of their place, never
by their content, to shards of about ``SHARD_PIECES``, so that equal rows are
spread too; each shard is packed by one task with counts per length, and only
its last sequence is likely to stay open.

Defined results: a null text is one piece of one id; equal rows are packed
each; a longer document than a sequence is cut into pieces; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm import tokens
from veritab.llm.common import written

SEQUENCE_TOKENS = 4096
#: pieces that one task packs (about)
SHARD_PIECES = 50_000

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class _Lengths:
    """Unpacked pieces by length."""

    def __init__(self, lengths: np.ndarray, limit: int) -> None:
        order = np.argsort(lengths, kind="stable")
        self.places: dict[int, list[int]] = {}
        for place, n in zip(order.tolist(), lengths[order].tolist()):
            self.places.setdefault(n, []).append(place)
        self.sizes = sorted(self.places)
        self.limit = limit
        self.largest = np.zeros(limit + 1, dtype=np.int64)  # largest unpacked length <= index
        self.stale = True

    def at_most(self, gap: int) -> int:
        i = bisect_right(self.sizes, gap)
        return self.sizes[i - 1] if i else 0

    def take(self, n: int) -> int:
        held = self.places[n]
        place = held.pop()
        if not held:
            del self.places[n]
            self.sizes.remove(n)
            self.stale = True
        return place

    def put(self, n: int, place: int) -> None:
        if n not in self.places:
            self.places[n] = []
            self.sizes.insert(bisect_right(self.sizes, n), n)
            self.stale = True
        self.places[n].append(place)

    def best_two(self, gap: int, above: int) -> tuple[int, int] | None:
        """Two unpacked pieces with the largest sum in (above, gap]."""
        if self.stale:
            self.largest[:] = 0
            self.largest[self.sizes] = self.sizes
            np.maximum.accumulate(self.largest, out=self.largest)
            self.ids = np.array(self.sizes, dtype=np.int64)
            self.many = np.array([len(self.places[n]) > 1 for n in self.sizes])
            self.stale = False
        i = bisect_right(self.sizes, gap // 2)
        small = self.ids[:i]
        if not i:
            return None
        other = self.largest[gap - small]
        # the same length twice needs two pieces; else the next smaller partner
        lone = (other == small) & np.array([len(self.places[n]) < 2 for n in small.tolist()]) \
            if (other == small).any() else np.zeros(i, dtype=bool)
        total = np.where((other >= small) & ~lone, small + other, 0)
        k = int(total.argmax())
        best = int(total[k])
        return (int(small[k]), best - int(small[k])) if best > above else None


def best_two_fit(lengths: np.ndarray, limit: int = SEQUENCE_TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in it) of every piece; all lengths are from 1 to ``limit``."""
    left = _Lengths(np.asarray(lengths, dtype=np.int64), limit)
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    number = 0
    while left.sizes:
        held: list[tuple[int, int]] = []  # (length, place), largest first
        gap = limit
        while gap and (n := left.at_most(gap)):
            held.append((n, left.take(n)))
            gap -= n
        while gap and left.sizes:
            n, place = held[-1]
            pair = left.best_two(gap + n, above=n)
            if not pair:
                break
            held.pop()
            held += sorted(((x, left.take(x)) for x in pair), reverse=True)
            held.sort(reverse=True)
            left.put(n, place)
            gap += n - sum(pair)
        at = 0
        for n, place in held:
            bins[place], offsets[place] = number, at
            at += n
        number += 1
    return bins, offsets


def pieces(docs: DataFrame, vocabulary: str, limit: int = SEQUENCE_TOKENS,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` of every piece."""
    def rows(keys: pa.Array, ids: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        size = np.diff(starts)
        n = -(-size // limit)
        doc = np.repeat(np.arange(len(size)), n)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        at = piece * limit
        length = np.minimum(limit, size[doc] - at)
        first = starts[doc] + at
        raw = ids.astype("<u4", copy=False)
        crc = [zlib.crc32(raw[a:b]) for a, b in zip(first.tolist(), (first + length).tolist())]
        yield pa.record_batch([keys.take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(at),
                               pa.array(length), pa.array(crc, pa.int64())],
                              names=["doc_id", "piece", "start", "length", "ids_crc32"])

    chosen = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return tokens.map_ids(chosen, vocabulary, PIECE_SCHEMA, rows)


def pack(docs: DataFrame, vocabulary: str, limit: int = SEQUENCE_TOKENS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``."""
    # short rows: the ids themselves are not needed for a plan of sequences
    table = written(pieces(docs, vocabulary, limit, id_col, text_col), "pieces")
    shards = max(1, round(table.count() / SHARD_PIECES))
    # the place of a row in the written table is the same in every attempt
    dealt = table.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=False)
        bins, offsets = best_two_fit(group["length"].to_numpy(), limit)
        group["sequence_id"] = (int(key[0]) << 32) + bins
        group["offset"] = offsets
        return group.drop(columns="shard")

    return dealt.groupBy("shard").applyInPandas(run, PIECE_SCHEMA + ", sequence_id bigint, offset bigint")
