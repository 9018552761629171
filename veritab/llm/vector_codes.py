"""Vector code compression with exact integer arithmetic (operator 13).

Vectors become integers (``floor(1024 x)``) and are cut into four equal parts;
a part is stored as the number of its nearest codebook entry.  The nearest entry
has the least |c|^2 - 2 x.c.  The dot products of a batch are one matrix
product, computed by float64 BLAS on limbs: integers are split into limbs so
short that every sum of products stays below 2^53, where float64 is exact, and
the limb products are put together in int64.  Then the first least value is
taken, so ties go to the lower index whatever order BLAS adds in.

A codebook starts as the part's values in the vectors with the 256 smallest ids.  A
round assigns all vectors in one pass; a task returns, per part and entry, the
sums and counts of what it assigned, and Spark adds them.  The driver
holds the codebooks only.  Totals of a label go back to its rows without a join
for frequent labels (see ``attach_totals``).

Defined results: a null or empty vector, one with a null or non-finite component
and one of another length than the most frequent are left out; integers
beyond 2^28 are set to it, so that every squared distance fits a long; a length that
four does not divide is filled up with zeros; fewer than 256 vectors give as many
entries; equal ids are ordered by vector, a null id comes last; equal rows each get
a row; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import attach_totals, written
from veritab.llm.vectors import integers_of, matrix_of, width_of

SCALE, LARGEST = 1024, 1 << 28
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: vectors whose distances are computed at a time (8 * ENTRIES bytes each)
BLOCK = 4096


# -- exact products --------------------------------------------------------

def limb_bits(length: int) -> int:
    """Bits of a limb, so that ``length`` products of two limbs sum to less than 2^53."""
    return (53 - max(1, length).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 arrays l0, l1, ... with x = l0 + l1 2^bits + ..., each entry below 2^bits in absolute value."""
    out, rest = [], np.abs(x)
    sign = np.where(x < 0, -1.0, 1.0)
    while not out or rest.any():
        out.append((rest & ((1 << bits) - 1)) * sign)
        rest = rest >> bits
    return out


def exact_products(left: np.ndarray, right: list[np.ndarray], bits: int) -> np.ndarray:
    """left @ right in int64, ``right`` being the limbs of an integer matrix."""
    total: np.ndarray | None = None
    for i, a in enumerate(limbs(left, bits)):
        for j, b in enumerate(right):
            term = (a @ b).astype(np.int64) << (bits * (i + j))
            total = term if total is None else total + term
    return total


class Codebooks:
    """``entries``: int64 [part, entry, place]."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.bits = limb_bits(entries.shape[2])
        self.across = [limbs(part.T, self.bits) for part in entries]
        self.norms = (entries * entries).sum(axis=2)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes [row, part], squared distance summed over the parts) of integer vectors [row, part, place]."""
        codes = np.empty(x.shape[:2], dtype=np.int64)
        error = np.zeros(len(x), dtype=np.int64)
        for at in range(0, len(x), BLOCK):
            for part in range(x.shape[1]):
                rows = x[at:at + BLOCK, part]
                away = self.norms[part] - 2 * exact_products(rows, self.across[part], self.bits)
                first = away.argmin(axis=1)
                codes[at:at + BLOCK, part] = first
                error[at:at + BLOCK] += away[np.arange(len(rows)), first] + (rows * rows).sum(axis=1)
        return codes, error

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integer_parts(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the usable rows, their integers [row, part, place])."""
    place, values = matrix_of(column, width)
    x = integers_of(values, SCALE, LARGEST)
    fill = -width % PARTS
    if fill:
        x = np.pad(x, ((0, 0), (0, fill)))
    return place, x.reshape(len(x), PARTS, (width + fill) // PARTS)


# -- codebooks -------------------------------------------------------------

def _usable(vector: str):
    """The vectors that :func:`matrix_of` reads, as a condition on rows (for the few first ones)."""
    return F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def first_entries(table: DataFrame, width: int) -> np.ndarray:
    """The integers of the vectors with the smallest ids, by part."""
    kept = table.where((F.size("vector") == width) & _usable("vector"))
    rows = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()
    _, x = integer_parts(pa.array([r["vector"] for r in rows], pa.list_(pa.float64())), width)
    return x.transpose(1, 0, 2)


def trained(table: DataFrame, entries: np.ndarray, width: int) -> Codebooks:
    """``ROUNDS`` rounds of assignment and floored means over all vectors."""
    _, n_entries, length = entries.shape
    names = [f"s{i}" for i in range(length)]
    schema = "cell int, n bigint, " + ", ".join(f"{c} bigint" for c in names)
    for _ in range(ROUNDS):
        books = Codebooks(entries)

        def run(batches: Iterator[pa.RecordBatch], books: Codebooks = books) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((PARTS * n_entries, length), dtype=np.int64)
            counts = np.zeros(PARTS * n_entries, dtype=np.int64)
            for batch in batches:
                _, x = integer_parts(batch.column(0), width)
                codes, _ = books.assign(x)
                cells = codes + np.arange(PARTS) * n_entries
                np.add.at(sums, cells.ravel(), x.reshape(-1, length))
                counts += np.bincount(cells.ravel(), minlength=len(counts))
            seen = np.flatnonzero(counts)
            yield pa.record_batch([pa.array(seen, pa.int32()), pa.array(counts[seen]),
                                   *[pa.array(column) for column in sums[seen].T]], names=["cell", "n", *names])

        per_task = table.select("vector").mapInArrow(run, schema)
        added = per_task.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", *names)])
        flat = entries.reshape(-1, length).copy()
        for row in added.collect():  # at most PARTS * ENTRIES rows
            flat[row["cell"]] = [row[c] // row["n"] for c in names]
        entries = flat.reshape(entries.shape)
    return Codebooks(entries)


def compress(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label") -> DataFrame:
    """One row per vector: ``vec_id``, ``code``, ``error``, ``label_error``, ``codebooks_sha256``."""
    rows = table.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
                        F.col(label_col).cast("string").alias("label"))
    width = width_of(rows, "vector")
    entries = first_entries(rows, width) if width else np.zeros((PARTS, 0, 1), dtype=np.int64)
    if not entries.size:
        return table.sparkSession.createDataFrame(
            [], "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string")
    books = trained(rows, entries, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, x = integer_parts(batch.column(1), width)
            codes, error = books.assign(x)
            hexes = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            at = pa.array(place)
            yield pa.record_batch([batch.column(0).take(at), batch.column(2).take(at),
                                   pa.array(hexes, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    coded = rows.mapInArrow(run, "vec_id bigint, label string, code string, error bigint")
    # a null label is a key of its own
    key = F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))
    coded = written(coded.select("vec_id", key.alias("label"), "code", "error"), "codes")
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("label_rows"))
    found = attach_totals(coded, written(totals, "label-errors"), "label", "label_rows")
    return found.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
