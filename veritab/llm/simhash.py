"""SimHash near-duplicate groups by generalised pigeonhole (operator 5).

Fingerprint: 64 bits; a bit is set if it is set in more than half of the
XXH64 values of the text's word shingles.  Two fingerprints link if they
differ in at most ``max_bits`` places; a component is everything reachable.

1. Equal fingerprints are one vertex (counted before anything is moved), so a
   group of exact copies costs one row.
2. The joint bit counts of all distinct fingerprints group correlated bits
   into the same part.  For m parts with thresholds t_i, sum(t_i + 1) =
   max_bits + 1 guarantees that linked fingerprints lie within t_i in some
   part i.  The thresholds are found by dynamic programming on the estimated
   cost (probes, and candidates by a chain estimate of each part's distance
   distribution); m is the number of parts with the cheapest plan.
3. Every fingerprint is filed under its exact part values and probes all
   values within t_i.  A bucket's candidates are verified on the whole
   fingerprint in the task that holds the bucket, which returns a spanning
   forest of the links, never the pairs.  Buckets above ``BUCKET_LIMIT`` are
   dealt out as pairs of blocks, so no task holds more than two blocks.
4. Components follow by minimum label propagation with pointer jumping.

Defined results: null or empty text has fingerprint zero and links like any
other; a null id belongs to its component but is its name only if no member
has an id; texts of equal fingerprint are linked; a text of any length is read whole;
an empty table gives no rows; other columns are not read, and pass through
``one_of_each_group`` under any name, where of fully equal rows one stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import attach_totals, text_or_empty, written

SHINGLE_WORDS = 4
MAX_BITS = 4
#: members of a bucket that are verified together; larger buckets go in pairs of blocks
BUCKET_LIMIT = 20_000
#: groups up to this size are verified many at a time
SMALL_GROUP = 64
#: rows of 16 bytes that may be broadcast; more are shuffled
BROADCAST_ROWS = 500_000
#: relative cost of moving a probe and of verifying a candidate
PROBE_COST, VERIFY_COST = 1.0, 0.02


# -- fingerprints ----------------------------------------------------------

def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text as an unsigned 64-bit integer."""
    import xxhash

    tokens = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII case, ASCII white space
    if not tokens:
        return 0
    line = b" ".join(tokens)
    k = min(words, len(tokens))
    size = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    end = np.cumsum(size + 1) - 1
    start = end - size
    digest = xxhash.xxh64_intdigest
    values = np.fromiter((digest(line[a:b], 42) for a, b in zip(start[:len(tokens) - k + 1].tolist(),
                                                               end[k - 1:].tolist())),
                         dtype="<u8", count=len(tokens) - k + 1)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(values), 1 << 16):
        part = values[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp`` (the fingerprint as a signed bigint) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py() or "", words) for t in batch.column(1)]
            fp = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(fp)], names=["doc_id", "text_hash", "fp"])

    text = text_or_empty(text_col)
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"),
                        F.xxhash64(text).alias("text_hash"))
            .mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint"))


# -- parts and thresholds --------------------------------------------------

def joint_bit_counts(vertices: DataFrame) -> tuple[int, np.ndarray]:
    """(number of fingerprints, 64 x 64 counts of bits that are set together)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, joint = 0, np.zeros((64, 64))
        for batch in batches:
            fp = batch.column(0).to_numpy()
            bits = np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits = bits.astype(np.float32)
            joint += bits.T @ bits
            n += len(fp)
        i, j = np.triu_indices(64)
        yield pa.record_batch([pa.array(np.append(i, -1), pa.int32()), pa.array(np.append(j, -1), pa.int32()),
                               pa.array(np.append(joint[i, j], n).astype(np.int64))], names=["i", "j", "n"])

    sums = (vertices.select("fp").mapInArrow(run, "i int, j int, n bigint")
            .groupBy("i", "j").agg(F.sum("n").alias("n")).collect())  # 2081 rows at most
    total, joint = 0, np.zeros((64, 64))
    for r in sums:
        if r["i"] < 0:
            total = r["n"]
        else:
            joint[r["i"], r["j"]] = joint[r["j"], r["i"]] = r["n"]
    return total, joint


def correlated_parts(n: int, joint: np.ndarray, m: int) -> list[list[int]]:
    """The 64 bits in m parts of nearly equal size, correlated bits together.

    A part starts with the most correlated free pair and grows by the bit most
    correlated with its last one, so neighbours in a part are the related ones.
    """
    p = np.diag(joint) / max(n, 1)
    cov = joint / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.clip(p * (1 - p), 1e-12, None))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, -1)
    free, parts = list(range(64)), []
    for k in range(m):
        size = (64 - sum(map(len, parts))) // (m - k)
        sub = corr[np.ix_(free, free)]
        i, _ = np.unravel_index(int(sub.argmax()), sub.shape)
        part = [free.pop(int(i))]
        while len(part) < size:
            part.append(free.pop(int(corr[part[-1], free].argmax())))
        parts.append(part)
    return parts


def distance_distribution(n: int, joint: np.ndarray, part: list[int], most: int) -> np.ndarray:
    """Estimated P(distance <= t), t = 0..most, of two fingerprints in a part.

    Agreement of two random fingerprints on neighbouring bits follows from the
    bits' joint distribution; the part's bits are taken as a chain.
    """
    total = max(n, 1)
    p = np.diag(joint) / total

    def agree(b: int) -> float:
        return p[b] ** 2 + (1 - p[b]) ** 2

    state = np.zeros((2, most + 1))  # [differs on the last bit, differences so far]
    state[0, 0] = agree(part[0])
    if most:
        state[1, 1] = 1 - agree(part[0])
    for b, c in zip(part, part[1:]):
        both = joint[b, c] / total
        cells = np.array([both, p[b] - both, p[c] - both, 1 - p[b] - p[c] + both])
        same = float((cells ** 2).sum())
        ab, ac = agree(b), agree(c)
        step = np.array([[same, ab - same], [ac - same, 1 - ab - ac + same]])
        step = np.clip(step, 0, None) / np.clip(np.array([[ab], [1 - ab]]), 1e-12, None)
        new = np.zeros_like(state)
        new[0] = state[0] * step[0, 0] + state[1] * step[1, 0]
        differ = state[0] * step[0, 1] + state[1] * step[1, 1]
        new[1, 1:] = differ[:-1]
        state = new
    return np.cumsum(state.sum(axis=0))


def allocate(n: int, joint: np.ndarray, parts: list[list[int]], max_bits: int) -> tuple[float, list[int]]:
    """Cheapest thresholds t_i >= -1 with sum(t_i + 1) = max_bits + 1 (-1: part unused)."""
    costs = []
    for part in parts:
        near = distance_distribution(n, joint, part, max_bits)
        costs.append([0.0] + [n * PROBE_COST * sum(comb(len(part), k) for k in range(t + 1))
                              + n * n / 2 * float(near[t]) * VERIFY_COST for t in range(max_bits + 1)])
    best = {0: (0.0, [])}
    for cost in costs:
        longer: dict[int, tuple[float, list[int]]] = {}
        for used, (c, chosen) in best.items():
            for units in range(min(max_bits + 1 - used, max_bits + 1) + 1):
                offer = (c + cost[units], chosen + [units - 1])
                if used + units not in longer or offer < longer[used + units]:
                    longer[used + units] = offer
        best = longer
    return best[max_bits + 1]


def plan(n: int, joint: np.ndarray, max_bits: int = MAX_BITS) -> tuple[list[list[int]], list[int]]:
    """(parts, thresholds) of the cheapest plan with 2 to max_bits + 1 parts."""
    offers = []
    for m in range(min(2, max_bits + 1), max_bits + 2):
        parts = correlated_parts(n, joint, m)
        cost, chosen = allocate(n, joint, parts, max_bits)
        offers.append((cost, m, parts, chosen))
    _, _, parts, chosen = min(offers, key=lambda o: o[:2])
    return parts, chosen


# -- links -----------------------------------------------------------------

def _flips(part: list[int], t: int) -> np.ndarray:
    """Masks that change at most t bits of a part; no change comes first."""
    masks = [0]
    for k in range(1, t + 1):
        masks += [sum(1 << b for b in c) for c in combinations(part, k)]
    return np.array(masks, dtype=np.uint64)


def _filed(vertices: DataFrame, parts: list[list[int]], thresholds: list[int]) -> DataFrame:
    """Every fingerprint under its own part values (``own``) and those it probes."""
    used = [(i, np.uint64(sum(1 << b for b in part)), _flips(part, t))
            for i, (part, t) in enumerate(zip(parts, thresholds)) if t >= 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
            for i, mask, flips in used:
                step = max(1, 200_000 // len(flips))
                for a in range(0, len(fp), step):
                    some = fp[a:a + step]
                    values = ((some & mask)[:, None] ^ flips[None, :]).reshape(-1)
                    own = np.zeros((len(some), len(flips)), dtype=bool)
                    own[:, 0] = True
                    yield pa.record_batch([
                        pa.array(np.full(len(values), i, dtype=np.int32)), pa.array(values.view(np.int64)),
                        pa.array(np.repeat(some, len(flips)).view(np.int64)), pa.array(own.reshape(-1))],
                        names=["part", "value", "fp", "own"])

    return vertices.select("fp").mapInArrow(run, "part int, value bigint, fp bigint, own boolean")


def _labels(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place reachable from each of ``size`` places over the links a-b."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _forest(fp: np.ndarray, own: np.ndarray, group: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) links that connect what links within each group of sorted rows."""
    starts = np.flatnonzero(np.diff(group, prepend=group[0] - 1))
    sizes = np.diff(np.append(starts, len(group)))
    out_a, out_b = [], []
    small = np.repeat(sizes <= SMALL_GROUP, sizes)
    at = np.flatnonzero(small)
    f, o, g = fp[at], own[at], group[at]
    links_a, links_b = [], []
    for d in range(1, int(sizes[sizes <= SMALL_GROUP].max(initial=1))):
        near = (g[:-d] == g[d:]) & (o[:-d] | o[d:])
        near[near] = np.bitwise_count(f[:-d][near] ^ f[d:][near]) <= max_bits
        i = np.flatnonzero(near)
        links_a.append(i)
        links_b.append(i + d)
    if links_a and sum(map(len, links_a)):
        label = _labels(len(f), np.concatenate(links_a), np.concatenate(links_b))
        moved = np.flatnonzero(label != np.arange(len(f)))
        out_a.append(f[moved])
        out_b.append(f[label[moved]])
    for k in np.flatnonzero(sizes > SMALL_GROUP):
        a, b = _spread(fp[starts[k]:starts[k] + sizes[k]], own[starts[k]:starts[k] + sizes[k]], max_bits)
        out_a.append(a)
        out_b.append(b)
    empty = np.empty(0, dtype=np.uint64)
    return np.concatenate([empty, *out_a]), np.concatenate([empty, *out_b])


def _spread(fp: np.ndarray, own: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one large group: breadth first from each free member, comparing
    what was just reached with what is still free, which shrinks quickly where
    members are close to each other."""
    out_a, out_b = [], []
    free, free_own = fp, own
    while len(free):
        root, todo = free[0], [(free[:1], free_own[:1])]
        free, free_own = free[1:], free_own[1:]
        while todo and len(free):
            some, some_own = todo.pop()
            if len(some) > 128:
                todo.append((some[128:], some_own[128:]))
                some, some_own = some[:128], some_own[:128]
            near = np.bitwise_count(some[:, None] ^ free[None, :]) <= max_bits
            near &= some_own[:, None] | free_own[None, :]
            hit = near.any(axis=0)
            if hit.any():
                out_a.append(free[hit])
                out_b.append(np.full(int(hit.sum()), root))
                todo.append((free[hit], free_own[hit]))
                free, free_own = free[~hit], free_own[~hit]
    empty = np.empty(0, dtype=np.uint64)
    return np.concatenate([empty, *out_a]), np.concatenate([empty, *out_b])


def links(vertices: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a``, ``b``: links of distinct fingerprints (column ``fp``) that connect
    exactly what fingerprints within ``max_bits`` of each other connect."""
    n, joint = joint_bit_counts(vertices)
    filed = _filed(vertices, *plan(n, joint, max_bits))
    sizes = filed.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > BUCKET_LIMIT).select(
        "part", "value", F.ceil(F.col("n") / BUCKET_LIMIT).cast("int").alias("blocks"))
    # a large bucket's member goes to the block pairs of its block with every block
    block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.least(block, j).cast("int").alias("x"), F.greatest(block, j).cast("int").alias("y")))
    whole = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))
    dealt = (filed.join(large, ["part", "value"], "left")
             .withColumn("pair", F.explode(F.when(F.col("blocks").isNull(), whole).otherwise(F.array_distinct(pairs))))
             .select("part", "value", "pair.x", "pair.y", "fp", "own"))
    key = ["part", "value", "x", "y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def out(table: pa.Table) -> pa.RecordBatch:
            cols = [table.column(i).to_numpy() for i in range(6)]
            change = np.zeros(len(cols[0]), dtype=bool)
            for c in cols[:4]:
                change[1:] |= c[1:] != c[:-1]
            a, b = _forest(cols[4].view(np.uint64), cols[5].astype(bool), np.cumsum(change), max_bits)
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < 200_000:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            cols = [table.column(i).to_numpy() for i in range(4)]
            last = np.ones(len(cols[0]), dtype=bool)
            for c in cols:
                last &= c == c[-1]
            cut = int(np.flatnonzero(~last).max(initial=-1)) + 1  # the last group may go on
            if cut:
                yield out(table.slice(0, cut))
            held, rows = table.slice(cut).to_batches(), table.num_rows - cut
        if rows:
            yield out(pa.Table.from_batches(held).combine_chunks())

    return (dealt.repartition(*key).sortWithinPartitions(*key)
            .mapInArrow(run, "a bigint, b bigint").distinct())


def components(edges: DataFrame) -> DataFrame:
    """``fp``, ``root`` of every fingerprint that has a link: the smallest
    fingerprint reachable.  Every round also jumps along the labels, so the
    number of rounds follows the logarithm of the longest path."""
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    label = written(both.groupBy(F.col("a").alias("fp")).agg(F.min(F.least("a", "b")).alias("root")), "labels")
    while True:
        near = (both.join(label.select(F.col("fp").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("fp")).agg(F.min("root").alias("near")))
        hooked = label.join(near, "fp").select("fp", F.col("root").alias("old"),
                                               F.least("root", "near").alias("root"))
        jump = label.select(F.col("fp").alias("root"), F.col("root").alias("next"))
        new = written(hooked.join(jump, "root", "left")
                      .select("fp", "old", F.least("root", F.coalesce("next", "root")).alias("root")), "labels")
        if new.where("old <> root").isEmpty():
            return new.select("fp", "root")
        label = new.select("fp", "root")


def _grouped(docs: DataFrame, words: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp``, ``component_id``, ``root`` of every row."""
    rows = written(fingerprints(docs, words, id_col, text_col), "fingerprints")
    vertices = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_rows")),
                       "vertices")
    roots = components(links(vertices.select("fp", "first_id"), max_bits))
    of_vertex = written(vertices.join(roots, "fp", "left")
                        .select("fp", "first_id", "n_rows", F.coalesce("root", "fp").alias("root")), "vertex_roots")
    names = of_vertex.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n_vertices"))
    # a fingerprint, or a group of them, may hold a third of all rows: neither is dealt by its key
    named = attach_totals(of_vertex.select("fp", "n_rows", "root"), written(names, "groups"), "root", "n_vertices")
    named = written(named.select("fp", "n_rows", "component_id", "root"), "named")
    return attach_totals(rows, named, "fp", "n_rows")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest
    id reachable) of every row."""
    return _grouped(docs, words, max_bits, id_col, text_col).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without later members of a group: the smallest id
    stays (then the smallest text hash; of fully equal rows, one)."""
    rows = written(_grouped(docs, words, max_bits, id_col, text_col).select("doc_id", "text_hash", "root"), "grouped")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    best = written(rows.groupBy("root").agg(F.min(place).alias("best"), F.count(F.lit(1)).alias("n")), "best")
    out = written(attach_totals(rows, best, "root", "n").where(~place.eqNullSafe(F.col("best")))
                  .select("doc_id", "text_hash").distinct(), "later_members")
    later = F.broadcast(out) if out.count() <= BROADCAST_ROWS else out
    hashed = F.xxhash64(F.coalesce(F.col(f"d.`{text_col}`").cast("string"), F.lit("")))
    kept = docs.alias("d").join(later.alias("x"), F.col(f"d.`{id_col}`").eqNullSafe(F.col("x.doc_id"))
                                & (hashed == F.col("x.text_hash")), "left_anti")
    twice = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if twice.isEmpty():
        return kept
    same = F.coalesce(F.col(text_col).cast("string"), F.lit(""))  # a null text counts as empty
    return kept.withColumn("__text", same).dropDuplicates([id_col, "__text"]).drop("__text")
