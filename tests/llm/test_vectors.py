"""Whitening and vector codes against plain versions."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from veritab.llm import common, vector_codes, vectors, whitening
from veritab.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<double>, label int, code string, n int, component int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", 7, 3) for i, v, k in rows], SCHEMA)


def usable(rows, width):
    return [r for r in rows if r[1] is not None and len(r[1]) == width
            and all(c is not None and math.isfinite(c) for c in r[1])]


NAN, INF = float("nan"), float("inf")


def odd(width):
    """Rows that are left out."""
    return [(901, None, 1), (902, [], 1), (903, [None] * width, 1), (904, [0.1] * (width - 1) + [NAN], 1),
            (905, [INF] + [0.1] * (width - 1), 2), (906, [0.5] * (width + 1), 2), (907, [-INF] * width, None)]


# -- rank-one updates

def test_rank_one_updates_with_deflation():
    rng = np.random.default_rng(0)
    for trial in range(1500):
        d = int(rng.integers(1, 10))
        values = np.sort(rng.integers(0, 4, d).astype(float) * 10.0 ** rng.integers(-8, 8))
        basis, _ = np.linalg.qr(rng.normal(size=(d, d)))
        v, rho = rng.integers(-2, 3, d) * 10.0 ** rng.integers(-6, 6), 10.0 ** rng.integers(-3, 3)
        want = basis.T @ np.diag(values) @ basis + rho * np.outer(v, v)
        got, rows = whitening.rank_one(values, basis, v, rho)
        assert (np.diff(got) >= 0).all()
        assert np.abs(rows @ rows.T - np.eye(d)).max() < 1e-13
        assert np.abs(rows.T @ np.diag(got) @ rows - want).max() <= 1e-13 * max(np.abs(want).max(), 1e-300)


def test_secular_roots_lie_between_the_poles():
    d, z2 = np.array([0.0, 1.0, 1.0 + 1e-9, 5.0]), np.array([1e-12, 1.0, 1.0, 1e-3])
    origin, tau = whitening.secular_roots(d, z2, 2.0)
    for i, (o, t) in enumerate(zip(origin, tau)):
        value, terms = Fraction(1), Fraction(1)
        for dj, zj in zip(d, z2):
            term = 2 * Fraction(zj) / (Fraction(dj) - Fraction(d[o]) - Fraction(t))
            value, terms = value + term, terms + abs(term)
        assert abs(value) <= terms * Fraction(1, 10 ** 13)
        root = Fraction(d[o]) + Fraction(t)
        assert Fraction(d[i]) < root and (i + 1 == len(d) or root < Fraction(d[i + 1]))


def test_combined_spectra_equal_one_pass():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 6)) * [1, 2, 3, 4, 5, 60] / 50
    def batch(m):
        return iter([pa.record_batch([pa.array(m.tolist(), pa.list_(pa.float64()))], names=["v"])])
    a, b = whitening.partition_spectrum(batch(x[:30]), 6), whitening.partition_spectrum(batch(x[30:]), 6)
    both, whole = whitening.merged(a, b), whitening.partition_spectrum(batch(x), 6)
    assert both["n"] == 90 and (both["high"] == whole["high"]).all() and (both["low"] == whole["low"]).all()
    assert np.allclose(both["eigenvalues"], whole["eigenvalues"], rtol=1e-10)
    assert whitening.partition_spectrum(iter([]), 6) is None


# -- whitening

def check_whitening(got, rows, width):
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v, _ in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in x])
    v = centred.T @ centred / n
    values, basis = np.linalg.eigh(v)
    values, basis, trace = values[::-1], basis[:, ::-1], np.trace(v)
    shown = min(8, width)
    assert len(got) == n * shown
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
    signs = {}
    for (i, _, _), entry, row in zip(rows, x, centred):
        for k in range(shown):
            r = next(r for r in by_id[i] if r["component"] == k + 1)
            assert r["n"] == n
            assert r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(entry, sums))
            assert r["explained"] == pytest.approx(values[k] / trace, rel=1e-9, abs=1e-12)
            if values[k] <= 1e-12 * trace:
                assert r["whitened"] is None
                continue
            want = float(row @ basis[:, k]) / math.sqrt(values[k])
            if abs(want) > 1e-3:
                assert signs.setdefault(k, np.sign(want * r["whitened"])) == np.sign(want * r["whitened"])
            assert abs(r["whitened"]) == pytest.approx(abs(want), abs=1e-7)
            assert r["identity_error"] < 1e-9


def test_whitening_of_the_table(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = QUERIES["op12_whitening"](spark, sf)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening(got.collect(), [tuple(r) for r in table.collect()], 64)


def test_whitening_over_many_partitions_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(vectors, "FAN_IN", 2)
    rng = np.random.default_rng(5)
    rows = [(i, list(map(float, v)), None) for i, v in enumerate(rng.normal(size=(120, 10)) * np.linspace(0.1, 2, 10))]
    rows += [(1000 + i, [0.25] * 10, 1) for i in range(60)]  # a frequent vector
    table = frame(spark, rows + odd(10)).repartition(7)
    check_whitening(whitening.whiten(table).collect(), rows, 10)


def test_whitening_without_variance(spark):
    for table, n in (([], 0), (odd(3), 0), ([(1, [0.5, 1.5], None)], 1), ([(i, [0.5, 1.5], None) for i in range(4)], 4)):
        got = whitening.whiten(frame(spark, table)).collect()
        if n:
            assert len(got) == 2 * n and all(
                (r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (n, 0, None, None, None)
                for r in got)
        else:
            # the longest of equally frequent lengths is read: the odd row of length 4
            assert all(r["vec_id"] in (902, 906) for r in got)


def test_whitening_of_flat_and_huge_vectors(spark):
    rows = [(i, [float(i), 2.0 * i, 3.0], 0) for i in range(9)]   # one direction only
    check_whitening(whitening.whiten(frame(spark, rows)).collect(), rows, 3)
    huge = [(1, [1e300, 0.0], 0), (2, [-1e300, 0.0], 0), (None, [0.0, 1.0], 0), (None, [0.0, 1.0], 0)]
    got = whitening.whiten(frame(spark, huge)).collect()
    assert len(got) == 8 and sum(r["vec_id"] is None for r in got) == 4
    assert {r["deviation"] for r in got if r["vec_id"] == 1} == {None}   # beyond a long


# -- vector codes

def plain_codes(rows):
    """(rows of the contract, codebooks) of usable (id, vector, label) rows, with Python integers."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))
    x = {id(r): [math.floor(1024 * c) for c in r[1]] for r in rows}
    width = len(rows[0][1])
    step = -(-width // 4)
    part = lambda r, p: (x[id(r)] + [0] * (4 * step - width))[p * step:(p + 1) * step]
    books = [[part(r, p) for r in order[:256]] for p in range(4)]

    def nearest(p, v):
        away = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in books[p]]
        return away.index(min(away)), min(away)

    for _ in range(4):
        told = [[nearest(p, part(r, p))[0] for r in rows] for p in range(4)]
        for p in range(4):
            for k in range(len(books[p])):
                mine = [part(r, p) for r, t in zip(rows, told[p]) if t == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    final = [[nearest(p, part(r, p)) for p in range(4)] for r in rows]
    error = [sum(e for _, e in f) for f in final]
    by_label = {}
    for r, e in zip(rows, error):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{k:02x}" for k, _ in f), e, by_label[r[2]], sha)
                   for r, f, e in zip(rows, final, error)), key=repr)


def codes_of(df):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bits", [20, 28, 40, 62])
def test_limb_products_are_exact(bits):
    rng = np.random.default_rng(bits)
    room = min(bits, 29)
    a = rng.integers(-(1 << room), 1 << room, (40, 16))
    b = rng.integers(-(1 << (bits - room)), 1 << (bits - room), (16, 30)) if bits > 29 else a[:30].T
    limb = vector_codes.limb_bits(16)
    assert 16 * ((1 << limb) - 1) ** 2 < 1 << 53
    want = [[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b.T] for r in a]
    if max(abs(v) for r in want for v in r) < 1 << 63:
        assert vector_codes.exact_products(a, vector_codes.limbs(b, limb), limb).tolist() == want


def test_vector_codes_of_the_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert codes_of(QUERIES["op13_vector_codes"](spark, sf)) == plain_codes(usable(rows, 64))


def test_vector_codes_with_ties_odd_rows_and_hot_labels(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(0, 200)), [float(c) for c in rng.integers(-3, 4, 10) / 2.0], [None, 1, 1, 1, 2][i % 5])
            for i in range(330)]
    rows += rows[:40] + [(None, [0.5] * 10, None), (None, [0.5] * 10, 9), (-1, [300000.0, -262144.0] * 5, 3)]
    bound = [(i, [max(-262144.0, min(262144.0, c)) for c in v], k) for i, v, k in rows]
    want = plain_codes(bound)
    for hot in (1, 10_000):
        monkeypatch.setattr(common, "HOT_ROWS", hot)
        assert codes_of(vector_codes.compress(frame(spark, rows + odd(10)).repartition(5))) == want


def test_few_and_no_vectors(spark):
    assert codes_of(vector_codes.compress(frame(spark, []))) == []
    assert codes_of(vector_codes.compress(frame(spark, [(1, None, 1), (2, [], 1), (3, [NAN], 2)]))) == []
    rows = [(3, [0.1, 0.2], None), (1, [0.1, 0.2], None), (2, [5.0, -5.0], 4)]
    assert codes_of(vector_codes.compress(frame(spark, rows))) == plain_codes(rows)
