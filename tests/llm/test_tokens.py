"""Token ids, Huffman files and packing against the tokenizers library and plain versions."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from veritab.llm import packing, token_output, tokens
from veritab.llm.queries import QUERIES, vocabulary

DOCS = "doc_id bigint, text string, ids string, start int"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def ids_of(tokenizer):
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def odd_texts(n=400):
    rng = random.Random(1)
    ranges = [(0, 0x180), (0, 128), (0x300, 0x370), (0x370, 0x3000), (32, 33), (10, 11), (28, 32), (0x1F000, 0x1F900)]
    texts = [None, "", "  ", "\n", "it's WE'LL 12½ ²", "<|endoftext|> x <|ENDOFTEXT|>", "İstanbul ΣΑΣ ǅ", "a" * 3000, "word,, a.b.c x?! (y.) e.g.'s don't. U.S.A., z,\u0301 \u00e9. w\u2014v, 3.5,7 <|x.y|> a.<|endoftext|>."]
    return texts + ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_encoder_equals_the_library(ids_of, monkeypatch):
    encode = tokens.BatchEncoder(vocabulary())
    texts = odd_texts()
    monkeypatch.setattr(tokens, "SLICE_BYTES", 500)
    array = pa.array(texts, pa.string())
    for at, n in tokens._slices(array):
        ids, starts = encode(array.slice(at, n))
        for i in range(n):
            assert ids[starts[i]:starts[i + 1]].tolist() == ids_of(texts[at + i])


def test_a_worker_reads_the_vocabulary_once(monkeypatch):
    import tokenizers

    texts, made = pa.array(["some words"]), []

    class Counted:
        @staticmethod
        def from_str(spec):
            made.append(1)
            return library.from_str(spec)

    library = tokenizers.Tokenizer
    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    first = [tokens.BatchEncoder(vocabulary())(texts)[0].tolist() for _ in range(3)]
    assert first[0] == first[1] == first[2] and len(made) <= 1


def test_marks_after_accented_words_make_no_new_chunks(ids_of):
    encode = tokens.BatchEncoder(vocabulary())
    asked, plain = [], encode.encode
    encode.encode = lambda chunk: asked.append(chunk) or plain(chunk)
    text = "Été, été. été; ÉTÉ: n'été? straße. straße! \u00d7. \u00f7, 3. lló.,! \u00aa."
    ids, starts = encode(pa.array([text, text]))
    assert ids[:starts[1]].tolist() == ids[starts[1]:].tolist() == ids_of(text)
    assert {"Été", "ÉtÉ", "straße", ","} <= set(asked)
    assert not {"été,", "été.", "été;", "straße.", "straße!"} & set(asked)


def test_code_lengths_are_optimal_and_limited():
    import heapq

    rng = random.Random(2)
    for n in (1, 2, 3, 30, 300):
        counts = {s * 3: int(2 ** rng.uniform(0, 30)) for s in range(n)}
        lengths = token_output.code_lengths(counts, 60)  # long enough not to bind
        heap = [(c, i) for i, c in enumerate(counts.values())]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            cost += a[0] + b[0]
            heapq.heappush(heap, (a[0] + b[0], b[1]))
        assert sum(counts[s] * b for s, b in lengths.items()) == (cost or counts[0])
        tight = token_output.code_lengths(counts, max(1, (n - 1).bit_length() + 1))
        assert max(tight.values()) <= max(1, (n - 1).bit_length() + 1)
        assert sum(2.0 ** -b for b in tight.values()) <= 1


def test_pack_and_unpack():
    rng = np.random.default_rng(3)
    for n in (0, 1, 255, 256, 257, 5000):
        ids = np.minimum(rng.geometric(0.02, n), 4000).astype("<u2")
        lengths = token_output.code_lengths({int(s): int(c) for s, c in zip(*np.unique(ids, return_counts=True))}, 14) \
            if n else {0: 1}
        order, bits, words = token_output.canonical(lengths)
        bits_of, word_of = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint64)
        bits_of[order], word_of[order] = bits, words
        payload, checkpoints = token_output.pack(ids, bits_of, word_of)
        assert len(payload) == (int(bits_of[ids].sum()) + 7) // 8
        table = token_output.decoding_table(lengths)
        assert token_output.unpack(payload, checkpoints, n, table).tolist() == ids.tolist()
        if n > 300:  # a checkpoint is a place to start from
            tail = token_output.unpack(payload, checkpoints[1:], n - 256, table)
            assert tail.tolist() == ids[256:].tolist()


def test_pack_writes_the_bits_of_long_code_words():
    rng = np.random.default_rng(4)
    lengths = token_output.code_lengths({s: 1 << min(s, 50) for s in range(60)})
    order, bits, words = token_output.canonical(lengths)
    assert bits.max() == token_output.MAX_BITS
    bits_of, word_of = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint64)
    bits_of[order], word_of[order] = bits, words
    for n in (1, 3, 4, 63, 64, 65, 700):
        ids = rng.integers(0, 60, n).astype("<u2")
        payload, checkpoints = token_output.pack(ids, bits_of, word_of)
        text = "".join(f"{int(word_of[i]):0{int(bits_of[i])}b}" for i in ids)
        assert payload == int(text.ljust(-(-len(text) // 8) * 8, "0"), 2).to_bytes(-(-len(text) // 8), "big")
        assert token_output.unpack(payload, checkpoints, n, token_output.decoding_table(lengths)).tolist() == ids.tolist()


def expected_rows(docs, ids_of):
    rows, start = [], 0
    for doc_id, text in docs:
        ids = ids_of(text)
        rows.append((doc_id, start, len(ids), brute.crc(ids)))
        start += len(ids)
    return rows


def test_token_output_on_the_tables(spark, sf, ids_of):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = QUERIES["op10_token_output"](spark, sf)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected_rows(docs, ids_of)


def test_token_output_edges(spark, ids_of, tmp_path, monkeypatch):
    monkeypatch.setattr(token_output, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(token_output, "PART_TOKENS", 1000)
    texts = odd_texts(40)
    docs = [(i // 2, t) for i, t in enumerate(texts)] + [(None, "no id"), (None, "no id"), (3, "same"), (3, "same")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS)
    token_output.write_ids(df, f"{tmp_path}/ids", vocabulary())
    got = sorted(token_output.read_ids(spark, f"{tmp_path}/ids").collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in docs), key=lambda i: (i is not None, i or 0))
    want = sorted((str(i), ids_of(t)) for i, t in docs)
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == want
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
    empty = token_output.round_trip(df.limit(0), vocabulary())
    assert empty.count() == 0


def check_packing(rows, docs, ids_of, limit):
    want = []
    for doc_id, text in docs:
        ids = ids_of(text)
        for k in range(0, len(ids), limit):
            part = ids[k:k + limit]
            want.append((str(doc_id), k // limit, k, len(part), brute.crc(part)))
    got = [(str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got) == sorted(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= limit
    return len(sequences), -(-sum(w[3] for w in want) // limit)


def test_packing_on_the_tables(spark, sf, ids_of):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got, least = check_packing(QUERIES["op2_best_fit_packing"](spark, sf).collect(), docs, ids_of, 4096)
    assert got <= least + 1


def test_packing_edges(spark, ids_of, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 20)
    docs = list(enumerate(odd_texts(40))) + [(None, "no id"), (3, "same words"), (3, "same words")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS)
    check_packing(packing.pack(df, vocabulary(), limit=32).collect(), docs, ids_of, 32)
    assert packing.pack(df.limit(0), vocabulary()).count() == 0


def test_best_two_fit_exchanges_the_smallest():
    # greedy: 6 + 3 leaves a gap of 1; 3 gives way to 2 + 2
    bins, offsets = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert bins[0] == bins[2] == bins[3] and bins[1] != bins[0]
    assert sorted(offsets[[0, 2, 3]].tolist()) == [0, 6, 8]
    rng = np.random.default_rng(5)
    for limit in (7, 100, 4096):
        lengths = rng.integers(1, limit + 1, 500)
        bins, offsets = packing.best_two_fit(lengths, limit)
        for b in set(bins.tolist()):
            held = sorted(zip(offsets[bins == b].tolist(), lengths[bins == b].tolist()))
            assert [o for o, _ in held] == np.concatenate([[0], np.cumsum([n for _, n in held])[:-1]]).tolist()
            assert sum(n for _, n in held) <= limit
