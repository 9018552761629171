"""Token ids of whole texts, with the tokenizers library inside Arrow batches.

The lower-casing word vocabulary splits a text into letter runs, single
numbers and punctuation runs before any merge, so a text's ids are the
concatenation of its pieces' ids.  Each worker keeps the ids of the pieces
it has seen (in a table of bounded size); the library's model encodes a
piece once instead of once per occurrence.  Texts with characters beyond Latin-1 hand the white-space
separated chunks that hold them to the whole library pipeline.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: entries of a worker's piece table, at most: a newer and an older half
TABLE_ENTRIES = 400_000
#: bytes of text that are encoded at a time
SLICE_BYTES = 6 << 20
#: longer pieces are encoded each time instead of kept
LONGEST_KEPT_PIECE = 64
#: id appended to every document
END_ID = 1

# Latin-1 classes of the vocabulary's splitting pattern (fixed values)
_LETTERS = "a-zªµºß-öø-ÿ"
_NUMBERS = "0-9²³¹¼½¾"
_SPACES = "\t-\r \x85\xa0"
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
#: a letter and a mark that starts the next piece
_WORD_END = "([a-zÀ-ÖØ-öø-ÿ])([.,;:!?])"
_BEYOND_LATIN1 = re.compile("[^\x00-\xff]")
_CHUNK = re.compile("[^\t-\r ]+")


def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the rest
    follows from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def is_splittable(tokenizer_json: str) -> bool:
    """True if the vocabulary file has the normalisation and splitting that the
    piece table relies on."""
    spec = json.loads(tokenizer_json)
    steps = [s.get("type") for s in (spec.get("normalizer") or {}).get("normalizers", [])]
    split = [s.get("type") for s in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    return steps == ["NFC", "Replace", "Lowercase"] and split == ["Split", "ByteLevel"]


@lru_cache(maxsize=1)
def _loaded(path: str) -> tuple[Tokenizer, bool, list[str]]:
    """(a vocabulary file's tokenizer, whether the piece table may be used, its special
    tokens' strings), which a worker reads once for all its tasks."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = f.read()
    return Tokenizer.from_str(spec), is_splittable(spec), [t["content"] for t in json.loads(spec)["added_tokens"]]


def make_encoder(path: str) -> tuple[Callable[[str], bytes], bool, str | None, dict[str, bytes]]:
    """(encode, split, mark, known): a function from a text to its ids as little-endian
    unsigned 32-bit bytes; whether a text's ids are those of its white-space
    separated chunks; the start of the special tokens' strings; the pieces that the
    worker keeps, each a lower-case text whose ids are these."""
    tokenizer, splittable, specials = _loaded(path)

    def whole(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    if not splittable:
        return whole, False, None, {}
    mark = specials[0][:2] if specials and all(s[:2] == specials[0][:2] for s in specials) else None
    if specials and mark is None:
        return whole, False, None, {}
    alphabet, tokenize = _byte_alphabet(), tokenizer.model.tokenize  # the alphabet translates bytes read as Latin-1
    packers = [struct.Struct(f"<{n}I").pack for n in range(LONGEST_KEPT_PIECE + 1)]

    class Table(dict):
        """The newer half; a piece of the older half moves here when it is seen again, and
        when this half is full it becomes the older one, so that frequent pieces stay."""

        older: dict[str, bytes] = {}

        def __missing__(self, piece: str) -> bytes:
            ids = self.older.get(piece)
            if ids is None:
                plain_letters = piece.isascii() and piece.isalpha()  # these stand for themselves
                shown = piece if plain_letters else piece.encode().decode("latin-1").translate(alphabet)
                found = [t.id for t in tokenize(shown)]
                ids = (packers[len(found)] if len(found) < len(packers) else struct.Struct(f"<{len(found)}I").pack)(*found)
            if len(piece) <= LONGEST_KEPT_PIECE:
                if len(self) >= TABLE_ENTRIES // 2:
                    self.older = dict(self)
                    self.clear()
                self[piece] = ids
            return ids

    table = Table()

    def plain(text: str) -> bytes:
        return b"".join(map(table.__getitem__, _PIECES.findall(text.lower())))

    def encode(text: str) -> bytes:
        if text.isalpha() and (text.isascii() or not _BEYOND_LATIN1.search(text)):
            return table[text.lower()]  # one piece
        if mark and mark in text:
            return whole(text)
        if text.isascii() or not _BEYOND_LATIN1.search(text):
            return plain(text)
        return b"".join(whole(chunk) if _BEYOND_LATIN1.search(chunk) else plain(chunk)
                        for chunk in _CHUNK.findall(text))

    return encode, True, mark, table


class BatchEncoder:
    """Encodes an Arrow array of texts at once.

    Arrow splits the texts at spaces and line feeds and numbers the distinct
    chunks of the batch; only those pass through Python, and numpy gathers
    their ids back into text order.
    """

    def __init__(self, path: str) -> None:
        self.encode, self.split, self.mark, self.known = make_encoder(path)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, each with the end id; where
        each text starts, with the total as last entry)."""
        # a copy: Arrow's ascii_lower misreads a slice that starts inside its buffer
        texts = pc.fill_null(texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string()), "")
        if not self.split:
            ids = [np.frombuffer(self.encode(t), "<u4") for t in texts.to_pylist()]
            ids = [np.append(x, np.uint32(END_ID)) for x in ids]
            return (np.concatenate(ids) if ids else np.empty(0, "<u4"),
                    np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]))
        if not (self.mark and pc.any(pc.match_substring(texts, self.mark)).as_py()):
            # the vocabulary does both too, before any merge: fewer distinct chunks, most of them single pieces
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), _WORD_END, r"\1 \2")
        # other white space stays inside a chunk; the encoder skips it there
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        chunks = pc.list_flatten(lists).dictionary_encode()
        per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        encode, known = self.encode, self.known.get
        encoded = [known(c) or encode(c) for c in chunks.dictionary.to_numpy(zero_copy_only=False).tolist()]
        encoded.append(np.array([END_ID], dtype="<u4").tobytes())
        pool = pa.array(encoded, pa.large_binary())
        del encoded
        code = np.full(len(chunks) + len(texts), len(pool) - 1, dtype=np.int32)
        ends = np.cumsum(per_text + 1) - 1
        is_chunk = np.ones(len(code), dtype=bool)
        is_chunk[ends] = False
        code[is_chunk] = chunks.indices.to_numpy(zero_copy_only=False)
        del lists, chunks, is_chunk
        taken = pool.take(pa.array(code))
        upto = np.frombuffer(taken.buffers()[1], "<i8", len(taken) + 1) >> 2
        ids = np.frombuffer(taken.buffers()[2] or b"", "<u4", int(upto[-1]))
        return ids, np.concatenate([[0], upto[ends + 1]])


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, rows) of runs of rows of at most ``SLICE_BYTES`` (or one row)."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > start and held + n > SLICE_BYTES:
            yield start, i - start
            start, held = i, 0
        held += n
    if len(size) > start:
        yield start, len(size) - start


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Short batches put together up to about ``SLICE_BYTES``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= SLICE_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


class TaskRows:
    """Output rows of one task."""

    def __call__(self, keys: pa.Array, ids: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError

    def end(self) -> Iterator[pa.RecordBatch]:
        raise NotImplementedError


def map_ids(docs: DataFrame, path: str, schema: str,
            rows: Callable[[pa.Array, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]] | None = None,
            task: Callable[[], TaskRows] | None = None) -> DataFrame:
    """Encode (id, text) rows and map the ids to output rows.

    ``rows(row ids, token ids, starts)`` yields record batches of ``schema``; ``task``
    makes such a function for each task, whose ``end`` yields last batches.
    Memory per task: one slice of texts with its ids, one Arrow batch, the piece table.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, state = BatchEncoder(path), task() if task else None
        for batch in _gathered(batches):
            for at, n in _slices(batch.column(1)):
                yield from (state or rows)(batch.column(0).slice(at, n), *encode(batch.column(1).slice(at, n)))
                pa.default_memory_pool().release_unused()  # what a slice has used, back to the system
        if state:
            yield from state.end()

    return docs.mapInArrow(run, schema)
