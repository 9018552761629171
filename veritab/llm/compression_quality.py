"""Quality classifier by compression (operator 3).

Two zstandard dictionaries are trained, one on good and one on bad labelled
texts.  A text is compressed in blocks with either; the difference of the two
sizes over the larger one says which kind it resembles.  A logistic model of
that difference alone is the calibrated probability of good, so texts are
ordered by it, whatever their length.

The model is fitted on at most ``TRAINING_ROWS`` labelled texts of each class,
never on held-out ones.  A dictionary is trained on all blocks of the whole
texts of its class, in a task of its own.  Scoring compresses every whole text.

Defined results: a null text scores as an empty one; equal texts score alike;
if the usable labels lack a class, every score is the share of good ones
(one half without labels); a text of any length is compressed whole; an empty table
gives no rows; other columns are not read, and pass through ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import held_out, text_or_empty, training_rows, written
from veritab.llm.models import Logistic, fit_logistic

#: labelled texts of each class that the model is fitted on, at most
TRAINING_ROWS = 4000
DICTIONARY_BYTES = 112_640
BLOCK_BYTES = 4096
LEVEL = 3


class Model(NamedTuple):
    good: bytes
    bad: bytes
    raw: bool  # the dictionaries are plain content: too few samples to train on
    fitted: Logistic | None
    share: float


def _blocks(texts: Iterable[str]) -> Iterator[bytes]:
    for text in texts:
        data = text.encode("utf-8", "surrogatepass")
        for i in range(0, len(data), BLOCK_BYTES):
            yield data[i:i + BLOCK_BYTES]


def _dictionary(samples: list[bytes]) -> bytes | None:
    """A trained dictionary; None if there is too little to train on."""
    import zstandard

    size = min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 10))
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return None


def _of_classes(sample: DataFrame, make: Callable[[list[bytes]], bytes | None]) -> dict[int, bytes | None]:
    """What ``make`` makes of the blocks of each class's texts, a task for each class."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"label": [key[0]], "made": [make(list(_blocks(rows["text"].sort_values())))]})

    texts = sample.where(F.char_length("text") > 0).select("label", "text")
    return {r["label"]: r["made"] and bytes(r["made"])
            for r in texts.groupBy("label").applyInPandas(run, "label int, made binary").collect()}


def measurer(good: bytes, bad: bytes, raw: bool) -> Callable[[str], float]:
    """A function from a text to its normalised size difference."""
    import zstandard

    kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_FULLDICT
    plain = dict(level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False)

    def compressor(content: bytes) -> zstandard.ZstdCompressor:
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=kind)
        dictionary.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=dictionary, **plain)

    as_good, as_bad = compressor(good).compress, compressor(bad).compress

    def measure(text: str) -> float:
        data = text.encode("utf-8", "surrogatepass")
        g = b = 0
        for i in range(0, len(data), BLOCK_BYTES):
            block = data[i:i + BLOCK_BYTES]
            g += len(as_good(block))
            b += len(as_bad(block))
        return (b - g) / max(g, b, 1)

    return measure


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAINING_ROWS,
        id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on labelled rows outside the held-out fifth."""
    sample = written(training_rows(docs, labels, label, rows, id_col, text_col), "quality_training")
    made = _of_classes(sample, _dictionary)
    if len(made) < 2:
        n = {r["label"]: r["count"] for r in sample.where(F.char_length("text") > 0).groupBy("label").count().collect()}
        return Model(b"", b"", True, None, n.get(1, 0) / sum(n.values()) if n else 0.5)
    raw = None in made.values()
    if raw:  # too few texts in one class: both dictionaries are the plain texts, to be compared alike
        made = _of_classes(sample, b"\n".join)
    bad, good = made[0], made[1]
    measured = _measured(sample, good, bad, raw).orderBy("label", "difference").collect()
    x = np.array([[r["difference"]] for r in measured])
    y = np.array([r["label"] for r in measured], dtype=float)
    return Model(good, bad, raw, fit_logistic(x, y), float(y.mean()))


def _measured(sample: DataFrame, good: bytes, bad: bytes, raw: bool) -> DataFrame:
    @F.pandas_udf("double")
    def difference(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        measure = measurer(good, bad, raw)
        for part in texts:
            yield pd.Series([measure(t) for t in part], dtype=float)

    return sample.select("label", difference("text").alias("difference"))


def score(text: Column, model: Model) -> Column:
    """Probability that a text is good."""
    if model.fitted is None:
        return F.lit(float(model.share))

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        measure = measurer(model.good, model.bad, model.raw)
        for part in texts:
            yield pd.Series(model.fitted(np.array([measure(t) for t in part], dtype=float).reshape(len(part), 1)))

    return scored(text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    scored = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                         score(text_or_empty(text_col), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    return docs.where(score(text_or_empty(text_col), model) >= threshold)
