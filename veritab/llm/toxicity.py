"""Toxicity by a weighted finite-state pattern grammar (operator 1).

Words become symbols: insult, threat, target, negation, reported speech, other
word.  Five small weighted transducers read them; each has its own states and
gives every symbol a factor:

* insult: an insult counts, and counts less each time after the first;
* threat: a threat counts little until a target follows it;
* target: what is aimed at a target counts in full, alone it counts less; a
  target after an insult adds to it;
* negation: what follows within three words counts less;
* report: what follows a verb of reporting counts less.

They are composed into one machine (product of the states, product of the
factors), which reads clauses.  A clause's score is the sum of the words'
weights times their factors.  A logistic model makes a text's strongest
clause, the sum over its clauses and their number a probability.

Insults are the listed words and the words and word beginnings that the
labelled texts show to be toxic: counted with Spark on at most
``TRAINING_ROWS`` labelled texts of each class, never on held-out ones, and
kept if they are too frequent there to be chance and stand in several different
contexts (copies of one text show only one).  Scoring reads every whole text once for the lexicon and gives the
clauses around hits to the machine.

Defined results: null and empty texts have no clause and score as texts
without a hit; equal texts score alike; without labels of both classes the
listed words and fixed weights are used; a text of any length is read whole, in
time that grows with its length; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import held_out, text_or_empty, training_rows, written
from veritab.llm.models import Logistic, fit_logistic

#: labelled texts of each class that the lexicon and the model are made from, at most
TRAINING_ROWS = 8000
#: letters of a word beginning, and contexts that an entry needs
STEM, LEAST_CONTEXTS = 5, 3
#: log-odds of a learned entry, at least
LEAST_WEIGHT = 2.0

# listed words (fixed values)
INSULTS = ("idiot idiots moron morons stupid loser losers pathetic worthless disgusting scum trash clown dumb fool "
           "bastard imbecile cretin dummkopf trottel arschloch abschaum imbécile crétin connard ordure "
           "idiota imbécil estúpido estúpida basura escoria").split()
THREATS = ("kill hurt destroy crush strangle stab töten umbringen verprügeln tuer frapper étrangler "
           "matar golpear destruir").split()
TARGETS = ("you your yours yourself he him she her they them their these those du dich dir dein euch ihr sie "
           "tu toi te vous ton votre ils elles tú ti usted ustedes vosotros ellos").split()
NEGATIONS = "not never no don't isn't aren't nicht kein keine nie jamais pas nunca jamás".split()
REPORTS = ("said says say quoted quotes wrote claimed called reported sagte sagt schrieb zitierte "
           "dit disait écrit dijo dice escribió citó").split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: what a symbol weighs before the factors (an insult has its own weight)
WEIGHTS = {THREAT: 2.0, TARGET: 1.0}


# -- transducers -----------------------------------------------------------

class Transducer(NamedTuple):
    """Deterministic weighted transducer over the symbols; state 0 is the start."""
    follow: list[list[int]]    # [state][symbol] -> state
    factor: list[list[float]]  # [state][symbol] -> factor


def transducer(states: int, rule: Callable[[int, int], tuple[int, float]]) -> Transducer:
    cells = [[rule(s, x) for x in range(6)] for s in range(states)]
    return Transducer([[c[0] for c in row] for row in cells], [[c[1] for c in row] for row in cells])


def _insult(s: int, x: int) -> tuple[int, float]:
    return (min(s + 1, 2), (1.0, 0.8, 0.6)[s]) if x == INSULT else (s, 1.0)


def _threat(s: int, x: int) -> tuple[int, float]:
    if x == THREAT:
        return 1, 0.25
    return (0, 2.0) if x == TARGET and s else (s, 1.0)


def _target(s: int, x: int) -> tuple[int, float]:
    aimed, pending = divmod(s, 2)  # a target was seen; something stands without one
    if x == TARGET:
        return 2, float(pending)
    if x in (INSULT, THREAT):
        return (s, 1.0) if aimed else (1, 0.8)
    return s, 1.0


def _negation(s: int, x: int) -> tuple[int, float]:
    if x == NEGATION:
        return 3, 1.0
    return max(s - 1, 0), 0.5 if s and x in (INSULT, THREAT) else 1.0


def _report(s: int, x: int) -> tuple[int, float]:
    return (1, 1.0) if x == REPORT else (s, 0.6 if s else 1.0)


def compose(a: Transducer, b: Transducer) -> Transducer:
    """Both read the same symbols; factors multiply."""
    nb = len(b.follow)
    pairs = list(product(range(len(a.follow)), range(nb)))
    return Transducer([[a.follow[i][x] * nb + b.follow[j][x] for x in range(6)] for i, j in pairs],
                      [[a.factor[i][x] * b.factor[j][x] for x in range(6)] for i, j in pairs])


def grammar() -> Transducer:
    machine = transducer(3, _insult)
    for states, rule in ((2, _threat), (4, _target), (4, _negation), (2, _report)):
        machine = compose(machine, transducer(states, rule))
    return machine


# -- lexicon ---------------------------------------------------------------

class Lexicon(NamedTuple):
    words: dict[str, float]
    stems: dict[str, float]


_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_CLAUSE_END = re.compile(r"[.!?;\n]")


def _listed() -> dict[str, float]:
    return dict.fromkeys(INSULTS, 3.0)


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Words and word beginnings of toxic texts, with their log-odds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}  # entry -> [toxic texts, clean texts, contexts as a bit set]
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _WORD.findall(text.lower())
                contexts: dict[str, int] = {}
                for before, word in zip(["", *words], words):
                    bit = 1 << (len(before) * 7 + sum(map(ord, before))) % 63
                    contexts[word] = contexts.get(word, 0) | bit
                    if len(word) > STEM:
                        stem = word[:STEM] + "*"
                        contexts[stem] = contexts.get(stem, 0) | bit
                for entry, bits in contexts.items():
                    found = seen.setdefault(entry, [0, 0, 0])
                    found[1 - label] += 1
                    found[2] |= bits
                if len(seen) > 300_000:  # hand over; sums follow in Spark
                    yield out(seen)
                    seen = {}
        yield out(seen)

    def out(seen: dict[str, list[int]]) -> pa.RecordBatch:
        columns = list(zip(*seen.values())) or [(), (), ()]
        return pa.record_batch([pa.array(list(seen), pa.string()), *(pa.array(c, pa.int64()) for c in columns)],
                               names=["entry", "toxic", "clean", "contexts"])

    counted = written(
        sample.dropDuplicates(["text"]).select("text", "label")
        .mapInArrow(run, "entry string, toxic bigint, clean bigint, contexts bigint")
        .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
                              F.bit_count(F.bit_or("contexts")).alias("contexts")), "toxicity_entries")
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    # so many toxic texts that not one of all entries would be expected there by chance
    least = max(2, math.ceil(math.log(counted.count() + 1) / math.log((toxic + clean + 1) / (toxic + 1))))
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    found = (counted.where((F.col("toxic") >= least) & (F.col("contexts") >= LEAST_CONTEXTS))
             .where(F.col("toxic") >= 19 * F.col("clean"))
             .withColumn("weight", weight).where(F.col("weight") >= LEAST_WEIGHT)
             .collect())  # entries of a bounded sample
    learned = {r["entry"]: float(r["weight"]) for r in found}
    return Lexicon({**_listed(), **{w: x for w, x in learned.items() if w[-1] != "*"}},
                   {w[:-1]: x for w, x in learned.items() if w[-1] == "*"})


def reader(lexicon: Lexicon) -> Callable[[str], tuple[float, float, float]]:
    """A function from a text to (strongest clause, sum of clauses, clauses with a hit)."""
    import ahocorasick

    machine = grammar()
    follow, factor = machine
    symbol = dict.fromkeys(REPORTS, REPORT) | dict.fromkeys(NEGATIONS, NEGATION) | dict.fromkeys(TARGETS, TARGET)
    symbol |= dict.fromkeys(THREATS, THREAT)
    words, stems = lexicon
    finder = ahocorasick.Automaton()
    for entry in {*words, *THREATS, *stems}:  # a word that is also a stem may go on
        finder.add_word(entry, (len(entry), entry not in stems))
    finder.make_automaton()

    def clause(text: str) -> float:
        state, total = 0, 0.0
        for word in _WORD.findall(text):
            weight = words.get(word) or (stems.get(word[:STEM]) if len(word) > STEM else None)
            x = INSULT if weight else symbol.get(word, OTHER)
            total += (weight or WEIGHTS.get(x, 0.0)) * factor[state][x]
            state = follow[state][x]
        return total

    def read(text: str) -> tuple[float, float, float]:
        low = text.lower()
        done, scores = -1, []
        for end, (n, whole) in finder.iter(low):
            start = end - n + 1
            if start <= done or start and low[start - 1].isalpha() or whole and low[end + 1:end + 2].isalpha():
                continue
            # no clause starts before the end of the last one
            first = max(done, *(low.rfind(c, done + 1, start) for c in ".!?;\n")) + 1
            close = _CLAUSE_END.search(low, end + 1)
            done = close.start() if close else len(low)
            scores.append(clause(low[first:done]))
        return max(scores, default=0.0), sum(scores), float(len(scores))

    return read


# -- model -----------------------------------------------------------------

class Model(NamedTuple):
    lexicon: Lexicon
    fitted: Logistic


#: used without labels of both classes: even at one full insult
DEFAULT = Logistic(np.zeros(3), np.ones(3), np.array([1.0, 0.0, 0.0, -2.5]))


def _features(raw: np.ndarray) -> np.ndarray:
    return np.column_stack([raw[:, 0], np.log1p(raw[:, 1]), np.log1p(raw[:, 2])])


def _raw(text: Column, lexicon: Lexicon) -> Column:
    @F.pandas_udf("array<double>")
    def read_all(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        read = reader(lexicon)
        for part in texts:
            yield pd.Series([list(read(t)) for t in part])

    return read_all(text)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAINING_ROWS,
        id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn the lexicon and the calibration from labelled rows outside the held-out fifth."""
    sample = written(training_rows(docs, labels, label, rows, id_col, text_col), "toxicity_training")
    if sample.select("label").distinct().count() < 2:
        return Model(Lexicon(_listed(), {}), DEFAULT)
    lexicon = learn_lexicon(sample)
    read = sample.select("label", _raw(F.col("text"), lexicon).alias("raw")).orderBy("label", "raw").collect()
    x = _features(np.array([r["raw"] for r in read]))
    y = np.array([r["label"] for r in read], dtype=float)
    return Model(lexicon, fit_logistic(x, y))


def score(text: Column, model: Model) -> Column:
    """Probability that a text is toxic."""
    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        read = reader(model.lexicon)
        for part in texts:
            yield pd.Series(model.fitted(_features(np.array([read(t) for t in part]).reshape(len(part), 3))))

    return scored(text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    scored = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                         score(text_or_empty(text_col), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
