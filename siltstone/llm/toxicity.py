"""Toxicity scores by a factorisation machine over hashed terms.

A term is a lower-cased word without outer punctuation, or one of its prefixes of 4, 5 and 6 letters, hashed into
2**18 slots; a document has a slot or has it not. The machine is

    score = sigmoid(w0 + sum_i w_i + 1/2 sum_f ((sum_i v_if)^2 - sum_i v_if^2))

over the document's slots, so that pairs of slots have a weight of their own. It is fitted on the driver with AdaGrad on
at most ``sample`` labelled documents for each label, taken by the smallest hash of their ids; that is the documented
bound. Class shares come from all labels that may be learnt from. Slots get a weight if their presence tells the labels
apart in the sample: likelihood-ratio statistic (as its root) of at least ``least``, which seven documents of one label
and none of the other reach, and three documents at least. They are counted and chosen in Spark; the driver gets at most
``kept`` of them, and of the sample only these, at most ``entries`` in all: the most telling come first.

Defined cases: a null or empty text scores as a document without terms, a text of any length by all its terms. Labels that
are null are ignored, labels that contradict each other count as toxic, and of texts that share a labelled id the one
whose slots are the least in order is learnt from. With one class, no labels or no documents (an empty table) every score
is the smoothed share of toxic labels. Rows that repeat an id are scored one by one. Ties among slots go to the smaller
slot. Other columns are ignored, whatever their names are.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import cut, steps, table, tidy

SLOTS = 1 << 18
PREFIXES = (4, 5, 6)
OUTER = ".,;:!?\"'()[]{}|*#%&-_/\\<>«»„“”’…"
CACHE = 200_000


def slots_of(word: str) -> list[int]:
    """Hashed slots of one white-space separated token, in lower case."""
    core = word.strip(OUTER)
    if not core:
        return []
    terms = [f"={core}"] + [f"^{core[:n]}" for n in PREFIXES if len(core) >= n]
    return [zlib.crc32(t.encode()) & (SLOTS - 1) for t in terms]


def document_slots(text: str | None) -> list[int]:
    out: set[int] = set()
    for word in set((text or "").lower().split()):
        out.update(slots_of(word))
    return sorted(out)


@dataclass
class Machine:
    """Weights of the kept slots; ``index`` maps a slot to its row in ``linear`` and ``factors``."""

    bias: float = 0.0
    index: dict[int, int] = field(default_factory=dict)
    linear: np.ndarray = field(default_factory=lambda: np.zeros(0))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))

    def logit(self, rows: np.ndarray) -> float:
        if not len(rows):
            return self.bias
        v = self.factors[rows]
        total = v.sum(axis=0)
        return self.bias + float(self.linear[rows].sum()) + 0.5 * float((total * total - (v * v).sum(axis=0)).sum())


def fit(documents: Sequence[Sequence[int] | np.ndarray], labels: list[int], share: float, rank: int = 4, epochs: int = 12, rate: float = 0.1, decay: float = 1e-4) -> Machine:
    """Fit on slots and labels; ``share`` is the share of label 1 among all labels, which sets the bias."""
    y = np.array(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        return Machine(bias=math.log(share / (1 - share)))
    chosen = np.unique(np.concatenate([np.array(s, dtype=int) for s in documents]))
    rows = [np.searchsorted(chosen, np.array(s, dtype=int)) for s in documents]
    rng = np.random.default_rng(7)
    m = Machine(0.0, {int(s): i for i, s in enumerate(chosen)}, np.zeros(len(chosen)), rng.normal(0, 0.02, (len(chosen), rank)))
    g_bias, g_linear, g_factors = 1e-6, np.full(len(chosen), 1e-6), np.full((len(chosen), rank), 1e-6)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            r = rows[i]
            error = 1 / (1 + math.exp(-max(-30.0, min(30.0, m.logit(r))))) - y[i]
            g_bias += error * error
            m.bias -= rate * error / math.sqrt(g_bias)
            if len(r):
                v = m.factors[r]
                step = error + decay * m.linear[r]
                g_linear[r] += step * step
                m.linear[r] -= rate * step / np.sqrt(g_linear[r])
                step = error * (v.sum(axis=0) - v) + decay * v
                g_factors[r] += step * step
                m.factors[r] -= 0.3 * rate * step / np.sqrt(g_factors[r])
    m.bias += math.log(share / (1 - share)) - math.log(y.mean() / (1 - y.mean()))
    return m


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0


def _telling(found: DataFrame, least: float, kept: int) -> DataFrame:
    """(slot, n, g): slots of the sample (label_id, y, slots) that tell labels apart, the ``kept`` best by ``g``."""
    sizes = found.agg(F.coalesce(F.sum("y"), F.lit(0)), F.count(F.lit(1))).first()
    ones, all_ = float(sizes[0]), float(sizes[1])
    counts = found.select("y", F.explode("slots").alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("n1")).filter("n >= 3")
    n, n1 = F.col("n").cast("double"), F.col("n1").cast("double")
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))
    g = F.lit(0.0)
    for here, size in ((n1, ones), (n - n1, all_ - ones)):
        g = g + part(here, n * size / all_) + part(F.lit(size) - here, (F.lit(all_) - n) * size / all_)
    root = F.sqrt(F.greatest(2 * g, F.lit(0.0)))
    return counts.select("slot", "n", root.alias("g")).filter(F.col("g") >= least).orderBy(F.col("g").desc(), "slot").limit(kept)


def train(docs: DataFrame, labels: DataFrame, sample: int = 4000, least: float = 3.0, kept: int = 20_000, entries: int = 6_000_000, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Machine:
    """Fit on labelled rows that are not held out: at most ``sample`` of either label."""
    usable = labels.select(labels[id_column].cast("long").alias("label_id"), labels[label_column].cast("int").alias("y")).filter("label_id IS NOT NULL AND y IS NOT NULL")
    usable = usable.filter(~held_out(F.col("label_id"))).groupBy("label_id").agg(F.max("y").alias("y"))
    ones, all_ = usable.agg(F.coalesce(F.sum("y"), F.lit(0)), F.count(F.lit(1))).first()
    share = (ones + 0.5) / (all_ + 2)  # a quarter without labels
    parts = [usable.filter(F.col("y") == y).orderBy(F.xxhash64("label_id"), "label_id").limit(sample) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1])

    @F.pandas_udf("array<int>")
    def slots(texts: pd.Series) -> pd.Series:
        return pd.Series([document_slots(t) for t in texts], dtype=object)

    with steps(docs.sparkSession):
        # At most 2 * sample ids.
        texts = docs.select(docs[id_column].cast("long").alias("label_id"), docs[text_column].alias("label_text")).join(F.broadcast(chosen), "label_id")
        found = cut(texts.select("label_id", "y", slots("label_text").alias("slots")).groupBy("label_id").agg(F.max("y").alias("y"), F.min("slots").alias("slots")))
        both = {r["y"] for r in found.select("y").distinct().collect()}
        if len(both) < 2:
            return fit([[]] * len(both), [*both], share)
        best, total = [], 0
        for r in _telling(found, least, kept).collect():
            total += r["n"]
            if total > entries:
                break
            best.append(r["slot"])
        known = np.zeros(SLOTS, dtype=bool)
        known[best] = True

        @F.pandas_udf("binary")
        def packed(rows: pd.Series) -> pd.Series:
            return pd.Series([np.asarray(r, dtype="<i4")[known[np.asarray(r, dtype=int)]].tobytes() for r in rows], dtype=object)

        rows = found.select("label_id", "y", packed("slots").alias("slots")).collect()
        rows.sort(key=lambda r: r["label_id"])
        return fit([np.frombuffer(r["slots"], dtype="<i4") for r in rows], [r["y"] for r in rows], share)


class Scorer:
    """Scores whole texts with a machine; what a token adds is remembered, up to ``CACHE`` tokens."""

    def __init__(self, machine: Machine):
        self.machine, self.seen = machine, {}

    def rows(self, word: str) -> tuple[int, ...]:
        index = self.machine.index
        found = tuple(index[s] for s in slots_of(word) if s in index)
        if len(self.seen) >= CACHE:
            self.seen.clear()
        self.seen[word] = found
        return found

    def score(self, text: str | None) -> float:
        seen, rows, hits = self.seen, self.rows, set()
        for word in set((text or "").lower().split()):
            found = seen.get(word)
            if found is None:
                found = rows(word)
            if found:
                hits.update(found)
        x = self.machine.logit(np.fromiter(sorted(hits), dtype=int, count=len(hits)))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def score_column(machine: Machine, text: Column) -> Column:
    """The score of a text column; the machine, of bounded size, travels with the function."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(machine)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype=float)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from tidy(run)(batches)

    return score(text)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score, from labels of documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    machine = train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(machine, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
