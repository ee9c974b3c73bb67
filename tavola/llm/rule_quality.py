"""Quality classifier: a sparse ensemble of rules over text statistics.

1. ``with_statistics`` computes a fixed set of statistics of every whole text.
2. On a bounded sample of labelled documents, boosted shallow trees are grown; every path from
   a root to a node is a rule, a conjunction of comparisons of statistics with thresholds.
3. A logistic regression with an L1 penalty weighs the rules; most get weight zero and go.
4. ``RuleModel.score`` is a Spark column: the logistic function of the weighted sum of the rules
   that remain. Scoring is plain expressions over the statistics.

Defined cases: a null text is the empty text, all of whose statistics are 0; statistics are of whole
texts, whatever their length; labels that are null or not 0 or 1 are not learnt from, of contradicting
labels of a document the smaller counts, and of several texts of one id the smallest, so a rerun fits
the same model; every row is scored, repeated ones alike; a score of just 0.5 is predicted as 1; without
rows of both labels the model has no rules and scores the share of label 1
(0.5 without labels); an empty table gives an empty result; statistics are in columns that begin
with ``stat_`` and replace columns of that name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tavola.llm._shared import on_workers, table

#: The most labelled documents that a model is fitted on (those of the smallest hash).
SAMPLE = 12_000
TREES, DEPTH, BINS, LEAST, RATE = 40, 3, 32, 20, 0.2
PENALTY, STEPS = 0.002, 400

_UPPER, _LOWER, _DIGITS = (bytes(range(a, b + 1)) for a, b in ((65, 90), (97, 122), (48, 57)))
_SIGNS = b"!\"#$%&()*+/:;<=>?@[\\]^_`{|}~"
_STOPS = b".,"

STATISTICS = (
    "words", "word_bytes", "upper", "digits", "signs", "stops", "distinct_words", "same_as_before",
    "same_two_before", "longest_word", "lines", "distinct_lines", "longest_line", "sign_words",
)


def statistics(text: str | None) -> tuple[float, ...]:
    """The values of STATISTICS for one text: words; bytes a word; of all bytes the share of
    capitals, digits, signs and stops; distinct words, words equal to the one before and to the
    second before, as shares of the words; bytes of the longest word; lines; distinct lines as a
    share of the lines; the longest line's share of the text; signs a word."""
    b = (text or "").encode()
    n = len(b)
    words = b.lower().split()
    if not words:
        return (0.0,) * len(STATISTICS)
    w = len(words)
    count = lambda chars: n - len(b.translate(None, chars))
    lines = [x for x in b.split(b"\n") if x]
    signs = count(_SIGNS)
    return (
        float(w), n / w, count(_UPPER) / n, count(_DIGITS) / n, signs / n, count(_STOPS) / n,
        len(set(words)) / w, sum(map(eq, words, words[1:])) / w, sum(map(eq, words, words[2:])) / w,
        float(max(map(len, words))), float(len(lines)), len(set(lines)) / len(lines),
        max(map(len, lines)) / n, signs / w,
    )


def with_statistics(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (else all) columns of ``df`` and the statistics of its ``text``."""
    names = [f"stat_{s}" for s in STATISTICS]
    keep = [c for c in (df.columns if keep is None else keep) if c not in names]
    read = df.select(*dict.fromkeys([*keep, "text"]))
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(s, T.DoubleType()) for s in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                values = np.array([statistics(t) for t in b["text"].to_pylist()]).reshape(-1, len(STATISTICS))
                columns = [*(b[c] for c in keep), *(pa.array(values[:, k]) for k in range(len(STATISTICS)))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])

    return on_workers(read).mapInArrow(run, schema)


#: (statistic's place, True for "greater than", threshold)
Condition = tuple[int, bool, float]


def _simplified(path: list[Condition]) -> tuple[Condition, ...]:
    """Per statistic and side only the tightest comparison."""
    tight: dict[tuple[int, bool], float] = {}
    for k, above, t in path:
        old = tight.get((k, above))
        tight[k, above] = t if old is None else (max(old, t) if above else min(old, t))
    return tuple(sorted((k, above, t) for (k, above), t in tight.items()))


def _holds(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for k, above, t in rule:
        out &= (x[:, k] > t) if above else (x[:, k] <= t)
    return out


def grow_rules(x: np.ndarray, y: np.ndarray, seed: int = 0) -> list[tuple[Condition, ...]]:
    """Rules of all nodes of boosted trees, each grown on a random half of the rows."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], 1)
    margin = np.zeros(len(y))
    rules: dict[tuple[Condition, ...], None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        rows = rng.permutation(len(y))[: max(LEAST, len(y) // 2)]
        nodes = [(rows, np.arange(len(y)), [])]
        for _ in range(DEPTH):
            following = []
            for own, every, path in nodes:
                best = _best_split(binned[own], grad[own], hess[own], cuts)
                if best is None:
                    margin[every] += RATE * grad[own].sum() / (hess[own].sum() + 1.0)
                    continue
                k, at = best
                for above in (False, True):
                    side = lambda r: r[(binned[r, k] > at) == above]  # noqa: B023, E731
                    branch = [*path, (k, above, float(cuts[k][at]))]
                    rules[_simplified(branch)] = None
                    following.append((side(own), side(every), branch))
            nodes = following
        for own, every, _ in nodes:
            margin[every] += RATE * grad[own].sum() / (hess[own].sum() + 1.0)
    return list(rules)


def _best_split(binned, grad, hess, cuts) -> tuple[int, int] | None:
    """(statistic, cut) of the largest second-order gain with LEAST rows on both sides."""
    if len(grad) < 2 * LEAST:
        return None
    best, found = 1e-3, None
    whole = grad.sum() ** 2 / (hess.sum() + 1.0)
    for k, c in enumerate(cuts):
        if not len(c):
            continue
        sums = [np.bincount(binned[:, k], w, len(c) + 1).cumsum()[:-1] for w in (grad, hess, None)]
        g, h, n = sums
        gain = g**2 / (h + 1.0) + (grad.sum() - g) ** 2 / (hess.sum() - h + 1.0) - whole
        gain[(n < LEAST) | (len(grad) - n < LEAST)] = -np.inf
        at = int(gain.argmax())
        if gain[at] > best:
            best, found = gain[at], (k, at)
    return found


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """(weights, intercept) of an L1-penalised logistic regression, by accelerated proximal
    gradient steps; the intercept is not penalised."""
    a = np.column_stack([a.astype(np.float64), np.ones(len(a))])
    lipschitz = np.linalg.norm(a.T @ a, 2) / (4 * len(a))
    w = z = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(STEPS):
        step = z - a.T @ (1 / (1 + np.exp(-(a @ z))) - y) / len(a) / lipschitz
        new = np.sign(step) * np.maximum(np.abs(step) - penalty / lipschitz, 0)
        new[-1] = step[-1]
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        w, z = new, new + (before - 1) / t * (new - w)
    return w[:-1], float(w[-1])


@dataclass
class RuleModel:
    intercept: float = 0.0
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, seed: int = 0) -> RuleModel:
        """Deterministic for the same rows in the same order."""
        if len(y) == 0 or y.min() == y.max():
            share = float(y.mean()) if len(y) else 0.5
            return cls(float(np.log((share + 1e-3) / (1 - share + 1e-3))))
        rules = grow_rules(x, y, seed)
        if not rules:
            return cls(float(np.log(y.mean() / (1 - y.mean()))))
        weights, intercept = lasso_logistic(np.column_stack([_holds(r, x) for r in rules]), y)
        return cls(intercept, [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w != 0])

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The same score by numpy, for tests."""
        margin = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            margin += weight * _holds(rule, x)
        return 1 / (1 + np.exp(-margin))

    def score(self) -> Column:
        """The score as a column over the statistics."""
        margin = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for k, above, t in rule:
                c = F.col(f"stat_{STATISTICS[k]}")
                holds = holds & ((c > t) if above else (c <= t))
            margin = margin + F.when(holds, F.lit(weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-margin))


def held_out(doc_id: Column) -> Column:
    """A third of the documents, never learnt from: CRC-32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 0) -> RuleModel:
    """Fits on at most ``sample`` labelled documents outside the held-out third."""
    usable = (
        labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & F.col("label_id").isNotNull() & ~held_out(F.col("label_id")))
        .groupBy("label_id").agg(F.min("y").alias("y"))
        .orderBy(F.xxhash64("label_id", F.lit(seed)), "label_id").limit(sample)
    )
    own = docs.select("doc_id", "text").join(F.broadcast(usable), F.col("doc_id") == F.col("label_id"))
    own = own.groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    rows = with_statistics(own, ["doc_id", "y"]).toPandas().sort_values("doc_id")
    x = rows[[f"stat_{s}" for s in STATISTICS]].to_numpy(float)
    return RuleModel.fit(x, rows["y"].to_numpy(float), seed)


def scored(docs: DataFrame, model: RuleModel, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with score and predicted, the statistics gone again."""
    d = with_statistics(docs, keep)
    names = [c for c in d.columns if not c.startswith("stat_") and c not in ("score", "predicted")]
    d = d.select(*names, model.score().alias("score"))
    return d.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    out = scored(docs, model, ["doc_id"]).withColumn("doc_id", F.col("doc_id").cast("long"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
