"""Toxicity by weak supervision.

Voters look at a text: one for each stem (start of words) that labelled toxic texts use, once or repeatedly,
far more than others do, and a few for patterns of writing. The label of a sampled text is one more voter, as labels can be wrong. A generative model
of all votes gives each voter's accuracies, finds which voters depend on each other, gives such a group one vote
and yields for every sampled text the probability of being toxic. A linear classifier fitted to these
probabilities scores every text of the corpus.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Forest, chunks, stored, with_made

#: At most so many labelled rows are fitted: those with the lowest hashes of their ids.
SAMPLE_ROWS = 8_000
#: Stems that become voters, of those that pass the two limits below, by how much they tell.
LEXICON_STEMS = 40
#: Letters of a stem; a word of so few letters is one itself.
STEM_LETTERS = range(3, 9)
#: A stem counts from its first or from its second time in a text on, whichever tells more.
TIMES = (1, 2)
#: A voter's stem is in at least this share of the toxic texts and this many times as likely there.
LEAST_SHARE = 0.02
LEAST_RATIO = 6.0
#: Correlation within a class from which two voters count as dependent.
DEPENDENT = 0.5
ROUNDS = 40

WORD = regex.compile(r"\p{L}+")
#: Patterns of writing, each a voter: upper-case letters and exclamation marks by share, filler signs.
PATTERNS = ("shouting", "exclaiming", "signs")
PATTERN_LIMITS = (0.5, 0.02, 0.05)


@dataclass(frozen=True)
class LabelModel:
    """Votes given the class. ``chances[g, y, v]``: group g of voters says v (0: against, 1: nothing, 2: for) in class y."""

    prior: float
    chances: np.ndarray
    groups: list[list[int]]
    correlations: np.ndarray

    @property
    def weights(self) -> np.ndarray:
        """What a voter counts for: its share of the one vote of its group."""
        out = np.zeros(len(self.correlations))
        for g in self.groups:
            out[g] = 1 / len(g)
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return _posterior(_merged(votes, self.groups), self.prior, self.chances)


def _merged(votes: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    """One vote for each group: what most of its voters say."""
    return np.stack([np.sign(votes[:, g].sum(axis=1)) for g in groups], axis=1).astype(int)


def _posterior(votes: np.ndarray, prior: float, chances: np.ndarray) -> np.ndarray:
    logs = np.log(chances)
    odds = np.full(len(votes), math.log(prior / (1 - prior)))
    for j in range(votes.shape[1]):
        odds += (logs[j, 1] - logs[j, 0])[votes[:, j] + 1]
    return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def _expect_and_maximise(votes: np.ndarray, start: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    marks, n, post = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float), len(votes), start.astype(float)
    for _ in range(ROUNDS):
        counts = np.einsum("cn,nvm->vcm", np.stack([1 - post, post]), marks) + 0.1
        chances = counts / counts.sum(axis=2, keepdims=True)
        prior = float(np.clip(post.mean(), 1 / (n + 2), 1 - 1 / (n + 2)))
        before, post = post, _posterior(votes, prior, chances)
        if np.abs(post - before).max() < 1e-6:
            break
    return prior, chances, post


def fit_label_model(votes: np.ndarray, start: np.ndarray) -> LabelModel:
    """Expectation maximisation over votes (-1, 0, 1; a column for each voter) from first guesses ``start``.

    A first run takes voters as independent and shows how they correlate within a class. Voters that depend on
    each other then become groups with one vote each, for which the second run gives the accuracies.
    """
    voters = votes.shape[1]
    _, _, post = _expect_and_maximise(votes, start)
    cov = np.zeros((voters, voters))
    for p in (1 - post, post):
        centred = votes - (p[:, None] * votes).sum(axis=0) / max(p.sum(), 1e-9)
        cov += (p[:, None] * centred).T @ centred
    scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    correlations = cov / scale[:, None] / scale[None, :]
    forest = Forest()
    for i in range(voters):
        for j in range(i, voters):
            if i == j or correlations[i, j] >= DEPENDENT:
                forest.root(i)
                forest.join(i, j)
    groups: dict[int, list[int]] = {}
    for i in range(voters):
        groups.setdefault(forest.root(i), []).append(i)
    prior, chances, _ = _expect_and_maximise(_merged(votes, list(groups.values())), start)
    return LabelModel(prior, chances, list(groups.values()), correlations)


def fit_linear(features: np.ndarray, target: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Logistic regression on probabilities, by Newton steps with a quadratic penalty; the last weight is the bias."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    hold = np.full(x.shape[1], penalty * max(len(x), 1) / 10)
    hold[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + hold * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(hold + 1e-9)
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class ToxicityModel:
    stems: list[tuple[str, int]]
    weights: np.ndarray
    labels: LabelModel | None = None
    voters: list[str] = field(default_factory=list)


def _automaton(stems: list[tuple[str, int]]):
    found = ahocorasick.Automaton()
    for i, (stem, _) in enumerate(stems):
        found.add_word(stem, (i, len(stem)))
    if stems:
        found.make_automaton()
    return found


def _observe(text: str, automaton, n_stems: int) -> tuple[np.ndarray, np.ndarray]:
    """How many words of the whole text start with each stem, and the shares of the patterns."""
    counts = np.zeros(n_stems)
    low = text.lower()
    if n_stems:
        for end, (i, length) in automaton.iter(low):
            start = end + 1 - length
            if not (start and low[start - 1].isalpha()):
                counts[i] += 1
    raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256) if text else np.zeros(256)
    upper, lower = raw[65:91].sum(), raw[97:123].sum()
    signs = raw[[35, 36, 37, 38, 42]].sum()
    size = max(raw.sum(), 1)
    return counts, np.array([upper / max(upper + lower, 1), raw[33] / size, signs / size])


def _hits(counts: np.ndarray, stems: list[tuple[str, int]]) -> np.ndarray:
    return counts // np.array([times for _, times in stems]) if stems else counts


def _features(counts: np.ndarray, patterns: np.ndarray, stems: list) -> np.ndarray:
    """Which stems a text holds often enough, how often in all, how many of them, and the patterns."""
    hits = _hits(counts, stems)
    total = hits.sum(axis=1, keepdims=True)
    kinds = (hits > 0).sum(axis=1, keepdims=True)
    return np.hstack([np.minimum(hits, 1), np.minimum(total, 2), np.minimum(np.log1p(total), 3), np.minimum(kinds, 6) / 3, patterns])


def _votes(counts: np.ndarray, patterns: np.ndarray, stems: list) -> np.ndarray:
    """Stems vote for when present and else abstain, so do patterns; no stem at all is a vote against."""
    hits = _hits(counts, stems)
    total = hits.sum(axis=1)
    none = np.where(total == 0, -1, np.where(total > 1, 1, 0))
    return np.hstack([(hits > 0).astype(int), (patterns >= np.array(PATTERN_LIMITS)).astype(int), none[:, None]])


def _stem_counts(sample: DataFrame) -> DataFrame:
    """Labelled texts of either class that hold a stem once or twice; each task counts first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clean, toxic = Counter(), Counter()
        for batch in chunks(batches):
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = Counter(WORD.findall((text or "").lower()))
                stems: Counter = Counter()
                for w, n in words.items():
                    for k in STEM_LETTERS:
                        if k <= len(w):
                            stems[w[:k]] += n
                (toxic if label else clean).update((p, t) for p, n in stems.items() for t in TIMES if n >= t)
        keys = list(clean.keys() | toxic.keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.int32()),
                pa.array([clean[k] for k in keys], pa.int64()),
                pa.array([toxic[k] for k in keys], pa.int64()),
            ],
            ["stem", "times", "clean", "toxic"],
        )

    counts = sample.select("text", "label").mapInArrow(work, "stem string, times int, clean long, toxic long")
    return counts.groupBy("stem", "times").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def learn_lexicon(sample: DataFrame, clean_rows: int, toxic_rows: int) -> list[tuple[str, int]]:
    """The stems that tell most (by likelihood ratio) of those that toxic texts use far more often.

    Of stems that start with each other only the first is kept.
    """
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    ratio = (a / (toxic_rows + 1)) / (b / (clean_rows + 1))
    both = (a + b) / (toxic_rows + clean_rows + 2)
    tells = a * F.log(a / (toxic_rows + 1) / both) + b * F.log(b / (clean_rows + 1) / both)
    kept = _stem_counts(sample).filter((F.col("toxic") >= max(3, LEAST_SHARE * toxic_rows)) & (ratio >= LEAST_RATIO))
    ranked = kept.orderBy(tells.desc(), F.length("stem").desc(), "stem", "times").limit(50 * LEXICON_STEMS).collect()
    stems: list[tuple[str, int]] = []
    for row in ranked:
        if not any(row.stem.startswith(s) or s.startswith(row.stem) for s, _ in stems):
            stems.append((row.stem, row.times))
    return stems[:LEXICON_STEMS]


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fit on at most ``sample_rows`` rows of ``labels`` (doc_id, toxic) whose documents are there.

    Rows without id or label are passed over; of repeated ids the higher label counts. With no labelled rows,
    or only one kind, there are no voters, and every text scores the share of toxic labels.
    """
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most sample_rows rows
    sample = stored(texts.select("doc_id", "text", (F.col("label") > 0).alias("label")))
    rows = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    clean, toxic = rows.get(False, 0), rows.get(True, 0)
    if not clean or not toxic:
        share = (toxic + 0.5) / (clean + toxic + 1) if clean + toxic else 0.0
        bias = math.log(share / (1 - share)) if share else -30.0
        return ToxicityModel([], np.array([0.0] * (3 + len(PATTERNS)) + [bias]))
    stems = learn_lexicon(sample, clean, toxic)
    seen = _observed(sample.select("doc_id", "text", "label"), stems).toArrow()
    order = np.argsort(seen["doc_id"].to_numpy(), kind="stable")
    counts = np.array(seen["counts"].to_pylist(), float).reshape(len(order), -1)[order]
    patterns = np.array(seen["patterns"].to_pylist(), float).reshape(len(order), -1)[order]
    label = seen["label"].to_numpy().astype(float)[order]
    votes = np.hstack([_votes(counts, patterns, stems), np.where(label > 0, 1, -1)[:, None]])
    start = np.clip(0.1 + 0.4 * label + 0.4 * (_hits(counts, stems).sum(axis=1) > 0), 0, 1)
    model = fit_label_model(votes, start)
    weights = fit_linear(_features(counts, patterns, stems), model.posterior(votes))
    voters = [*(s for s, _ in stems), *PATTERNS, "no stem", "label"]
    return ToxicityModel(stems, weights, model, voters)


def _observed(rows: DataFrame, stems: list[tuple[str, int]]) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(stems)
        for batch in chunks(batches):
            seen = [_observe(t or "", automaton, len(stems)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([s[0] for s in seen], pa.list_(pa.float64())),
                    pa.array([s[1] for s in seen], pa.list_(pa.float64())),
                ],
                ["doc_id", "label", "counts", "patterns"],
            )

    return rows.mapInArrow(work, "doc_id long, label boolean, counts array<double>, patterns array<double>")


def score(docs: DataFrame, model: ToxicityModel, name: str = "toxicity") -> DataFrame:
    """All columns of ``docs`` with ``name``, the probability of being toxic; a null text scores as empty.

    One narrow stage over whole texts; the model holds at most ``LEXICON_STEMS`` stems.
    """
    stems, weights = model.stems, model.weights

    def make(texts: list) -> dict:
        automaton = _automaton(stems)
        seen = [_observe(t or "", automaton, len(stems)) for t in texts]
        x = _features(np.array([s[0] for s in seen]), np.array([s[1] for s in seen]), stems)
        return {name: 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))}

    return with_made(docs, ["text"], make, {name: T.DoubleType()})
