"""Toxicity by weak supervision.

Voters are words (lexicon) and word beginnings (patterns) that labelled toxic documents hold oftener than labelled
clean ones, each at several counts, and the share of all such words in a text. A generative label model with a latent
label estimates, from the votes alone, every voter's firing rates in either class and the voters' correlations within a
class; a voter that follows another adds little. Labels choose the voters, and give the share of the class and the
weights that estimation begins with; no row's own label enters its posterior. The posterior labels train a linear
classifier, which scores every document.
"""

from __future__ import annotations

import re
from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_crc, filter_batches, materialize, sized_broadcast, texts

#: Bounds of the model: labelled rows it is fitted on (about; chosen by a hash of doc_id), and voters.
TRAIN_ROWS, VOTERS = 12_000, 160
PREFIXES = range(3, 10)
COUNTS = (1, 2, 4)
#: Voters' words in a hundred words from which a text's share of them is another vote.
SHARES = (0.2, 0.5, 1, 2, 4)
#: Least likelihood ratio statistic of a voter: about what the best of a million chance candidates reaches.
TELLING = 30
#: Correlation within a class from which voters can hang on one another.
RELATED = 0.02
#: Log odds of the label that any voter stands for when estimation begins, before its rarity.
TRUST = 3.0
_LETTERS = re.compile(r"[^\W\d_]+")
_CACHE = 300_000


def _beginnings(token: str) -> set[str]:
    out = set()
    for w in _LETTERS.findall(token):
        out.update(w[:k] for k in PREFIXES if len(w) >= k)
        out.add(w + "$")
    return out


class Voters:
    """Counts each voter's words in a text."""

    def __init__(self, names: list[str]):
        self.names = names
        self.of = {n: i for i, n in enumerate(names)}
        self.cache: dict[str, tuple[int, ...]] = {}

    def hits(self, token: str) -> tuple[int, ...]:
        got = tuple(self.of[b] for b in _beginnings(token) if b in self.of)
        if len(self.cache) > _CACHE:
            self.cache.clear()
        if len(token) < 200:
            self.cache[token] = got
        return got

    def count(self, text: str) -> tuple[dict[int, int], int]:
        found: dict[int, int] = {}
        words, cache, total = Counter(text.lower().split()), self.cache, 0
        for w, n in words.items():
            total += n
            got = cache.get(w)
            if got is None:
                got = self.hits(w)
            for i in got:
                found[i] = found.get(i, 0) + n
        return found, total


def features(found: dict[int, int], words: int, voters: int) -> np.ndarray:
    x = np.zeros(voters + 3)
    for i, n in found.items():
        x[i] = np.log1p(n)
    hits = sum(found.values())
    x[voters:] = np.log1p(hits), np.log1p(100.0 * hits / max(words, 20)), np.log1p(len(found))
    return x


def vote_matrix(n: np.ndarray, words: np.ndarray) -> np.ndarray:
    """n: [text, voter] counts of words. One vote for each voter and range of counts, and for each range of shares."""
    share = 100.0 * n.sum(1, keepdims=True) / np.maximum(words, 20)[:, None]
    ranges = [(x >= lo) & (x < hi) for x, cuts in ((n, COUNTS), (share, SHARES)) for lo, hi in zip(cuts, (*cuts[1:], np.inf))]
    return np.concatenate(ranges, 1).astype(float)


def _odds(rows: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    return {b: log((t + 0.5) / (toxic + 1)) - log((c + 0.5) / (clean + 1)) for b, t, c in rows}


def choose_voters(rows: list[tuple[str, int, int]], toxic: int, clean: int, most: int = VOTERS) -> list[str]:
    """rows: (word beginning, toxic documents, clean documents). The most telling ones, without near repetitions."""

    def telling(t, c):  # the likelihood ratio statistic of the two shares
        n, p = toxic + clean, (t + c) / (toxic + clean)
        s = 0.0
        for k, m in ((t, toxic), (c, clean)):
            for o, e in ((k, m * p), (m - k, m * (1 - p))):
                s += 2 * o * log(o / e) if o and e else 0.0
        return s if n else 0.0

    odds = _odds(rows, toxic, clean)
    ranked = sorted(((telling(t, c), len(b), b) for b, t, c in rows if odds[b] > log(3)), key=lambda x: (-x[0], -x[1], x[2]))
    chosen: list[str] = []
    for score, _, b in ranked:
        if len(chosen) == most or score < TELLING:
            break
        kin = [c for c in chosen if b.startswith(c) or c.startswith(b) or (c + "$") == b]
        if all(odds[b] > odds[c] + 1.0 and b.startswith(c) for c in kin):
            chosen.append(b)
    return chosen


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class LabelModel:
    """Posteriors of a latent label from votes alone; no row's own label is seen.

    The label draws the votes; within a class a voter also depends on one other voter, its parent in the tree of the
    strongest conditional mutual information. Expectation maximisation estimates the rates at which a voter fires by
    class (`rate`: its accuracies), its rates given its parent (`given`), and the voters' correlations within a class
    (`correlation`; two voters of less than RELATED don't hang on one another): a copy of its parent adds nothing. The
    prior share of the label is given. With `abstain`, for voters that don't apply to every row (words of one language),
    a voter that doesn't fire says nothing, neither of the label nor of the voters that hang on it (a row that isn't
    silent is hardly ever clean, so that would explain their votes away), and that none fires is a vote of its own; else
    not firing counts as firing does. Estimation begins with each voter standing for the label, rarer ones for more, and
    these first posteriors keep a share `anchor` in all later ones' estimates: a single independent voter tells no
    classes apart.
    """

    def __init__(self, votes: np.ndarray, prior: float, rounds: int = 10, abstain: bool = True, anchor: float = 0.5):
        self.prior, self.abstain = float(np.clip(prior, 1e-4, 1 - 1e-4)), abstain
        x = self._with_silence(votes)
        start = TRUST - np.log((votes.sum(0) + 1) / (len(votes) + 2))
        q = first = _sigmoid(votes @ start - self._shift(votes @ start))
        for _ in range(rounds):
            self._fit(x, (q + anchor * first) / (1 + anchor))
            z = self._evidence(x)
            self.shift = self._shift(z)
            last, q = q, _sigmoid(z - self.shift)
            if np.abs(q - last).max() < 1e-3:
                break

    def _shift(self, z: np.ndarray) -> float:
        """What to take off the evidence so that the posteriors' mean is the prior share."""
        lo, hi = -200.0, 200.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if _sigmoid(z - mid).mean() > self.prior else (lo, mid)
        return (lo + hi) / 2

    def _with_silence(self, votes: np.ndarray) -> np.ndarray:
        return (np.c_[votes, ~votes.any(1)] if self.abstain else votes).astype(float)

    def _fit(self, x: np.ndarray, q: np.ndarray) -> None:
        m, weight = x.shape[1], (1 - q, q)
        total = np.array([w.sum() for w in weight]) + 1
        both = np.stack([(x * w[:, None]).T @ x for w in weight])  # how often two voters fire together, by class
        one = np.stack([np.diag(b) for b in both])
        self.rate = (one + 0.3) / total[:, None]
        spread = np.sqrt(self.rate * (1 - self.rate))
        within = (both / total[:, None, None] - self.rate[:, :, None] * self.rate[:, None, :]) / (spread[:, :, None] * spread[:, None, :])
        self.correlation = np.clip((within * (total / total.sum())[:, None, None]).sum(0), -1, 1)
        np.fill_diagonal(self.correlation, 0)
        gain = np.zeros((m, m))
        for k in (0, 1):
            a, b = self.rate[k][:, None], self.rate[k][None, :]
            joint = np.clip((both[k] + 0.3 * np.minimum(a, b)) / total[k], 1e-9, np.minimum(a, b) * (1 - 1e-9))
            for p, e in ((joint, a * b), (a - joint, a * (1 - b)), (b - joint, (1 - a) * b), (1 - a - b + joint, (1 - a) * (1 - b))):
                gain += total[k] * np.where(p > 0, p * np.log(np.maximum(p, 1e-12) / e), 0)
        gain[np.abs(self.correlation) < RELATED] = 0
        self.parent = self._tree(gain, np.log(len(x) + 1))
        has, pa = np.flatnonzero(self.parent >= 0), self.parent[self.parent >= 0]
        self.given = np.repeat(self.rate[:, None], 2, 1)  # [class, whether the parent fires, voter]
        for k in (0, 1):
            fired, prior = one[k][pa], self.rate[k][has]
            self.given[k, 1, has] = (both[k][has, pa] + 2 * prior) / (fired + 2)
            if not self.abstain:
                self.given[k, 0, has] = (one[k][has] - both[k][has, pa] + 2 * prior) / (total[k] - 1 - fired + 2)

    @staticmethod
    def _tree(gain: np.ndarray, least: float) -> np.ndarray:
        """Each voter's parent, or -1: a spanning forest of the greatest gains, none below `least`."""
        m = len(gain)
        parent, best, seen = np.full(m, -1), np.full(m, -np.inf), np.zeros(m, bool)
        for _ in range(m):
            at = int(np.where(seen, -np.inf, best).argmax()) if seen.any() else int(gain.sum(1).argmax())
            if seen[at]:
                at = int(np.flatnonzero(~seen)[0])
            if best[at] < least:
                parent[at] = -1
            seen[at] = True
            better = ~seen & (gain[at] > best)
            best[better], parent[better] = gain[at][better], at
        return parent

    def _evidence(self, x: np.ndarray) -> np.ndarray:
        p = np.clip(self.given, 1e-6, 1 - 1e-6)
        joined = np.where(self.parent >= 0, x[:, self.parent], 0) > 0
        said = lambda r: np.where(joined, r[1], r[0])
        z = (x * said(np.log(p[1] / p[0]))).sum(1)
        return z if self.abstain else z + ((1 - x) * said(np.log((1 - p[1]) / (1 - p[0])))).sum(1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return _sigmoid(self._evidence(self._with_silence(votes)) - self.shift)


def fit_linear(x: np.ndarray, q: np.ndarray, penalty: float = 0.2, rounds: int = 25) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last weight is the constant."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        g = x.T @ (p - q) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge + 1e-9), g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class ToxicityModel:
    def __init__(self, voters: list[str], weights: np.ndarray):
        self.voters, self.weights = voters, weights

    def scorer(self):
        counter, w = Voters(self.voters), self.weights
        n = len(self.voters)

        def score(text: str) -> float:
            found, words = counter.count(text)
            return float(_sigmoid(features(found, words, n) @ w[:-1] + w[-1]))

        return score


def train_toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Fitted on labelled documents outside the held-out fold: all of them, or about `rows` by a hash of doc_id.

    Labels are taken as the largest per doc_id; nulls are no labels. With no rows of one class every score is the
    other class's share.
    """
    known = labels.where("toxic is not null and doc_id is not null").where(F.pmod(doc_crc(), F.lit(5)) != 0)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    total = known.count()
    share = min(1.0, rows / max(total, 1))
    known = known.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 11) < int(share * 2**53))
    part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sized_broadcast(known, 2 * rows), "doc_id").select("text", "toxic")
    part = materialize(part, "toxicity-train")

    def tally(batches):
        for b in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for t, y in zip(texts(b.column(0)), b.column(1).to_pylist()):
                seen[y].update(set().union(*map(_beginnings, set(t.lower().split()))))
            keys = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([seen[1][k] for k in keys], pa.int64()), pa.array([seen[0][k] for k in keys], pa.int64())], ["b", "t", "c"])

    size = {r.toxic: r["count"] for r in part.groupBy("toxic").count().collect()}
    clean, toxic = size.get(0, 0), size.get(1, 0)
    if not clean or not toxic:
        return ToxicityModel([], np.array([0, 0, 0, 6.0 if toxic else -6.0]))
    counts = part.mapInArrow(tally, "b string, t long, c long").groupBy("b").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    best = counts.where((F.col("t") >= 3) & (odds > log(3))).orderBy(F.desc(F.col("t") / toxic - F.col("c") / clean), "b").limit(20 * VOTERS)  # bounds the model, not the rows it scores
    found = [tuple(r) for r in best.collect()]
    names = choose_voters(found, toxic, clean)

    def vote(batches):
        counter = Voters(names)
        for b in batches:
            got = [counter.count(t) for t in texts(b.column(0))]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([list(f) for f, _ in got], pa.list_(pa.int32())), pa.array([list(f.values()) for f, _ in got], pa.list_(pa.int32())), pa.array([n for _, n in got], pa.int64())], ["y", "i", "n", "words"])

    cast = sorted(tuple(map(lambda v: tuple(v) if isinstance(v, list) else v, r)) for r in part.mapInArrow(vote, "y int, i array<int>, n array<int>, words long").collect())
    y = np.array([r[0] for r in cast])
    n = np.zeros((len(cast), len(names)))
    for k, r in enumerate(cast):
        n[k, list(r[1])] = r[2]
    votes = vote_matrix(n, np.array([r[3] for r in cast]))
    q = LabelModel(votes, y.mean()).posterior(votes)
    x = np.stack([features(dict(zip(r[1], r[2])), r[3], len(names)) for r in cast])
    return ToxicityModel(names, fit_linear(x, q))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Null and empty texts get the score of a text without words; repeated rows score alike; other columns are
    ignored. A null doc_id is not held out.
    """

    def run(batches):
        score = model.scorer()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([score(t) for t in texts(b.column(1))], pa.float64())], ["doc_id", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    held = F.coalesce(F.pmod(doc_crc(), F.lit(5)) == 0, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """docs without the rows predicted toxic; all columns as they were, nothing shuffled.

    Null and empty texts score as texts without words; a null doc_id changes nothing; repeated rows go or stay together;
    very long texts are scored whole; an empty table stays empty.
    """
    at = docs.columns.index("text")

    def run(batches):
        score = model.scorer()
        for b in batches:
            yield b.filter(pa.array([score(t) < 0.5 for t in texts(b.column(at))], pa.bool_()))

    return filter_batches(docs, run)
