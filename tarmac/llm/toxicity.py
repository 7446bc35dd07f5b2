"""Toxicity by a support vector machine with a gappy subsequence string kernel on sentences.

Words are compared by the three-character subsequences they share, each weighted by DECAY for
every character it skips (one at most between neighbours), so a word with characters left out or
put in is still close to itself. Landmarks are words and pairs of adjacent words of a bounded
labelled sample. A sentence is pooled over its words: its kernel with a landmark is the largest of
any of its words (for a pair, the largest product at adjacent places). A Nyström subspace of the
landmarks carries a linear machine with a squared hinge.

Labels are of documents, insults are in sentences: training labels the sentences (multiple
instances). All sentences of toxic documents count as toxic at first; with each fit a toxic
document keeps its highest sentence, those beyond the margin are left open, and the others count
as clean. A text's score comes from the margin of its best sentence and from how many sentences lie
beyond the margin, and how densely; how these count is a logistic regression on labelled texts
that this machine has not seen, in the proportions of the labels, so a text without evidence
scores no more than the share of toxic texts.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterable, Sequence
from itertools import product

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.arrow import add_columns, sample_by_class, texts

FIELDS = "score double"
# Bounds of the labelled sample: texts of each class, and characters after which no further text is taken.
SAMPLE_PER_CLASS, SAMPLE_CHARS = 1500, 5_000_000
# Landmarks that stand out in toxic texts, and clean words that are near to them.
MARKS, NEAR_MARKS = 160, 40
# Clean words among which those are looked for, and sentences that a fit counts as clean, the highest.
NEAR_POOL, NEGATIVES = 30_000, 6000
# What slack costs in each round of labelling.
COSTS = (0.02, 0.2, 2.0, 30.0)
DECAY = 0.6
# The normalised kernel is raised to this power: words that share a part only are far apart.
POWER = 1.5
# A smaller kernel of two words counts as none.
LEAST = 0.5
# Letters of a word that are compared together; longer ones are cut into overlapping windows.
WINDOW, STEP = 18, 8
# Kernels of words are kept per worker, twice so many words at most.
GENERATION = 300_000
_SENTENCES = re.compile(r"(?<=[.!?])\s+|\n")
_SPACED = re.compile(r"(?<!\S)\S(?:[^\S\n]\S){3,}(?!\S)")
_LETTERS = re.compile(r"[^\W\d_]+")
_SPACE = 20  # bits that the subsequences of any letters are hashed to
_NONE: tuple = ()


def windows(token: str) -> list[str]:
    """The letters of a run, without what stands between them; long ones in overlapping parts."""
    letters = token if token.isalpha() else "".join(_LETTERS.findall(token))
    if len(letters) <= WINDOW:
        return [letters] if letters else []
    return [letters[i:i + WINDOW] for i in range(0, len(letters) - WINDOW + STEP, STEP)]


def sentences(text: str) -> list[list[str]]:
    """Runs without white space, lower-cased, by sentence; single characters with spaces between are one run."""
    lowered = text.lower()
    if _SPACED.search(lowered):
        lowered = _SPACED.sub(lambda m: re.sub(r"\s", "", m[0]), lowered)
    return [run for s in _SENTENCES.split(lowered) if (run := s.split())]


def subsequences(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, feature, weight) of all words, features of a word once; every letter counts as itself."""
    size = np.array([len(w) for w in words], np.int64)
    wide = np.full((len(words), int(size.max(initial=0)) + 7), -1, np.int64)
    row = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + 1
    wide[:, 0] = 0
    wide[row, at] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    wide[np.arange(len(words)), size + 1] = 1
    keys, weights = [], []
    for gap_one, gap_two in product((0, 1), repeat=2):
        one, two = 1 + gap_one, 2 + gap_one + gap_two
        a, b, c = wide[:, :-two], wide[:, one:one - two], wide[:, two:]
        word, place = np.nonzero(c >= 0)
        mixed = ((a[word, place] << 42) | (b[word, place] << 21) | c[word, place]).astype(np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        keys.append(word << _SPACE | (mixed >> np.uint64(64 - _SPACE)).astype(np.int64))
        weights.append(np.full(len(word), DECAY ** (gap_one + gap_two)))
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    return key >> _SPACE, key & ((1 << _SPACE) - 1), np.bincount(place, np.concatenate(weights), len(key))


class WordKernels:
    """Kernels of words with some fixed words."""

    def __init__(self, fixed: Sequence[str]) -> None:
        self.fixed = list(fixed)
        word, feature, weight = subsequences(self.fixed)
        norm = np.sqrt(np.bincount(word, weight ** 2, len(self.fixed)))
        order = np.argsort(feature, kind="stable")
        used, begin = np.unique(feature[order], return_index=True)
        self.column = np.full(1 << _SPACE, -1, np.int32)
        self.column[used] = np.arange(len(used))
        # The fixed words that have a feature stand together, with their weights.
        self.begin = np.r_[begin, len(feature)].astype(np.int64)
        self.word, self.weight = word[order], (weight / norm[word])[order]

    def __call__(self, words: Sequence[str], least: float = 0.0) -> np.ndarray:
        """(words, fixed words): normalised kernels, raised to POWER; 0 for words that have none of ``least``."""
        word, feature, weight = subsequences(words)
        norm = np.sqrt(np.bincount(word, weight ** 2, len(words)))
        place = self.column[feature]
        known = place >= 0
        # What a word has in common with all fixed words together bounds its kernel with each.
        reach = np.sqrt(np.bincount(word[known], weight[known] ** 2, len(words))) / norm
        hit = np.flatnonzero(known & (reach ** POWER >= least)[word])  # in the order of words
        place = place[hit]
        count = self.begin[place + 1] - self.begin[place]
        each = np.repeat(np.arange(len(hit)), count)
        entry = self.begin[place][each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
        shared = self.weight[entry] * (weight[hit] / norm[word[hit]])[each]
        cell = word[hit][each] * len(self.fixed) + self.word[entry]
        return np.bincount(cell, shared, len(words) * len(self.fixed)).reshape(len(words), -1) ** POWER


class ToxicityModel:
    """Landmarks and the weights of a sentence's kernels with them."""

    def __init__(self, marks: Sequence[tuple[str, ...]]) -> None:
        """``marks`` are words, as tuples of one, and pairs of words."""
        self.marks = list(marks)
        self.kernels = WordKernels(sorted({w for m in self.marks for w in m}))
        at = {w: i for i, w in enumerate(self.kernels.fixed)}
        # Which landmarks a fixed word is alone, and which it begins, with the word that must follow.
        self.alone: list[list[int]] = [[] for _ in at]
        self.begins: list[list[tuple[int, int]]] = [[] for _ in at]
        for u, mark in enumerate(self.marks):
            if len(mark) == 1:
                self.alone[at[mark[0]]].append(u)
            else:
                self.begins[at[mark[0]]].append((at[mark[1]], u))
        own = self.kernels(self.kernels.fixed).astype(float) if at else np.zeros((0, 0))
        among = np.zeros((len(self.marks), len(self.marks)))
        for u, one in enumerate(self.marks):
            for v, two in enumerate(self.marks):
                if len(one) == len(two):
                    among[u, v] = np.prod([own[at[a], at[b]] for a, b in zip(one, two, strict=True)])
        value, vector = np.linalg.eigh(among)
        keep = value > 1e-6 * value.max(initial=0)
        self.root = vector[:, keep] / np.sqrt(value[keep])
        self.weights, self.bias = np.zeros(len(self.marks)), -1.0
        self.slope, self.offset = np.array([1.0, 1.0, 1.0]), -4.0
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"young": {}, "old": {}}

    # --- kernels of words and sentences -------------------------------------------------

    def _learn(self, unknown: Sequence[str]) -> dict[str, tuple]:
        """((fixed word, kernel), ...) of runs not seen before; of most runs none."""
        parts = [(t, w) for t in unknown for w in windows(t)]
        found: dict[str, dict[int, float]] = {}
        for begin in range(0, len(parts), 2048):
            some = parts[begin:begin + 2048]
            k = self.kernels([w for _, w in some], LEAST)
            for i, j in zip(*np.nonzero(k >= LEAST), strict=True):
                best = found.setdefault(some[i][0], {})
                best[int(j)] = max(best.get(int(j), 0.0), float(k[i, j]))
        new = {t: tuple(found[t].items()) if t in found else _NONE for t in unknown}
        for t, m in new.items():
            if len(self.young) >= GENERATION:
                self.old, self.young = self.young, {}
            self.young[t] = m
        return new

    def matches(self, runs: Sequence[list[str]]) -> list[list[tuple]]:
        """Of each run of tokens the matches of each token; new tokens are compared together."""
        found = [list(map(self.young.get, run)) for run in runs]
        missing = {t for run, ms in zip(runs, found, strict=True) if None in ms for t, m in zip(run, ms, strict=True) if m is None}
        if not missing:
            return found
        known = {t: self.old[t] for t in missing if t in self.old}
        self.young.update(known)
        left = sorted(missing - known.keys())
        for k in range(0, len(left), 20_000):
            known |= self._learn(left[k:k + 20_000])
        return [[known[t] if m is None else m for t, m in zip(run, ms, strict=True)] if None in ms else ms
                for run, ms in zip(runs, found, strict=True)]

    def pooled(self, ms: list[tuple]) -> dict[int, float]:
        """Landmark to the largest kernel of a sentence's words, or adjacent words, with it."""
        z: dict[int, float] = {}
        for p, here in enumerate(ms):
            for i, k in here:
                for u in self.alone[i]:
                    if k > z.get(u, 0.0):
                        z[u] = k
                if self.begins[i] and p + 1 < len(ms) and ms[p + 1]:
                    after = dict(ms[p + 1])
                    for j, u in self.begins[i]:
                        if j in after and k * after[j] > z.get(u, 0.0):
                            z[u] = k * after[j]
        return z

    def dense(self, pooled: Sequence[dict[int, float]]) -> np.ndarray:
        out = np.zeros((len(pooled), len(self.marks)), np.float32)
        for i, z in enumerate(pooled):
            for u, k in z.items():
                out[i, u] = k
        return out

    # --- the machine --------------------------------------------------------------------

    def fit(self, z: np.ndarray, toxic: np.ndarray, cost: float) -> None:
        """Linear machine in the subspace of the landmarks, squared hinge, Newton steps; classes weigh the same."""
        x = np.hstack([z @ self.root, np.ones((len(z), 1))])
        y = np.where(toxic, 1.0, -1.0)
        c = cost * np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1)) * min(len(y), 2000)
        w = np.zeros(x.shape[1])
        for _ in range(30):
            inside = y * (x @ w) < 1
            xi, ci = x[inside], c[inside]
            step = np.linalg.solve(
                np.eye(len(w)) + (xi * ci[:, None]).T @ xi,
                w + (xi * ci[:, None]).T @ (xi @ w - y[inside]))
            w = w - step
            if np.abs(step).max() < 1e-5:
                break
        self.weights, self.bias = self.root @ w[:-1], float(w[-1])

    def margin(self, z: dict[int, float]) -> float:
        return self.bias + sum(k * self.weights[u] for u, k in z.items())

    def evidence(self, batch: Sequence[str]) -> np.ndarray:
        """Of each whole text: its best sentence's margin, and sentences beyond the margin, all and per 100 words."""
        out = []
        for begin in range(0, len(batch), 64):
            cut = [sentences(t) for t in batch[begin:begin + 64]]
            ms = iter(self.matches([run for text in cut for run in text]))
            for text in cut:
                margins, words = [self.bias], 0
                for run in text:
                    own = next(ms)
                    words += len(run)
                    if any(own):
                        margins.append(self.margin(self.pooled(own)))
                near = np.clip(np.array(margins), -1.5, 1.5)
                count = float(np.clip(near + 0.5, 0, 1).sum())
                out.append((near.max(), np.log1p(count), np.log1p(count / max(1.0, words / 100))))
        return np.array(out).reshape(-1, 3)

    def scores(self, batch: Sequence[str]) -> np.ndarray:
        """A probability per text; empty ones score as texts without evidence."""
        return 1 / (1 + np.exp(-np.clip(self.evidence(batch) @ self.slope + self.offset, -30, 30)))

    def calibrate(self, batch: Sequence[str], toxic: np.ndarray, share: float, ridge: float = 0.02) -> None:
        """Logistic regression by Newton steps; ``share`` of all texts is toxic."""
        x = np.hstack([self.evidence(batch), np.ones((len(batch), 1))])
        if toxic.all() or not toxic.any():
            self.slope, self.offset = np.zeros(3), float(np.log(share / (1 - share))) if 0 < share < 1 else -4.0
            return
        c = np.where(toxic, share / toxic.mean(), (1 - share) / (~toxic).mean()) / len(batch)
        used = [0, 1, 2, 3]
        while True:
            w, z = np.zeros(len(used)), x[:, used]
            hold = ridge / 100 * np.diag([1.0] * (len(used) - 1) + [1e-3])
            for _ in range(50):
                p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
                slope = z.T @ (c * (p - toxic)) + hold @ w
                w -= np.clip(np.linalg.solve((z * (c * p * (1 - p))[:, None]).T @ z + hold, slope), -5, 5)
            wrong = [u for u, v in zip(used[:-1], w[:-1], strict=True) if v < 0]
            if not wrong:
                break
            used = [u for u in used if u not in wrong]  # more evidence never counts for less
        self.slope = np.zeros(3)
        self.slope[used[:-1]], self.offset = w[:-1], float(w[-1])


def _association(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Signed log-likelihood ratio of being in so many toxic and clean texts; more than zero: more often in toxic ones."""
    n = n_toxic + n_clean
    share = (toxic + clean) / n
    total = np.zeros(len(toxic))
    for seen, size in ((toxic, n_toxic), (clean, n_clean)):
        for part, expected in ((seen, size * share), (size - seen, size * (1 - share))):
            total += np.where(part > 0, part * np.log(np.maximum(part, 1e-9) / np.maximum(expected, 1e-9)), 0)
    return np.where(toxic * n_clean > clean * n_toxic, total, -total)


def _landmarks(docs: Sequence[tuple[list[list[str]], bool]]) -> list[tuple[str, ...]]:
    """Words and pairs that stand out most in toxic texts, and the clean words nearest to them.

    No share or contrast is asked for: what stands out less than others comes later, and there are no
    more landmarks of this kind than toxic texts, as these could not weigh them. A pair is
    taken where it stands out more than both of its words.
    """
    words: tuple[Counter, Counter] = (Counter(), Counter())
    pairs: tuple[Counter, Counter] = (Counter(), Counter())
    for runs, toxic in docs:
        own, two = set(), set()
        for run in runs:
            cut = [windows(t) for t in run]
            own.update(w for c in cut for w in c)
            flat = [c[0] if len(c) == 1 else None for c in cut]
            two.update((a, b) for a, b in zip(flat, flat[1:], strict=False) if a and b)
        words[toxic].update(own)
        if toxic:
            pairs[1].update(two)
        else:
            pairs[0].update(two)
    size = [max(sum(1 for _, t in docs if t is flag), 1) for flag in (False, True)]

    def ranked(counts: tuple[Counter, Counter]) -> dict:
        keys = list(counts[1])
        g = _association(np.array([counts[1][k] for k in keys], float), np.array([counts[0][k] for k in keys], float), size[1], size[0])
        return {k: v for k, v in zip(keys, g.tolist(), strict=True) if v > 0}

    single = ranked(words)
    double = {p: v for p, v in ranked(pairs).items() if v > 1.5 * max(single.get(p[0], 0.0), single.get(p[1], 0.0))}
    scored = [((w,), v) for w, v in single.items()] + list(double.items())
    order = lambda m: zlib.crc32(" ".join(m).encode("utf-8", "surrogatepass"))
    marks = [m for m, _ in sorted(scored, key=lambda x: (-x[1], len(x[0]), order(x[0]), x[0]))[:min(MARKS, size[1])]]
    clean = sorted(sorted((w for w in words[0] if words[0][w] * size[1] >= words[1][w] * size[0]),
                          key=lambda w: (order((w,)), w))[:NEAR_POOL])
    if marks and clean:
        near = WordKernels(sorted({w for m in marks for w in m}))
        chosen = {w for m in marks for w in m}
        top = np.concatenate([near(clean[i:i + 2048]).max(axis=1) for i in range(0, len(clean), 2048)])
        hard = [clean[i] for i in np.argsort(-top, kind="stable") if clean[i] not in chosen]
        marks += [(w,) for w in hard[:NEAR_MARKS]]
    return marks


def train(labelled: Iterable[tuple[str, bool]], share: float | None = None, rounds: int = len(COSTS)) -> ToxicityModel:
    """A model from (text, toxic) rows, ``share`` of all texts being toxic (default: as in the rows).

    Every fifth row of a class (with few toxic rows every third) is kept for the calibration. A text most of whose sentences were in
    earlier texts of its class is a copy and teaches once. Without both classes all texts score the
    share.
    """
    labelled = list(labelled)
    keep = 5 if sum(bool(y) for _, y in labelled) >= 300 else 3
    kept, docs, rows, seen = [], [], [0, 0], (set(), set())
    for text, toxic in labelled:
        toxic = bool(toxic)
        runs = [list(map(sys.intern, run)) for run in sentences(text)]
        marks = {hash(tuple(r)) for r in runs}
        copy = len(marks) > 1 and len(marks & seen[toxic]) > 0.5 * len(marks)
        seen[toxic].update(marks)
        rows[toxic] += 1
        if rows[toxic] % keep == 0:
            kept.append((text, toxic))
        elif not copy:
            docs.append((runs, toxic))
    share = rows[1] / max(sum(rows), 1) if share is None else share
    if not any(t for _, t in docs) or all(t for _, t in docs):
        model = ToxicityModel([])
        model.calibrate([], np.zeros(0, bool), share)
        return model
    model = _fitted(docs, rounds)
    model.calibrate([t for t, _ in kept], np.array([y for _, y in kept], bool), share)
    return model


def _fitted(docs: Sequence[tuple[list[list[str]], bool]], rounds: int) -> ToxicityModel:
    """Multiple instances: landmarks, then fits between which sentences are labelled anew."""
    model = ToxicityModel(_landmarks(docs))
    clean: dict[tuple, int] = {(): 1}
    bags: list[list[tuple]] = []
    for begin in range(0, len(docs), 64):
        matched = iter(model.matches([run for runs, _ in docs[begin:begin + 64] for run in runs]))
        for runs, toxic in docs[begin:begin + 64]:
            own = sorted({tuple(sorted(model.pooled(next(matched)).items())) for _ in runs})
            if toxic:
                bags.append([z for z in own if z])
            else:
                clean |= dict.fromkeys(own, 1)
    bags = [b for b in bags if b]
    negative = model.dense([dict(z) for z in sorted(clean)])
    held = [model.dense([dict(z) for z in b]) for b in bags]
    positive = held
    if not held:
        return model
    for turn in range(rounds):
        if turn:
            labelled = [h @ model.weights + model.bias for h in held]
            best = [int(m.argmax()) for m in labelled]
            positive = [h[b:b + 1] for h, b in zip(held, best, strict=True)]
            others = [h[(m < 0) & (np.arange(len(m)) != b)] for h, m, b in zip(held, labelled, best, strict=True)]
            pool = np.concatenate([negative, *others])
        else:
            pool = negative
        if len(pool) > NEGATIVES:
            pool = pool[np.argsort(-(pool @ model.weights) if turn else -pool.sum(axis=1), kind="stable")[:NEGATIVES]]
        z = np.concatenate([*positive, pool, np.zeros((1, len(model.marks)), np.float32)])
        toxic = np.arange(len(z)) < sum(len(p) for p in positive)
        # Cheap slack at first: what many toxic texts share is learned before what a few have by chance.
        model.fit(z, toxic, COSTS[min(turn, len(COSTS) - 1)])
    return model


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, chars: int = SAMPLE_CHARS) -> ToxicityModel:
    """A model from documents (doc_id, text) and labels (doc_id, toxic).

    The sample is bounded: of each class the labelled texts with the smallest hashes of their ids,
    ``per_class`` at most and until they have ``chars`` characters; a text is taken whole. NULL ids,
    texts and labels teach nothing; of several labels of a document the worst counts. The sampled
    ids are few, so they go to the documents, not the other way.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        (F.max("toxic") > 0).alias("toxic"))
    known = known.join(docs.filter(F.col("text").isNotNull()).select("doc_id").distinct(), "doc_id", "left_semi")
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    chosen = sample_by_class(known, "toxic", F.col("doc_id").cast("string"), per_class)
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("_id"), "toxic", "_rank"))
    before = Window.partitionBy("toxic").orderBy("_rank", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        docs.select("doc_id", "text").filter(F.col("text").isNotNull())
        .join(chosen, F.col("doc_id") == F.col("_id")).select("text", "toxic", "_rank").distinct()
        .withColumn("before", F.coalesce(F.sum(F.length("text")).over(before), F.lit(0)))
        .filter(F.col("before") < chars).orderBy("_rank", "toxic", "text").select("text", "toxic").collect())
    total = sum(counts.values())
    return train(((r.text, r.toxic) for r in rows), counts.get(True, 0) / total if total else 0.0)


def score_toxicity(docs: DataFrame, model: ToxicityModel, drop: Sequence[str] = ()) -> DataFrame:
    """All rows and columns of ``docs`` (less ``drop``) with a score from 0 to 1; whole texts.

    NULL, empty and letterless texts score as texts without evidence do.
    """
    def make():
        def compute(batch):
            return [model.scores(texts(batch, "text"))]
        return compute
    return add_columns(docs, FIELDS, make, drop)
