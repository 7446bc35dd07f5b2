"""Language identification with a blended-spectrum string kernel.

The kernel of two texts is the number of character n-grams (n = 1..3) present in both, divided
by the root of the product of their own numbers. Landmark texts span a Nyström subspace in which
one-versus-rest kernel ridge regression is solved on a bounded sample of labelled rows. A task
scores a batch as two matrix products: presence of n-grams by landmarks, kernels by classes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.arrow import add_columns, code_points, sample_by_class, texts

UNKNOWN = "und"
FIELDS = "lang_pred string, score double"
# Bounds of the labelled sample and of its landmarks per language, of the length of texts that are
# sampled whole (of longer ones, their distinct n-grams), and of the letters that have a code of
# their own. N-grams with other letters are hashed to so many codes.
SAMPLE_PER_CLASS, LANDMARKS_PER_CLASS, SAMPLE_CHARS, LETTERS, HASHED = 240, 24, 20_000, 94, 1 << 17
_ROWS = 32
# A character has 21 bits of a packed n-gram; what is no letter is 1.
_BITS, _POINT = 21, (1 << 21) - 1
_ALPHA = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def packed_grams(text: str) -> np.ndarray:
    """The distinct n-grams with n up to 3 as numbers; none for a text without letters."""
    c = code_points(f" {text.lower()} ").astype(np.int64)
    c[~_ALPHA[c]] = 1
    if (c == 1).all():
        return np.zeros(0, np.int64)
    c = c[np.r_[True, (c[1:] > 1) | (c[:-1] > 1)]]
    two = c[:-1] << _BITS | c[1:]
    return np.unique(np.concatenate([c, two, two[:-1] << _BITS | c[2:]]))


@dataclass
class Grams:
    """Codes of the n-grams of a text: exact over an alphabet, hashed with other letters; 0 between words."""

    letters: str

    def __post_init__(self) -> None:
        self.base = len(self.letters) + 2
        self.exact = self.base + self.base ** 2 + self.base ** 3
        self.size = self.exact + HASHED
        self._code = _ALPHA.astype(np.uint8)
        for i, letter in enumerate(self.letters):
            self._code[ord(letter)] = i + 2

    def codes(self, text: str | np.ndarray) -> np.ndarray:
        """Every n-gram with n up to 3, repeated ones too; none for a text without letters.

        Distinct n-grams of a text, packed, stand for it.
        """
        if not isinstance(text, str):
            return self._of_packed(text)
        c = self._code[code_points(f" {text.lower()} ")]
        if not c.any():
            return np.zeros(0, np.int32)
        if (c == 1).any():
            return self._of_packed(packed_grams(text))
        once = np.r_[True, (c[1:] > 0) | (c[:-1] > 0)]
        c = c[once].astype(np.int32)
        b = self.base
        two = c[:-1] * b + c[1:]
        three = two[:-1] * b + c[2:]
        return np.concatenate([c, two + b, three + b + b * b])

    def _of_packed(self, packed: np.ndarray) -> np.ndarray:
        parts = [packed >> 2 * _BITS, packed >> _BITS & _POINT, packed & _POINT]
        places = [self._code[p].astype(np.int64) for p in parts]
        b, other = self.base, np.zeros(len(packed), bool)
        for place in places:
            other |= place == 1
        exact = (places[0] * b + places[1]) * b + places[2]
        exact += np.where(parts[0] > 0, b + b * b, np.where(parts[1] > 0, b, 0))
        mixed = packed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        hashed = self.exact + (mixed >> np.uint64(32)).astype(np.int64) % HASHED
        return np.where(other, hashed, exact).astype(np.int32)


class LanguageModel:
    """Landmarks, and regression weights for kernels with them."""

    def __init__(self, landmarks: Sequence[str | np.ndarray], letters: str) -> None:
        self.grams = Grams(letters)
        known = [np.unique(self.grams.codes(t)) for t in landmarks]
        self.features = np.unique(np.concatenate(known)) if known else np.zeros(0, np.int32)
        self._index()
        self.presence = np.zeros((len(self.features), len(known)), np.float32)
        for j, codes in enumerate(known):
            self.presence[self.column[codes], j] = 1 / max(np.sqrt(len(codes)), 1)
        self.classes: list[str] = []
        # The least lead of the best language over the second with which a text is identified, and
        # by class the least share of its n-grams that landmarks must know.
        self.least_lead = -np.inf
        self.least_known: dict[str, float] = {}
        self.weights = np.zeros((len(known) + 1, 0), np.float32)

    def _index(self) -> None:
        self.column = np.full(self.grams.size, -1, np.int32)
        self.column[self.features] = np.arange(len(self.features), dtype=np.int32)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("grams", "column")} | {"l": self.grams.letters}

    def __setstate__(self, state: dict) -> None:
        self.grams = Grams(state.pop("l"))
        self.__dict__.update(state)
        self._index()

    def kernels(self, batch: Sequence[str | np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Kernels with the landmarks (and a constant), and which texts have letters."""
        return self._compare(batch)[:2]

    def _compare(self, batch: Sequence[str | np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``kernels``, with the number of n-grams of each text that landmarks know, and of all."""
        present = np.zeros((len(batch), len(self.features)), np.float32)
        own, lettered = np.ones(len(batch), np.float32), np.zeros(len(batch), bool)
        seen = np.zeros(self.grams.size, bool)
        for i, text in enumerate(batch):
            codes = self.grams.codes(text)
            if len(codes):
                lettered[i] = True
                seen[codes] = True
                columns = self.column[codes]
                present[i, columns[columns >= 0]] = 1
                own[i] = np.count_nonzero(seen) if len(codes) > 5000 else len(np.unique(codes))
                seen[codes] = False
        k = (present @ self.presence) / np.sqrt(own)[:, None]
        return np.hstack([k, np.ones((len(batch), 1), np.float32)]), lettered, present.sum(1), own

    def fit(self, batch: Sequence[str | np.ndarray], labels: Sequence[str], ridge: float = 1e-3) -> LanguageModel:
        self.classes = sorted(set(labels))
        k = np.vstack([self.kernels(batch[i:i + _ROWS])[0] for i in range(0, len(batch), _ROWS)]).astype(float)
        among = (self.presence.T @ self.presence).astype(float)
        value, vector = np.linalg.eigh(among)
        keep = value > value.max() * 1e-6
        root = np.zeros((k.shape[1], keep.sum() + 1))
        root[:-1, :-1] = vector[:, keep] / np.sqrt(value[keep])
        root[-1, -1] = 1
        z = k @ root
        wanted = np.array([[label == c for c in self.classes] for label in labels], float)
        solved = np.linalg.solve(z.T @ z + ridge * len(batch) * np.eye(z.shape[1]), z.T @ wanted)
        self.weights = (root @ solved).astype(np.float32)
        return self

    def predict(self, batch: Sequence[str]) -> tuple[list[str], np.ndarray]:
        """The language with the highest output, and its share of all positive outputs."""
        labels, scores = [], []
        for i in range(0, len(batch), _ROWS):
            k, lettered = self.kernels(batch[i:i + _ROWS])
            out = np.clip(k @ self.weights, 1e-6, 1.0)
            best = out.argmax(1) if out.shape[1] else np.zeros(len(out), int)
            for j, (b, ok) in enumerate(zip(best, lettered, strict=True)):
                known = ok and out.shape[1] > 0
                labels.append(self.classes[b] if known else UNKNOWN)
                scores.append(float(out[j, b] / out[j].sum()) if known else 0.0)
        return labels, np.array(scores)

    def leads(self, batch: Sequence[str | np.ndarray]) -> tuple[list[str], np.ndarray]:
        """The language with the highest output, and how far kernels with landmarks put it before any other.

        The constant's part is left out: a text that has nothing in common with landmarks has no lead.
        """
        return self._judge(batch)[:2]

    def _judge(self, batch: Sequence[str | np.ndarray]) -> tuple[list[str], np.ndarray, np.ndarray]:
        labels, leads, shares = [], [], [np.zeros(0)]
        for i in range(0, len(batch), _ROWS):
            k, lettered, seen, own = self._compare(batch[i:i + _ROWS])
            # Of few n-grams the share says little: it is taken one standard error (at most) higher.
            shares.append((seen + np.sqrt(own)) / own)
            evidence = k[:, :-1] @ self.weights[:-1]
            best = (evidence + self.weights[-1]).argmax(1) if self.classes else np.zeros(len(k), int)
            for row, b, ok in zip(evidence, best, lettered, strict=True):
                known = ok and len(row) > 0
                labels.append(self.classes[b] if known else UNKNOWN)
                leads.append(float(row[b] - np.delete(row, b).max(initial=-np.inf if len(row) > 1 else 0.0)) if known else 0.0)
        return labels, np.array(leads), np.concatenate(shares)

    def claims(self, batch: Sequence[str]) -> list[str | None]:
        """The language that claims each text; None where its lead, or the share of n-grams that landmarks know, is too small."""
        return [name if share >= self.least_known.get(name, np.inf) and lead >= self.least_lead else None
                for name, lead, share in zip(*self._judge(batch), strict=True)]

    def learn_known(self, batch: Sequence[str | np.ndarray], labels: Sequence[str], landmark: Sequence[bool]) -> None:
        """Sets ``least_known`` from taught texts: ``KNOWN_SHARE`` of the share that all but one in a hundred of a class reach.

        Landmarks teach it for a class that has no other texts; what only the landmark itself holds is then unknown.
        """
        inside = self.presence > 0
        apart = inside[inside.sum(1) > 1].sum(0) / np.maximum(inside.sum(0), 1)
        others = [t for t, mark in zip(batch, landmark, strict=True) if not mark]
        counted = [self._compare(others[i:i + _ROWS])[2:] for i in range(0, len(others), _ROWS)]
        shares = iter(np.concatenate([seen / own for seen, own in counted]) if counted else [])
        marks = iter(apart)
        by_class: dict[tuple[str, bool], list[float]] = {}
        for label, mark in zip(labels, landmark, strict=True):
            by_class.setdefault((label, bool(mark)), []).append(float(next(marks if mark else shares)))
        self.least_known = {
            c: KNOWN_SHARE * float(np.quantile(by_class.get((c, False)) or by_class[c, True], 0.01, method="lower"))
            for c in self.classes}


# Part of the least lead of rightly identified texts that a document needs.
LEAD_SHARE = 0.25
# Part of the share of known n-grams of texts in a language that a document in it needs.
KNOWN_SHARE = 0.75


def fit_languages(
    labelled: DataFrame, per_class: int = SAMPLE_PER_CLASS, landmarks: int = LANDMARKS_PER_CLASS, calibrate: bool = False,
) -> LanguageModel:
    """A model from rows with doc_id, text and lang: at most ``per_class`` of each language.

    With ``calibrate`` a model that has not seen every fourth row tells with what lead it identifies
    those rightly; ``LEAD_SHARE`` of the least lead is what ``keep_identified`` then asks for. So the
    limit follows from the labels, whatever the number of languages. Very short or mixed texts that are
    identified rightly can fall below it (2 of 1,000 on a trial); without ``calibrate`` nothing goes for its lead.
    The share of n-grams that a language's texts have in common with landmarks is always learned (``learn_known``).

    Rows with a NULL id, text or language, or without a letter, teach nothing. Texts are chosen by
    a hash of the id; of those over ``SAMPLE_CHARS`` characters tasks send the distinct n-grams.
    """
    frame = labelled.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
        & F.col("text").rlike(r"\p{L}"))
    few = sample_by_class(frame, "lang", F.col("doc_id").cast("string"), per_class)
    long = F.length("text") > SAMPLE_CHARS

    @F.pandas_udf("binary")
    def packed(texts_):
        return texts_.map(lambda t: None if t is None else packed_grams(t).tobytes())

    rows = few.select(
        "lang", "_rank", F.when(~long, F.col("text")).alias("text"), packed(F.when(long, F.col("text"))).alias("grams"),
    ).orderBy("lang", "_rank").collect()
    taught = [np.frombuffer(r.grams, np.int64) if r.text is None else r.text for r in rows]
    counts: dict[str, int] = {}
    for t in taught:
        points = code_points(t.lower()) if isinstance(t, str) else t & _POINT
        for p, n in zip(*np.unique(points[_ALPHA[points]], return_counts=True), strict=True):
            counts[chr(p)] = counts.get(chr(p), 0) + int(n)
    letters = "".join(sorted(sorted(counts, key=lambda c: (-counts[c], c))[:LETTERS]))
    model = LanguageModel([t for r, t in zip(rows, taught, strict=True) if r["_rank"] <= landmarks], letters)
    if not rows:
        return model
    labels = [r.lang for r in rows]
    apart = [i for i, r in enumerate(rows) if r["_rank"] > landmarks and r["_rank"] % 4 == 0] if calibrate else []
    if apart and len(set(labels)) > 1:
        rest = sorted(set(range(len(rows))) - set(apart))
        model.fit([taught[i] for i in rest], [labels[i] for i in rest])
        found, leads = model.leads([taught[i] for i in apart])
        right = [lead for i, name, lead in zip(apart, found, leads, strict=True) if name == labels[i]]
        least = float(min(right, default=0.0))  # below 0 where some are told by the constant alone
        model.least_lead = least - (1 - LEAD_SHARE) * abs(least)
    model.fit(taught, labels)
    model.learn_known(taught, labels, [r["_rank"] <= landmarks for r in rows])
    return model


def identify(docs: DataFrame, model: LanguageModel, drop: Sequence[str] = (), fields: str = FIELDS) -> DataFrame:
    """All rows and columns of ``docs`` (less ``drop``) with lang_pred and score.

    NULL texts and texts without a letter are ``und`` with score 0, and so is every text if the
    model has learned no language. Whole texts are scored, whatever their length.
    """
    def make():
        def compute(batch):
            return model.predict(texts(batch, "text"))
        return compute
    return add_columns(docs, fields, make, drop)


def keep_identified(docs: DataFrame, model: LanguageModel, wanted: Sequence[str] | None = None) -> DataFrame:
    """The documents in one of the ``wanted`` languages (default: all that were learned), all columns as they came.

    What goes: documents without a text or a letter; those whose language is not wanted; those that
    no language claims (a text in no learned language, or of random letters): landmarks know too few
    of its n-grams for a text in the best language (``model.least_known``), or the lead over the
    second is smaller than ``model.least_lead``. A model that has learned no language tells nothing
    against a text with letters. Repeated rows are judged each; an empty table stays empty; long
    texts are judged whole.
    """
    if not model.classes:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    names = set(model.classes if wanted is None else wanted)

    def make():
        def compute(batch):
            return [[name in names for name in model.claims(texts(batch, "text"))]]
        return compute
    return add_columns(docs, "_lang_kept boolean", make).filter("_lang_kept").select(*docs.columns)
