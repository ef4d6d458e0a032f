"""Toxicity by a support vector machine over a subsequence string kernel with Nystroem landmarks.

The kernel compares two words by the three-letter subsequences that they share, each weighted by DECAY for
every letter that it spans, up to SPAN letters; it is divided by the words' own norms. Letters inserted into
an insult, or left out of it, change some subsequences and leave others, so such forms stay similar. The
beginning and the end of a word count as letters. Before that, letters lose case, digits and signs that
stand for letters become them, other signs go, and a run of single letters is read as one word as well.

Landmarks are words of the training sample. A word is represented by its kernel with the landmarks, times
the inverse root of the landmarks' own kernel matrix. The machine is trained on sentences, each labelled as
its document: a sentence is worth its most toxic word, and which word that is in a toxic sentence is chosen
anew in each round, from words that the sample's toxic documents favour. A document's score is a logistic
function, fitted on the sample, of its TOP most toxic words.

Those are words that stand in MIN_TOXIC toxic documents of the sample or more and mostly there (TOXIC_SHARE).
If no word does, they are the words of each toxic document with its highest share, smoothed.

The sample is bounded (SAMPLE documents a label; whole texts) and fixed by a hash. The machine is trained on up
to CLEAN_SENTENCES of its clean sentences, the logistic function on all of its texts. Held-out rows and all
columns but the text are kept out of training and scoring.

As the kernel is a sum over subsequences and the machine is linear in the landmarks, machine and landmarks
together are one weight for each subsequence; scoring a word is a sum of those divided by its norm.

Defined results: NULL, empty and letterless texts get the score of a text without a toxic word. If a label
is missing from the sample, or its texts hold no word of three letters, every score is 0. Rows are independent.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadpulse.llm import labelled
from threadpulse.llm import words as W

SAMPLE, CLEAN_SENTENCES = 1000, 4000
LANDMARKS = 256
DECAY, SPAN = 0.7, 7
ROUNDS, STEPS, FORMS = 2, 150, 2
REGULAR = 1e-4
#: A word is suspect at first if so many toxic documents of the sample have it, and this share of all with it.
MIN_TOXIC, TOXIC_SHARE = 4, 0.8
CACHED_WORDS = 1_000_000

TOP, SENTENCE_WEIGHT = 3, 0.02
_CODES, _BEGIN, _END = 64, 0, 63
#: Fixed: digits and signs that stand for letters.
_STANDS_FOR = str.maketrans("013457@$", "oieastas")
_SENTENCE = re.compile(r"[.!?\n]+\s")
_SPACED = re.compile(r"(?<!\S)(?:\w[^\w\s]?\s){2,}\w(?!\S)")


def folded(token: str) -> str:
    """The token's letters without case; a sign that stands for a letter becomes it if the token has letters."""
    token = token.strip(".,;:!?\"'()[]").lower()
    if any(c.isalpha() for c in token):
        token = token.translate(_STANDS_FOR)
    return "".join(c for c in token if c.isalpha())


def tokens(text: str | None) -> list[str]:
    """White-space separated tokens, and each run of single letters as one more."""
    text = text or ""
    return text.split() + ["".join(m.split()) for m in _SPACED.findall(text)]


def _subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, code and weight of every three-letter subsequence that spans up to SPAN letters."""
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    raw = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = np.where((raw >= 97) & (raw <= 122), raw - 96, 27 + raw % 35)
    letter = np.where(raw == ord("<"), _BEGIN, np.where(raw == ord(">"), _END, letter))
    word = np.repeat(np.arange(len(words)), sizes)
    n = len(letter)
    out = []
    for second in range(1, SPAN - 1):
        for third in range(second + 1, SPAN):
            at = np.flatnonzero(word[: n - third] == word[third:]) if n > third else np.empty(0, np.int64)
            code = (letter[at] * _CODES + letter[at + second]) * _CODES + letter[at + third]
            out.append((word[at], code, np.full(len(at), DECAY ** (third - 2), np.float64)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _merged(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Subsequences with equal ones of a word added up, and each word's norm."""
    word, code, weight = _subsequences(words)
    key, inverse = np.unique(word * _CODES**3 + code, return_inverse=True)
    value = np.bincount(inverse, weight, len(key))
    word = key // _CODES**3
    norm = np.sqrt(np.bincount(word, value**2, len(words)))
    return word, key % _CODES**3, value, norm


def features(words: list[str], codes: np.ndarray) -> np.ndarray:
    """Normed subsequence vectors of words as a (word, code) matrix, for the given ascending codes alone."""
    word, code, value, norm = _merged(words)
    at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    known = codes[at] == code
    out = np.zeros((len(words), len(codes)), np.float32)
    out[word[known], at[known]] = (value / norm[word])[known]
    return out


def kernel(a: list[str], b: list[str]) -> np.ndarray:
    """Kernel values of all words of a with all of b."""
    codes = np.unique(_merged(b)[1])
    return features(a, codes) @ features(b, codes).T


class Model(NamedTuple):
    """Weight of every subsequence, and the logistic function's slopes for the top words and its shift."""

    weights: np.ndarray
    bias: float
    logistic: np.ndarray


def _word_values(words: list[str], model: Model) -> np.ndarray:
    word, code, value, norm = _merged(words)
    total = np.bincount(word, value * model.weights[code], len(words))
    return total / np.where(norm > 0, norm, 1) + model.bias


def fit(texts: list[tuple[str, int]]) -> Model | None:
    """A model from pairs of text and label; None if a label is missing or has no word of three letters."""
    if {y for _, y in texts} != {0, 1}:
        return None
    rng = np.random.default_rng(7)
    found = [(sorted({f for t in tokens(s) if len(f := folded(t)) > 2}), y, k) for k, (text, y) in enumerate(texts) for s in _SENTENCE.split(text)]
    of_text: list[set[str]] = [set() for _ in texts]
    for words, _, k in found:
        of_text[k].update(words)
    in_toxic, in_all = Counter(), Counter()
    for k, (_, y) in enumerate(texts):
        own = of_text[k]
        in_all.update(own)
        if y:
            in_toxic.update(own)
    n1 = sum(y for _, y in texts)
    scale = n1 / max(1, len(texts) - n1)
    share = {w: c / (c + scale * (in_all[w] - c)) for w, c in in_toxic.items() if c >= MIN_TOXIC}
    suspects = {w for w, s in share.items() if s >= TOXIC_SHARE}
    if not suspects:
        # few labels, or insults spelled in many ways: of each toxic document the words with its highest smoothed share
        share = {w: c / (c + scale * (in_all[w] - c) + 1) for w, c in in_toxic.items()}
        highest = [max((share[w] for w in own if y), default=0) for own, (_, y) in zip(of_text, texts, strict=True)]
        suspects = {w for own, (_, y), top in zip(of_text, texts, highest, strict=True) if y for w in own if share[w] == top}
    toxic = [[w for w in words if w in suspects] for words, y, _ in found if y]
    toxic = [words for words in toxic if words]
    clean = [words for words, y, _ in found if not y and words]
    if not toxic or not clean:
        return None
    clean = [clean[i] for i in rng.permutation(len(clean))[:CLEAN_SENTENCES]]
    # each suspect also counts in forms with a letter inserted, which the machine is to tolerate
    forms = {w: [_inserted(w, rng) for _ in range(FORMS)] for w in sorted(suspects)}
    vocabulary = sorted({w for s in [*toxic, *clean, *forms.values()] for w in s})
    number = {w: i for i, w in enumerate(vocabulary)}
    frequent = [w for w, _ in Counter(w for s in clean for w in s).most_common(LANDMARKS // 2)]
    landmarks = sorted(sorted(suspects, key=lambda w: (-in_toxic[w], w))[: LANDMARKS // 2] + [w for w in frequent if w not in suspects])
    codes = np.unique(_merged(landmarks)[1])
    basis = features(landmarks, codes)
    values, vectors = np.linalg.eigh(basis @ basis.T + 1e-3 * np.eye(len(landmarks)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    z = np.concatenate([features(vocabulary[i : i + 500], codes) @ basis.T for i in range(0, len(vocabulary), 500)]) @ root
    w, b = np.zeros(z.shape[1]), 0.0
    chosen = {k: max(s, key=lambda x: share[x]) for k, s in enumerate(toxic)}
    clean_ids = [np.array([number[x] for x in s]) for s in clean]
    for round_ in range(ROUNDS):
        if round_:
            score = z @ w + b
            chosen = {k: max(s, key=lambda x: score[number[x]]) for k, s in enumerate(toxic)}
        positive = [*chosen.values(), *(f for x in chosen.values() for f in forms[x])]
        w, b = _hinge(z, np.array([number[x] for x in positive]), clean_ids, w, b)
    weights = np.zeros(_CODES**3)
    weights[codes] = (root @ w) @ basis
    model = Model(weights, float(b), np.zeros(TOP + 1))
    scorer = Scorer(model)
    # toxic sentences count as texts too, at a lower weight: one toxic word is enough in a text of one sentence
    top = np.concatenate([scorer.top([text]) for text, _ in texts] + [scorer.top([" ".join(words)]) for words in toxic])
    label = np.array([y for _, y in texts] + [1] * len(toxic), float)
    weight = np.array([1.0] * len(texts) + [SENTENCE_WEIGHT * n1 / len(toxic)] * len(toxic))
    return Model(weights, float(b), _logistic(top, label, weight))


def _inserted(word: str, rng) -> str:
    at = int(rng.integers(1, len(word)))
    return word[:at] + chr(97 + int(rng.integers(26))) + word[at:]


def _hinge(z, toxic: np.ndarray, clean: list[np.ndarray], w, b) -> tuple[np.ndarray, float]:
    """Minimises the regularised hinge loss over sentences, each by its highest word, in steps."""
    weight = len(clean) / max(1, len(toxic))
    flat, owner = np.concatenate(clean), np.repeat(np.arange(len(clean)), [len(c) for c in clean])
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    for step in range(1, STEPS + 1):
        score = z @ w + b
        highest = np.maximum.reduceat(score[flat], first)
        at = flat[np.flatnonzero(score[flat] == highest[owner])]
        bad_clean = at[score[at] > -1]
        bad_toxic = toxic[score[toxic] < 1]
        total = len(clean) * 2
        grad = REGULAR * w + (z[bad_clean].sum(axis=0) - weight * z[bad_toxic].sum(axis=0)) / total
        rate = 4 / (1 + 0.05 * step)
        w = w - rate * grad
        b -= rate * 0.5 * (len(bad_clean) - weight * len(bad_toxic)) / total
    return w, float(b)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Slopes and shift by Newton steps on the log loss with a small penalty."""
    design = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    theta = np.zeros(design.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        grad = design.T @ (weight * (p - y)) + 1e-2 * theta
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(len(theta))
        theta = theta - np.linalg.solve(hess, grad)
    return theta


class Scorer:
    """Scores of texts, with a bounded table of words."""

    def __init__(self, model: Model | None):
        self.model = model
        self.known: dict[str, float] = {}

    def top(self, texts: list[str | None]) -> np.ndarray:
        """The values of the TOP most toxic words of each text, descending."""
        words = [tokens(t) for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        new = list({w for own in words for w in own if w not in self.known})
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            self.known.update(zip(part, _word_values([folded(w) for w in part], self.model).tolist(), strict=True))
        none = _word_values([""], self.model).tolist() * TOP
        return np.array([sorted([*map(self.known.__getitem__, own), *none])[: -TOP - 1 : -1] for own in words])

    def score(self, texts: list[str | None]) -> list[float]:
        if self.model is None:
            return [0.0] * len(texts)
        *slopes, shift = self.model.logistic
        return (1 / (1 + np.exp(-np.clip(self.top(texts) @ slopes + shift, -30, 30)))).tolist()


_scorers: dict[str, Scorer] = {}


def score(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; learns from labels (doc_id, toxic) first."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = labels.where("toxic IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    texts = [(r["text"], r["toxic"]) for r in labelled.sample(rows, known, "toxic", per_label).collect()]
    key = uuid.uuid4().hex  # names the model in workers that serve several queries
    fitted = docs.sparkSession.sparkContext.broadcast(fit(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _scorers:
            _scorers.clear()
            _scorers[key] = Scorer(fitted.value)
        for batch in W.slices(batches, "text", 1 << 20):
            found = _scorers[key].score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(found, pa.float64()),
                    pa.array([int(x >= 0.5) for x in found], pa.int32()),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    wanted = rows.select("doc_id", labelled.held_out().alias("held_out"), "text")
    return wanted.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
