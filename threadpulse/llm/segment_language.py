"""Language by unigram models of pieces, summed over all segmentations.

Every language has a probability for each piece of a fixed public vocabulary. The probability of a word is
the sum over all ways to cut it into pieces, by the forward algorithm; that of a text is the product over
its words, where a word is a run of letters, however long. The probabilities are fitted by expectation and
maximisation on the words of a sample of labelled texts, starting from how often pieces occur in them. A
letter that no piece covers counts as one piece of a fixed small probability.

The sample is bounded: SAMPLE whole texts of each of the LANGUAGES values of lang that most rows have (of
equally frequent ones the first in order), and at most TRAINED letters of one run. Every row is scored.

Only letters count: digits, number signs, other signs and white space cannot tell languages apart.
Prediction sees the text alone. Words of up to SHORT letters are summed directly; longer ones in logarithms, a
block of letters at a time, so that neither the sum nor the memory depends on the length.

Defined results: `und` with score 0 if the text is NULL or has no letter, or if there is nothing to learn
from. The score is the probability of the predicted language among the learned ones, at equal prior. Ties
go to the language first in order. Rows are independent; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadpulse.llm import labelled
from threadpulse.llm import words as W

SAMPLE = 150
LANGUAGES = 200
TRAINED = 1 << 20
SHORT = 32  # letters; sums of products of so many stay above zero
BLOCK = 4096  # letters of a long word that are summed at once
CELLS = 4_000_000  # sums (places of words, times languages) that are held at once
ROUNDS = 3
FLOOR = 1e-7  # probability of a letter that no piece covers
SMOOTH = 0.1
CACHED = 10_000_000  # sums (words, times languages) that a worker keeps
UNKNOWN = "und"
MARK = "▁"
_WORDS = re.compile(r"[^\W\d_]+")  # letters, and number signs that are no digits


class Pieces:
    """The automaton over the pieces of a vocabulary that consist of letters."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.automaton = ahocorasick.Automaton()
        self.n = self.longest = 0
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if not model.is_control(i) and not model.is_byte(i) and piece.removeprefix(MARK).isalpha() and piece == piece.lower():
                self.automaton.add_word(piece, self.n << 8 | len(piece))
                self.n += 1
                self.longest = max(self.longest, len(piece))
        self.automaton.make_automaton()

    def lattice(self, words: list[str]) -> Lattice:
        return Lattice(self, [MARK + word for word in words])

    def totals(self, words: list[str], chances: np.ndarray) -> np.ndarray:
        """Logarithms of the probabilities of words of any length, as (word, language)."""
        if max(map(len, words), default=0) <= SHORT:
            return self.lattice(words).totals(chances)
        out = np.zeros((len(words), chances.shape[1]))
        lengths = np.array([len(w) + 1 for w in words])
        # sums up to the last places before a block; the word's beginning is the first
        sums = np.full((len(words), self.longest, chances.shape[1]), -np.inf)
        sums[:, -1] = 0
        for a in range(0, int(lengths.max()), BLOCK):
            left = np.flatnonzero(lengths > a)
            shift = max(0, a - self.longest)
            part = Lattice(self, [(MARK + words[i])[shift : a + BLOCK] for i in left])
            # places are counted from longest - 1 before the block, as the sums known so far
            end = part.end + shift - a + self.longest - 1
            new = np.flatnonzero(end >= self.longest)
            before = sums[left]
            places = min(BLOCK, int(lengths.max()) - a)
            found = _log_sums(before, end[new], part.size[new], part.word[new], chances[part.piece[new]], places)
            done = lengths[left] <= a + BLOCK
            out[left[done]] = found[np.flatnonzero(done), lengths[left[done]] - a + self.longest - 1]
            sums[left] = found[:, -self.longest :]
        return out


def _log_sums(before: np.ndarray, end: np.ndarray, size: np.ndarray, word: np.ndarray, chance: np.ndarray, places: int) -> np.ndarray:
    """Logarithms of the sums up to each place, as (word, place, language), continued by a number of places.

    before holds the places known so far; pieces are in order of end, then word, with their chance by language.
    """
    n, known, languages = before.shape
    out = np.concatenate([before, np.zeros((n, places, languages))], axis=1)
    cut = np.searchsorted(end, np.arange(known, known + places + 1))
    for place, a, b in zip(range(known, known + places), cut, cut[1:], strict=False):
        last = out[:, place - 1]
        step = np.full((n, languages), FLOOR)
        if a < b:
            own = word[a:b]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            step[own[first]] += np.add.reduceat(np.exp(out[own, place - size[a:b]] - last[own]) * chance[a:b], first)
        out[:, place] = last + np.log(step)
    return out


def chunks(words: list[str], block: int, most: int, cells: int) -> Iterator[list[str]]:
    """The words in order of length, in lists of at most `most` words and, if of several, `cells` places in a block."""
    words = sorted(words, key=len)
    at = 0
    while at < len(words):
        size = most
        while size > 1 and size * min(len(words[min(at + size, len(words)) - 1]) + 1, block) > cells:
            size = (size + 1) // 2
        yield words[at : at + size]
        at += size


class Lattice:
    """All pieces in a list of marked words: the word, the place of the end, the length and the number of each."""

    def __init__(self, pieces: Pieces, words: list[str]):
        found = [list(pieces.automaton.iter(word)) for word in words]
        pairs = np.fromiter(chain.from_iterable(chain.from_iterable(found)), np.int64).reshape(-1, 2)
        self.word = np.repeat(np.arange(len(words)), [len(f) for f in found])
        end, self.size, self.piece = pairs[:, 0] + 1, pairs[:, 1] & 255, pairs[:, 1] >> 8
        self.lengths = np.array([len(w) for w in words], np.int64)
        order = np.lexsort((self.word, end))
        self.word, self.size, self.piece, self.end = self.word[order], self.size[order], self.piece[order], end[order]
        self.top = int(self.lengths.max()) if len(words) else 0
        self.cut = np.searchsorted(self.end, np.arange(self.top + 2))

    def forward(self, chances: np.ndarray) -> np.ndarray:
        """Sums over all segmentations up to each place, as (word, place, language), scaled by place.

        The first place is the mark of the word's beginning, which may also stand alone.
        """
        alpha = np.zeros((len(self.lengths), self.top + 1, chances.shape[1]))
        alpha[:, 0] = 1
        for place in range(1, self.top + 1):
            a, b = self.cut[place], self.cut[place + 1]
            alpha[:, place] = alpha[:, place - 1] * FLOOR
            if a == b:
                continue
            word = self.word[a:b]
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            own = alpha[word, place - self.size[a:b]] * chances[self.piece[a:b]]
            alpha[word[first], place] += np.add.reduceat(own, first)
        return alpha

    def totals(self, chances: np.ndarray) -> np.ndarray:
        """Logarithms of the probabilities of the words, as (word, language)."""
        alpha = self.forward(chances)
        return np.log(np.maximum(alpha[np.arange(len(self.lengths)), self.lengths], 1e-300))

    def expected(self, chances: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected counts of pieces over all segmentations, as (piece, language)."""
        if self.top > SHORT + 1:
            return self._expected_long(chances, weight)
        alpha = self.forward(chances)
        rows = np.arange(len(self.lengths))
        beta = np.zeros_like(alpha)
        beta[rows, self.lengths] = 1
        counts = np.zeros_like(chances)
        total = np.maximum(alpha[rows, self.lengths], 1e-300)
        for place in range(self.top, 0, -1):
            a, b = self.cut[place], self.cut[place + 1]
            word, start = self.word[a:b], place - self.size[a:b]
            flow = beta[word, place] * chances[self.piece[a:b]]
            np.add.at(counts, self.piece[a:b], alpha[word, start] * flow / total[word] * weight[word])
            np.add.at(beta, (word, start), flow)
            beta[:, place - 1] += beta[:, place] * FLOOR
        return counts


    def _expected_long(self, chances: np.ndarray, weight: np.ndarray) -> np.ndarray:
        begin = np.zeros((len(self.lengths), 1, chances.shape[1]))
        alpha = _log_sums(begin, self.end, self.size, self.word, chances[self.piece], self.top)
        # sums from each place to the end are those of the mirrored word
        start = self.lengths[self.word] - self.end + self.size
        order = np.lexsort((self.word, start))
        beta = _log_sums(begin, start[order], self.size[order], self.word[order], chances[self.piece[order]], self.top)
        total = alpha[np.arange(len(self.lengths)), self.lengths]
        left, right = alpha[self.word, self.end - self.size], beta[self.word, start - self.size]
        counts = np.zeros_like(chances)
        np.add.at(counts, self.piece, np.exp(left + right - total[self.word]) * chances[self.piece] * weight[self.word])
        return counts


def letters(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    found = _WORDS.findall((text or "").lower())
    if all(map(str.isalpha, found)):
        return found
    return [run for w in found for run in "".join(c if c.isalpha() else " " for c in w).split()]


def fit(texts: list[tuple[str, str]], pieces: Pieces) -> tuple[list[str], np.ndarray]:
    """Languages in order, and chances of pieces (piece, language), from pairs of text and language."""
    languages = sorted({lang for _, lang in texts})
    counts: dict[str, Counter] = {lang: Counter() for lang in languages}
    for text, lang in texts:
        counts[lang].update(run[:TRAINED] for run in letters(text))
    chances = np.full((pieces.n, len(languages)), SMOOTH)
    lattices = []
    for k, lang in enumerate(languages):
        for words in chunks(list(counts[lang]), TRAINED, 20_000, CELLS // 10):
            lattice = pieces.lattice(words)
            weight = np.array([counts[lang][w] for w in words], float)[:, None]
            np.add.at(chances[:, k], lattice.piece, weight[lattice.word, 0])
            lattices.append((k, lattice, weight))
    chances /= chances.sum(axis=0)
    for _ in range(ROUNDS):
        new = np.full_like(chances, SMOOTH)
        for k, lattice, weight in lattices:
            new[:, k : k + 1] += lattice.expected(chances[:, k : k + 1], weight)
        chances = new / new.sum(axis=0)
    return languages, chances


class Scorer:
    """Scores of texts, with a bounded table of words."""

    def __init__(self, languages: list[str], chances: np.ndarray, pieces: Pieces):
        self.languages, self.chances, self.pieces = languages, chances, pieces
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.known = np.zeros((1024, len(self.languages)), np.float32)

    def _learn(self, words: list[str]) -> None:
        runs = [letters(w) for w in words]
        total = {}
        for part in chunks(list({p for own in runs for p in own}), BLOCK, 5_000, CELLS // max(1, len(self.languages))):
            total.update(zip(part, self.pieces.totals(part, self.chances), strict=True))
        first = len(self.row)
        while len(self.known) < first + len(words):
            self.known = np.concatenate([self.known, np.zeros_like(self.known)])
        for k, (word, own) in enumerate(zip(words, runs, strict=True)):
            self.row[word] = first + k
            if own:
                self.known[first + k] = total[own[0]] if len(own) == 1 else sum(total[p] for p in own)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        words = [(t or "").split() for t in texts]
        if len(self.row) * len(self.languages) > CACHED:
            self.clear()
        self._learn(list({w for own in words for w in own if w not in self.row}))
        out = []
        for own in words:
            total = self.known[[self.row[w] for w in own]].sum(axis=0, dtype=np.float64) if own else np.zeros(1)
            if not total.any() or not self.languages:
                out.append((UNKNOWN, 0.0))
                continue
            best = int(total.argmax())
            out.append((self.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return out


_scorers: dict[str, Scorer] = {}
_pieces: dict[str, Pieces] = {}


def _pieces_of(model_file: str) -> Pieces:
    return _pieces.get(model_file) or _pieces.setdefault(model_file, Pieces(model_file))


def predict(docs: DataFrame, model_file: str, per_language: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; learns from docs (doc_id, text, lang) first."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    frequent = rows.where(~labelled.held_out() & F.col("lang").isNotNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    learned = F.broadcast(frequent.orderBy(F.desc("n"), "lang").limit(LANGUAGES).select("lang"))
    known = rows.select("doc_id", "lang").join(learned, "lang", "left_semi")
    texts = [(r["text"], r["lang"]) for r in labelled.sample(rows, known, "lang", per_language).collect()]
    key = uuid.uuid4().hex  # names the model in workers that serve several queries
    fitted = docs.sparkSession.sparkContext.broadcast(fit(texts, _pieces_of(model_file)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _scorers:
            _scorers.clear()
            _scorers[key] = Scorer(*fitted.value, _pieces_of(model_file))
        for batch in W.slices(batches, "text", 1 << 20):
            found = _scorers[key].predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    wanted = rows.select("doc_id", labelled.held_out().alias("held_out"), "text")
    return wanted.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
