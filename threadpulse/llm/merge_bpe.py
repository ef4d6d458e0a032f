"""Encoding and decoding with a SentencePiece model of merge type, exact and without a merge queue.

Merging always joins the best-scored adjacent pair, the leftmost first. The result is the only sequence of
pieces in which every adjacent pair is stable: merging the text of the two again gives the same two. So the
encoder walks from left to right, takes the longest piece that begins at a position (all found by one
Aho-Corasick pass), checks that it is stable beside the piece before, and goes back to the next shorter
piece if not. A bitfield holds the positions from which no sequence went on, so none is tried twice.

A space is written as the model's mark for it, which begins pieces and never stands inside or after other
letters; merges therefore stay within a word and its leading marks, and the text is encoded word by word.
Words repeat, so each task keeps a bounded table of those that it has seen.

NULL counts as the empty text, which has the end id alone. Rows are independent; columns other than doc_id
and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from threadpulse.llm import words as W

MARK = "▁"
CACHED_WORDS, CACHED_LETTERS = 240_000, 64
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


class MergeEncoder:
    """Pieces of a model file, their order of merging, and the automaton over them."""

    def __init__(self, model_file: str, words: int = CACHED_WORDS):
        self.words = words
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        self.end_id, self.unknown_id = model.eos_id(), model.unk_id()
        self.byte_id: dict[int, int] = {}
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(_BYTE.fullmatch(piece)[1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.id[piece] = i
                self.rank[piece] = -model.get_score(i)
        # A piece of one letter needs no merge; any other counts only if merging its letters gives it.
        self.parts: dict[str, tuple[str, str]] = {}
        automaton, pieces = ahocorasick.Automaton(), []
        for piece in sorted(self.id, key=lambda p: (self.rank[p], len(p))):
            if len(piece) == 1 or self._by_merges(piece):
                automaton.add_word(piece, len(piece))
                pieces.append(piece)
        automaton.make_automaton()
        usable = set(pieces)
        #: Length of the longest usable piece that a piece begins with.
        self.shorter = {p: next((k for k in range(len(p) - 1, 0, -1) if p[:k] in usable), 0) for p in pieces}
        self.letters = frozenset(p for p in pieces if len(p) == 1)
        self.runs = re.compile(f"[{re.escape(''.join(sorted(self.letters)))}]+|.", re.DOTALL)
        self.automaton = automaton
        # two generations of words: when the young one is full it becomes the old one, and the old one goes
        self.young: dict[str, tuple[str, int, bytes]] = {}
        self.old: dict[str, tuple[str, int, bytes]] = {}
        self.known: dict[tuple[str, str], bool] = {}
        # a line end that no piece has stands alone, so that words beside it repeat more often
        end = "" if "\n" in self.id else "\n"
        self.word = re.compile(f"{MARK}*[^{MARK}{end}]+|{MARK}+|{end or MARK}+")

    def _by_merges(self, text: str) -> bool:
        """Whether merging the letters of text gives one piece; notes its last two parts."""
        parts = list(text)
        while len(parts) > 1:
            ranked = [self.rank.get(a + b, float("inf")) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranked)
            if best == float("inf"):
                return False
            at = ranked.index(best)
            if len(parts) == 2:
                self.parts[text] = (parts[0], parts[1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    def _stable(self, left: str, right: str) -> bool:
        """Whether merging the letters of left + right ends at just these two.

        The last merges are undone from both ends: a joint piece over the seam, were it merged before the
        larger of the two parts beside it, would have come first. On equal order the leftmost wins.
        """
        a, b, limit, from_right = left, right, float("inf"), True
        rank, parts = self.rank, self.parts
        stable = True
        while True:
            joint = rank.get(a + b)
            # what undid the part on the right lies right of the seam, so an equal joint merge comes first
            if joint is not None and (joint < limit or joint == limit and from_right):
                stable = False
                break
            pa_, pb = parts.get(a), parts.get(b)
            if pa_ is None and pb is None:
                break
            ra = rank[a] if pa_ else -float("inf")
            rb = rank[b] if pb else -float("inf")
            # the later merge is undone first; of two equal ones the right was the later
            if rb >= ra:
                b, limit, from_right = pb[0], rb, True
            else:
                a, limit, from_right = pa_[1], ra, False
        if len(self.known) < self.words:
            self.known[left, right] = stable
        return stable

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text without unknown letters."""
        longest = [0] * len(text)
        for last, size in self.automaton.iter(text):
            longest[last - size + 1] = size  # matches come by their end, so the longest of a place is last
        failed = bytearray((len(text) >> 3) + 1)
        known, shorter = self.known, self.shorter
        out: list[str] = []
        place, size, before = 0, longest[0] if longest else 0, None
        while place < len(longest):
            while size:
                end = place + size
                piece = text[place:end]
                if not failed[end >> 3] >> (end & 7) & 1:
                    if before is None:
                        break
                    if (stable := known.get((before, piece))) is None:
                        stable = self._stable(before, piece)
                    if stable:
                        break
                size = shorter.get(piece, 0)
            if size:
                out.append(piece)
                place, before = end, piece
                size = longest[place] if place < len(longest) else 0
            elif out:
                failed[place >> 3] |= 1 << (place & 7)
                piece = out.pop()
                place -= len(piece)
                before = out[-1] if out else None
                size = shorter.get(piece, 0)
            else:
                raise ValueError("the vocabulary has no stable sequence for this text")
        return out

    def encode_word(self, word: str) -> list[int]:
        """Ids of a word with its leading marks; letters that no piece has become their UTF-8 bytes."""
        if self.letters.issuperset(word):
            return [self.id[p] for p in self.pieces(word)]
        ids: list[int] = []
        for run in self.runs.findall(word):
            if run in self.letters or len(run) > 1:
                ids += [self.id[p] for p in self.pieces(run)]
            else:
                ids += [self.byte_id.get(b, self.unknown_id) for b in run.encode("utf-8", "replace")]
        return ids

    def _of_word(self, word: str) -> tuple[str, int, bytes]:
        """Ids as text with a leading space each, their number, and the bytes that they decode to."""
        if (kept := self.old.get(word)) is None:
            ids = self.encode_word(word)
            kept = "".join(f" {i}" for i in ids), len(ids), self._bytes(ids)
        if len(word) <= CACHED_LETTERS:
            if len(self.young) >= self.words:
                self.old, self.young = self.young, {}
            self.young[word] = kept
        return kept

    def _bytes(self, ids: list[int]) -> bytes:
        return b"".join(self._texts().get(i, b"") for i in ids)

    def _texts(self) -> dict[int, bytes]:
        if not hasattr(self, "_text_of"):
            self._text_of = {i: p.replace(MARK, " ").encode() for p, i in self.id.items()}
            self._text_of |= {i: bytes([b]) for b, i in self.byte_id.items()}
        return self._text_of

    def marked(self, text: str) -> str:
        """The text as it is encoded: one mark ahead, marks for spaces; the empty text stays empty."""
        return MARK + text.replace(" ", MARK) if text else ""

    def encode(self, text: str) -> list[int]:
        """Ids of the text and the end id."""
        return [i for word in self.word.findall(self.marked(text)) for i in self.encode_word(word)] + [self.end_id]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: the space ahead goes; bytes that are no UTF-8 become replacement letters."""
        return self._text(self._bytes(ids))

    @staticmethod
    def _text(data: bytes) -> str:
        return data.removeprefix(b" ").decode("utf-8", "replace")

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the decimal ids joined by spaces, SHA-256 of the decoded text."""
        young, rare = self.young, self._of_word
        found = [young.get(w) or rare(w) for w in self.word.findall(self.marked(text or ""))]
        ids = "".join([f[0] for f in found] + [f" {self.end_id}"])[1:]
        decoded = self._text(b"".join([f[2] for f in found]))
        return (
            sum(f[1] for f in found) + 1,
            hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )


_encoders: dict[tuple[str, int], MergeEncoder] = {}


def encoder(model_file: str, words: int = CACHED_WORDS) -> MergeEncoder:
    """One encoder for each model and size of its word tables in a Python worker."""
    if (model_file, words) not in _encoders:
        _encoders[model_file, words] = MergeEncoder(model_file, words)
    return _encoders[model_file, words]


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id and ids, an array that ends with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model_file)
        for batch in W.slices(batches, "text"):
            ids = [coder.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def digests(docs: DataFrame, model_file: str, words: int = CACHED_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text.

    Each Python worker keeps two tables of so many words; fewer cost time and save memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model_file, words)
        for batch in W.slices(batches, "text"):
            rows = [coder.digest(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
