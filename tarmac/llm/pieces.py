"""Exact piece encoding by backtracking, and decoding.

The longest piece that starts at a place is taken (an Aho-Corasick automaton walks from longest to
longest) if it can stand beside the piece before it: merging the two pieces' characters anew must
give the same two pieces. If not, the next shorter piece is tried, and the walk starts again behind
it; if none is left, the piece before is given back and its end is closed, as no encoding goes on
from there. Neighbours that all agree are the encoding that merging would give.

Texts are cut where no piece can reach across: before a run of spaces, around characters that
only bytes can stand for, and between letters and marks that follow a letter in no piece. Encoded units are kept in a cache of bounded size per worker.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import string
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tarmac.llm.arrow import add_columns, texts

SPACE = "▁"
# Units longer than this are not cached; a worker's cache holds twice ``generation`` units at most,
# some 250 bytes each, for as long as the worker lives. Checked pairs are kept likewise.
CACHED_LENGTH, GENERATION, PAIRS = 48, 400_000, 150_000
# Characters that a walk over a long unit takes at once.
WINDOW = 256


class PieceModel:
    """Vocabulary of a merge-type model with byte fallback, and encoding and decoding by it."""

    def __init__(self, path: str, generation: int = GENERATION) -> None:
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.generation = generation
        size = model.get_piece_size()
        self.end = model.eos_id()
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id = [0] * 256
        self.content: list[bytes] = [b""] * size
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.content[i] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.id[piece], self.rank[piece] = i, model.get_score(i)
                self.content[i] = piece.replace(SPACE, " ").encode()
            elif model.is_unknown(i):
                self.content[i] = " ⁇ ".encode()
        self.text_id = {str(i): content for i, content in enumerate(self.content)}
        self.end_text = str(self.end)
        self.spaced = {str(i) for piece, i in self.id.items() if piece[0] == SPACE}
        self.controls = {str(i) for i in range(size) if model.is_control(i)}
        self.single = {p for p in self.id if len(p) == 1}
        self.text = list(map(str, range(size)))
        # By id: the piece, its length, and the longest piece that it starts with (-1: none).
        self.piece, self.length, self.shorter = [""] * size, [0] * size, [-1] * size
        automaton = ahocorasick.Automaton()
        for piece, i in self.id.items():
            automaton.add_word(piece, i)
            self.piece[i], self.length[i] = piece, len(piece)
            self.shorter[i] = next((self.id[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.id), -1)
        automaton.make_automaton()
        self.walk = automaton.iter_long
        self.widest = max(self.length)
        self.space_run = max(len(p) for p in self.id if set(p) == {SPACE})
        self.blanks = [[self.id[p] for p in self.merge(SPACE * n)] for n in range(self.space_run)]
        joined = {b for p in self.id for a, b in zip(p, p[1:], strict=False) if _LETTER(a)}
        used = set().union(*self.id)
        breaks = "".join(repr(c)[1:-1] for c in "\n\r\t" if c not in used)
        enders = "".join(re.escape(c) for c in string.punctuation if c not in joined)
        # A word; then whatever has no space: no piece has one of the enders behind a letter, and
        # line breaks and tabs are characters that only bytes can stand for.
        self.units = re.compile(
            rf"{SPACE}*[^\W\d_]++(?=[{SPACE}{enders}{breaks}]|\Z)"
            rf"|{SPACE}+[^{SPACE}{breaks}]*|[{breaks or SPACE}]|[^{SPACE}{breaks}]+"
        ).findall
        self.agreed: dict[int, bool] = {}
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def merge(self, text: str) -> list[str]:
        """The definition: join the best-ranked neighbours, leftmost first, until none can be."""
        parts, rank = list(text), self.rank.get
        ranks = [rank(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best, at = None, -1
            for i, r in enumerate(ranks):
                if r is not None and (best is None or r > best):
                    best, at = r, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at])
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1])

    def agree(self, left: int, right: int) -> bool:
        """Whether two pieces (-1: none) stay as they are when their characters are merged anew."""
        key = (left + 1) * len(self.piece) + right
        known = self.agreed.get(key)
        if known is None:
            if len(self.agreed) >= PAIRS:
                self.agreed.clear()
            want = [self.piece[i] for i in (left, right) if i >= 0]
            known = self.agreed[key] = self.merge("".join(want)) == want
        return known

    def segment(self, text: str) -> list[int] | None:
        """Pieces of a text, as ids; None if a character is no piece itself."""
        length, shorter, agreed, size = self.length, self.shorter, self.agreed, len(self.piece)
        ids: list[int] = []
        closed: set[int] = set()
        at, left, whole = 0, -1, len(text)
        base, rim = 0, -1  # where the walk began, and up to where it sees the longest pieces
        while at < whole:
            if at > rim:
                base, rim = at, at + WINDOW - self.widest if at + WINDOW < whole else whole
                walk = self.walk(text[at:at + WINDOW])
            last, piece = next(walk, (-1, 0))
            end = base + last + 1
            if end - length[piece] != at or end == at:
                return None
            while True:
                known = agreed.get((left + 1) * size + piece)
                if (self.agree(left, piece) if known is None else known) and end not in closed:
                    break
                rim = -1
                piece = shorter[piece]
                while piece < 0:
                    if not ids:
                        return None
                    closed.add(at)
                    left = ids.pop()
                    at -= length[left]
                    piece = shorter[left]
                    left = ids[-1] if ids else -1
                end = at + length[piece]
            ids.append(piece)
            at, left = end, piece
        return ids

    def _all_known(self, text: str) -> list[int]:
        return self.segment(text) or [self.id[p] for p in self.merge(text)]

    def _spaces(self, count: int) -> list[int]:
        """A run of spaces: equal ranks join from the left, up to the longest run that is a piece."""
        full, rest = divmod(count, self.space_run)
        return [self.id[SPACE * self.space_run]] * full + self.blanks[rest]

    def encode_unit(self, unit: str) -> list[int]:
        """Ids of a run of spaces with what follows up to the next space."""
        ids = None if unit.startswith(SPACE + SPACE) else self.segment(unit)
        if ids is not None:
            return ids
        spaces = len(unit) - len(unit.lstrip(SPACE))
        head, ids = 0, []
        if spaces:
            unit = unit[spaces - 1:]
            run = self._known(unit, 0)
            first = self._all_known(run)
            lone = self.piece[first[0]] == SPACE
            ids = self._spaces(spaces if lone else spaces - 1) + (first[1:] if lone else first)
            head = len(run)
        while head < len(unit):
            run = self._known(unit, head)
            if run:
                ids += self._all_known(run)
                head += len(run)
            else:
                ids += [self.byte_id[b] for b in unit[head].encode("utf-8", "surrogatepass")]
                head += 1
        return ids

    def _known(self, text: str, at: int) -> str:
        end = at
        while end < len(text) and text[end] in self.single:
            end += 1
        return text[at:end]

    def _cached(self, unit: str) -> str:
        ids = self.young.get(unit)
        if ids is None:
            ids = self.old.get(unit)
            if ids is None:
                ids = " ".join(map(self.text.__getitem__, self.encode_unit(unit)))
            if len(unit) <= CACHED_LENGTH:
                if len(self.young) >= self.generation:
                    self.old, self.young = self.young, {}
                self.young[unit] = ids
        return ids

    def encode(self, text: str) -> str:
        """Ids of a text with the end id, in decimal, joined by spaces."""
        if not text:
            return str(self.end)
        units = self.units(SPACE + text.replace(" ", SPACE))
        ids = list(map(self.young.get, units))
        if None in ids:
            ids = [self._cached(unit) if known is None else known for unit, known in zip(units, ids, strict=True)]
        ids.append(str(self.end))
        return " ".join(ids)

    def decode(self, ids: list[str]) -> str:
        """The text of ids in decimal; bytes that are no UTF-8 become U+FFFD, one each.

        Control ids have no text, but bytes before and after one are not put together.
        """
        if ids and ids[-1] == self.end_text:
            ids = ids[:-1]
        if self.controls.isdisjoint(ids):
            text = self._bytes(ids)
        else:
            cuts = [-1, *(i for i, x in enumerate(ids) if x in self.controls), len(ids)]
            text = "".join(self._bytes(ids[a + 1:b]) for a, b in zip(cuts, cuts[1:], strict=False))
        first = next((x for x in ids if x not in self.controls), None)
        return text[1:] if first in self.spaced else text

    def _bytes(self, ids: list[str]) -> str:
        return b"".join(map(self.text_id.__getitem__, ids)).decode("utf-8", "each-byte")


_LETTER = re.compile(r"[^\W\d_]").fullmatch


def _replace_each(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("each-byte", _replace_each)


@lru_cache(maxsize=1)
def load(path: str, generation: int = GENERATION) -> PieceModel:
    return PieceModel(path, generation)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


ENCODED = "n_tokens bigint, ids array<int>, decoded string"
CHECKED = "n_tokens bigint, ids array<int>, round_trip boolean"
DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _mapped(
    docs: DataFrame, path: str, fields: str, row: Callable[[PieceModel, str], tuple], generation: int = GENERATION,
) -> DataFrame:
    def make():
        model = load(path, generation)

        def compute(batch):
            columns = list(zip(*[row(model, text) for text in texts(batch, "text")], strict=True)) or [()] * 3
            return [_lists(c) if c and isinstance(c[0], np.ndarray) else c for c in columns]
        return compute
    return add_columns(docs, fields, make, drop=["text"])


def _lists(rows: Sequence[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows)))


def _numbers(joined: str) -> np.ndarray:
    return np.fromstring(joined, np.int32, sep=" ")


def _ids_row(model: PieceModel, text: str) -> tuple:
    joined = model.encode(text)
    ids = joined.split(" ")
    return len(ids), _numbers(joined), model.decode(ids)


def _checked_row(model: PieceModel, text: str) -> tuple:
    joined = model.encode(text)
    ids = joined.split(" ")
    return len(ids), _numbers(joined), model.decode(ids) == text


def _digest_row(model: PieceModel, text: str) -> tuple:
    joined = model.encode(text)
    ids = joined.split(" ")
    decoded = model.decode(ids)
    return (len(ids), hashlib.sha256(joined.encode()).hexdigest(),
            hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Rows of ``docs`` (any columns and a ``text``) with n_tokens, ids and the text decoded from them.

    NULL and empty texts have the end id alone. Nothing is shuffled; rows are neither merged nor
    lost. A column of ``docs`` named like a result gives way to it.
    """
    return _mapped(docs, model or default_model(), ENCODED, _ids_row)


def encode_checked(docs: DataFrame, model: str | None = None, generation: int = GENERATION) -> DataFrame:
    """As ``encode_documents``, with whether the decoded text is the text instead of the text itself."""
    return _mapped(docs, model or default_model(), CHECKED, _checked_row, generation)


def encode_digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """As ``encode_documents``, with digests made where the ids are, for checks that need no ids."""
    return _mapped(docs, model or default_model(), DIGESTS, _digest_row)
