"""SentencePiece encoding over a table of distinct marked words, and decoding.

A text is written with a marker for every space and one before it. Where no piece of a
vocabulary has a marker behind another character, no merge ever crosses from a word to
the marker after it; so a text can be cut there, into runs of markers with the word that
follows, and each such *marked word* is segmented by itself. The same holds around
characters that no piece joins with others, such as line breaks, and between letters and
punctuation where no piece holds both. Whether the vocabulary allows this is checked when it is read.

Every distinct marked word gets a number and its ids in a table, segmented when it is
first met; a text is then a list of numbers, and its ids are put together by position.
The table lives in a worker process, across its tasks, and starts afresh at
``words`` entries. It is not one table for the whole corpus: to join a word's ids to its
places, every word of every text would have to be shuffled twice.

Segmenting follows the published rule: of all neighbours whose join is a piece, the pair
with the highest score is joined first, the leftmost of equals; what is no piece in the
end is spelt in bytes.

Decoding joins the surfaces of the pieces, turns markers into spaces, and drops the
marker that encoding put in front. Bytes are read as UTF-8, each that fits nowhere as U+FFFD.

Null text: as empty. Empty text: begin and end id alone. A null ``doc_id`` stays null;
repeated rows give repeated results; further columns of the input are not read. An empty
table gives an empty table. Markers that a text itself holds decode as spaces, as the
library has it.

One pass without a shuffle. Memory per task: the vocabulary, the table, and a slice of
rows of bounded size, or one longer text.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from blockmill.llm.texts import WordTable, map_rows

# The marker of a space, and what stands for bytes that are no text.
MARK = "▁"
BAD = "�"
SLICE_BYTES = 4 << 20
# Words of more characters are segmented with a queue.
SHORT = 48
_NEVER = float("-inf")


@dataclass(frozen=True)
class PieceSettings:
    """A model file, and marked words kept in a worker's table."""

    model_file: str
    words: int = 300_000


class Vocabulary:
    """Pieces, scores and special ids of a model file."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2 as files

        model = files.ModelProto()
        with open(model_file, "rb") as file:
            model.ParseFromString(file.read())
        kinds = files.ModelProto.SentencePiece
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids: dict[int, int] = {}
        self.surfaces: list[bytes] = []
        self.hidden: set[int] = set()
        self.unknown = model.trainer_spec.unk_id
        self.begin, self.end = model.trainer_spec.bos_id, model.trainer_spec.eos_id
        for number, piece in enumerate(model.pieces):
            surface = piece.piece.replace(MARK, " ").encode("utf-8")
            if piece.type == kinds.NORMAL:
                self.scores[piece.piece], self.ids[piece.piece] = piece.score, number
            elif piece.type == kinds.BYTE:
                byte = int(piece.piece[1:-1], 16)
                self.byte_ids[byte], surface = number, bytes([byte])
            elif piece.type == kinds.CONTROL:
                self.hidden.add(number)
                surface = b""
            elif piece.type == kinds.UNKNOWN:
                surface = model.trainer_spec.unk_surface.encode("utf-8")
            else:
                raise ValueError(f"piece {number} is of a kind that this encoder lacks")
            self.surfaces.append(surface)
        self._check(model)
        self.words = re.compile(_word_pattern(self.ids))

    def spelt(self, piece: str) -> list[int]:
        return [self.byte_ids[b] for b in piece.encode("utf-8")]

    def _check(self, model) -> None:
        rules, trained = model.normalizer_spec, model.trainer_spec
        plain = (
            trained.model_type == trained.BPE and rules.add_dummy_prefix and rules.escape_whitespaces
            and not rules.remove_extra_whitespaces and not rules.precompiled_charsmap
            and not trained.treat_whitespace_as_suffix and len(self.byte_ids) == 256
        )
        if not plain:
            raise ValueError("only BPE models with byte pieces, markers in front and no normalising are read")
        across = [p for p in self.ids if MARK in p.lstrip(MARK)]
        if across:
            raise ValueError(f"{len(across)} pieces cross from a word to the next marker")


def _word_pattern(pieces: dict[str, int]) -> str:
    """Marked words, and ASCII characters that no piece joins with others.

    Where no piece has letters beside other characters, a word ends there too.
    """
    longer = [p.lstrip(MARK) for p in pieces if len(p) > 1]
    joined = {c for p in longer if len(p) > 1 for c in p} | {p for p in longer if len(p) == 1}
    letters = {c for c in joined if c.isalpha()}
    if any(0 < sum(c in letters for c in p) < len(p) for p in longer):
        letters = set()
    alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined)
    run = "".join(sorted(letters))
    forms = [f"[{alone}]"] if alone else []
    forms += [f"{MARK}*[{run}]+"] if run else []
    return "|".join([*forms, f"{MARK}*[^{MARK}{alone}{run}]+", f"{MARK}+"])


def segment(word: str, scores: dict[str, float]) -> list[str]:
    """The pieces of one word."""
    return _by_scan(word, scores) if len(word) <= SHORT else _by_queue(word, scores)


def _by_scan(word: str, scores: dict[str, float]) -> list[str]:
    parts, find = list(word), scores.get
    joins = [find(a + b, _NEVER) for a, b in zip(parts, word[1:])]
    while joins:
        best = max(joins)
        if best == _NEVER:
            break
        at = joins.index(best)
        joined = parts[at] = parts[at] + parts.pop(at + 1)
        del joins[at]
        if at:
            joins[at - 1] = find(parts[at - 1] + joined, _NEVER)
        if at < len(joins):
            joins[at] = find(joined + parts[at + 1], _NEVER)
    return parts


def _by_queue(word: str, scores: dict[str, float]) -> list[str]:
    """The same in n log n steps. A pair in the queue counts while both its sides are as they were."""
    n = len(word)
    size, after, before = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
    queue: list[tuple[float, int, int, int]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < n:
            score = scores.get(word[left: right + size[right]])
            if score is not None:
                queue.append((-score, left, size[left], size[right]))

    for k in range(n):
        offer(k)
    heapq.heapify(queue)
    push = heapq.heappush

    def add(left: int) -> None:
        right = after[left]
        if right < n:
            score = scores.get(word[left: right + size[right]])
            if score is not None:
                push(queue, (-score, left, size[left], size[right]))

    while queue:
        _, left, mine, other = heapq.heappop(queue)
        right = after[left]
        if size[left] != mine or right >= n or size[right] != other:
            continue
        size[left], size[right] = mine + other, 0
        after[left] = after[right]
        if after[left] < n:
            before[after[left]] = left
        if before[left] >= 0:
            add(before[left])
        add(left)
    out, k = [], 0
    while k < n:
        out.append(word[k: k + size[k]])
        k = after[k]
    return out


class Encoder:
    """Whole texts to ids, with begin and end ids."""

    def __init__(self, vocabulary: Vocabulary, words: int):
        self.vocabulary = vocabulary
        self._table = WordTable(self._segmented, words)
        self._ends = np.array([vocabulary.begin]), np.array([vocabulary.end])

    def _segmented(self, words: list[str]) -> list[list[int]]:
        v = self.vocabulary
        out = []
        for word in words:
            parts = segment(word, v.scores)
            ids = [v.ids.get(p) for p in parts]
            if None in ids:
                ids = [n for p, k in zip(parts, ids) for n in (v.spelt(p) if k is None else (k,))]
            out.append(ids)
        return out

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        find = self.vocabulary.words.findall
        words = [find(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self._table.learn(words)
        begin, end = self._ends
        return [
            np.concatenate([begin, self._table.values(self._table.numbers(w))[0], end]) for w in words
        ]


class Decoder:
    """Ids to text."""

    def __init__(self, vocabulary: Vocabulary):
        self._surfaces = vocabulary.surfaces
        self._sizes = np.array([len(s) for s in self._surfaces], np.int64)
        self._starts = np.concatenate([[0], np.cumsum(self._sizes)])[:-1]
        self._bytes = np.frombuffer(b"".join(self._surfaces), np.uint8)
        self._marked = {n for p, n in vocabulary.ids.items() if p.startswith(MARK)}
        self._shown = np.array([n not in vocabulary.hidden for n in range(len(self._surfaces))])
        self._is_byte = np.zeros(len(self._surfaces), bool)
        self._is_byte[list(vocabulary.byte_ids.values())] = True

    def __call__(self, ids: np.ndarray) -> str:
        ids = np.asarray(ids, np.int64)
        shown = np.flatnonzero(self._shown[ids])
        if not len(shown):
            return ""
        ids = ids[shown[0]: shown[-1] + 1]
        sizes = self._sizes[ids]
        ends = np.cumsum(sizes)
        raw = self._bytes[np.repeat(self._starts[ids] - ends + sizes, sizes) + np.arange(int(ends[-1]))].tobytes()
        skip = int(ids[0]) in self._marked
        if len(ids) == len(shown):
            try:
                return raw[skip:].decode("utf-8")
            except UnicodeDecodeError:
                pass
        return self._by_runs(ids)[skip:]

    def _by_runs(self, ids: np.ndarray) -> str:
        """Runs of byte ids are read by themselves; neighbours, hidden ones too, end a character."""
        is_byte = self._is_byte[ids]
        cuts = np.flatnonzero(is_byte[1:] != is_byte[:-1]) + 1
        out = []
        for run in np.split(ids, cuts):
            raw = b"".join(self._surfaces[k] for k in run.tolist())
            out.append(_characters(raw) if self._is_byte[run[0]] else raw.decode("utf-8"))
        return "".join(out)


def _characters(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for width in (1, 2, 3, 4):
            try:
                out.append(raw[at: at + width].decode("utf-8"))
            except UnicodeDecodeError:
                continue
            at += width
            break
        else:
            out.append(BAD)
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def shared_encoder(settings: PieceSettings) -> Encoder:
    """One encoder for all tasks of a worker process, so that its table stays."""
    return Encoder(Vocabulary(settings.model_file), settings.words)


def default_settings() -> PieceSettings:
    import public_tokenizers

    return PieceSettings(public_tokenizers.path("piece_bpe_32k.model"))


def encode_and_decode(docs: DataFrame, settings: PieceSettings | None = None, ids: bool = False) -> DataFrame:
    """Tokens of each row of ``doc_id, text`` and digests of the ids and of the text they decode to.

    With ``ids`` a last column holds the token ids.
    """
    settings = settings or default_settings()

    def make():
        encoder = shared_encoder(settings)
        decoder = Decoder(encoder.vocabulary)

        def rows(doc_ids, texts):
            for doc_id, found in zip(doc_ids, encoder(texts)):
                of_ids = hashlib.sha256(found.astype("<u4").tobytes()).hexdigest()
                of_text = hashlib.sha256(decoder(found).encode("utf-8")).hexdigest()
                row = (doc_id, len(found), of_ids, of_text)
                yield (*row, found) if ids else row

        return rows

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(
        docs, ["doc_id", "text"], schema + (", ids array<int>" if ids else ""), make, SLICE_BYTES
    )
