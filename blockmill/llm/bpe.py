"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

*Encoding.* A token sequence is the BPE form of its bytes exactly if each pair of
neighbours is the BPE form of the pair's bytes. So every prefix of a piece has one
last token: the one that fits the last token of what stands before it. A state of
the transducer holds what the future can depend on: the last token already sent, the
tokens up to each place from which a token may still start, and where in the token
trie each of these starts stands. Reading a byte extends the
starts, finds the new prefix's last token and sends all tokens on which every
open start agrees; the look-ahead is bounded by the longest token. Moves are worked
out when first met and kept while the table has room; later ones are worked out each
time. The forms of whole chunks are kept too.

Pieces are the matches of the pattern. A single space between two characters that
are not white space always begins a piece, so a text may be cut there first and the
chunks, of which most repeat, looked up.

*Decoding.* A UTF-8 state machine reads token by token; a character that is split
over tokens is sent when its last byte arrives. A byte that cannot follow gives
U+FFFD and the machine starts again at that byte.

Null text: as empty, which has no tokens. Null ``doc_id`` stays null; repeated rows
give repeated results; further columns are not read; an empty table gives an empty
table. One pass, no shuffle. Tables in a task are bounded by ``BpeSettings``.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from blockmill.llm.texts import WordTable, map_rows

# Cut only between characters that no pattern takes for white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_NEVER = 1 << 62
# Chunks whose pieces are worked out together.
CHUNKS_AT_ONCE = 1 << 14
# Longest piece, in bytes, that goes step by step with others.
STEPS_TOGETHER = 64
PAIR_BITS = 20
PAIR_SLOTS = 1 << PAIR_BITS
# Fixed value: the golden ratio's odd multiplier, as a signed number (Fibonacci hashing).
PAIR_HASH = np.int64(-7046029254386353131)


@dataclass(frozen=True)
class BpeSettings:
    """A rank file (base64 token and rank on each line), the pattern, and table sizes."""

    rank_file: str
    pattern: str
    chunks: int = 400_000
    pieces: int = 300_000
    states: int = 60_000
    pairs: int = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int], down_to: int = 1) -> list[int]:
    """The definition: join the neighbours of least rank, leftmost first, until none joins.

    Stops early when ``down_to`` parts are left.
    """
    parts = [piece[k: k + 1] for k in range(len(piece))]
    while len(parts) > down_to:
        rank, at = min(
            (ranks.get(a + b, _NEVER), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))
        )
        if rank == _NEVER:
            break
        parts[at: at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Encodes one piece at a time."""

    def __init__(self, ranks: dict[bytes, int], states: int = 60_000, pairs: int = 200_000):
        self.ranks, self._max_states, self._max_pairs = ranks, states, pairs
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        # Trie of tokens: a node is the dictionary of its children and a token or None.
        self._children: list[dict[int, int]] = [{}]
        self._token: list[int | None] = [None]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                after = self._children[node].get(byte)
                if after is None:
                    after = self._children[node][byte] = len(self._children)
                    self._children.append({})
                    self._token.append(None)
                node = after
            self._token[node] = rank
        # The same trie for many pieces at once: edges by node * 256 + byte, in order.
        edges = sorted((node << 8 | byte, after) for node, found in enumerate(self._children) for byte, after in found.items())
        self._edges, self._edge_ends = np.array(edges, np.int64).T.copy()
        self._node_tokens = np.array([-1 if t is None else t for t in self._token], np.int64)
        self._sizes, self._shorter = (np.zeros(max(ranks.values()) + 1, np.int64) for _ in range(2))
        for token, rank in ranks.items():
            self._sizes[rank] = len(token)
            # The longest token that is a shorter beginning of this one; -1 for a byte.
            self._shorter[rank] = next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), -1)
        # Pairs met lately, each in the one slot that its key hashes to.
        self._pair_keys, self._pair_fits = np.zeros(PAIR_SLOTS, np.int64), np.zeros(PAIR_SLOTS, bool)
        # By left token << 32 | right token.
        self._fits: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._spines: tuple[dict[int, list[int]], dict[int, list[int]]] = ({}, {})
        # A state: the last token sent (-1: none), and for each place where a further token
        # may start, earliest first: the tokens from the last one sent up to there, and the
        # trie node to which the bytes since then lead. The last place is the end.
        start = (-1, ((),), (0,))
        self._number, self._states = {start: 0}, [start]
        # By state * 256 + byte: the next state, with the settled tokens if there are any.
        self._moves: dict[int, int | tuple[int, tuple]] = {}

    def _is_whole(self, token: int) -> bool:
        """Whether the token is the BPE form of its own bytes."""
        return self._halves_of(token) is not None

    def _halves_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of this one joins; (-1, -1) for a byte."""
        if token not in self._halves:
            found = (-1, -1)
            if len(self.bytes_of[token]) > 1:
                parts = merge(self.bytes_of[token], self.ranks, 2)
                whole = len(parts) == 2 and self.ranks.get(b"".join(map(self.bytes_of.get, parts))) == token
                found = tuple(parts) if whole else None
            self._halves[token] = found
        return self._halves[token]

    def _spine(self, token: int, side: int) -> list[int]:
        """The tokens at one end of a token while it is being merged, from its byte up to itself."""
        known = self._spines[side].get(token)
        if known is None:
            half = self._halves_of(token)[side]
            known = self._spines[side][token] = [*(self._spine(half, side) if half >= 0 else ()), token]
        return known

    def _fit(self, left: int, right: int) -> bool:
        """Whether the two tokens are the BPE form of their joint bytes.

        Follows both sides of the seam through the merges, in the order of their
        ranks: they fit if no pair at the seam would be merged before one of its
        members is merged into its own token.
        """
        key = left << 32 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= self._max_pairs:
                self._fits.clear()
            known = self._fits[key] = self._fit_anew(left, right)
        return known

    def _fit_anew(self, left: int, right: int) -> bool:
        return self._is_whole(right) and (
            left < 0 or self._seam_holds(self._spine(left, 1), self._spine(right, 0)))

    def _seam_holds(self, ends: list[int], begins: list[int]) -> bool:
        i = j = 0
        while True:
            after_left = ends[i + 1] if i + 1 < len(ends) else _NEVER
            after_right = begins[j + 1] if j + 1 < len(begins) else _NEVER
            seam = self.ranks.get(self.bytes_of[ends[i]] + self.bytes_of[begins[j]], _NEVER)
            if seam < after_left and seam <= after_right and seam != _NEVER:
                return False
            if after_left == after_right == _NEVER:
                return True
            if after_left <= after_right:
                i += 1
            else:
                j += 1

    def _move(self, state: tuple, byte: int) -> tuple[tuple, tuple]:
        """The state after a byte, and the tokens that it settles."""
        children, tokens = self._children, self._token
        sent, paths, nodes = state
        path, open_paths, open_nodes = None, [], []
        for before, node in zip(paths, nodes):  # the earliest start gives the longest token
            after = children[node].get(byte)
            if after is None:
                continue
            if path is None:
                token = tokens[after]
                if token is not None and self._fit(before[-1] if before else sent, token):
                    path = (*before, token)
            if children[after]:
                open_paths.append(before)
                open_nodes.append(after)
        if not open_paths:
            return (path[-1], ((),), (0,)), path
        open_paths.append(path)
        open_nodes.append(0)
        # What all paths share is settled; it is what the first and the last in order share.
        low, high, n = min(open_paths), max(open_paths), 0
        while n < len(low) and low[n] == high[n]:
            n += 1
        if n:
            sent, open_paths = path[n - 1], [p[n:] for p in open_paths]
        return (sent, tuple(open_paths), tuple(open_nodes)), path[:n]

    def _learn(self, at: int, byte: int) -> int | tuple[int, tuple]:
        state, settled = self._move(self._states[at], byte)
        number = self._number.setdefault(state, len(self._states))
        if number == len(self._states):
            self._states.append(state)
        move = self._moves[at << 8 | byte] = (number, settled) if settled else number
        return move

    def _longest(self, piece: bytes, at: int) -> int:
        """The longest token that begins at a byte."""
        children, tokens = self._children, self._token
        node = children[0][piece[at]]
        found = tokens[node]
        for k in range(at + 1, len(piece)):
            node = children[node].get(piece[k])
            if node is None:
                break
            if tokens[node] is not None:
                found = tokens[node]
        return found

    def _go_on(self, piece: bytes, settled: list[int]) -> list[int]:
        """The tokens of a piece whose first ones are settled, without keeping states.

        The same relation as ``_move``: each token fits the one before. Longer tokens are
        tried first; since a prefix has one last token only, a place from which no token
        leads on is given up for good.
        """
        out, bytes_of, shorter = settled, self.bytes_of, self._shorter.item
        fits, fit_of = self._fits.get, self._fit
        at, end = sum([len(bytes_of[t]) for t in out]), len(piece)
        dead, token = set(), self._longest(piece, at)
        while True:
            left = out[-1] if out else -1
            while token >= 0:
                after = at + len(bytes_of[token])
                if after not in dead:
                    fit = fits(left << 32 | token)
                    if fit is None:
                        fit = fit_of(left, token)
                    if fit:
                        break
                token = shorter(token)
            if token >= 0:
                out.append(token)
                if after == end:
                    return out
                at, token = after, self._longest(piece, after)
            else:
                dead.add(at)
                token = out.pop()
                at -= len(bytes_of[token])

    def _longest_at(self, data: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """``_longest`` at many places."""
        found, open_, node, at = np.full(len(at), -1), np.arange(len(at)), np.zeros(len(at), np.int64), at.copy()
        while len(open_):
            key = node << 8 | data[at]
            edge = np.minimum(np.searchsorted(self._edges, key), len(self._edges) - 1)
            is_edge = self._edges[edge] == key
            open_, at, node = open_[is_edge], at[is_edge] + 1, self._edge_ends[edge[is_edge]]
            token = self._node_tokens[node]
            found[open_[token >= 0]] = token[token >= 0]
            inside = at < ends[open_]
            open_, at, node = open_[inside], at[inside], node[inside]
        return found

    def _fit_each(self, lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
        """``_fit`` of many pairs."""
        keys = lefts + 2 << 32 | rights
        slots = keys * PAIR_HASH >> 64 - PAIR_BITS & PAIR_SLOTS - 1
        fits, unknown = self._pair_fits[slots], self._pair_keys[slots] != keys
        if unknown.any():
            new, which, back = np.unique(keys[unknown], return_index=True, return_inverse=True)
            pairs = zip(lefts[unknown][which].tolist(), rights[unknown][which].tolist())
            made = np.fromiter((self._fit_anew(a, b) for a, b in pairs), bool, len(new))
            fits[unknown] = made[back]
            slots = slots[unknown][which]
            # Of keys that share a slot, numpy keeps the last in both tables.
            self._pair_keys[slots], self._pair_fits[slots] = new, made
        return fits

    def _go_on_each(self, pieces: list[bytes], settled: list[list[int]]) -> list[list[int]]:
        """``_go_on`` for many pieces, all of them one step after the other."""
        bytes_of, n = self.bytes_of, len(pieces)
        rests = [p[sum([len(bytes_of[t]) for t in s]):] for p, s in zip(pieces, settled)]
        sizes = np.fromiter(map(len, rests), np.int64, n)
        data = np.frombuffer(b"\0".join(rests) + b"\0", np.uint8).astype(np.int64)
        ends = np.cumsum(sizes + 1) - 1
        at = ends - sizes
        first = np.fromiter((s[-1] if s else -1 for s in settled), np.int64, n)
        out, depth = np.zeros((n, int(sizes.max())), np.int64), np.zeros(n, np.int64)
        dead, left, token = np.zeros(len(data), bool), first.copy(), self._longest_at(data, at, ends)
        open_ = np.arange(n)
        while len(open_):
            none = token[open_] < 0
            if none.any():
                back = open_[none]
                dead[at[back]] = True
                depth[back] -= 1
                token[back] = out[back, depth[back]]
                at[back] -= self._sizes[token[back]]
                left[back] = np.where(depth[back] > 0, out[back, depth[back] - 1], first[back])
            after = at[open_] + self._sizes[token[open_]]
            good = ~dead[after]
            good[good] = self._fit_each(left[open_[good]], token[open_[good]])
            shorter, on = open_[~good], open_[good]
            token[shorter] = self._shorter[token[shorter]]
            out[on, depth[on]] = left[on] = token[on]
            depth[on] += 1
            at[on] = after[good]
            more = on[at[on] < ends[on]]
            token[more] = self._longest_at(data, at[more], ends[more])
            open_ = np.concatenate([shorter, more])
        return [s + row[:k] for s, row, k in zip(settled, out.tolist(), depth.tolist())]

    def _run(self, piece: bytes) -> tuple[list[int], bool]:
        """Tokens by the moves of the states, and whether these are all or only the settled first ones."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole], True
        out: list[int] = []
        at, find, more = 0, self._moves.get, len(self._states) < self._max_states
        for byte in piece:
            move = find(at << 8 | byte)
            if move is None:
                if not more:
                    return out, False
                move = self._learn(at, byte)
            if type(move) is int:
                at = move
            else:
                at, settled = move
                out += settled
        # The last start is the end of the piece.
        out += self._states[at][1][-1]
        return out, True

    def encode(self, piece: bytes) -> list[int]:
        out, done = self._run(piece)
        # The table is full: what it does not know is worked out and forgotten.
        return out if done else self._go_on(piece, out)

    def encode_each(self, pieces: list[bytes]) -> list[list[int]]:
        """The tokens of many pieces; what the table does not know is worked out for all at once."""
        found, rest = [], []
        for k, piece in enumerate(pieces):
            out, done = self._run(piece)
            if not done:
                if len(piece) <= STEPS_TOGETHER:
                    rest.append(k)
                else:
                    out = self._go_on(piece, out)
            found.append(out)
        if rest:
            for k, out in zip(rest, self._go_on_each([pieces[k] for k in rest], [found[k] for k in rest])):
                found[k] = out
        return found


# Lead byte ranges of UTF-8 with the range of the second byte and the
# number of further bytes (Unicode Standard, table of well-formed byte sequences).
UTF8_LEADS = (
    (0x00, 0x7F, 0, 0, 0), (0xC2, 0xDF, 0x80, 0xBF, 1), (0xE0, 0xE0, 0xA0, 0xBF, 2),
    (0xE1, 0xEC, 0x80, 0xBF, 2), (0xED, 0xED, 0x80, 0x9F, 2), (0xEE, 0xEF, 0x80, 0xBF, 2),
    (0xF0, 0xF0, 0x90, 0xBF, 3), (0xF1, 0xF3, 0x80, 0xBF, 3), (0xF4, 0xF4, 0x80, 0x8F, 3),
)


class StreamDecoder:
    """Token ids to text, as they come. What a character still lacks is the state."""

    BAD = "\ufffd"

    def __init__(self, bytes_of: dict[int, bytes]):
        self._bytes_of = bytes_of
        self._lead = {b: rest for low, high, *rest in UTF8_LEADS for b in range(low, high + 1)}
        # By state (bytes of an unfinished character) and token: text to send, next state.
        self._steps: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}
        # Of the steps from the first state back to it, the text alone.
        self._whole: dict[int, str] = {}
        self.pending = b""

    def _step(self, pending: bytes, token: int) -> tuple[str, bytes]:
        out = []
        for byte in self._bytes_of[token]:
            if pending:
                low, high, more = self._lead[pending[0]]
                if not (low if len(pending) == 1 else 0x80) <= byte <= (high if len(pending) == 1 else 0xBF):
                    out.append(self.BAD)
                    pending = b""
            if pending:
                pending += bytes([byte])
                if len(pending) > more:
                    out.append(pending.decode("utf-8"))
                    pending = b""
            elif byte not in self._lead:
                out.append(self.BAD)
            elif self._lead[byte][2]:
                pending = bytes([byte])
            else:
                out.append(chr(byte))
        return "".join(out), pending

    def feed(self, ids: list[int]) -> str:
        out = list(map(self._whole.get, ids))
        at = 0
        while at < len(ids):
            if not self.pending:
                try:
                    at = out.index(None, at)
                except ValueError:
                    break
            token, pending = ids[at], self.pending
            steps = self._steps.setdefault(pending, {})
            step = steps.get(token)
            if step is None:
                step = steps[token] = self._step(pending, token)
                if not pending and not step[1]:
                    self._whole[token] = step[0]
            out[at], self.pending = step
            at += 1
        return "".join(out)

    def finish(self) -> str:
        """Whatever is left of an unfinished character."""
        rest, self.pending = self.pending, b""
        return self.BAD if rest else ""


@lru_cache(maxsize=2)
def shared_encoder(settings: BpeSettings) -> "Encoder":
    """One encoder for all tasks of a worker process, so what it has learned stays."""
    encoder = Encoder(settings)
    gc.freeze()  # the vocabulary's tables live as long as the process
    return encoder


class Encoder:
    """Whole texts to token ids."""

    def __init__(self, settings: BpeSettings):
        import regex

        self.transducer = Transducer(read_ranks(settings.rank_file), settings.states, settings.pairs)
        self._pieces = regex.compile(settings.pattern).findall
        self._table = WordTable(self._encode, settings.chunks)
        # Pieces met lately and those before; what is met again stays.
        self._known: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        self._most = settings.pieces

    def _encode(self, chunks: list[str]) -> list[Sequence[int]]:
        out: list[Sequence[int]] = []
        for first in range(0, len(chunks), CHUNKS_AT_ONCE):
            pieces = list(map(self._pieces, chunks[first: first + CHUNKS_AT_ONCE]))
            found = self._tokens_of(dict.fromkeys(chain.from_iterable(pieces)))
            out += [found[p[0]] if len(p) == 1 else list(chain.from_iterable(map(found.__getitem__, p))) for p in pieces]
        return out

    def _tokens_of(self, pieces: Iterable[str]) -> dict[str, tuple[int, ...]]:
        # Chunks that differ in their punctuation share their pieces.
        found: dict[str, tuple[int, ...]] = {}
        new = []
        for piece in pieces:
            tokens = self._known.get(piece) or self._older.get(piece)
            if tokens is None:
                new.append(piece)
            else:
                found[piece] = tokens
        found.update(zip(new, map(tuple, self.transducer.encode_each([p.encode("utf-8") for p in new]))))
        if len(self._known) + len(found) > self._most:
            self._older, self._known = self._known, {}
        self._known.update(found)
        return found

    @staticmethod
    def _chunks(text: str | None) -> list[str]:
        if not text:
            return []
        first, *rest = _CUT.split(text)
        return [first, *[" " + c for c in rest]]

    def __call__(self, texts: list[str | None]) -> list[list[int]]:
        chunks = [self._chunks(t) for t in texts]
        self._table.learn(chunks)
        return [self._table.values(self._table.numbers(c))[0].tolist() for c in chunks]


def default_settings() -> BpeSettings:
    import public_tokenizers

    return BpeSettings(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_and_decode(docs: DataFrame, settings: BpeSettings | None = None, ids: bool = False) -> DataFrame:
    """Tokens of each row of ``doc_id, text`` and digests of the ids and of the text they decode to.

    With ``ids`` a last column holds the token ids.
    """
    settings = settings or default_settings()

    def make():
        encoder = shared_encoder(settings)
        decoder = StreamDecoder(encoder.transducer.bytes_of)
        digits = {token: str(token) for token in encoder.transducer.bytes_of}.__getitem__

        def rows(doc_ids, texts):
            for doc_id, found in zip(doc_ids, encoder(texts)):
                text = decoder.feed(found) + decoder.finish()
                row = (doc_id, len(found), _digest(",".join(map(digits, found)).encode()), _digest(text.encode("utf-8")))
                yield (*row, found) if ids else row

        return rows

    schema = DIGESTS + (", ids array<int>" if ids else "")
    return map_rows(docs, ["doc_id", "text"], schema, make)
