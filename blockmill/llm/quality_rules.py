"""Quality rules: what public vocabularies make of a text, beside plain counts.

A vocabulary made for human languages spends few tokens on a text it knows and
many on noise. Each word is encoded by itself with several public vocabularies that
fall back to bytes: one of pieces, and byte-level ones given as ranks. Three figures of
the whole text are held against bands that depend on its language or script:

* characters per token (the inverse of fertility),
* share of byte-fallback tokens; at byte level, of tokens that are no whole characters,
* entropy of the token distribution, in bits.

A text is judged by the vocabulary that knows it best, that of most characters per
token (ties: the first), since any one of them lacks some languages. Random letters are
strange to all of them: ``qtxnv kbzrd`` has 1.2 to 1.5 characters a token, invented
prose about 2, real prose more. ``n_tokens``, ``chars_per_token``, ``byte_share`` and
``token_entropy`` are the first vocabulary's figures, the ``best_`` columns those that
the verdict looks at.

The base counts run before the bands; a text that fails them is rejected.

Null text: as empty. Empty or blank text: all counts 0, ``base_failed``. A null
``doc_id`` stays null; repeated rows give repeated results; further columns of the
input are not read. An empty table gives an empty table.

One pass without a shuffle. Memory per task: one slice of rows (256, or fewer that hold
4 MB; a longer text is a slice of its own) and a bounded cache of encoded words.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from blockmill.llm.texts import (
    SLICE, SPACES, WordTable, code_points_in_words, covered, map_rows, tidy, utf8, window_ids,
)

SLICE_BYTES = 4 << 20
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# First code point of each script block and its name; a block ends where the next begins.
SCRIPT_BLOCKS = (
    (0x00C0, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"),
    (0x0530, "other"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"),
    (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x3040, "cjk"), (0xA000, "other"),
    (0xAC00, "cjk"), (0xD7B0, "other"), (0xF900, "cjk"), (0xFB00, "other"),
    (0x20000, "cjk"), (0x32000, "other"),
)
_STARTS = np.array([s for s, _ in SCRIPT_BLOCKS])
_NAMES = [n for _, n in SCRIPT_BLOCKS]


@dataclass(frozen=True)
class Band:
    """What is accepted; both ends belong to the band."""

    min_chars_per_token: float
    max_chars_per_token: float
    max_byte_share: float
    min_entropy: float


# Least characters per token lie above random letters of the script (Latin consonants up
# to 1.54, Greek 1.11, Cyrillic 1.23, Hebrew 1.16, Arabic 1.13, Thai 0.78 in texts of 100
# words) and below prose in languages that the vocabularies hardly know. Other scripts are
# spelt in two or three bytes a character, noise or not.
DEFAULT_BANDS: Mapping[str, Band] = {
    "latin": Band(1.60, 8.0, 0.10, 4.0),
    "greek": Band(1.15, 8.0, 0.30, 3.5),
    "cyrillic": Band(1.25, 8.0, 0.20, 4.0),
    "hebrew": Band(1.18, 8.0, 0.60, 3.5),
    "arabic": Band(1.15, 8.0, 0.60, 3.5),
    "indic": Band(0.30, 8.0, 0.95, 3.0),
    "thai": Band(0.80, 8.0, 0.95, 3.0),
    "cjk": Band(0.30, 4.0, 0.90, 3.5),
    "other": Band(0.25, 8.0, 0.98, 3.0),
    "none": Band(0.25, 8.0, 0.50, 3.0),
}


@dataclass(frozen=True)
class FertilityRules:
    """Vocabularies and bands; a language's bands go before its script's.

    ``model_file`` is a SentencePiece model, ``rank_files`` are byte-level ranks whose
    pieces are cut by ``pattern``.
    """

    model_file: str
    bands: Mapping[str, Band] = field(default_factory=lambda: dict(DEFAULT_BANDS))
    language_bands: Mapping[str, Band] = field(default_factory=dict)
    cached_words: int = 200_000
    rank_files: tuple[str, ...] = ()
    pattern: str = ""


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()),
    T.StructField("script", T.StringType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("chars_per_token", T.DoubleType()),
    T.StructField("byte_share", T.DoubleType()),
    T.StructField("token_entropy", T.DoubleType()),
    T.StructField("best_vocabulary", T.IntegerType()),
    T.StructField("best_chars_per_token", T.DoubleType()),
    T.StructField("best_byte_share", T.DoubleType()),
    T.StructField("best_token_entropy", T.DoubleType()),
])


def script_of(text: str, raw: bytes) -> str:
    """The script of most letters; ties go to the name that sorts first."""
    plain = np.frombuffer(raw, np.uint8) | 0x20
    counts = {"latin": int(((plain >= ord("a")) & (plain <= ord("z"))).sum())}
    if len(raw) != len(text):
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        block = np.searchsorted(_STARTS, points[points >= _STARTS[0]], side="right") - 1
        for k, n in enumerate(np.bincount(block, minlength=len(_NAMES)).tolist()):
            counts[_NAMES[k]] = counts.get(_NAMES[k], 0) + n
    name, most = max(sorted(counts.items()), key=lambda x: x[1])
    return name if most else "none"


def repeated_words(ids: np.ndarray, size: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window which the text holds at least twice."""
    windows = window_ids(ids, size)
    if not len(windows):
        return 0
    often = np.bincount(windows) > 1
    if not often.any():
        return 0
    return int(covered(np.flatnonzero(often[windows]), size, len(ids)).sum())


def duplicate_lines(raw: bytes) -> int:
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES.encode())]
    return len(lines) - len(set(lines))


def _is_whole(token: bytes) -> bool:
    try:
        token.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def rank_encoding(file: str, pattern: str):
    """The byte-level encoding of a file of ranks, and which ids are no whole characters."""
    import tiktoken

    with open(file, "rb") as lines:
        ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(file, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    is_byte = np.zeros(max(ranks.values()) + 1, bool)
    is_byte[[n for t, n in ranks.items() if not _is_whole(t)]] = True
    return encoding, is_byte


class Fertility:
    """Token figures of texts, each word encoded by itself with every vocabulary.

    The vocabularies' ids lie one after another, so one table of words holds them all.
    """

    def __init__(self, rules: FertilityRules):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=rules.model_file)
        is_byte = [np.array([self._model.is_byte(i) for i in range(self._model.vocab_size())])]
        self._encodings = []
        for file in rules.rank_files:
            encoding, flags = rank_encoding(file, rules.pattern)
            self._encodings.append((encoding, sum(map(len, is_byte))))
            is_byte.append(flags)
        self._ends = np.cumsum([len(f) for f in is_byte])
        self._is_byte = np.concatenate(is_byte)
        self.table = WordTable(self._encode, rules.cached_words)

    def _encode(self, new: list[bytes]) -> list[list[int]]:
        texts = [w.decode("utf-8") for w in new]
        found = self._model.encode(texts, num_threads=1)
        for encoding, first in self._encodings:
            encode = encoding.encode_ordinary
            # Byte-level vocabularies know most words with the space before them.
            for ids, text in zip(found, texts):
                ids += [first + i for i in encode(" " + text)]
        return found

    def __call__(self, numbers: np.ndarray) -> list[np.ndarray]:
        """Ids of a text's words, an array for each vocabulary."""
        ids, _ = self.table.values(numbers)
        if len(self._ends) == 1:
            return [ids]
        owner = np.searchsorted(self._ends, ids, side="right")
        return [ids[owner == k] for k in range(len(self._ends))]

    def shares(self, ids: np.ndarray) -> tuple[float, float]:
        """Share of byte tokens, entropy."""
        if not len(ids):
            return 0.0, 0.0
        share = np.unique(ids, return_counts=True)[1] / len(ids)
        return float(self._is_byte[ids].sum() / len(ids)), float(-(share * np.log2(share)).sum())


def _measure(rules: FertilityRules):
    def make():
        fertility = Fertility(rules)

        def row(doc_id, text, raw, found, lang):
            numbers = fertility.table.numbers(found)
            n, chars = len(found), code_points_in_words(text)
            repeat = repeated_words(numbers)
            failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
            script = script_of(text, raw)
            ids = fertility(numbers)
            per_token = [chars / len(i) if len(i) else 0.0 for i in ids]
            best = per_token.index(max(per_token))
            first = fertility.shares(ids[0])
            byte_share, entropy = fertility.shares(ids[best]) if best else first
            band = rules.language_bands.get(lang) or rules.bands[script]
            good = (
                band.min_chars_per_token <= per_token[best] <= band.max_chars_per_token
                and byte_share <= band.max_byte_share and entropy >= band.min_entropy
            )
            return (
                doc_id, n, chars, sum(raw.count(s) for s in SYMBOLS), duplicate_lines(raw), repeat,
                failed, bool(good and not failed), script, len(ids[0]), per_token[0], *first,
                best, per_token[best], byte_share, entropy,
            )

        def rows(doc_ids, texts, langs):
            texts = [t or "" for t in texts]
            raws = [utf8(t) for t in texts]
            found = [r.split() for r in raws]
            fertility.table.learn(found)
            return map(row, doc_ids, texts, raws, found, langs)

        return rows

    return make


def default_rules() -> FertilityRules:
    import public_tokenizers

    return FertilityRules(
        public_tokenizers.path("piece_bpe_32k.model"),
        rank_files=(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),), pattern=public_tokenizers.PATTERN,
    )


def with_lang(docs: DataFrame) -> DataFrame:
    return docs if "lang" in docs.columns else docs.withColumn("lang", F.lit(None).cast("string"))


def quality_rules(docs: DataFrame, rules: FertilityRules | None = None) -> DataFrame:
    """Counts, token figures and verdict of every row of ``doc_id, text[, lang]``."""
    rules = rules or default_rules()
    return map_rows(with_lang(docs), ["doc_id", "text", "lang"], SCHEMA, _measure(rules), SLICE_BYTES)


def _slices(texts: pd.Series) -> Iterator[slice]:
    """Runs of rows of bounded number and size; a text's UTF-8 form has at most 4 bytes a code point."""
    first = size = 0
    for k, text in enumerate(texts):
        length = 4 * len(text) if text else 0
        if k > first and (k - first >= SLICE or size + length > SLICE_BYTES):
            yield slice(first, k)
            first, size = k, 0
        size += length
    yield slice(first, len(texts))


def keep_good(docs: DataFrame, rules: FertilityRules | None = None) -> DataFrame:
    """The rows that pass, with all their columns; decided row by row without a join."""
    rules = rules or default_rules()

    def passes(batches):
        rows = _measure(rules)()
        for texts, langs in batches:
            kept = []
            for run in _slices(texts):
                part = texts[run].tolist()
                kept += [r[7] for r in rows(part, part, langs[run].tolist())]
            yield pd.Series(kept, dtype=bool)

    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    verdict = F.pandas_udf(tidy(passes), "boolean", F.PandasUDFType.SCALAR_ITER)
    return docs.filter(verdict(F.col("text"), lang))
