import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from blockmill.llm import pieces as P
from llm_cases import comparable, edge_rows, edge_texts

SETTINGS = P.default_settings()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=SETTINGS.model_file)
ENCODER = P.Encoder(P.Vocabulary(SETTINGS.model_file), SETTINGS.words)
DECODER = P.Decoder(ENCODER.vocabulary)


def library(text):
    return LIBRARY.encode(text, add_bos=True, add_eos=True)


def test_whole_texts(edges, nothing):
    want = []
    for doc_id, text, *_ in edge_rows():
        ids = library(text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(),
                     hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest(), ids))
    assert comparable(P.encode_and_decode(edges, ids=True).collect()) == comparable(want)
    assert P.encode_and_decode(nothing).count() == 0


ALPHABET = st.one_of(
    st.characters(exclude_categories=["Cs"], max_codepoint=0x2FFF), st.sampled_from(" \n\t▁'sé漢🙂a1.\r;»,()_²"),
)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=70))
def test_any_text_equals_the_library(text):
    ids = ENCODER([text])[0].tolist()
    assert ids == library(text)
    assert DECODER(ids) == LIBRARY.decode(ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 262), st.integers(0, 31_999)), max_size=25))
def test_any_ids_decode_as_the_library_has_it(ids):
    assert DECODER(ids) == LIBRARY.decode(ids)


def test_long_words_and_small_tables():
    rng = random.Random(2)
    words = ["".join(rng.choice("aeinorst-漢é") for _ in range(n)) for n in (47, 48, 49, 50, 500, 60_000)]
    words += ["a" * 5000, "▁" * 777, " " * 100 + "x", "the" * 3000]
    small = P.Encoder(ENCODER.vocabulary, 3)
    for texts in (words, [t for t in edge_texts() if t and len(t) < 5000]):
        assert [i.tolist() for i in small(texts)] == [library(t) for t in texts]


def test_random_scores():
    """Other vocabularies, over few letters so that joins compete; both ways of segmenting agree."""
    rng = random.Random(5)
    for _ in range(60):
        tokens, scores = list("abc"), {}
        for _ in range(25):
            token = rng.choice(tokens) + rng.choice(tokens)
            scores.setdefault(token, float(rng.randint(-6, 0)))
            tokens.append(token)
        for _ in range(60):
            word = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 40)))
            want = slow(word, scores)
            assert P._by_scan(word, scores) == want == P._by_queue(word, scores)


def slow(word, scores):
    parts = list(word)
    while True:
        joins = [(-scores[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in scores]
        if not joins:
            return parts
        k = min(joins)[1]
        parts[k: k + 2] = ["".join(parts[k: k + 2])]


@pytest.mark.parametrize("pieces", [{"ab": 1, "▁a": 2}, {"a.": 1, "ab": 2}, {"...": 1, "\n\n": 2, "ab": 3}])
def test_words_end_only_where_nothing_joins(pieces):
    """Any two neighbours that some piece joins lie in one word."""
    import re

    pattern = re.compile(P._word_pattern(pieces))
    pairs = {p[k: k + 2] for p in pieces for k in range(len(p) - 1)}
    rng = random.Random(1)
    for _ in range(300):
        text = "▁" + "".join(rng.choice("ab.▁\n1é") for _ in range(30))
        words = pattern.findall(text)
        assert "".join(words) == text
        assert not any(a[-1] + b[0] in pairs for a, b in zip(words, words[1:]))


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as files

    model = files.ModelProto()
    with open(SETTINGS.model_file, "rb") as file:
        model.ParseFromString(file.read())
    model.pieces[400].piece = "a▁b"
    (tmp_path / "across").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="cross"):
        P.Vocabulary(str(tmp_path / "across"))
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="normalising"):
        P.Vocabulary(str(tmp_path / "other"))


def test_no_ids():
    assert DECODER(np.array([], int)) == "" and DECODER([1, 2]) == ""
