import random

import pytest
import sentencepiece

from blockmill.llm import quality_rules as Q
from llm_cases import comparable, edge_rows


def brute(text):
    import re
    from collections import Counter
    from math import log2

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k: k + 8]) for k in range(len(words) - 7)]
    often = Counter(windows)
    hit = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    model = sentencepiece.SentencePieceProcessor(model_file=Q.default_rules().model_file)
    tokens = Counter(t for w in words for t in model.encode(w))
    n = sum(tokens.values())
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
        sum(x in lines[:k] for k, x in enumerate(lines)), len(hit),
        len(words) < 20 or 100 * len(hit) > 30 * len(words), n,
        -sum(c / n * log2(c / n) for c in tokens.values()) if n else 0.0,
    )


def test_counts_equal_brute_force(edges):
    got = Q.quality_rules(edges).collect()
    texts = [r[1] for r in edge_rows()]
    want = comparable([brute(t) for t in texts])
    found = comparable([
        (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
         r["base_failed"], r["n_tokens"], r["token_entropy"]) for r in got
    ])
    assert [w[:7] for w in want] == [f[:7] for f in found]
    assert [w[7] for w in want] == pytest.approx([f[7] for f in found])
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_stage_keeps_what_the_operator_keeps(edges, nothing):
    kept = Q.keep_good(edges)
    assert kept.columns == edges.columns
    assert kept.count() == Q.quality_rules(edges).filter("kept").count() > 0
    assert Q.keep_good(nothing).count() == Q.quality_rules(nothing).count() == 0


def test_bands_reject(spark):
    rng = random.Random(3)
    noise = " ".join("".join(rng.choice("qxzjkvw0987") for _ in range(12)) for _ in range(100))
    greek = " ".join("".join(rng.choice("αβγδεζηθ") for _ in range(6)) for _ in range(60))
    df = spark.createDataFrame([(1, noise), (2, greek)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in Q.quality_rules(df).collect()}
    assert not rows[1]["kept"] and not rows[1]["base_failed"]
    assert rows[2]["script"] == "greek"
    strict = Q.FertilityRules(Q.default_rules().model_file, language_bands={"xx": Q.Band(0, 99, 1, 99)})
    assert Q.quality_rules(df.selectExpr("*", "'xx' as lang"), strict).filter("kept").count() == 0


def test_word_table_starts_afresh():
    from blockmill.llm.texts import WordTable

    table = WordTable(lambda words: [[len(w)] * len(w) for w in words], 5)
    for text in (["a", "bb"], ["ccc", "dddd", "a"], ["eeeee", "ffffff", "bb"], list("uvwxyz")):
        table.learn([text])
        values, sizes = table.values(table.numbers(text))
        assert sizes.tolist() == [len(w) for w in text]
        assert values.tolist() == [len(w) for w in text for _ in w]


def figures_by_both_vocabularies(text):
    """Characters per token, share of byte tokens and entropy under each vocabulary, word by word."""
    import base64
    from collections import Counter
    from math import log2

    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    level = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    words = [w.decode() for w in (text or "").encode().split()]
    found = []
    for encode, is_byte in (
        (model.encode, model.is_byte),
        (lambda w: level.encode_ordinary(" " + w),
         lambda i: "�" in level.decode_single_token_bytes(i).decode("utf-8", "replace")),
    ):
        ids = Counter(i for w in words for i in encode(w))
        n = sum(ids.values())
        found.append((
            sum(map(len, words)) / n, sum(c for i, c in ids.items() if is_byte(i)) / n,
            -sum(c / n * log2(c / n) for c in ids.values()),
        ) if n else (0.0, 0.0, 0.0))
    return found


def test_verdict_equals_brute_force(spark, small):
    texts = [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    texts += [r[1] for r in edge_rows()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in Q.quality_rules(docs).collect()}
    for k, text in enumerate(texts):
        row, both = got[k], figures_by_both_vocabularies(text)
        best = 0 if both[0][0] >= both[1][0] else 1
        band = Q.DEFAULT_BANDS[row["script"]]
        share, bytes_, entropy = both[best]
        good = (band.min_chars_per_token <= share <= band.max_chars_per_token
                and bytes_ <= band.max_byte_share and entropy >= band.min_entropy)
        assert row["kept"] == (good and not row["base_failed"])
        assert row["best_vocabulary"] == best
        assert (row["best_chars_per_token"], row["best_byte_share"], row["best_token_entropy"]) == pytest.approx(both[best])
        assert (row["chars_per_token"], row["byte_share"], row["token_entropy"]) == pytest.approx(both[0])


def noise(letters, seed, words=100):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 10))) for _ in range(words))


def test_random_letters_go(spark):
    alphabets = [
        "bcdfghjklmnpqrstvwxz", "0123456789abcdef", "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщъыьэюя",
        "אבגדהוזחטיכלמנסעפצקרשת", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    ]
    rows = [(50 * k + n, noise(a, 50 * k + n)) for k, a in enumerate(alphabets) for n in range(50)]
    found = Q.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert not [r["doc_id"] for r in found if r["base_failed"] or r["kept"]]


# Plain sentences of many languages.
PROSE = {
    "en": "The old baker opened his small shop before sunrise because many people wanted warm bread every morning",
    "de": "Der alte Bäcker öffnete seinen kleinen Laden vor Sonnenaufgang, weil viele Leute jeden Morgen warmes Brot wollten",
    "fr": "Le vieux boulanger ouvrait sa petite boutique avant le lever du soleil, car beaucoup de gens voulaient du pain chaud",
    "es": "El viejo panadero abría su pequeña tienda antes del amanecer porque mucha gente quería pan caliente cada mañana",
    "pl": "Stary piekarz otwierał swój mały sklep przed wschodem słońca, ponieważ wielu ludzi chciało ciepłego chleba każdego ranka",
    "fi": "Vanha leipuri avasi pienen kauppansa ennen auringonnousua, koska monet ihmiset halusivat lämmintä leipää joka aamu",
    "tr": "Yaşlı fırıncı küçük dükkanını güneş doğmadan açardı, çünkü birçok insan her sabah sıcak ekmek isterdi",
    "vi": "Người thợ làm bánh già mở cửa hàng nhỏ trước khi mặt trời mọc vì nhiều người muốn bánh mì nóng mỗi buổi sáng",
    "el": "Ο γέρος φούρναρης άνοιγε το μικρό μαγαζί του πριν από την ανατολή του ήλιου, γιατί πολλοί άνθρωποι ήθελαν ζεστό ψωμί",
    "ru": "Старый пекарь открывал свою маленькую лавку до восхода солнца, потому что многие люди хотели тёплого хлеба каждое утро",
    "he": "האופה הזקן פתח את החנות הקטנה שלו לפני הזריחה כי אנשים רבים רצו לחם חם בכל בוקר ביום חורף",
    "ar": "كان الخباز العجوز يفتح متجره الصغير قبل شروق الشمس لأن كثيرا من الناس كانوا يريدون خبزا ساخنا كل صباح",
    "fa": "نانوای پیر مغازه کوچک خود را پیش از طلوع خورشید باز می کرد چون مردم بسیاری هر صبح نان گرم می خواستند",
    "uk": "Старий пекар відчиняв свою маленьку крамницю до сходу сонця, бо багато людей хотіли теплого хліба щоранку",
}


def test_prose_of_many_languages_stays(spark):
    rows = [(k, text, lang) for k, (lang, text) in enumerate(PROSE.items())]
    for r in Q.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect():
        band = Q.DEFAULT_BANDS[r["script"]]
        assert r["best_chars_per_token"] > 1.05 * band.min_chars_per_token, list(PROSE)[r["doc_id"]]
        assert r["best_byte_share"] <= band.max_byte_share and r["best_token_entropy"] >= band.min_entropy


def test_good_documents_stay(spark):
    """Of the documents marked good that pass the base counts, the bands reject none."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    good = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1").select("doc_id")
    found = Q.quality_rules(docs).filter("not base_failed").join(good, "doc_id")
    assert found.count() > 50 and found.filter("not kept").count() == 0


def test_slices_are_bounded():
    import pandas as pd

    texts = pd.Series([None, "", *["short"] * 600, "x" * (Q.SLICE_BYTES // 4 + 1), "y" * 300_000, "z" * 800_000, "end"])
    runs = list(Q._slices(texts))
    assert [k for r in runs for k in range(r.start, r.stop)] == list(range(len(texts)))
    assert all(r.stop - r.start <= 256 for r in runs)
    assert all(r.stop - r.start == 1 or 4 * sum(len(t or "") for t in texts[r]) <= Q.SLICE_BYTES for r in runs)
    assert list(Q._slices(pd.Series([], dtype=object))) == [slice(0, 0)]
