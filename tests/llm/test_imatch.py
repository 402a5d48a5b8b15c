import hashlib

import numpy as np
import pytest

from blockmill.llm import imatch as I
from llm_cases import DOCS, edge_rows, prose


def test_next_and_edited_texts(edges, nothing):
    rows = sorted(
        ((I.LAST if r[0] is None else r[0], r[1] or "") for r in edge_rows()), key=lambda r: r[0]
    )
    got = I.fingerprints_with_next(edges).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    for k, (doc, text) in enumerate(rows):
        if doc in (15, 18, 39, 42, 54, I.LAST):  # before repeated rows or rows without an id, which the text hash orders
            continue
        after = rows[(k + 1) % len(rows)][1]
        row = by_id[doc][0]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(I.edited(text, after).encode()).hexdigest()
    prints = {}
    for r in got:
        for t in [t for d, t in rows if d == (I.LAST if r["doc_id"] is None else r["doc_id"])][:1]:
            if r["doc_id"] is not None:
                assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert I.fingerprints_with_next(nothing).count() == 0


def test_partitions_do_not_matter(spark):
    rows = [(7 * k % 1009, prose(k % 150, 30 + k % 50), "en", "s", 0) for k in range(300)]
    frame = spark.createDataFrame(rows, DOCS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for parts in (1, 4, 13):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append(sorted(map(tuple, I.fingerprints_with_next(frame.repartition(parts)).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]
    ordered = sorted(rows)
    for k, row in enumerate(found[0]):
        text, after = ordered[k][1], ordered[(k + 1) % len(ordered)][1]
        assert row[2] == hashlib.sha256(I.edited(text, after).encode()).hexdigest()
    near, far = np.array([r[5] for r in found[0]]), np.array([r[6] for r in found[0]])
    assert (near[:, None] > far[None, :]).mean() > 0.95


def test_one_document_is_its_own_next(spark):
    row = I.fingerprints_with_next(spark.createDataFrame([(5, prose(1, 40), "en", "s", 0)], DOCS)).collect()[0]
    text = prose(1, 40)
    assert row["edited_sha256"] == hashlib.sha256(I.edited(text, text).encode()).hexdigest()
    assert row["near_next"] == 1.0


def test_frequency_band(spark):
    settings = I.IMatchSettings(min_docs=2, max_share=0.5, slot_bits=16)
    texts = ["everywhere twice one", "everywhere twice two", "everywhere three", "everywhere four"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    table = I.document_frequency_table(frame.repartition(3), settings)
    terms = I.Terms(100)
    inside = I.Printer(table, settings)._in_band(terms([b"everywhere Twice, one two three four"])[0])
    assert inside.tolist() == terms([b"twice"])[0].tolist()


def test_plain_fingerprints(edges):
    plain = {tuple(r) for r in I.imatch_fingerprints(edges).collect()}
    both = {(r["doc_id"], r["fingerprint"]) for r in I.fingerprints_with_next(edges).collect()}
    assert plain == both
    assert pytest.approx(1.0) == I.Printer(np.zeros(1 << 16, np.uint64), I.IMatchSettings()).likeness(
        np.ones((6, 32), np.uint8), np.ones((6, 32), np.uint8))


@pytest.mark.parametrize("n", [50_000, 100_000, 400_000])
def test_long_texts_keep_their_likeness(n):
    rng = np.random.default_rng(3)
    printer = I.Printer(np.zeros(1 << 16, np.uint64), I.IMatchSettings(min_terms=1 << 30))  # all terms count
    text, after = rng.integers(0, 1 << 63, (2, n), dtype=np.uint64)
    own, following = printer(np.sort(text)), printer(np.sort(after))
    for share, least in ((0.25, 0.2), (0.1, 0.35), (0.03, 0.5)):
        k = int(n * share)
        near_edited = printer.likeness(own, printer(np.sort(np.concatenate([text[k:], after[:k]]))))
        assert near_edited > least
    assert printer.likeness(own, following) < 0.1


def test_band_holds_whatever_the_number_of_terms(spark):
    """Words of one document stay out, however many others there are and wherever they are counted."""
    rows = [(k, " ".join([f"one{k}x{n}" for n in range(300)] + [f"two{k // 2}x{n}" for n in range(9)])) for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    terms = I.Terms(100_000)
    for bits in (6, 10, 22):
        settings = I.IMatchSettings(slot_bits=bits)
        for parts in (1, 7):
            printer = I.Printer(I.document_frequency_table(frame.repartition(parts), settings), settings)
            for k, text in rows[::13]:
                want = terms([" ".join(f"two{k // 2}x{n}" for n in range(9)).encode()])[0]
                assert printer._in_band(terms([text.encode()])[0]).tolist() == want.tolist()


def test_fingerprint_equals_brute_force():
    """Draws, sorted lexicons and likeness in plain Python."""
    import xxhash

    rng = np.random.default_rng(9)
    settings = I.IMatchSettings(salts=8, min_terms=1)
    salts = np.random.default_rng(settings.seed).integers(0, 1 << 63, (8, 1), dtype=np.uint64)[:, 0].tolist()
    mask = (1 << 64) - 1

    def draw(term, salt):
        x = (term ^ salt) * int(I._A) & mask
        return (x ^ x >> 32) * int(I._B) & mask

    def brute(terms):
        out = []
        for size in settings.sizes:
            known = [[t for t in terms if draw(t, s) < 1 << 64 - size] for s in salts]
            large = len(terms) > settings.largest << size
            out.append([
                1 + xxhash.xxh32_intdigest(b"".join(t.to_bytes(8, "little") for t in k)) % ((1 << 32) - 1)
                if k and not large else 0 for k in known
            ])
        return out

    found = []
    for n in (1, 4, 30, 33, 200, 900):
        lexicon = np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        outside = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
        printer = I.Printer(lexicon, settings)
        got = printer(np.sort(np.concatenate([lexicon, outside])))
        assert got.tolist() == brute(lexicon.tolist())
        found.append((printer, lexicon, got))
    printer, lexicon, own = found[-1]
    other = printer(lexicon[90:])
    for a, b in ((own, other), (own, found[2][2]), (found[0][2], found[1][2]), (own, own)):
        rows = [[(x, y) for x, y in zip(*r) if x or y] for r in zip(a.tolist(), b.tolist())]
        enough = [r for r in rows if len(r) >= 4]
        level = enough[-1] if enough else rows[0]
        want = 1.0 if a.tolist() == b.tolist() else sum(x == y for x, y in level) / max(1, len(level))
        assert printer.likeness(a, b) == want


def test_rare_share_bounds_the_band(spark):
    rows = [(k, f"pair{k // 2} four{k // 4} eight{k // 8}") for k in range(64)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = [len(I.document_frequency_table(frame, I.IMatchSettings(min_share=s, max_share=0.5))) for s in (0, 4 / 64, 5 / 64)]
    assert sizes == [32 + 16 + 8, 16 + 8, 8]
    assert sizes[1] <= 3 / (4 / 64)  # mean terms of a document by the least share


def test_rows_without_id_are_spread(spark):
    """Null and repeated ids fill several ranges; the order is by text hash within an id."""
    rows = [(None if k % 3 else 7 if k % 2 else k, prose(k, 25)) for k in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    dealt = I.in_order_with_next(frame, 8).groupBy("part").count().collect()
    assert len(dealt) >= 6 and max(r["count"] for r in dealt) <= 2.5 * 600 / 8
    hashed = frame.selectExpr("coalesce(doc_id, 9223372036854775807) AS doc", "xxhash64(text) AS h", "text").collect()
    texts = [r["text"] for r in sorted(hashed, key=lambda r: (r["doc"], r["h"]))]
    want = sorted(
        hashlib.sha256(I.edited(t, texts[(k + 1) % len(texts)]).encode()).hexdigest() for k, t in enumerate(texts)
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 8):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert sorted(r["edited_sha256"] for r in I.fingerprints_with_next(frame).collect()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_terms_equal_plain_splitting():
    rng = np.random.default_rng(4)
    alphabet = list("abAB.,;-$ \t\n\x0b\x0c\r\x1c\x85\u00a0\u2028é\u4e2d") + ["  ", "x" * 30]
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 200))) for _ in range(300)] + ["", " ", ".,;", "a", "A." * 50]
    raws, known = [t.encode() for t in texts], {}
    for piece in (1, 7, 64, 1 << 20):
        for raw, got in zip(raws, I.Terms(piece)(raws)):
            want = {w.strip(I.EDGES) for w in raw.lower().split()} - {b""}
            assert len(got) == len(want)
            for term in want:  # a hash depends on the term alone
                if term not in known:
                    known[term] = int(I.Terms()([term])[0][0])
            assert sorted(known[t] for t in want) == got.tolist()
    assert len(set(known.values())) == len(known)
    assert I.Terms()([]) == []
