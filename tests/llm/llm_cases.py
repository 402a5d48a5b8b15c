"""Rows that the tests of this folder share."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "amber birch cedar delta ember fable grove haven inlet jolly kayak lemon maple north ocean piano quiet river stone tulip".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(WORDS) for _ in range(rng.randint(1, 2))) for _ in range(n))


def edge_texts():
    """Nulls, empty and blank texts, repeats, near copies, long texts, other scripts."""
    base = prose(1, 300)
    shared = prose(2, 60)
    return [
        None, "", "  \n\t ", "a", "one two", "Ünïcode 漢字 🙂 text", base, base, base + " tail",
        base.replace("amber", "AMBER"), prose(3, 100) + "\n" + shared + "\n" + prose(4, 100),
        shared + " " + prose(5, 30), prose(6, 40) + " " + shared, "word " * 500, prose(7, 20_000),
        "\n".join(["same line here"] * 30), "#*$ %&| <> " * 20, "x\x1cy\x85z w v", prose(8, 50),
    ]


def edge_rows():
    rows = [(i * 3, t, "en", f"src{i % 4}", len(t or "")) for i, t in enumerate(edge_texts())]
    rows += [rows[6], rows[6], rows[14]]  # repeated rows
    rows += [(None, prose(9, 80), None, None, None), (None, None, None, None, None)]
    return rows


def comparable(rows):
    return sorted((tuple(r) for r in rows), key=repr)
