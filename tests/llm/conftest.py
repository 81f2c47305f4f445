from __future__ import annotations

import random

import pytest

#: Names that the operators use themselves, as columns that are none of their business.
CLASHING = ("text_key", "rest", "lines", "taken", "words", "count", "size", "class", "language", "score", "row", "n_words")


@pytest.fixture(scope="session")
def table(spark):
    """Rows of (doc_id, text) with lang, source, n_chars and columns of clashing names."""

    def make(rows, langs=None):
        langs = langs or {}
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
            f"`{c}` string" for c in CLASHING
        )
        full = [(i, t, langs.get(i), None, None if t is None else len(t), *CLASHING) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def texts():
    """Messy documents: near and exact copies, repeated rows and lines, nulls, odd white space."""
    chance = random.Random(5)
    vocabulary = [a + b for a in "bdfgklmn" for b in ("a", "e", "io", "um", "é")]

    def prose(n):
        words = [chance.choice(vocabulary) for _ in range(n)]
        return "".join(w + chance.choice([" "] * 8 + ["\n", "  ", "\t", ". "]) for w in words)

    rows = [(i, prose(chance.randint(1, 90))) for i in range(1, 24)]
    common = "Ka lum  dé fio gum be nio ka lum ga"
    for i, base in enumerate((3, 3, 7, 7, 7, 11)):
        words = rows[base][1].split(" ")
        words[chance.randrange(len(words))] = "changed"
        rows.append((30 + i, " ".join(words)))
    rows += [(40 + i, f"{prose(12)}\n  {common}\t\n{prose(9)}") for i in range(5)]
    rows += [(50, rows[2][1]), (51, rows[2][1]), (52, rows[2][1].upper()), (53, common), (54, common.lower() + "\n" + common)]
    rows += [(60, None), (61, ""), (62, "   \n\t "), (63, "solo"), (64, "#$%&"), (65, "a\x0bb\x0cc\rd"), (66, "日本 語 😀 ça")]
    rows += [(70, "la la la la " * 40), (71, prose(1500)), (None, rows[2][1]), (None, None), (3, rows[2][1])]
    return rows + [rows[4], rows[4]]
