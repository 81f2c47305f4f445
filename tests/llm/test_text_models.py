from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import language_id, license_scan, toxicity

# --- language ---------------------------------------------------------------------------

SAMPLES = {
    "xa": "the cat and the dog went then to the thing there and them".split(),
    "xb": "der hund und die katze gehen dann zu dem ding dort und ihnen".split(),
    "xc": "el perro y la gata van luego a la cosa alla y ellos ñandu".split(),
}


@pytest.fixture(scope="module")
def spoken():
    chance = random.Random(1)
    rows, langs = [], {}
    for i in range(120):
        lang = chance.choice(sorted(SAMPLES))
        rows.append((i, " ".join(chance.choice(SAMPLES[lang]) for _ in range(40)).capitalize()))
        langs[i] = lang
    rows += [(200, None), (201, ""), (202, "123 !?"), (203, "the"), (204, "Ж"), (None, "the cat and the dog"), rows[0], rows[0]]
    langs |= {200: "xa", 202: "xb", 203: None}
    return rows, langs


def listed(text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    padded = "_" + "_".join(words) + "_" if words else ""
    grams = Counter(c for w in words for c in w)
    grams.update(padded[i : i + 2] for i in range(len(padded) - 1))
    grams.update(padded[i : i + 3] for i in range(len(padded) - 2) if padded[i + 1] != "_")
    return grams


def code(gram):
    value = 0
    for c in gram:
        value = value << 21 | (1 if c == "_" else ord(c) + 2)
    return value


def ranked(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))][:size]


def test_language_equals_brute_force_and_is_right_on_held_out_rows(spark, table, spoken):
    import zlib

    rows, langs = spoken
    docs = table(rows, langs).withColumn("lang", F.when(F.col("doc_id") != 203, F.col("lang")))
    got = {}
    for r in language_id.identify(docs, ranks=50, into="row").collect():
        got.setdefault((r["doc_id"], r["text"]), set()).add((r["row"]["lang_pred"], r["row"]["score"]))
        assert r["rest"] == "rest"
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    profiles = {}
    for i, text in rows:
        if text is not None and langs.get(i) and not held(i):
            profiles.setdefault(langs[i], Counter()).update(listed(text))
    profiles = {k: ranked(v, 50) for k, v in profiles.items()}
    right = total = 0
    for i, text in rows:
        own = ranked(listed(text), 50)
        sums = {
            k: sum(abs(p.index(g) - n) if g in p else 50 for n, g in enumerate(own)) for k, p in sorted(profiles.items())
        }
        best = min(sums, key=sums.get) if own else "und"
        score = 1 - sums[best] / (50 * len(own)) if own else 0.0
        ((name, value),) = got[i, text]
        assert name == best and value == pytest.approx(score)
        if held(i) and langs.get(i) and own:
            total, right = total + 1, right + (best == langs[i])
    assert total > 20 and right / total > 0.95


def test_language_without_labels_or_rows(table):
    assert language_id.identify(table([(1, "abc")])).first()["language"]["lang_pred"] == "und"
    assert language_id.identify(table([])).count() == 0


# --- licenses ---------------------------------------------------------------------------


def test_planted_licenses_are_found_where_they_are(table, texts):
    chance = random.Random(3)
    rows, planted = list(texts), {}
    for n, (name, text) in enumerate(license_scan.TEMPLATES.items()):
        words = text.split()
        if len(words) > 30:
            words[10] = "otherwise"
            words.insert(20, "inserted")
            del words[25]
        before = " ".join(chance.choice(["alpha", "beta", "Lizenz", "ü"]) for _ in range(n))
        planted[500 + n] = (name, before + "\n// " + "\n *  ".join(words) + "\nomega")
    rows += [(i, t) for i, (_, t) in planted.items()]
    found = license_scan.scan_licenses(table(rows)).collect()
    by_doc = {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(planted)
    for i, (name, text) in planted.items():
        best = max(by_doc[i], key=lambda r: (r["template_words"], r["coverage"]))
        assert best["template"] == name and best["coverage"] > 0.9
        span = text[best["first_char"] : best["end_char"]]
        assert len(license_scan.words_of(span)) == best["end_word"] - best["first_word"]
        assert license_scan.words_of(span) == license_scan.words_of(text)[best["first_word"] : best["end_word"]]


def longest_common(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    return table[-1, -1]


def test_alignment_reaches_the_longest_common_words_in_its_band():
    chance = random.Random(2)
    for _ in range(40):
        template = [chance.randrange(1, 200) for _ in range(40)]
        copy = [w if chance.random() > 0.1 else 0 for w in template]
        del copy[chance.randrange(40)]
        row = [0] * chance.randrange(5) + copy + [0] * 3
        matched, first, end = license_scan.align(np.array(row), np.array(template), -8, 8)
        assert 0 <= first < end <= len(row)
        assert longest_common(row[first:end], template) >= matched >= longest_common(row, template) - 3


def test_fewest_shared_words_still_share_a_fingerprint():
    index = license_scan.LicenseIndex(license_scan.TEMPLATES)
    for row in index.rows.values():
        codes = index._codes(row)
        picked = np.isin(codes, index.codes)
        runs = np.lib.stride_tricks.sliding_window_view(picked, license_scan.WIDTH)
        assert runs.any(axis=1).all()


def test_licenses_of_no_rows(table):
    assert license_scan.scan_licenses(table([])).count() == 0
    with pytest.raises(ValueError):
        license_scan.LicenseIndex({"short": "two words"})


# --- toxicity ---------------------------------------------------------------------------


def test_gradients_equal_differences():
    chance = np.random.default_rng(0)
    net = toxicity.Network({b"a": 2, b"bb": 3}, hidden=3, width=2)
    net.weights = {k: v.astype("float64") for k, v in net.weights.items()}
    words, ids = [b"a", b"bb", b"ccc"], chance.integers(0, 4, (5, 6))
    ids[:, 0] = 1
    label = np.array([0, 1, 0, 1, 1])

    def loss():
        p = 1 / (1 + np.exp(-net.run(net.gates(net.features(words)[0]), ids)))
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).sum()

    for name, grad in net.step(words, ids, label, np.ones(5)).items():
        flat = net.weights[name].reshape(-1)
        for i in np.flatnonzero(grad.reshape(-1))[:8]:
            kept = flat[i]
            flat[i] = kept + 1e-4
            up = loss()
            flat[i] = kept - 1e-4
            down = loss()
            flat[i] = kept
            assert grad.reshape(-1)[i] == pytest.approx((up - down) / 2e-4, rel=1e-3, abs=1e-6)


@pytest.mark.parametrize("n", [0, 1, 16, 31, 32, 33, 47, 48, 49, 500])
def test_windows_overlap_and_cover_every_word(n):
    starts = toxicity.window_starts(n)
    covered = {k for s in starts for k in range(s, min(n, s + toxicity.WINDOW))}
    assert covered == set(range(n)) and len(starts) >= 1
    assert all(b - a == toxicity.STRIDE for a, b in zip(starts, starts[1:], strict=False))
    ids, owner = toxicity.window_ids([n, 3], np.arange(1, n + 4), toxicity.STRIDE)
    assert [row[row > 0].tolist() for row in ids[owner == 0]] == [
        list(range(s + 1, min(n, s + toxicity.WINDOW) + 1)) for s in starts
    ]


def test_grams_of_a_word_do_not_depend_on_its_neighbours():
    together, counts = toxicity.char_grams([b"a", b"bcd", b"a"])
    alone, _ = toxicity.char_grams([b"bcd"])
    assert together[counts[0] : counts[0] + counts[1]].tolist() == alone.tolist()
    assert together[: counts[0]].tolist() == together[-counts[2] :].tolist()


def test_planted_toxic_words_are_told_apart_on_held_out_texts(spark, table):
    chance = random.Random(4)
    clean = ["word%d" % i for i in range(300)]
    bad = ["nasty", "vile", "rotten"]

    def make(toxic):
        words = [chance.choice(clean) for _ in range(chance.randrange(10, 120))]
        for _ in range(2 if toxic else 0):
            words[chance.randrange(len(words))] = chance.choice(bad)
        return " ".join(words)

    labels = [(i, i % 3 == 0) for i in range(600)]
    rows = [(i, make(toxic)) for i, toxic in labels]
    rows += [(None, "nasty"), (900, None), (901, ""), (902, "word1 " * 5000 + "vile rotten nasty"), rows[0]]
    docs = table(rows)
    known = spark.createDataFrame([(i, int(t)) for i, t in labels if i < 450] + [(900, 1), (1, None), (None, 1)], "doc_id long, toxic int")
    score = toxicity.toxicity_udf(toxicity.fit_on(docs, known))
    got = {(r["doc_id"], r["text"]): r["s"] for r in docs.select("*", score("text").alias("s")).collect()}
    assert all(0 <= s <= 1 for s in got.values())
    held = [(got[i, text] >= toxicity.CUT) == toxic for (i, text), (_, toxic) in zip(rows, labels, strict=False) if i >= 450]
    assert np.mean(held) > 0.93
    assert got[900, None] == got[901, ""] < 0.5


def test_one_class_and_no_class():
    for labels, low, high in (([], 0.4, 0.6), ([1, 1], 0.9, 1), ([0, 0, 0], 0, 0.1)):
        net = toxicity.fit(["some words", None, "more"][: len(labels)], labels)
        assert low <= toxicity.Scorer(net).scores(["some text"])[0] <= high
    assert len(toxicity.Scorer(net).scores([])) == 0
