"""Personal data, spelling variants and conversation repair against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from patronage.llm import conversation_repair as repair
from patronage.llm import private_data, private_scan, queries, spelling_variants

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_strict(text):
    """The four forms as they are defined, without any shortcut."""

    def luhn(digits):
        doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    def digits(s):
        return re.sub("[^0-9]", "", s)

    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    return spans + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]


def messy_text(chance):
    pieces = [
        "a.b@c.de", "x@y", "@", "a@b.c_d@e.f.", "q%w@é.com", "1.2.3.4.5", "300.1.1.1", "001.02.3.255", "4111 1111 1111 1111",
        "4111-1111-1111-1112", "5500005555555559", "+1 (017) 555-7713", "+44 20", "+4 4 4 4 4 4 4 4 4 4", "12", ". ", " ", "-", "+",
        "é", "€ ", "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"", "user [at] mail [dot] org", "name", "\n", "7", "0",
        "2001:db8::1", "12:30:45", "DE89 3704 0044 0532 0130 00", "078-05-1120", "(017) 555-7713",
    ]
    return "".join(chance.choice(pieces) for _ in range(chance.randint(0, 25)))


def test_strict_spans_are_the_defined_ones():
    chance = random.Random(3)
    for _ in range(4000):
        text = messy_text(chance)
        assert private_scan.strict_spans(text) == plain_strict(text), text


def test_candidates_keep_strict_spans_and_do_not_touch():
    chance = random.Random(4)
    for _ in range(1500):
        text = messy_text(chance)
        found = private_scan.candidates(text)
        strict = [(private_scan.KINDS[c.kind], c.start, c.end) for c in found if c.strict]
        assert strict == plain_strict(text)
        loose = sorted((c.start, c.end) for c in found if not c.strict)
        for (_, a), (b, _) in itertools.pairwise(loose):
            assert a <= b
        for s, e in loose:
            assert not any(s < end and start < e for _, start, end in strict)
        for c in found:
            assert 0 <= c.votes < private_scan.N_VOTES and 0 <= c.features < private_scan.N_FEATURES


@pytest.mark.parametrize("unit", ["a", "1", "1 ", "1.", "a@", "@a", "+1 ", "a.b-", "A1", "(12) "])
def test_scans_are_linear(unit):
    start = time.time()
    private_scan.candidates(unit * (400_000 // len(unit)))
    assert time.time() - start < 20


def test_reliabilities_do_not_depend_on_grouping_and_are_found():
    chance = np.random.default_rng(1)
    true = chance.random(6000) < 0.3
    right = np.array([0.9, 0.95, 0.8, 0.7, 0.85])
    votes = np.zeros(len(true), "int64")
    for hit in right:
        agrees = chance.random(len(true)) < hit
        says_yes = np.where(agrees, true, ~true)
        votes = 3 * votes + np.where(chance.random(len(true)) < 0.2, 0, np.where(says_yes, 2, 1))
    values, counts = np.unique(votes, return_counts=True)
    grouped = private_data.estimate(values, counts)
    single = private_data.estimate(votes, np.ones(len(votes)))
    assert np.allclose(grouped.hits, single.hits) and np.isclose(grouped.share, single.share)
    assert abs(grouped.share - 0.3) < 0.03
    assert np.abs(grouped.hits - right).max() < 0.08 and np.abs(grouped.rejections - right).max() < 0.08
    likely = private_data.posterior(private_data.unpack(votes), grouped)
    assert ((likely > 0.5) == true).mean() > 0.93


def test_estimate_without_candidates_and_with_one_pattern():
    none = private_data.estimate(np.array([], "int64"), np.array([], "int64"))
    assert none.share == 0.5 and len(none.hits) == len(private_scan.LABELERS)
    one = private_data.estimate(np.array([0]), np.array([1000]))
    assert 0 < one.share < 1


def test_classifier_is_at_the_minimum():
    chance = np.random.default_rng(2)
    features = chance.integers(0, private_scan.N_FEATURES, 300)
    likely, counts = chance.random(300), chance.integers(1, 50, 300)
    weights = private_data.train(features, likely, counts)
    x = np.concatenate((np.ones((300, 1)), features[:, None] >> np.arange(len(private_scan.FEATURES)) & 1), axis=1)
    p = 1 / (1 + np.exp(-x @ weights))
    assert np.abs(x.T @ (counts * (p - likely)) + weights).max() < 1e-3


def plain_private(texts):
    """Counts of all candidates in one place, and the model from them."""
    seen = Counter((c.kind, c.votes, c.features) for t in texts for c in private_scan.candidates(t))
    accepted = set()
    for kind in {k for k, _, _ in seen}:
        rows = [(v, f, n) for (k, v, f), n in sorted(seen.items()) if k == kind]
        votes, features, counts = (np.array(c) for c in zip(*rows, strict=True))
        likely = private_data.posterior(private_data.unpack(votes), private_data.estimate(votes, counts))
        weights = private_data.train(features, likely, counts)
        for f in range(private_scan.N_FEATURES):
            z = weights[0] + sum(w for b, w in enumerate(weights[1:]) if f >> b & 1)
            if z >= 0:
                accepted.add((kind, f))
    return [private_data.spans_of(t, frozenset(accepted)) for t in texts]


def test_query_equals_plain_version(spark, table, texts, tmp_path):
    chance = random.Random(9)
    rows = [*texts, *((100 + i, messy_text(chance)) for i in range(150)), (300, "x" * 50_000 + " a@b.cd " + "7" * 9_000)]
    table(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in queries.op11_weak_supervision(spark, str(tmp_path)).collect())
    wanted = Counter()
    for (doc_id, _), (strict, spans) in zip(rows, plain_private([t for _, t in rows]), strict=True):
        counts = [sum(k == kind for k, _, _ in strict) for kind in ("email", "ip", "card", "phone")]
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in strict)
        wanted[(doc_id, *counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{k}:{s}:{e}" for k, s, e in spans))] += 1
    assert got == wanted
    assert any(len(row[-1].split(",")) > sum(row[1:5]) and row[-1] for row in got), "the method adds nothing"


def test_masking(spark, table):
    text = "mail a@b.cd and call +1 (017) 555-7713 now"
    found = private_data.find_private(table([(1, text), (2, None), (3, "")]), mask=True)
    masked = {r["doc_id"]: r["private"]["masked"] for r in found.collect()}
    assert masked == {1: "mail <email> and call <phone> now", 2: None, 3: ""}
    assert private_data.masked("abcdef", [("x", 0, 3), ("y", 2, 5), ("z", 5, 6)]) == "<x><z>"


def test_no_documents(spark, table):
    assert private_data.find_private(table([])).count() == 0
    assert spelling_variants.group_variants(table([])).count() == 0


def plain_variants(rows, least=7, times=10):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 31 == 0:
                at = h % len(low)
                low = low[:at] + low[at + 1 :]
            counts[low] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least and c >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        short, long = sorted((a, b), key=len)
        return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    out, forms = [], {}
    for w in n:
        others = [o for o in n if o != w and near(w, o)]
        best = min(others, key=lambda o: (-n[o], o), default=None)
        forms[w] = best if best is not None and n[best] >= times * n[w] else None
        out.append([w, forms[w], None, n[w], len(others), n[forms[w]] if forms[w] else None])
    for row in out:
        root = row[0]
        while forms[root]:
            root = forms[root]
        row[2] = root
    return Counter(map(tuple, out))


def test_variants_equal_plain_version(spark, table, texts):
    chance = random.Random(8)
    words = ["aaaaaaa", "aaaaaab", "baaaaaa", "aaaaaaaa", "éaaaaaa", "Grünwald", "grunwald", "gruenwald", "committee", "comittee",
             "commitee", "commitees", "committees", "ÿ×÷ÿÿÿÿ", "×÷ÿÿÿÿÿ", "zzzzzzz"]
    rows = list(texts)
    for i in range(400):
        often = [w for w in words for _ in range(1 + 30 * (w in ("committee", "aaaaaaa")))]
        rows.append((1000 + i, " ".join(chance.choice(often) for _ in range(40))))
    rows.append((2000, "committes " * 3 + "comitees " * 30 + "commiteees " * 2))
    rows.append((2001, "longword" * 4000 + " " + "longword" * 4000))
    got = Counter(tuple(r) for r in spelling_variants.group_variants(table(rows)).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == plain_variants(rows)
    assert any(form != root and form is not None for _, form, root, *_ in got)


def test_corrupted_words(spark):
    rows = [(i, w) for i in range(400) for w in ("straße", "abcdefg", "é")]
    frame = spark.createDataFrame(rows, "doc_id long, run string")
    changed = frame.select("doc_id", "run", spelling_variants.corrupted(frame["doc_id"], frame["run"]).alias("word")).collect()
    for doc_id, run, word in changed:
        h = zlib.crc32(f"{doc_id}:{run}".encode())
        at = h % len(run)
        assert word == (run[:at] + run[at + 1 :] if h % 31 == 0 else run)
    assert any(len(r["word"]) < len(r["run"]) for r in changed)


def test_ranges_are_no_larger_than_the_alphabet(spark):
    letters = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
    words = spark.createDataFrame([("abc" + c + "defg", 2 + i) for i, c in enumerate(letters)] + [("abcdefg", 500)], "word string, n long")
    sizes = spelling_variants.rotations(words).groupBy("prefix").count().agg({"count": "max"}).first()[0]
    assert sizes <= len(letters) + 1
    found = spelling_variants.neighbours(words).groupBy("word").sum("near").collect()
    assert {r[1] for r in found} == {len(letters)}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


GRAMMAR = re.compile("(s?(ua)+)?")


def plain_repair(rows):
    """All repairs in order of cost by brute force: sequences of edits, a row or an insert at a time."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        stripped = text.strip(" \t\n\v\f\r")
        faults.append(
            "blank" if not stripped else "duplicate" if (role, text) in seen else None if stripped[-1] in ".!?" else "truncated"
        )
        seen.add((role, text))
    best = None
    todo = [(0, "", 0, "", [])]
    while todo:
        cost, audit, at, initials, said = todo.pop()
        if best is not None and cost > best[0]:
            continue
        if not re.fullmatch("(s?(ua)*u?)?", initials):
            continue
        if at == len(rows) and GRAMMAR.fullmatch(initials) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, said)
        for role in ("user", "assistant"):
            if cost + 5 <= 2 * len(rows) or cost + 5 <= (best[0] if best else 10**9) and audit.count("I") < 3:
                todo.append((cost + 5, audit + "I", at, initials + role[0], [*said, f"{role}:"]))
        if at < len(rows):
            role, text = rows[at][2:]
            more = 5 if faults[at] == "truncated" else 0
            if faults[at] not in ("blank", "duplicate"):
                for new in ("user", "assistant"):
                    todo.append((cost + 1 + more, audit + "R", at + 1, initials + new[0], [*said, f"{new}:{text}"]))
                todo.append((cost + more, audit + "K", at + 1, initials + (role[:1] or "?"), [*said, f"{role}:{text}"]))
            todo.append((cost + 2, audit + "D", at + 1, initials, said))
    turns = [t for _, t, _, _ in rows if t is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(rows)]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        best[0],
        best[1],
        hashlib.sha256("\n".join(best[2]).encode()).hexdigest(),
    )


def by_conversation(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])
    return {c: sorted((r for r in plain_damage(rows) if r[0] == c), key=key) for c in {r[0] for r in rows}}


def talks(chance, n, longest, convs=None):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "Student"]
    texts = ["Yes.", "No!", "Why?", "cut off", "  ", "", None, "End. \n", "same.", "same."]
    rows = []
    for conv in convs or range(n):
        for turn in range(chance.randint(1, longest)):
            said = None if chance.random() < 0.1 else turn * chance.choice([1, 1, 1, 2])
            role = ("user", "assistant")[turn % 2] if chance.random() < 0.6 else chance.choice(roles)
            text = f"{chance.choice(texts) or ''} {turn}." if chance.random() < 0.5 else chance.choice(texts)
            rows.append((conv, said, role, text))
            if chance.random() < 0.05:
                rows.append(rows[-1])
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, hash string, said string, first string, copies string, part string"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired(spark, rows, folder, **sizes):
    frame = spark.createDataFrame([(*r, *"abcde") for r in rows], SCHEMA)
    if not sizes:
        frame.repartition(3).write.parquet(f"{folder}/conversations.parquet")
        found = queries.op13_glr_repair(spark, str(folder))
    else:
        found = repair.repair(repair.damage(frame), **sizes).withColumnRenamed("hash", "repaired_sha256")
    found = found.collect()
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in found}


def test_repair_equals_all_edits(spark, tmp_path):
    rows = talks(random.Random(2), 150, 6) + talks(random.Random(3), 1, 5, [None])
    wanted = {c: plain_repair(r) for c, r in by_conversation(rows).items()}
    assert repaired(spark, rows, tmp_path) == wanted
    assert any(not r for r in by_conversation(rows).values()), "no conversation lost all rows"


def test_pieces_make_no_difference(spark, tmp_path):
    rows = talks(random.Random(6), 12, 7) + talks(random.Random(7), 1, 400, [500]) + talks(random.Random(8), 1, 90, [None])
    rows += [(600, 1, "user", "same row.")] * 40 + [(601, None, "assistant", None)] * 30
    whole = repaired(spark, rows, tmp_path)
    assert repaired(spark, rows, None, piece_rows=1) == whole
    assert repaired(spark, rows, None, piece_rows=7, piece_chars=30) == whole
    plain = by_conversation(rows)
    for conv in set(plain) - {500, 600, 601, None}:
        assert whole[conv] == plain_repair(plain[conv])
    assert whole[600][2] == len(plain[600]) - 1 and whole[600][6].count("D") >= len(plain[600]) - 1


def test_equal_tops_merge_without_loss():
    """The automaton against all edits, on roles and faults alone."""
    for roles in itertools.product("sua", repeat=4):
        for fault in (None, "truncated", "blank"):
            rows = [repair.Row(i, {"s": "system", "u": "user", "a": "assistant"}[r], f"{i}.", fault if i == 2 else None)
                    for i, r in enumerate(roles)]
            cost, audit = repair.best_end(repair.tables_of(rows, (repair.START,))[repair.START])
            text = {None: "{}.", "truncated": "{}", "blank": " "}
            plain = [(0, i, r.role, text[r.fault].format(i)) for i, r in enumerate(rows)]
            assert (cost, audit) == plain_repair(plain)[5:7]


def test_no_conversations_and_very_long_text(spark, tmp_path):
    assert repaired(spark, [], None, piece_rows=5) == {}
    rows = [(1, 0, "user", "long " * 300_000 + "."), (1, 1, "assistant", "x" * 1_200_000), (2, 5, "user", "a.")]
    found = repaired(spark, rows, tmp_path)
    assert set(found) == {1, 2}
