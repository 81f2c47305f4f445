"""Links of the n-gram join, one by one, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from patronage.llm import ngram_join
from patronage.llm.common import keyed


def sets_of(rows, n):
    out = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        size = min(n, len(words))
        if i is not None and words:
            out[i] = frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    return out


def brute(rows, n, percent):
    sets = sets_of(rows, n)
    return {
        (a, b): len(sets[a] & sets[b])
        for a in sets
        for b in sets
        if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    }


@pytest.mark.parametrize("n, percent, block", [(4, 85, 256), (2, 50, 7)])
def test_every_link_of_a_large_group_is_returned(table, texts, monkeypatch, n, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    chance = random.Random(n)
    rows = list(texts)
    base = [f"w{chance.randrange(400)}" for _ in range(200)]
    for i in range(100, 160):  # near copies that are not all linked with each other
        copy = list(base)
        for _ in range(chance.randrange(5)):
            copy[chance.randrange(200)] = f"e{chance.random()}"
        rows.append((i, " ".join(copy)))
    rows += [(170, rows[-1][1]), (171, rows[-1][1])]
    wanted = brute(rows, n, percent)
    sets = sets_of(rows, n)
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    between = {(a, b): c for (a, b), c in wanted.items() if first[sets[a]] == a and first[sets[b]] == b and sets[a] != sets[b]}
    membership, links = ngram_join.near_duplicate_links(table(rows), n, percent, bits=14)
    found = links.collect()
    assert {(r["u"], r["v"]): r["common"] for r in found} == between and len(found) == len(between) > 100
    assert {r["doc_id"]: r["class_doc"] for r in membership.where("n_shingles > 0 and doc_id is not null").collect()} == {
        i: first[sets[i]] for i in sets
    }
    counts = {i: sum(i in pair for pair in wanted) for i in sets}
    got = {r["doc_id"]: r["n_links"] for r in ngram_join.with_link_counts(table(rows), n, percent, bits=14).collect()}
    assert got.pop(None) is None
    assert {i: c for i, c in got.items() if i in sets} == counts
    assert {c for i, c in got.items() if i not in sets} == {0}


def test_common_tokens_of_many_columns(monkeypatch):
    monkeypatch.setattr(ngram_join, "_COLUMNS", 5)
    chance = np.random.default_rng(1)
    left, right = ([np.unique(chance.integers(0, 40, 20)) for _ in range(k)] for k in (6, 4))
    left.append(np.zeros(0, "int64"))
    wanted = [[len(np.intersect1d(a, b)) for b in right] for a in left]
    assert ngram_join.common_tokens(left, right).tolist() == wanted


def test_links_of_no_rows(table):
    membership, links = ngram_join.near_duplicate_links(table([]), bits=10)
    assert membership.count() == links.count() == 0


def test_texts_that_nobody_asks_for_do_not_move(spark, table):
    """All rows that are asked for stay, by id and text; of the others only what a bitmap lets through."""
    rows = keyed(table([(i % 900, f"text {i}") for i in range(1000)] + [(None, "text 5"), (7, None)]))
    asked = rows.where("doc_id % 20 = 3")
    kept = ngram_join._marked(rows, asked, 14)
    assert kept.columns == rows.columns
    wanted = {tuple(r) for r in asked.collect()}
    found = [tuple(r) for r in kept.collect()]
    assert wanted <= set(found) and len(found) == len(set(found)) < len(wanted) + 20
    assert ngram_join._marked(rows, asked.limit(0), 14).count() == 0
