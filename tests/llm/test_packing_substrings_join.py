from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from patronage.llm import ngram_join, packing, substring_dedup
from patronage.llm.queries import public_vocabulary
from patronage.llm.suffix_automaton import SuffixAutomaton
from patronage.llm.tokens import Encoder

# --- packing ----------------------------------------------------------------------------


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fitting = [(room, i) for i, room in enumerate(rooms) if room >= n]
        if fitting:
            rooms[min(fitting)[1]] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def test_plan_equals_piece_by_piece_best_fit():
    chance = random.Random(1)
    for _ in range(150):
        capacity = chance.choice([1, 5, 10, 64, 100])
        lengths = [chance.randint(1, capacity) for _ in range(chance.randint(0, 120))]
        counts = Counter(lengths)
        moves, bins = sorted(packing.best_fit_plan(counts, capacity)), defaultdict(list)
        for this, after in zip(moves, [*moves[1:], None], strict=False):
            end = after.rank if after and after.length == this.length else counts[this.length]
            for nth in range(end - this.rank):
                at = this.offset + nth % this.per_bin * this.length
                bins[this.bin + nth // this.per_bin].append((at, this.length))
        for parts in bins.values():
            parts.sort()
            assert [a for a, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sorted(capacity - sum(n for _, n in p) for p in bins.values()) == best_fit_decreasing(lengths, capacity)


@pytest.fixture(scope="module")
def vocabulary():
    pytest.importorskip("public_tokenizers")
    return public_vocabulary()


def test_ids_equal_the_tokenizer(vocabulary):
    from tokenizers import Tokenizer

    whole, ours = Tokenizer.from_file(vocabulary["tokenizer"]), Encoder(**vocabulary)
    chance = random.Random(2)
    parts = ["a", "The", "'s", " ", "  ", "\n", " \n", "\t", "é", "10", "...", ",", "<|endoftext|>", "日本", "\x1c", "don't", "\r\n", " b", "😀", "é"]
    for _ in range(3000):
        text = "".join(chance.choice(parts) for _ in range(chance.randrange(14)))
        ids = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == ids, text


def test_sequences_give_every_document_back(table, texts, vocabulary):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary["tokenizer"])
    docs = table(texts)
    pieces = packing.cut_pieces(docs, **vocabulary, capacity=64, with_ids=True)
    packed = packing.pack(pieces.drop("ids"), 64)
    rows = packed.collect()
    ids = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in packing.sequences(pieces, packed).collect()}
    want = Counter()
    for i, text in texts:
        row = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = (len(row) - 1) % 64 + 1
        cuts = [0, *range(first, len(row) + 1, 64)]
        want.update((i, n, a, row[a:b].tobytes()) for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)))
    got = Counter(
        (r["doc_id"], r["piece"], r["start"], ids[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]].tobytes())
        for r in rows
    )
    assert got == want
    assert all(zlib.crc32(ids[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]].tobytes()) == r["ids_crc32"] for r in rows)
    rooms = [64 - len(s) for s in ids.values()]
    assert sorted(rooms) == best_fit_decreasing([r["length"] for r in rows], 64)


def test_packing_no_rows(table, vocabulary):
    assert packing.pack(packing.cut_pieces(table([]), **vocabulary)).count() == 0


# --- substrings -------------------------------------------------------------------------


def without_repeats(rows, window):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - window + 1 if i is not None else 0):
            run = tuple(words[k : k + window])
            first[run] = min(first.get(run, i), i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1 if i is not None else 0):
            if first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((str(i), len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return sorted(out)


@pytest.mark.parametrize("window, gram, shard, stream", [(5, 2, 3, 2), (8, 8, 100, 100)])
def test_substrings_equal_brute_force(table, texts, window, gram, shard, stream):
    rows = substring_dedup.dedup_substrings(table(texts), window, gram, shard, stream).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["text"]) for r in rows)
    assert got == without_repeats(texts, window)
    assert sum(r[2] > 0 for r in got) > 5
    for r in rows:
        assert sum(s["end"] - s["first"] for s in r["spans"]) == r["n_removed"]


def test_a_passage_in_many_documents_stays_in_the_first(table):
    chance = random.Random(8)
    passage = [f"p{i}" for i in range(9)]
    rows = [(i, " ".join([f"x{chance.random()}"] * 2 + passage + [f"y{chance.random()}"] * 3)) for i in range(300)]
    found = {r["doc_id"]: r["n_removed"] for r in substring_dedup.dedup_substrings(table(rows), 6, 3, 20, 50).collect()}
    assert found == {i: 9 if i else 0 for i in range(300)}


def test_substrings_of_no_rows(table):
    assert substring_dedup.dedup_substrings(table([])).count() == 0


def test_automaton_knows_every_run_and_its_first_document():
    chance = random.Random(3)
    for _ in range(200):
        docs = [(chance.randrange(20), [chance.choice("abc") for _ in range(chance.randrange(14))]) for _ in range(5)]
        automaton = SuffixAutomaton()
        for doc, words in docs:
            automaton.add(words, doc)
        automaton.close()
        window, doc = chance.randint(1, 5), chance.randrange(20)
        row = [chance.choice("abcd") for _ in range(20)]
        first = {}
        for d, words in docs:
            for k in range(len(words) - window + 1):
                first[tuple(words[k : k + window])] = min(first.get(tuple(words[k : k + window]), d), d)
        want = [k for k in range(20 - window + 1) if first.get(tuple(row[k : k + window]), 99) < doc]
        assert automaton.earlier(row, doc, window) == want


def test_segments_cover_all_windows_once_and_agree_on_equal_windows():
    hashes = substring_dedup.WordHashes()
    row = hashes.of([str(i % 7).encode() for i in range(60)])
    anchors, contents, first, count = substring_dedup.segments(row, 9, 4)
    assert first.tolist() == np.concatenate(([0], np.cumsum(count)[:-1])).tolist() and count.sum() == 60 - 9 + 1
    moved = substring_dedup.segments(row[10:], 9, 4)
    assert set(moved[0]) == set(anchors)


# --- n-gram join ------------------------------------------------------------------------


def groups_of_rows(rows, n, percent):
    """Row (doc_id, text) to the frozen set of rows that links lead to; rows without id are alone."""
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        size = min(n, len(words))
        sets[i, text] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()
    root = {r: r for r in sets}

    def find(r):
        while root[r] != r:
            r = root[r]
        return r

    names = [r for r in sets if r[0] is not None]
    for x, y in itertools.combinations(names, 2):
        both = len(sets[x] & sets[y])
        if both and 100 * both >= percent * len(sets[x] | sets[y]):
            root[find(y)] = find(x)
    members = {}
    for r in sets:
        members.setdefault(find(r), set()).add(r)
    return {r: frozenset(members[find(r)]) for r in sets}, {r: len(s) for r, s in sets.items()}


def components(rows, n, percent):
    groups, sizes = groups_of_rows(rows, n, percent)
    return sorted(
        (str(i), sizes[i, t], str(None if i is None else min(j for j, _ in groups[i, t] if j is not None))) for i, t in rows
    )


def test_rows_that_share_an_id_are_told_apart(spark, table):
    chance = random.Random(12)

    def prose():
        return " ".join(f"p{chance.randrange(10**6)}" for _ in range(40))

    a, b, c, d, e, f = (prose() for _ in range(6))
    rows = [
        (1, a), (1, b),  # neither has a copy
        (2, c), (2, d), (3, d),  # one has
        (4, e), (4, f), (5, e + " more"), (6, f + " more"), (7, f + " other"),  # both have, near ones
        (8, a.upper()), (9, b), (9, b + " end"),  # copies of the first two under other ids, and one with itself
    ]
    found = ngram_join.near_duplicates(table(rows), 5, 80, bits=14).collect()
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found)
    assert got == components(rows, 5, 80)
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, table(rows), "").collect()
    groups, _ = groups_of_rows(rows, 5, 80)
    stayed = [(r["doc_id"], r["text"]) for r in kept]
    assert {groups[r] for r in stayed} == set(groups.values()) and len(stayed) == len(set(groups.values()))
    assert all(i == min(j for j, _ in groups[i, t]) for i, t in stayed)
    assert {(1, a), (1, b), (2, c), (2, d), (4, e), (4, f)} == set(stayed)


@pytest.mark.parametrize("n, percent", [(4, 85), (2, 50), (5, 80)])
def test_components_equal_brute_force(table, texts, n, percent):
    rows = list(texts)
    chance = random.Random(n)
    base = [f"w{chance.randrange(400)}" for _ in range(60)]
    for i in range(100, 160):  # a large group of near copies, some too far from its centre
        copy = list(base)
        for _ in range(chance.randrange(5)):
            copy[chance.randrange(60)] = f"e{chance.random()}"
        rows.append((i, " ".join(copy)))
    chain = [f"c{k}" for k in range(60)]
    for i in range(200, 212):  # a chain: neighbours are close, the ends are not
        chain = chain[1:] + [f"d{i}"]
        rows.append((i, " ".join(chain)))
    found = ngram_join.near_duplicates(table(rows), n, percent, bits=14).collect()
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found)
    assert got == components(rows, n, percent)
    assert max(Counter(r[2] for r in got).values()) > 10


def test_links_are_not_lost_when_every_set_takes_the_longest_prefix(table, texts, monkeypatch):
    chance = random.Random(6)
    rows = []
    for i in range(80):
        words = [f"w{chance.randrange(12)}" for _ in range(chance.randrange(1, 9))]
        rows.append((i, " ".join(words)))
    found = ngram_join.near_duplicates(table(rows), 1, 60, bits=8).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found) == components(rows, 1, 60)


def test_a_part_of_a_larger_set_is_linked_though_few_listed_tokens_meet(table):
    """The larger set's own tokens fill its prefix, so that the two list one token in common."""
    rows = []
    for n in range(12):
        part = [f"s{n}x{i}" for i in range(85)]
        rows += [(10 * n, " ".join(part)), (10 * n + 1, " ".join(part + [f"r{n}x{i}" for i in range(15)]))]
        rows += [(1000 + 100 * n + k, f"s{n}x{i} s{n}x{i + 1}") for k, i in enumerate(range(0, 84, 2))]
    found = ngram_join.near_duplicates(table(rows), 1, 85, bits=22).collect()
    roots = {r["doc_id"]: r["component_id"] for r in found}
    assert all(roots[10 * n + 1] == 10 * n for n in range(12))


def test_prefixes_of_similar_sets_share_enough_tokens():
    chance = random.Random(9)
    for _ in range(500):
        percent = chance.choice([50, 80, 85])
        x = set(chance.sample(range(60), chance.randint(1, 40)))
        y = set(chance.sample(sorted(x), max(1, len(x) - chance.randrange(4)))) | set(chance.sample(range(60, 99), chance.randrange(4)))
        if 100 * len(x & y) < percent * len(x | y):
            continue
        small, large = sorted((x, y), key=len)
        for level in range(1, min(ngram_join.LONGEST, -(-percent * len(small) // 100)) + 1):
            a = sorted(small)[: ngram_join.prefix_lengths(len(small), percent)[0] + level - 1]
            b = sorted(large)[: ngram_join.prefix_lengths(len(large), percent)[1] + level - 1]
            assert len(set(a) & set(b)) >= level


def test_join_of_no_rows(table):
    assert ngram_join.near_duplicates(table([]), bits=10).count() == 0
    none = ngram_join.near_duplicates(table([(1, None), (2, "")]), bits=10).collect()
    assert {(r["doc_id"], r["component_id"], r["n_shingles"]) for r in none} == {(1, 1, 0), (2, 2, 0)}
