"""The pipeline's stages against plain Python versions of them, over one small folder."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from patronage.llm.common import store

from .test_packing_substrings_join import best_fit_decreasing, groups_of_rows
from .test_rules_lines_leaks_urls import deduplicated, leaks
from .test_text_models import code, listed, ranked


@pytest.fixture(scope="module")
def folder(spark, table, texts, tmp_path_factory):
    pytest.importorskip("public_tokenizers")
    path = str(tmp_path_factory.mktemp("tables"))
    names = {i: ("aa", "bb")[i % 2] for i, _ in texts if i is not None and i % 5}
    table(texts, names).write.parquet(f"{path}/documents.parquet")
    items = [(1, texts[4][1]), (2, "nothing of this is in any of the documents at all here"), (3, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, names, items


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def same(found, wanted):
    assert Counter((str(i), t) for i, t in found) == Counter((str(i), t) for i, t in wanted)


def test_every_stage_equals_brute_force(spark, folder):
    import zlib

    path, names, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, rows = docs.columns, rows_of(docs)
    wanted = []
    profiles = defaultdict(Counter)
    for i, text in rows:
        if i in names and text is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            profiles[names[i]].update(listed(text))
    known = {code(g) for p in profiles.values() for g in ranked(p, 300)}
    for i, text in rows:
        own = ranked(listed(text), 300)
        if own and any(code(g) in known for g in own):
            wanted.append((i, text))
    stages = dict(corpus_pipeline.STAGES)
    docs, _ = store(stages["language_id"](spark, docs, path), "t1")
    same(rows_of(docs), wanted)
    assert docs.columns == columns and len(wanted) < len(rows)

    wanted = [(i, t) for i, _, _, t in deduplicated(wanted, 20, 3)]
    docs, _ = store(stages["line_dedup"](spark, docs, path), "t2")
    same(rows_of(docs), wanted)
    assert all(r["n_chars"] == len(r["text"]) and r["rest"] == "rest" for r in docs.collect())

    found = rows_of(docs)
    groups, _ = groups_of_rows(found, 5, 80)
    firsts = {r: min((j for j, _ in group if j is not None), default=None) for r, group in groups.items()}
    wanted = list(dict.fromkeys((i, t) for i, t in found if firsts[i, t] == i))
    docs, _ = store(stages["ngram_jaccard_join"](spark, docs, path), "t3")
    same(rows_of(docs), wanted)
    assert docs.columns == columns and len(wanted) < len(found)

    hit = Counter((i, n) for i, n, hits, _ in leaks(wanted, items, 10) if hits)
    kept = [(i, t) for i, t in wanted if not any(h for d, _, h, _ in leaks([(i, t)], items, 10))]
    docs, _ = store(stages["benchmark_decontamination"](spark, docs, path), "t4")
    same(rows_of(docs), kept)
    assert sum(hit.values()) == len(wanted) - len(kept) > 0

    packed = stages["best_fit_packing"](spark, docs, path).collect()
    assert {str(r["doc_id"]) for r in packed} == {str(i) for i, _ in kept}
    bins = defaultdict(int)
    for r in packed:
        bins[r["sequence_id"]] += r["length"]
    assert sorted(2048 - n for n in bins.values()) == best_fit_decreasing([r["length"] for r in packed], 2048)
    whole = corpus_pipeline.run(spark, path).collect()
    key = lambda r: (str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert Counter(map(key, whole)) == Counter(map(key, packed))


def test_stages_take_no_rows(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0
