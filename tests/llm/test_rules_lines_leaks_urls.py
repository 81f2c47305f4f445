from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from patronage.llm import decontaminate, line_dedup, quality_rules, url_filter

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_in(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def measured(text):
    text = text or ""
    words = words_in(text)
    grams = defaultdict(list)
    for i in range(len(words) - 2):
        grams[tuple(words[i : i + 3])].append(i)
    covered = {i + j for places in grams.values() if len(places) > 1 for i in places for j in range(3)}
    lines = [line for line in text.split("\n") if words_in(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(covered), len(lines),
    )


def test_measures_equal_brute_force(table, texts):
    rows = quality_rules.measure(table(texts)).collect()
    found = sorted((str(r["doc_id"]), *(r[c] for c in quality_rules.MEASURES)) for r in rows)
    assert found == sorted((str(i), *measured(t)) for i, t in texts)


def test_policies_and_ablations_read_the_ledger_only(table, texts):
    ledger = quality_rules.rule_ledger(table(texts))
    kept = [r["kept"] for r in quality_rules.apply_policy(ledger, "v2").collect()]
    strict = [r["kept"] for r in quality_rules.apply_policy(ledger, "base").collect()]
    assert 0 < sum(kept) <= sum(strict) < len(texts)
    bits = [r["failures"] for r in ledger.collect()]
    mask = quality_rules.mask_of(quality_rules.POLICIES["v2"])
    for row in quality_rules.ablations(ledger, "v2").collect():
        bit = quality_rules.mask_of([row["rule"]])
        assert row["failed"] == sum(b & bit > 0 for b in bits)
        assert row["failed_alone"] == sum(b & mask == bit for b in bits)
        assert row["kept_without"] == sum(b & mask & ~bit == 0 for b in bits)


def test_no_rows_give_no_rows(table):
    empty = table([])
    assert quality_rules.rule_ledger(empty).count() == 0
    assert quality_rules.ablations(quality_rules.rule_ledger(empty), "v1").count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0
    items = empty.select(F.col("doc_id").alias("item_id"), "text")
    assert decontaminate.find_leaks(empty, items).count() == 0


def deduplicated(rows, min_chars, min_docs):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for i, text in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if i is None or len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i
        ]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("batches, fanout", [(1, 2), (5, 3)])
def test_line_dedup_equals_brute_force_for_any_batches(table, texts, batches, fanout):
    found = line_dedup.dedup_lines(table(texts), min_chars=20, batches=batches, fanout=fanout).collect()
    got = sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in found)
    assert got == deduplicated(texts, 20, 3)
    assert any(r[2] for r in got)


def test_runs_are_levelled_and_hold_every_line_once(spark, table, texts):
    runs = line_dedup.LineRuns(spark, 2)
    from patronage.llm.common import keyed

    lines = line_dedup.long_lines(keyed(table(texts)), 5)
    for part in range(5):
        runs.add(lines.where(F.pmod("doc_id", F.lit(5)) == part))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert runs.totals().count() == lines.select("line_hash").distinct().count()
    assert runs.unseen(lines).count() == 0
    assert runs.unseen(lines.withColumn("line_hash", F.reverse(F.col("line_hash").cast("binary")))).count() > 0
    runs.drop()


def leaks(rows, items, window):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    out = []
    for i, text in rows:
        row, hit, found = words(text), set(), set()
        for item, body in items:
            of = words(body)
            length = min(window, len(of))
            runs = {tuple(of[k : k + length]) for k in range(len(of) - length + 1)} if of and item is not None else set()
            for k in range(len(row) - length + 1 if runs else 0):
                if tuple(row[k : k + length]) in runs:
                    hit.update(range(k, k + length))
                    found.add(str(item))
        out.append((str(i), len(row), len(hit), sorted(found)))
    return sorted(out)


@pytest.mark.parametrize("window", [10, 6])
def test_leaks_equal_brute_force(spark, table, texts, window):
    items = [
        (1, texts[70 % len(texts)][1]), (2, "ka LUM dé, fio! gum be nio ka lum ga extra words here"), (10, "solo"),
        (11, "ka lum"), (12, None), (13, " .,"), (None, "ka lum"), (2, texts[5][1]), (14, "nothing of this is there"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    found = decontaminate.find_leaks(table(texts), benchmark, window=window).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], list(r["item_ids"])) for r in found)
    assert got == leaks(texts, items, window)
    for r in found:
        covered = {k for s in r["spans"] for k in range(s["first"], s["end"])}
        assert len(covered) == r["n_hit"]


URLS = [
    "http://A.Example.org/es/1?x", "https://example.org/en/12#a", "https://example.org/en/2", "http://x.com/fr/a",
    "http://x.com/de/a", "http://com/de/", "http://notcom/de/", "x.com/de/", None, "", "http://", "http://u@h.co.uk:80",
    "https://y.org?q=/es/", "a://b://c.org/es/", "http://10.0.0.1/p", "http://spam.net/a", "http://spam.net/b",
    "http://good.net/a", "line\nhttp://z.com/fr/\n?",
]


def judged(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    host = host.translate(LOWER)
    fitting = [
        (rule, verdict)
        for verdict, rule in url_filter.RULES
        if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith(rule[rule.index("/") :])
    ]
    return (host, path, *max(fitting, key=lambda r: len(r[0]), default=(None, None)))


def test_rules_win_and_reputation_decides_the_rest(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit(1))
    pages = pages.unionByName(pages.where("page_id in (3, 8)"))
    bad = [(i, 1) for i in (15, 16) for _ in range(40)] + [(17, 0)] * 300 + [(0, None), (None, 1)]
    rows = url_filter.filter_urls(pages, spark.createDataFrame(bad, "page_id long, bad int")).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        host, path, rule, verdict = judged(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        if verdict:
            assert r["verdict"] == verdict
    verdicts = {r["page_id"]: r for r in rows}
    assert verdicts[15]["verdict"] == "block" and verdicts[17]["verdict"] == "allow"
    assert 0 < verdicts[17]["bad_rate"] < 0.05 and verdicts[15]["bad_rate"] > 0.8


def test_reputation_without_outcomes_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    row = url_filter.filter_urls(pages, none).first()
    assert (row["labelled"], row["bad_rate"]) == (0, 0.5)
    assert url_filter.filter_urls(pages.limit(0), none).count() == 0


@pytest.mark.parametrize(
    "host, domain, suffix",
    [("a.b.example.com", "example.com", "com"), ("shop.x.co.uk", "x.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"),
     ("localhost", "localhost", "localhost"), ("u@a.b.org:81", "b.org", "org"), ("10.0.0.1", "10.0.0.1", "10.0.0.1"), ("", "", "")],
)
def test_registered_domain(spark, host, domain, suffix):
    columns = url_filter.domain_and_suffix(F.col("host"))
    assert tuple(spark.createDataFrame([(host,)], "host string").select(*columns).first()) == (domain, suffix)


def test_long_lines_are_named_by_128_bits(spark):
    row = spark.createDataFrame([("\t Ab É ",)], "line string").select(line_dedup.line_hash(F.col("line"))).first()
    assert bytes(row[0]) == hashlib.md5("ab É".encode()).digest()


def test_very_long_texts_of_repeated_lines(spark, table):
    """Three equal texts of 60,000 lines; each line stays in the last document that has it."""
    import time

    text = "\n".join(f"boilerplate line number {i}" for i in range(60_000))
    start = time.time()
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(table([(1, text), (2, text), (3, text), (4, "short\n" + text[:50])])).collect()}
    assert [found[i]["n_dropped"] for i in (1, 2, 3, 4)] == [60_000, 60_000, 1, 0]
    assert found[1]["text"] == "" and found[3]["text"] == text.split("\n", 1)[1] and found[4]["n_lines"] == 3
    assert time.time() - start < 90
