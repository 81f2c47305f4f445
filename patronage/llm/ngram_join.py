"""Jaccard self-join of documents on word n-gram sets, by adaptive multi-match prefixes.

Tokens are n-gram hashes. All sets are ordered the same way, rare tokens first, by a sketch of
all token counts. Two sets that are similar enough share a token of a short prefix of that
order; with the prefix lengthened by l - 1 tokens they share l. A set whose prefix meets many
others gets a larger l: it is listed under a few tokens more, and a pair is only verified if
it shares as many tokens as the smaller l of the two says.

Pairs are not enumerated within groups that are linked already. Equal sets are one class. In a
first round each class meets one class per token, the most typical one, and links that hold
are joined to groups. The second round pairs classes of different groups only; it leaves out
nothing that the prefixes allow, so no link between groups is lost.

The links themselves all lie inside components, so they are found there: the classes of a
component are dealt into blocks, and every pair of blocks counts the common tokens of all its
pairs of classes. No pair of a component is left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.common import keyed, remove_folders, store
from patronage.llm.substring_dedup import Runs, WordHashes
from patronage.models.density import connected_components

WORDS = 5
PERCENT = 80
#: The sketch of token counts has 2 ** SKETCH_BITS places of one byte, on every executor.
SKETCH_BITS = 22
_CHUNK_BITS = 16
LONGEST = 3
#: Classes of a component that meet in one task, and shared tokens counted at a time.
BLOCK = 256
_COLUMNS = 4096


def shingles(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Distinct hashes of the n-word runs, A-Z as a-z; a shorter text is one run, in order."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, "int64")
    row, size = hashes.of(words), min(n, len(words))
    starts = np.arange(len(words) - size + 1)
    return np.unique(Runs(row).hash(starts, starts + size))


def required(percent: int, sizes: int | np.ndarray) -> int | np.ndarray:
    """Least intersection of two sets with that sum of sizes."""
    return -(-percent * sizes // (100 + percent))


def prefix_lengths(size: int, percent: int) -> tuple[int, int]:
    """Prefix that must meet larger sets, and prefix that must meet smaller ones."""
    return size - int(required(percent, 2 * size)) + 1, size - -(-percent * size // 100) + 1


def _spread(tokens: np.ndarray, bits: int) -> np.ndarray:
    return (tokens.view("uint64") >> np.uint64(64 - bits)).astype("int64")


def _sets_and_sketch(rows: DataFrame, n: int, bits: int) -> DataFrame:
    """Per row doc_id, text_key, size and digest of its set, and the tasks' token counts as
    rows with a chunk number and compressed counts."""
    kinds = {"doc_id": pa.int64(), "text_key": pa.int64(), "size": pa.int64(), "digest": pa.binary(), "chunk": pa.int32(), "counts": pa.binary()}
    names = list(kinds)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHashes(), np.zeros(1 << bits, "uint32")
        for batch in batches:
            out = []
            for doc, text, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = shingles(text, n, hashes)
                np.add.at(counts, _spread(tokens, bits), 1)
                out.append((doc, key, len(tokens), xxhash.xxh3_128_digest(tokens.tobytes()), None, None))
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names)
        chunks = counts.reshape(-1, min(1 << _CHUNK_BITS, 1 << bits))
        packed = [zlib.compress(c.tobytes(), 1) for c in chunks if c.any()]
        numbers = [i for i, c in enumerate(chunks) if c.any()]
        none = [None] * len(numbers)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip([none] * 4 + [numbers, packed], kinds.values(), strict=True)], names
        )

    return rows.mapInArrow(read, "doc_id long, text_key long, size long, digest binary, chunk int, counts binary")


def _sketch(parts: DataFrame, bits: int) -> np.ndarray:
    """Logarithms of the summed counts, one byte each. Chunks are summed where they meet; what
    is collected has the fixed size of the sketch."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(zlib.decompress(counts), "uint32").astype("uint64")
                sums[chunk] = sums[chunk] + part if chunk in sums else part
        logs = [np.frexp(np.maximum(s, 1).astype("float64"))[1].astype("uint8").tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(logs, pa.binary())], ["chunk", "logs"])

    sketch = np.ones(1 << bits, "uint8")
    width = min(1 << _CHUNK_BITS, 1 << bits)
    rows = parts.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, logs binary")
    for row in rows.collect():
        sketch[row["chunk"] * width : (row["chunk"] + 1) * width] = np.frombuffer(row["logs"], "uint8")
    return sketch


def _prefixes(rows: DataFrame, n: int, percent: int, bits: int, sketch: np.ndarray) -> DataFrame:
    """(token, class, size, place, mark) of every prefix token of every set.

    ``mark`` is 4 times a rank, higher for sets of more frequent tokens, plus the level. A class
    is listed once per task, however many of its copies the task has.
    """
    shared = rows.sparkSession.sparkContext.broadcast(sketch)
    floor = int(np.median(sketch))  # the logarithm that tokens have by chance alone
    kinds = {"token": pa.int64(), "class": pa.int64(), "size": pa.int32(), "place": pa.int32(), "mark": pa.int32()}

    def list_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, logs, seen = WordHashes(), shared.value, set()
        for batch in batches:
            parts: list[list[np.ndarray]] = [[np.zeros(0, "int64")] for _ in kinds]
            for text in batch.column(0).to_pylist():
                tokens = shingles(text, n, hashes)
                size = len(tokens)
                digest = xxhash.xxh3_128_digest(tokens.tobytes())
                if not size or digest in seen:
                    continue
                seen.add(digest)
                common = logs[_spread(tokens, bits)]
                order = np.lexsort((tokens, common))
                high = prefix_lengths(size, percent)[1]
                # the mean number of other sets that the prefix meets, as a power of 4
                cost = np.log2(np.exp2(common[order[:high]].astype("float64") - floor).mean()) / 2
                level = max(1, min(1 + int(max(0, cost)), LONGEST, -(-percent * size // 100)))
                listed = order[: min(size, high + level - 1)]
                columns = (
                    tokens[listed],
                    np.full(len(listed), int.from_bytes(digest[:8], "big", signed=True)),
                    np.full(len(listed), size),
                    np.arange(len(listed)),
                    np.full(len(listed), 4 * int(common.mean() * 500) + level),
                )
                for part, column in zip(parts, columns, strict=True):
                    part.append(column)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(p).astype(k.to_pandas_dtype()), k) for p, k in zip(parts, kinds.values(), strict=True)],
                list(kinds),
            )

    return rows.select("text").mapInArrow(
        list_tokens, "token long, class long, size int, place int, mark int"
    )


def _verify(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(u, v): digests of the sets of the pairs (a, b) of classes that are similar enough.

    ``texts`` has class, digest and text of one document per set, more than one row of a class
    only if two sets have one class number; then all of them are compared.
    """
    left = texts.select(F.col("class").alias("a"), F.col("digest").alias("u"), F.col("text").alias("left"))
    right = texts.select(F.col("class").alias("b"), F.col("digest").alias("v"), F.col("text").alias("right"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("u", "v", "left", "right")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, held = WordHashes(), None, np.zeros(0, "int64")
        for batch in batches:
            linked: list[tuple[bytes, bytes]] = []
            for u, v, one, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if u != last:
                    last, held = u, shingles(one, n, hashes)
                tokens = shingles(other, n, hashes)
                common = len(np.intersect1d(held, tokens, assume_unique=True))
                if 100 * common >= percent * (len(held) + len(tokens) - common):
                    linked.append((u, v))
            columns = list(zip(*linked, strict=True)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["u", "v"])

    return both.mapInArrow(compare, "u binary, v binary")


def _marked(rows: DataFrame, asked: DataFrame, bits: int) -> DataFrame:
    """``rows`` without most of those whose (doc_id, text_key) is not ``asked`` for, so that their texts
    do not move. A bitmap of hashes, as large as the sketch at most, goes to every executor; it keeps
    all that are asked for, and some by chance."""
    place = F.pmod(F.xxhash64(F.lit(31), "doc_id", "text_key"), F.lit(8 << bits)) + 1
    held = asked.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("held")
    )
    placed = rows.withColumns({"bucket": F.bitmap_bucket_number(place), "at": F.bitmap_bit_position(place).cast("int")})
    byte = F.conv(F.hex(F.expr("substring(held, at div 8 + 1, 1)")), 16, 10).cast("int")
    kept = placed.join(F.broadcast(held), "bucket").where(byte.bitwiseAND(F.expr("shiftleft(1, at % 8)")) != 0)
    return kept.select(rows.columns)


LEVEL, RANK = "(mark % 4)", "(mark div 4)"


def _first_places(percent: int) -> Column:
    """Whether a place is in the prefix that must meet larger sets."""
    return F.expr(f"place < size - ({percent} * 2 * size + 99 + {percent}) div (100 + {percent}) + {LEVEL}")


def _listed(percent: int) -> Column:
    """Length of the prefix that is listed."""
    return F.expr(f"least(size, size - ({percent} * size + 99) div 100 + {LEVEL})")


def _shared(listed: DataFrame, by: str) -> DataFrame:
    """Rows whose token is listed with two values of ``by`` or more. The rows are dealt out by token
    once, and both ends of the values are read off where they lie."""
    token = Window.partitionBy("token")
    ends = listed.select("*", F.min(by).over(token).alias("low"), F.max(by).over(token).alias("high"))
    return ends.where("low <> high").drop("low", "high")


def _met(shared: DataFrame, percent: int) -> DataFrame:
    """Adds ``met``, how many of its listed tokens the class shares, and ``spare``, how many of its
    tokens are not listed."""
    met = F.count(F.lit(1)).over(Window.partitionBy("class")).cast("int")
    return shared.withColumns({"met": met, "spare": (F.col("size") - _listed(percent)).cast("int")})


def _can_link(percent: int, sizes: Column, common: Column) -> Column:
    return percent * sizes <= (100 + percent) * common


def _common(one: str, other: str) -> Column:
    """Most tokens that two classes can have in common. The one whose listed tokens end first
    in the order has what it shares among tokens that both list, and its spare ones."""
    return F.greatest(F.col(f"{one}spare"), F.col(f"{other}spare")) + F.least(F.col(f"{one}met"), F.col(f"{other}met"))


def _first_pairs(listed: DataFrame, percent: int) -> DataFrame:
    """Each class with the most typical class of one of its tokens: the one it meets most."""
    order = F.shiftleft(F.expr(RANK).cast("long"), 47).bitwiseOR(F.col("class").bitwiseAND((1 << 47) - 1))
    pivots = listed.groupBy("token").agg(
        *(F.max_by(c, order).alias(f"pivot{n}") for c, n in (("class", ""), *((c, f"_{c}") for c in ("size", "met", "spare"))))
    )
    sizes = F.col("size") + F.col("pivot_size")
    met = (
        listed.join(pivots, "token")
        .where(F.col("pivot") != F.col("class"))
        .where(_can_link(percent, sizes, _common("", "pivot_")))
        .groupBy("class", "pivot")
        .agg(F.count(F.lit(1)).alias("tokens"))
    )
    order = F.struct("tokens", "pivot")
    return met.groupBy("class").agg(F.max(order).alias("best")).select(F.col("best.pivot").alias("a"), F.col("class").alias("b"))


def _second_pairs(listed: DataFrame, groups: DataFrame, percent: int) -> tuple[DataFrame, str]:
    """All pairs (a, b) of classes of different groups that share as many prefix tokens as their
    levels say. Groups meet before their classes do. Also the folder that they are read from."""
    grouped = listed.drop("met", "spare").join(groups, "class", "left").withColumn("group", F.coalesce("group", "class"))
    grouped, folder = store(grouped, "ngram-grouped")
    rows, mixed = store(_met(_shared(grouped, "group"), percent).withColumn("level", F.expr(LEVEL)), "ngram-mixed")
    remove_folders(rows.sparkSession, [folder])
    larger = rows.select(*(F.col(c).alias(f"b_{c}") for c in ("class", "size", "place", "level", "group", "met", "spare")), "token")
    smaller = rows.where(_first_places(percent)).select(
        "token",
        F.col("group").alias("a_group"),
        *(F.col(c).alias(f"a_{c}") for c in ("class", "size", "place", "level", "met", "spare")),
    )
    size = F.col("b_size")
    left = size - F.col("b_place") + F.col("b_level") - 1
    right = F.col("a_size") - F.col("a_place") + F.col("a_level") - 1
    held = smaller.groupBy("token", "a_group").agg(
        F.min("a_size").alias("least"),
        F.max("a_size").alias("largest"),
        F.max(right).alias("room"),
        F.max("a_met").alias("held_met"),
        F.max("a_spare").alias("held_spare"),
    )
    wanted = larger.join(held, "token").where(
        (F.col("a_group") != F.col("b_group"))
        & (F.col("least") <= size)
        & (100 * F.col("largest") >= percent * size)
        & _can_link(percent, F.col("least") + size, F.least(left, "room", _common("b_", "held_")))
    )
    ordered = (F.col("a_size") < size) | ((F.col("a_size") == size) & (F.col("a_class") < F.col("b_class")))
    fits = (100 * F.col("a_size") >= percent * size) & _can_link(
        percent, F.col("a_size") + size, F.least(left, right, _common("a_", "b_"))
    )
    pairs = (
        wanted.drop("least", "largest", "room", "held_met", "held_spare")
        .join(smaller, ["token", "a_group"])
        .where(ordered & fits)
        .groupBy(F.col("a_class").alias("a"), F.col("b_class").alias("b"))
        .agg(F.count(F.lit(1)).alias("tokens"), F.first(F.least("a_level", "b_level")).alias("least"))
        .where("tokens >= least")
        .select("a", "b")
    )
    return pairs, mixed


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bits: int = SKETCH_BITS) -> DataFrame:
    """doc_id, text_key, n_shingles, set_id, class_doc, component_id and component_key per row of
    ``docs``.

    Rows whose sets of ``words``-word runs have a Jaccard similarity of ``percent`` in a hundred or
    more are linked. A row is known by its doc_id and its text's key, so rows that repeat an id with
    another text are compared, and linked, each by its own text. ``set_id`` names the row's set and
    class_doc is the smallest doc_id that has it; component_id and component_key are the smallest
    (doc_id, text_key) that links lead to. Rows without words are linked with nothing (their set_id
    is null). Rows without doc_id have no component and link nothing. Jobs run while intermediate
    tables are stored; those that the result does not read are deleted again.

    A task holds one batch of texts and the tokens of one text at a time.
    """
    spark, rows = docs.sparkSession, keyed(docs)
    done: list[str] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        table, folder = store(df, label)
        done.append(folder)
        return table

    parts, _ = store(_sets_and_sketch(rows, words, bits), "ngram-sets")
    sets = parts.where("chunk is null").select("doc_id", "text_key", "size", "digest")
    listed = _prefixes(rows.where("doc_id is not null"), words, percent, bits, _sketch(parts, bits))
    # tasks list a class each; what they agree on lies together already
    shared, folder = store(_shared(listed, "class").dropDuplicates(["token", "class"]), "ngram-shared")
    met = keep(_met(shared, percent), "ngram-met")
    remove_folders(spark, [folder])
    spoken = sets.where("doc_id is not null and size > 0")
    firsts = spoken.groupBy("digest").agg(F.min(F.struct("doc_id", "text_key")).alias("one")).select("digest", "one.*")
    number = F.conv(F.substring(F.hex("digest"), 1, 16), 16, -10).cast("long")
    classes = keep(firsts.withColumn("class", number), "ngram-classes")
    first = keep(_first_pairs(met, percent), "ngram-first-pairs")

    # texts move once, for both rounds: those of all classes that share a token
    # (a merge at every size: their share of all texts does not fall as the corpus grows)
    asked = keep(met.select("class").distinct().join(classes, "class"), "ngram-asked")
    # identical rows lie together by what they were joined by, so they are dropped there
    texts = _marked(rows, asked, bits).join(asked.hint("merge"), ["doc_id", "text_key"])
    texts = texts.dropDuplicates(["doc_id", "text_key", "class", "digest"]).select("class", "digest", "text")
    texts = keep(texts, "ngram-texts")

    def texts_of(pairs: DataFrame) -> DataFrame:
        """class, digest and text of what is to be compared."""
        return texts.join(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "class", "left_semi")

    links = keep(_verify(first, texts_of(first), words, percent), "ngram-links")
    nodes = classes.select(F.col("digest").alias("node"))
    rooted = connected_components(nodes, links).where("node <> root")
    # a group's name is a digest, a lone class's its own number: told apart by a hash
    named = rooted.select("node", "root").union(rooted.select(F.col("root").alias("node"), "root")).distinct()
    groups = named.join(classes, named["node"] == classes["digest"]).select("class", F.xxhash64(F.lit(9), "root").alias("group"))
    pairs, folder = _second_pairs(met, groups, percent)
    second = keep(pairs, "ngram-second-pairs")
    remove_folders(spark, [folder])
    more = keep(_verify(second, texts_of(second), words, percent), "ngram-more-links")
    roots = connected_components(nodes, links.union(more))
    placed = classes.join(roots, classes["digest"] == roots["node"]).select("digest", "doc_id", "text_key", "root")
    least = placed.groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("least"))
    # stored, so that the next join can be split where a class has very many copies
    roots, _ = store(
        placed.join(least, "root").select(
            "digest",
            F.col("doc_id").alias("class_doc"),
            F.col("least.doc_id").alias("component"),
            F.col("least.text_key").alias("key"),
        ),
        "ngram-roots",
    )
    remove_folders(spark, done)
    known = F.col("doc_id").isNotNull()
    return sets.join(roots, "digest", "left").select(
        "doc_id",
        "text_key",
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("digest")).alias("set_id"),
        F.when(known, F.coalesce("class_doc", "doc_id")).alias("class_doc"),
        F.when(known, F.coalesce("component", "doc_id")).alias("component_id"),
        F.when(known, F.coalesce("key", "text_key")).alias("component_key"),
    )


def common_tokens(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set of distinct tokens."""
    found = np.zeros((len(left), len(right)), "int64")
    one, other = (np.concatenate([np.zeros(0, "int64"), *sets]) for sets in (left, right))
    shared = np.intersect1d(one, other)
    places = [np.repeat(np.arange(len(sets)), [len(x) for x in sets]) for sets in (left, right)]
    for start in range(0, len(shared), _COLUMNS):
        part = shared[start : start + _COLUMNS]
        marks = []
        for tokens, place, sets in ((one, places[0], left), (other, places[1], right)):
            at = np.minimum(np.searchsorted(part, tokens), len(part) - 1)
            held = part[at] == tokens
            mark = np.zeros((len(sets), len(part)), "float32")
            mark[place[held], at[held]] = 1
            marks.append(mark)
        found += (marks[0] @ marks[1].T).astype("int64")  # counts to 4,096 are exact
    return found


def _compared(rows: DataFrame, found: DataFrame, words: int, percent: int, pairs: bool) -> DataFrame:
    """All links between different sets of one component: (u, v, common) with the documents
    u < v that stand for the sets, or (set_id, linked), how many rows the sets linked to one have,
    in parts to be summed."""
    spoken = found.where("doc_id is not null and set_id is not null")
    classes = spoken.groupBy("set_id").agg(
        F.first("component_id").alias("component"),
        F.first("component_key").alias("component_key"),
        F.countDistinct("doc_id", "text_key").alias("copies"),
        F.min(F.struct("doc_id", "text_key")).alias("one"),
    )
    # stored, so that the next join can be split where a component has very many classes
    classes, _ = store(classes.select("*", "one.*").drop("one"), "ngram-class-sizes")
    blocks = F.ceil(F.col("classes") / BLOCK).cast("int")
    whole = ["component", "component_key"]
    sizes = classes.groupBy(*whole).agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
    placed = classes.join(sizes, whole).withColumn("blocks", blocks)
    placed = placed.withColumn("block", F.pmod(F.xxhash64(F.lit(23), "set_id"), F.col("blocks")).cast("int"))
    texts = rows.select("doc_id", "text_key", "text").join(placed, ["doc_id", "text_key"])
    texts, _ = store(texts.dropDuplicates(["set_id"]), "ngram-class-texts")
    columns = [*whole, "doc_id", "set_id", "copies", "text", "block"]
    met = texts.select(*columns, F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")).select(
        *columns, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )

    def compare(table: pa.Table) -> pa.Table:
        hashes = WordHashes()
        docs, copies, block = (table.column(c).to_numpy() for c in ("doc_id", "copies", "block"))
        sets = [shingles(text, words, hashes) for text in table.column("text").to_pylist()]
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        one, other = np.flatnonzero(block == i), np.flatnonzero(block == j)
        common = common_tokens([sets[x] for x in one], [sets[x] for x in other])
        total = np.array([len(x) for x in sets])
        linked = 100 * common >= percent * (total[one][:, None] + total[other][None, :] - common)
        linked &= one[:, None] != other[None, :]
        if pairs:
            a, b = np.nonzero(linked & (one[:, None] < other[None, :]) if i == j else linked)
            u, v = docs[one[a]], docs[other[b]]
            return pa.table({"u": np.minimum(u, v), "v": np.maximum(u, v), "common": common[a, b]})
        sums = np.zeros(len(docs), "int64")
        sums[one] += linked.astype("int64") @ copies[other]
        if i != j:
            sums[other] += linked.T.astype("int64") @ copies[one]
        return pa.table({"set_id": table.column("set_id"), "linked": pa.array(sums)})

    schema = "u long, v long, common long" if pairs else "set_id binary, linked long"
    return met.groupBy(*whole, "i", "j").applyInArrow(compare, schema)


def near_duplicate_links(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bits: int = SKETCH_BITS
) -> tuple[DataFrame, DataFrame]:
    """:func:`near_duplicates`, and all links between different sets: u, v (``class_doc`` of the
    two, u < v) and common, the size of their intersection. Documents with the same set are
    linked without being listed; what links to a class links to all its documents."""
    found, _ = store(near_duplicates(docs, words, percent, bits), "ngram-found")
    return found, _compared(keyed(docs), found, words, percent, pairs=True)


def with_link_counts(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bits: int = SKETCH_BITS) -> DataFrame:
    """:func:`near_duplicates` with n_links, how many other documents the document is linked to
    itself. Every pair of different sets in a component is compared; NULL without doc_id."""
    found, _ = store(near_duplicates(docs, words, percent, bits), "ngram-found")
    linked = _compared(keyed(docs), found, words, percent, pairs=False).groupBy("set_id").agg(F.sum("linked").alias("linked"))
    spoken = found.where("doc_id is not null and set_id is not null")
    copies = spoken.groupBy("set_id").agg(F.countDistinct("doc_id", "text_key").alias("copies"))
    # stored, so that the next join can be split where a class has very many copies
    counts, _ = store(
        copies.join(linked, "set_id", "left").select(
            "set_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
        ),
        "ngram-link-counts",
    )
    n_links = F.when(F.col("n_shingles") > 0, F.col("n_links")).when(F.col("doc_id").isNotNull(), 0)
    return found.join(counts, "set_id", "left").select(*found.columns, n_links.cast("long").alias("n_links"))
