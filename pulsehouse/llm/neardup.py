"""Near-duplicates by BagMinHash.

A document's bag holds its shingles of ``WORDS`` words (runs of letters, digits and
underscores, in lower case) with their counts; two documents are linked if the weighted
Jaccard index of their bags, sum(min) / sum(max), is at least ``LIKE``. Classes are the
connected components of the links.

1. One pass over the texts gives each document a 128-bit key of its bag and a BagMinHash
   signature of ``BANDS * ROWS`` components. Documents with equal bags become one node; its
   number has nothing to do with their ids.
2. Signatures are cut into bands; nodes that agree on a band share a bucket. Every node is
   paired with the smallest node of each of its buckets (not with all others), pairs whose
   signatures make a link implausible go, and the exact overlap of the bags settles the
   rest. Two nodes with an index of 0.8 share a band but for one case in 100,000.
3. Links become components by passing on the smallest label, with pointer jumping. A bucket
   whose nodes are all in one component needs no further look. In the others, rounds pair
   every node outside the bucket's main component with one more member of that component, a
   central one that shares many buckets, and another one in each round, as long as that
   settles a good part of these nodes. Nodes that are left in buckets of at most ``SMALL``
   nodes are compared with the whole bucket.
4. What is left of larger buckets is compared in full, each node outside its bucket's main
   component with all nodes of the bucket: in cells of two blocks of about ``CELL``
   characters each, so a text is sent once for every CELL characters of texts that it is
   compared with. Two nodes that share several large buckets are compared in the first one
   only. A cell looks at sketches of the signatures first, then at the bags, the most alike
   first, and stops for a node once it is linked with the main component. So no link between
   components is lost, however large a bucket is.

Defined results: a null text is empty. A text of fewer than ``WORDS`` words has one
shingle of all its words; a text without words has one "word", the text without blanks at
its ends, so empty texts form a class. A class id is the smallest doc_id in it; a row
without doc_id shows doc_id null and counts as a number above 2**62 that its text gives.
Rows with equal doc_id and different texts are nodes of their own: each text is compared
and has the class of its own bag. Two classes with one smallest doc_id show the same class
id; ``firsts`` tells them apart. Repeated rows stay. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsehouse.llm.bagminhash import mix, signatures
from pulsehouse.llm.common import code_points, give_back, pieces, shown, stored

WORDS = 5
LIKE = 0.8
BANDS, ROWS = 30, 5
#: Share of equal components below which two signatures cannot belong to a link: at an
#: index of 0.8 a share of 150 components lies below it once in a billion cases.
PLAUSIBLE = 0.6
#: Characters of a block of nodes that are compared in full with another block.
CELL = 1 << 21
#: Buckets of so many nodes at most are compared by a plain join.
SMALL = 32
#: Rounds go on while they settle at least this share of the nodes outside main components.
PROGRESS = 0.1
#: Characters and rows that a task holds as numbers at once.
CHARS, ROWS_AT_ONCE = 1 << 20, 500
_ODD = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _word_characters() -> np.ndarray:
    table = np.zeros(0x110000, dtype=bool)
    table[[c for c in range(0x110000) if chr(c).isalnum()]] = True
    table[ord("_")] = True
    return table


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = 1 << 20
    up, down = (np.full(n, f, dtype=np.uint64) for f in (_ODD, pow(_ODD, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row number) of all words of the texts, in order."""
    is_word = _word_characters()
    hashes, rows = [], []
    for group in pieces((t.lower() for t in texts), 1 << 18, at_space=True):
        parts = [code_points(f" {p} ") for _, p, _ in group]
        codes = np.concatenate(parts)
        owner = np.repeat(np.array([r for r, _, _ in group]), [len(p) for p in parts])
        inside = is_word[codes]
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        up, down = _powers()
        run = np.cumsum(codes * up[:len(codes)])
        hashes.append(mix((run[ends - 1] - run[starts - 1]) * down[starts]))
        rows.append(owner[starts])
    return np.concatenate(hashes), np.concatenate(rows)


def bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, count, row number) of the texts' bags, by row and shingle."""
    word, row = word_hashes(texts) if texts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    counts = np.bincount(row, minlength=len(texts))
    none = np.flatnonzero(counts == 0)
    n = max(0, len(word) - WORDS + 1)
    value = np.zeros(n, dtype=np.uint64)
    for k in range(WORDS):
        value = mix(value * np.uint64(3) + word[k:k + n] + np.uint64(k + 1))
    whole = row[:n] == row[WORDS - 1:] if n else np.zeros(0, dtype=bool)
    value, owner = value[whole], row[:n][whole]
    extra, extra_row = [], []
    begins = np.cumsum(counts) - counts
    for r in np.flatnonzero((counts > 0) & (counts < WORDS)):
        h = np.array([counts[r] + (1 << 40)], dtype=np.uint64)
        for w in word[begins[r]:begins[r] + counts[r]]:
            h = mix(h * np.uint64(3) + w)
        extra.append(h[0])
        extra_row.append(r)
    for r in none:
        codes = code_points(texts[r].strip()).astype(np.uint64)
        h = np.array([len(codes) + (2 << 40)], dtype=np.uint64)
        power = np.cumprod(np.full(len(codes), _ODD, dtype=np.uint64))
        extra.append(mix(h + np.sum(codes * power, dtype=np.uint64))[0])
        extra_row.append(r)
    value = np.concatenate([value, np.array(extra, dtype=np.uint64)])
    owner = np.concatenate([owner, np.array(extra_row, dtype=np.int64)]).astype(np.int64)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return value[at], np.diff(np.append(at, len(value))), owner[at]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard index of two bags, each (sorted shingles, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


def text_slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch of about CHARS characters of text and at most ROWS_AT_ONCE rows."""
    texts = batch.column(column).to_pylist()
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= CHARS or i + 1 - start >= ROWS_AT_ONCE:
            yield batch.slice(start, i + 1 - start), texts[start:i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield batch.slice(start), texts[start:]


def row_id() -> Column:
    """The doc_id; for rows without one a number above 2**62 from the text."""
    own = F.shiftrightunsigned(F.xxhash64(shown("text")), 2).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(F.col("doc_id").cast("long"), own)


def text_digest() -> Column:
    """16 bytes that tell the texts of one id apart."""
    return F.unhex(F.md5(shown("text").cast("binary")))


def signed(documents: DataFrame, m: int = BANDS * ROWS) -> DataFrame:
    """doc_id, id (never null), digest (of the text), key1, key2, chars, signature."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b, texts in text_slices(whole):
                value, count, row = bags(texts)
                signature = signatures(value, count, row, len(texts), m)
                edges = np.searchsorted(row, np.arange(len(texts)))
                keys = [np.add.reduceat(mix(value + np.uint64(s)) * count.astype(np.uint64), edges)
                        .view(np.int64) for s in (11, 22)]
                flat = pa.array(signature.view(np.int32).ravel())
                yield pa.record_batch({
                    "doc_id": b.column("doc_id"), "id": b.column("id"), "digest": b.column("digest"),
                    "key1": pa.array(keys[0]), "key2": pa.array(keys[1]),
                    # with what a node takes besides its text
                    "chars": pa.array([len(t) + 1000 for t in texts], pa.int64()),
                    "signature": pa.ListArray.from_arrays(
                        pa.array(np.arange(len(texts) + 1) * m, pa.int32()), flat)})
        give_back()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), row_id().alias("id"),
                            text_digest().alias("digest"), shown("text").alias("text"))
    return rows.mapInArrow(task, "doc_id long, id long, digest binary, key1 long, key2 long, chars long, signature array<int>")


def share_equal(a: str, b: str) -> Column:
    same = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda s, x: s + x) / F.size(a)


def in_bands(nodes: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """band (a hash of its number and rows), node, chars."""
    return (nodes.select("node", "chars", "signature", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("k"))
            .select(F.xxhash64("k", F.slice("signature", F.col("k") * rows + 1, rows)).alias("band"), "node", "chars"))


def sketch() -> Column:
    """The low byte of each component. Equal components have equal bytes, so a share of equal
    bytes is never below that of the components."""
    return F.transform("signature", lambda x: (x.bitwiseAND(255) - 128).cast("byte"))


def plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches leave a link possible."""
    one = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    two = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    return (pairs.join(one, "a").join(two, "b").where(share_equal("sa", "sb") >= PLAUSIBLE)
            .select("a", "b"))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose bags' exact index is at least LIKE. ``texts``: node, text,
    each node once."""
    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keep = []
            # as many pairs at once as hold about CHARS characters
            held = ((b["ta"].str.len() + b["tb"].str.len()).cumsum() // CHARS).to_numpy()
            for _, part in b.groupby(held, sort=False):
                for s in range(0, len(part), 64):
                    some = part.iloc[s:s + 64]
                    value, count, row = bags([*some["ta"], *some["tb"]])
                    e = np.searchsorted(row, np.arange(2 * len(some) + 1))
                    bag = [(value[i:j], count[i:j]) for i, j in zip(e, e[1:])]
                    keep += [likeness(bag[i], bag[i + len(some)]) >= LIKE for i in range(len(some))]
            yield b.loc[np.array(keep, dtype=bool), ["a", "b"]]
        give_back()

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.join(one, "a").join(two, "b").mapInPandas(task, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, label: for each node of a link, the smallest node it is connected with."""
    both = stored(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .where("a != b").distinct(), "neardup-links")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("b"))
                    .select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "neardup-labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near")))
        told = (labels.join(near, labels.node == near.a)
                .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        # the label's own label, which may be smaller still
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = stored(told.join(jump, "label", "left")
                     .select("node", "old", F.coalesce("further", "label").alias("label")), "neardup-labels")
        changed = new.where("old != label").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label; other nodes are alone) after the links (a, b) are added."""
    of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}"))
    between = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
               .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    merged = components(between)
    told = labels.unionAll(links.select(F.explode(F.array("a", "b")).alias("node"))
                           .distinct().join(labels, "node", "left_anti").select("node", F.col("node").alias("label")))
    new = merged.select(F.col("node").alias("label"), F.col("label").alias("new"))
    return stored(told.join(new, "label", "left").select("node", F.coalesce("new", "label").alias("label")),
                  "neardup-labels")


def unsettled(bands: DataFrame, labels: DataFrame) -> DataFrame:
    """band, node, middle, chars, label, main, size, outside: the nodes of buckets with several
    components. main: the label that most nodes of the bucket have; outside: how many have
    another."""
    named = (bands.join(labels, "node", "left")
             .select("band", "node", "middle", "chars", F.coalesce("label", "node").alias("label")))
    each = named.groupBy("band", "label").agg(F.count("*").alias("n"))
    mixed = (each.groupBy("band").agg(F.sum("n").alias("size"), F.max(F.struct("n", "label")).alias("m"),
                                      F.count("*").alias("labels"))
             # of two nodes the star has compared the one pair there is
             .where("labels > 1 and size > 2")
             .select("band", "m.label", "size", (F.col("size") - F.col("m.n")).alias("outside"))
             .withColumnRenamed("label", "main"))
    return stored(named.join(mixed, "band"), "neardup-unsettled")


def another_member(members: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each node outside with one member of its bucket's main component: one
    of those in the largest buckets, as a node near the middle of a group is."""
    order = F.struct(F.round(2 * F.log2("middle")), F.xxhash64("node", F.lit(turn)))
    hubs = members.where("label = main").groupBy("band").agg(F.max_by("node", order).alias("hub"))
    return (members.where("label != main").join(hubs, "band")
            .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())


def pairs_of_small(members: DataFrame) -> DataFrame:
    """Pairs (a, b) across components in buckets of at most SMALL nodes."""
    few = members.where(F.col("size") <= SMALL)
    one = few.where("label != main").select("band", F.col("node").alias("x"), F.col("label").alias("lx"))
    two = few.select("band", F.col("node").alias("y"), F.col("label").alias("ly"))
    return (one.join(two, "band").where("lx != ly")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def links_of_large(members: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) across components in buckets of more than SMALL nodes."""
    own = members.where(F.col("size") > SMALL).groupBy("node").agg(F.collect_set("band").alias("bands"))
    known = stored(texts.join(own, "node").join(nodes.select("node", "sketch"), "node"), "neardup-large")
    many = members.where(F.col("size") > SMALL)
    blocks = many.groupBy("band").agg(
        F.ceil(F.sum("chars") / CELL).cast("int").alias("wide"),
        F.ceil(F.sum(F.when(F.col("label") != F.col("main"), F.col("chars"))) / CELL).cast("int").alias("tall"))
    many = many.join(blocks, "band")
    row = lambda n: F.pmod(F.xxhash64("node", n), n).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    outside = many.where("label != main").select("band", row("tall").alias("i"), all_of("wide").alias("j"),
                                                 "node", "label", "main", F.lit(True).alias("left"))
    every = many.select("band", all_of("tall").alias("i"), row("wide").alias("j"),
                        "node", "label", "main", F.lit(False).alias("left"))
    cells = outside.unionByName(every).join(known, "node")
    return cells.groupBy("band", "i", "j").applyInPandas(_links_of_cell, "a long, b long").distinct()


def _links_of_cell(rows: pd.DataFrame) -> pd.DataFrame:
    """The links of a cell's left nodes with its other nodes."""
    # a node on both sides has one text and one bag
    rows = rows.sort_values(["node", "left"])
    single = rows.drop_duplicates("node")
    place = np.searchsorted(single["node"].to_numpy(), rows["node"].to_numpy())
    value, count, row = bags(single["text"].tolist())
    e = np.searchsorted(row, np.arange(len(single) + 1))
    sketches = np.stack(single["sketch"].to_numpy())[place]
    label, left, node = (rows[c].to_numpy() for c in ("label", "left", "node"))
    band, main = rows["band"].iloc[0], rows["main"].iloc[0]
    # only earlier buckets matter: two nodes are compared in the first that they share
    earlier = [{b for b in x if b < band} for x in single["bands"]]
    right, found = np.flatnonzero(~left), []

    def alike(i: int, k: int) -> bool:
        i, k = place[i], place[k]
        return likeness((value[e[i]:e[i + 1]], count[e[i]:e[i + 1]]),
                        (value[e[k]:e[k + 1]], count[e[k]:e[k + 1]])) >= LIKE

    for i in np.flatnonzero(left):
        own = earlier[place[i]]
        # nodes outside are on both sides of the bucket: the smaller one looks at the larger
        j = right[(label[right] != label[i]) & ((label[right] == main) | (node[right] > node[i]))]
        share = (sketches[j] == sketches[i]).mean(axis=1)
        j, share = j[share >= PLAUSIBLE], share[share >= PLAUSIBLE]
        done = set()            # components that the node is linked with
        for k in j[np.argsort(-share, kind="stable")]:
            if label[k] not in done and own.isdisjoint(earlier[place[k]]) and alike(i, k):
                done.add(label[k])
                found.append((min(node[i], node[k]), max(node[i], node[k])))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def settled(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, key1, key2) and the bags (key1, key2, first): ``first`` is the
    smallest (id, digest) in the bag's class and belongs to no other class."""
    docs = stored(signed(documents), "neardup-signatures")
    # stored, so that a node keeps its number
    nodes = stored(docs.groupBy("key1", "key2")
                   .agg(F.min(F.struct("id", "digest")).alias("first"), F.any_value("signature").alias("signature"),
                        F.max("chars").alias("chars"))
                   .withColumn("sketch", sketch()).withColumn("node", F.monotonically_increasing_id()),
                   "neardup-nodes")
    bands = in_bands(nodes)
    shared = bands.groupBy("band").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    # middle: how many nodes the buckets of a node hold together
    bands = stored(bands.join(shared, "band").groupBy("node")
                   .agg(F.sum("n").alias("middle"), F.first("chars").alias("chars"),
                        F.collect_list(F.struct("band", "a")).alias("of"))
                   .select("node", "middle", "chars", F.explode("of").alias("b"))
                   .select("b.band", "node", "b.a", "middle", "chars"), "neardup-bands")
    # the texts of nodes that share a bucket, from one pass over the documents
    named = bands.select("node").distinct().join(nodes.select("node", "first.id", "first.digest"), "node")
    texts = stored(documents.select(row_id().alias("id"), text_digest().alias("digest"), shown("text").alias("text"))
                   .join(named, ["id", "digest"]).groupBy("node")
                   .agg(F.min("text").alias("text")), "neardup-texts")

    def settle(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The plausible pairs among new ones, and those of them that are links."""
        some = stored(plausible(pairs, nodes), "neardup-pairs")
        return some, stored(verified(some, texts), "neardup-links")

    tested, links = settle(bands.where("a != node").select("a", F.col("node").alias("b")).distinct())
    labels = components(links)
    members, turn = unsettled(bands, labels), 0
    outside = members.where("label != main").select("node").distinct().count()
    while outside:
        some, links = settle(another_member(members, turn).join(tested, ["a", "b"], "left_anti"))
        tested, turn = tested.unionAll(some), turn + 1
        if not links.isEmpty():
            labels = relabelled(labels, links)
            members = unsettled(bands, labels)
        before, outside = outside, members.where("label != main").select("node").distinct().count()
        if before - outside < PROGRESS * before:
            break
    if outside:
        some, links = settle(pairs_of_small(members).join(tested, ["a", "b"], "left_anti"))
        links = stored(links.unionAll(links_of_large(members, nodes, texts)), "neardup-rest")
        if not links.isEmpty():
            labels = relabelled(labels, links)
    linked = labels.join(nodes.select("node", "first"), "node")
    least = linked.groupBy("label").agg(F.min("first").alias("least"))
    linked = linked.join(least, "label").select("node", "least")
    found = nodes.join(linked, "node", "left").select("key1", "key2", F.coalesce("least", "first").alias("first"))
    return docs.select("doc_id", "key1", "key2"), found


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, class_id: one row for each row of ``documents``."""
    docs, found = settled(documents)
    return docs.join(found, ["key1", "key2"]).select("doc_id", F.col("first.id").alias("class_id"))


def firsts(documents: DataFrame) -> DataFrame:
    """id, digest: for each class the row_id and text_digest of its first document."""
    return settled(documents)[1].select("first.id", "first.digest").distinct()
