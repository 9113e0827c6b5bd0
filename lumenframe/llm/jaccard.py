"""N-gram Jaccard join by a MinHash LSH forest.

Documents with the same set of shingles are folded to a class first. Each tree of the forest has its own sequence of minimum hashes;
sorted by them, classes that agree on a prefix stand together. Prefixes start at full depth and are shortened until a pair at the threshold meets in
some tree with at least the target probability. All classes with a prefix in common form a bucket, known by its least member;
the buckets of one least member form a cluster. Clusters are verified on the whole sets of shingles: small ones at once,
larger ones in blocks of BLOCK members, block against block, so that no task sees more than two blocks. Tasks return counts and a
spanning forest of links, never the pairs; a pair that meets in several clusters is counted in the one with the least name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from lumenframe.llm.common import add_columns, mix, text_bytes, tidy, word_hashes, word_spans
from lumenframe.sources.scratch import materialize

WORDS, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 24, 8, 0.9999
#: Members of a block of a large cluster.
BLOCK = 512
#: Shingles at a time in a block's product.
COLUMNS = 4096
SEED = 7
#: An id that stands for null, in order after all others.
LAST = (1 << 63) - 1


def depth_for(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with at least this probability."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The different shingle hashes of each text, sorted, one text after another, and the offsets of each text.

    A text of fewer than WORDS words has one shingle of all of them; one without words has none.
    """
    raw, at = text_bytes(texts)
    starts, ends, before = word_spans(raw, at)
    words, counts = word_hashes(raw, starts, ends, SEED), np.diff(before)
    n = len(words)
    text = np.repeat(np.arange(len(counts)), counts)
    hashes = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(WORDS):
            step = mix(words + np.uint64(j)) * np.uint64(2 * j + 1)
            inside = np.zeros(n, bool)
            inside[: n - j] = text[j:] == text[: n - j]
            hashes[: n - j] += np.where(inside[: n - j], step[j:], np.uint64(0))
    hashes = mix(hashes)
    number = np.arange(n) - before[:-1][text]
    whole = (number + WORDS <= counts[text]) | (number == 0)
    text, hashes = text[whole], hashes[whole]
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    text, hashes = text[new], hashes[new]
    return hashes, np.searchsorted(text, np.arange(len(counts) + 1))


def prefixes(hashes: np.ndarray, at: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """For each text with shingles and each tree, a hash of its first ``depth`` minimum hashes."""
    rng = np.random.default_rng(SEED)
    odd = rng.integers(0, 1 << 62, (trees, depth), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(0, 1 << 63, (trees, depth), dtype=np.uint64)
    begins = at[:-1]
    out = np.zeros((len(begins), trees), np.uint64)
    with np.errstate(over="ignore"):
        for t in range(trees):
            key = np.full(len(begins), t + 1, np.uint64)
            for d in range(depth):
                least = np.minimum.reduceat((hashes + plus[t, d]) * odd[t, d], begins)
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least)
            out[:, t] = key
    return out


def signed(df: DataFrame, text: str, trees: int, depth: int) -> DataFrame:
    """``df`` with the size and two hashes of each text's set of shingles, and its prefixes in each tree."""

    def run(texts):
        hashes, at = shingles(texts)
        sizes = np.diff(at)
        some = np.flatnonzero(sizes)
        s1, s2 = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
        keys = np.zeros((0, trees), np.uint64)
        if len(some):
            begins = at[:-1][some]
            s1[some] = np.add.reduceat(mix(hashes), begins)
            s2[some] = np.add.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), begins)
            keys = prefixes(hashes, np.append(begins, len(hashes)), trees, depth)
        offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, trees, 0))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel().view(np.int64)))
        return [pa.array(sizes, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), lists]

    outs = [StructField(c, LongType()) for c in ("set_size", "s1", "s2")] + [StructField("keys", ArrayType(LongType()))]
    return add_columns(df, text, outs, run)


def _keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``df`` with __k, an id that is never null, and __t, a hash of the text and of whether the id is null."""
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))
    return df.withColumns({"__k": key, "__t": F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(doc_id).isNull())})


def grouped(df: DataFrame, doc_id: str, text: str, threshold: float, trees: int) -> DataFrame:
    """Per row of ``df``: __k, __t, id, set_size, class_id, copy_of, n_links, and the document that stands for its component."""
    depth = depth_for(threshold, trees)
    docs = _keyed(df, doc_id, text).select("__k", "__t", F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = materialize(signed(docs, "text", trees, depth).drop("text"), "jaccard-rows")
    one = F.min(F.struct("__k", "__t")).alias("one")
    classes = rows.filter("set_size > 0").groupBy("s1", "s2", "set_size").agg(
        F.first("keys").alias("keys"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("copy_of"), one
    )
    classes = materialize(classes.withColumn("c", F.monotonically_increasing_id()), "jaccard-classes")
    members = clusters(classes)
    sums, links = verified(with_sets(docs, classes, members), threshold)
    return labelled(rows, classes, sums, components(links))


def join(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, trees: int = TREES) -> DataFrame:
    """(doc_id, n_shingles, class_id, copy_of, n_links): one row per row of ``df``.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles is at least ``threshold``. class_id is the
    least id of the connected component, copy_of the least id with the same set of shingles, n_links the number of other rows
    linked to this one. Texts without words (null too) have no link and are their own class. Ids may be null or repeat. Runs
    jobs and writes working tables.
    """
    found = grouped(df, doc_id, text, threshold, trees)
    return found.select(F.col("id").alias(doc_id), F.col("set_size").alias("n_shingles"), "class_id", "copy_of", "n_links")


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, trees: int = TREES) -> DataFrame:
    """The rows of ``df`` that stand for their component: the least id (null last), of equal ids the least hash of the text.

    Rows equal in id and text are one document, of which one row stays.
    """
    found = grouped(df, doc_id, text, threshold, trees)
    kept = found.filter("one.__k = __k AND one.__t = __t").select("__k", "__t").distinct()
    kept = materialize(kept, "jaccard-kept")
    return _keyed(df, doc_id, text).join(kept, ["__k", "__t"]).dropDuplicates(["__k", "__t"]).drop("__k", "__t")


def clusters(classes: DataFrame) -> DataFrame:
    """(c, clusters): each class that shares a prefix with another, and the names of its clusters, in order."""
    keyed = classes.select("c", "s1", F.posexplode("keys").alias("tree", "key"))
    least = keyed.groupBy("tree", "key").agg(F.min(F.struct("s1", "c")).alias("least"), F.count(F.lit(1)).alias("n"))
    least = least.filter("n > 1").select("tree", "key", F.col("least.c").alias("cluster"))
    pairs = keyed.join(least, ["tree", "key"]).groupBy("c").agg(F.sort_array(F.collect_set("cluster")).alias("clusters"))
    return materialize(pairs, "jaccard-members")


def with_sets(docs: DataFrame, classes: DataFrame, members: DataFrame) -> DataFrame:
    """(c, copies, clusters, shingles) of the classes in some cluster, from one text of each."""
    wanted = classes.join(members, "c").select("c", "copies", "clusters", F.col("one.__k").alias("__k"), F.col("one.__t").alias("__t"))
    found = docs.select("__k", "__t", "text").join(wanted, ["__k", "__t"]).dropDuplicates(["__k", "__t"])
    found = found.select("c", "copies", "clusters", "text")

    def run(texts):
        hashes, at = shingles(texts)
        return [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(hashes.view(np.int64)))]

    made = add_columns(found, "text", [StructField("shingles", ArrayType(LongType()))], run).drop("text")
    out = materialize(made, "jaccard-sets")
    tidy(docs.sparkSession)
    return out


def verified(sets: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """((c, n): linked rows of other classes, (c, root): links that span what is linked), verified exactly."""
    each = sets.select("c", F.explode("clusters").alias("cluster"))
    counts = materialize(each.groupBy("cluster").count(), "jaccard-counts")
    blocks = F.expr(f"CAST((count + {BLOCK} - 1) DIV {BLOCK} AS INT)")
    placed = each.join(counts.withColumn("blocks", blocks), "cluster")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    placed = placed.select("c", "cluster", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pair = placed.select("c", "cluster", "own", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"))
    rows = pair.join(sets, "c")
    rows = rows.repartition("cluster", "left", "right").sortWithinPartitions("cluster", "left", "right", "c")
    columns = ["cluster", "left", "right", "own", "c", "copies", "clusters", "shingles"]

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = pa.Table.from_batches([batch])
            held = batch if held is None else pa.concat_tables([held, batch])
            keys = np.stack([held.column(c).to_numpy() for c in columns[:3]], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            if len(cuts):
                yield from results(held.slice(0, cuts[-1]), [0, *cuts])
                held = held.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield from results(held, [0, held.num_rows])

    def results(table, cuts):
        table = table.combine_chunks()
        made = [_verify(table.slice(a, b - a), threshold) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        made = [m for m in made if m is not None]
        if made:
            ids, n, roots = (np.concatenate(x) for x in zip(*made, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.array(roots)], names=["c", "n", "root"])

    found = materialize(rows.select(*columns).mapInArrow(run, "c long, n long, root long"), "jaccard-links")
    tidy(sets.sparkSession)
    sums = found.groupBy("c").agg(F.sum("n").alias("n"))
    return sums, found.filter("c != root").select("c", "root").distinct()


def _verify(group: pa.Table, threshold: float):
    """Members with a link in this block pair: their ids, linked rows counted here, and the least id they are connected to."""
    if group.num_rows < 2:
        return None
    ids, own, copies = (group.column(c).to_numpy() for c in ("c", "own", "copies"))
    cluster, left, right = (group.column(c)[0].as_py() for c in ("cluster", "left", "right"))
    lists = group.column("shingles").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    both = intersections(lists.flatten().to_numpy(zero_copy_only=False), sizes)
    either = sizes[:, None] + sizes[None, :] - both
    linked = both >= threshold * either - 1e-9
    np.fill_diagonal(linked, False)
    if left != right:
        linked &= own[:, None] != own[None, :]
    some = np.flatnonzero(linked.any(axis=1))
    if not len(some):
        return None
    linked = linked[np.ix_(some, some)]
    ids, copies = ids[some], copies[some]
    root = np.arange(len(some))
    while True:
        least = np.where(linked, root[None, :], len(some)).min(axis=1)
        new = np.minimum(root, least)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    names = group.column("clusters").combine_chunks()
    names = names.chunk(0) if isinstance(names, pa.ChunkedArray) else names
    names = names.take(pa.array(some))
    flat = names.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(some)), pc.list_value_length(names).to_numpy(zero_copy_only=False))
    less = flat < cluster
    if less.any():
        values, at = np.unique(flat[less], return_inverse=True)
        shared = np.zeros((len(some), len(values)), np.float32)
        shared[row[less], at] = 1
        linked = linked & (shared @ shared.T == 0)
    return ids, linked @ copies.astype(np.int64), ids[root]


def intersections(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, given one after another."""
    n = len(sizes)
    row = np.repeat(np.arange(n), sizes)
    names, at, counts = np.unique(values, return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1
    keep = counts[at] > 1
    row, at = row[keep], number[at[keep]]
    out = np.zeros((n, n), np.float32)
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    width = int(at[-1]) + 1 if len(at) else 0
    for a in range(0, width, COLUMNS):
        i, j = np.searchsorted(at, [a, a + COLUMNS])
        part = np.zeros((n, min(COLUMNS, width - a)), np.float32)
        part[row[i:j], at[i:j] - a] = 1
        out += part @ part.T
    return out


def components(links: DataFrame) -> DataFrame:
    """(c, root): the least node each node of ``links`` (c, root) is connected to.

    Every round takes the least label among a node and its neighbours, then the label of that label; it ends when no label changed.
    """
    edges = links.select("c", F.col("root").alias("o")).union(links.select("root", "c"))
    edges = materialize(edges.distinct(), "component-edges")
    labels = materialize(edges.groupBy("c").agg(F.least(F.min("o"), F.col("c")).alias("root")), "component-labels")
    while True:
        near = edges.join(labels.withColumnRenamed("c", "o"), "o").groupBy("c").agg(F.min("root").alias("near"))
        new = labels.join(near, "c").select("c", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("c").alias("root"), F.col("root").alias("next"))
        new = new.join(jump, "root").select("c", "was", F.least("root", "next").alias("root"))
        new = materialize(new, "component-labels")
        if new.filter("was != root").isEmpty():
            return new.select("c", "root")
        labels = new.select("c", "root")


def labelled(rows: DataFrame, classes: DataFrame, sums: DataFrame, root: DataFrame) -> DataFrame:
    known = classes.select("c", "s1", "s2", "set_size", "copies", "copy_of", "one").join(root, "c", "left").join(sums, "c", "left")
    known = known.withColumn("root", F.coalesce("root", "c"))
    least = known.groupBy("root").agg(F.min("copy_of").alias("class_id"), F.min("one").alias("__one"))
    known = known.drop("one").join(least, "root").withColumn("n_links", F.col("copies") - 1 + F.coalesce("n", F.lit(0)))
    known = materialize(known.select("s1", "s2", "set_size", "class_id", "copy_of", "n_links", "__one"), "jaccard-labels")
    out = rows.drop("keys").join(known, ["s1", "s2", "set_size"], "left")
    some = F.col("set_size") > 0
    return out.select(
        "__k",
        "__t",
        "id",
        "set_size",
        F.when(some, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
        F.when(some, F.col("copy_of")).otherwise(F.col("id")).alias("copy_of"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(some, F.col("__one")).otherwise(F.struct("__k", "__t")).alias("one"),
    )
