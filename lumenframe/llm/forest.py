"""Approximate nearest neighbours by a hash-prefix forest.

Each tree writes every vector as a long string of hash symbols; sorted by these strings, vectors with a common prefix stand
together. A symbol is the axis, with its sign, that a random rotation of the vector lies nearest to. A query descends to its longest prefix and
then ascends in all trees at once, one symbol a step, until the stretches that share its prefix hold enough candidates, and on until K
different rows have been met. How many are enough is
measured: a bounded sample of queries is searched exactly, and the least number is taken at which the forest finds RECALL of their
neighbours. Above the first symbol all vectors share the empty prefix, so that a search that needs them all is exact.

Largest inner products are found among unit vectors: stored vectors get one more component that fills them up to the largest norm,
queries a zero. Equal vectors are folded to one before they are indexed. Stretches are searched in blocks of BLOCK vectors by
matrix products; a block returns the best K of each query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.llm.common import tidy
from lumenframe.sources.scratch import materialize

K, TREES, SYMBOLS = 20, 48, 3
#: Share of the sample's true neighbours that the forest must find, the sample's size, and vectors of a block.
RECALL, SAMPLE, BLOCK = 0.96, 192, 4096
SEED = 11
#: Scores this close to the last one kept are kept as well, as a matrix product's last digits depend on its shape.
SLACK = 1e-9


def rotations(size: int, trees: int, symbols: int) -> np.ndarray:
    """Random orthogonal matrices (trees, symbols, size, size), the same in every task."""
    rng = np.random.default_rng(SEED)
    return np.linalg.qr(rng.normal(size=(trees, symbols, size, size)))[0].astype(np.float32)


def strings(vectors: np.ndarray, trees: int, symbols: int) -> np.ndarray:
    """Hashes of all prefixes (vectors, trees, symbols): entry [i, t, d] stands for the first d + 1 symbols in tree t."""
    out = np.zeros((len(vectors), trees, symbols), np.int64)
    turned = rotations(vectors.shape[1], trees, symbols)
    rows = np.arange(len(vectors))
    for t in range(trees):
        prefix = np.zeros(len(vectors), np.int64)
        for d in range(symbols):
            near = vectors @ turned[t, d]
            axis = np.abs(near).argmax(axis=1)
            prefix = prefix * (2 * vectors.shape[1] + 1) + 1 + 2 * axis + (near[rows, axis] > 0)
            out[:, t, d] = prefix
    return out


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size)


def usable(df: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    """(vec_id, v) of the rows that take part, and the length of their vectors.

    Null ids, vectors that are null, zero or hold null or non-finite components, and vectors of another length than most have no
    part.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(finite & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    size = sizes[0]["size"] if sizes else 0
    return rows.filter(F.size("v") == size), size


def index(groups: DataFrame, size: int, trees: int = TREES, symbols: int = SYMBOLS) -> DataFrame:
    """(g, tree, p1 .. p<symbols>): every vector's prefixes in every tree, with ``fill`` as its last component."""
    names = ["g", "tree", *[f"p{d + 1}" for d in range(symbols)]]

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                v = np.column_stack([_matrix(part.column("v"), size), part.column("fill").to_numpy()])
                made = strings((v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32), trees, symbols)
                ids = np.repeat(part.column("g").to_numpy(), trees)
                columns = [pa.array(ids), pa.array(np.tile(np.arange(trees, dtype=np.int32), part.num_rows))]
                flat = made.reshape(-1, symbols)
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(flat[:, d]) for d in range(symbols)]], names=names)

    schema = "g long, tree int, " + ", ".join(f"p{d + 1} long" for d in range(symbols))
    return groups.select("g", "v", "fill").mapInArrow(run, schema)


def counts(indexed: DataFrame, symbols: int) -> DataFrame:
    """(depth, tree, prefix, n): vectors in every stretch of every depth; depth 0 is all of them, once."""
    every = indexed.select("tree", F.posexplode(F.array(*[f"p{d + 1}" for d in range(symbols)])).alias("depth", "prefix"))
    by = every.groupBy((F.col("depth") + 1).alias("depth"), "tree", "prefix").agg(F.count(F.lit(1)).alias("n"))
    whole = indexed.filter("tree = 0").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).alias("depth"), F.lit(0).alias("tree"), F.lit(0).cast("long").alias("prefix"), "n"
    )
    return by.unionByName(whole)


def places(indexed: DataFrame, symbols: int, depths: list[int] | None = None) -> DataFrame:
    """(g, depth, tree, prefix) of each vector's own stretches at all or the given depths."""
    some = range(symbols + 1) if depths is None else depths
    steps = [F.struct(F.lit(d).alias("depth"), "tree", F.col(f"p{d}").alias("prefix")) for d in some if d]
    steps = F.array(*steps) if steps else F.array().cast("array<struct<depth:int,tree:int,prefix:bigint>>")
    if 0 in some:
        root = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("tree"), F.lit(0).cast("long").alias("prefix"))
        steps = F.when(F.col("tree") == 0, F.concat(steps, F.array(root))).otherwise(steps)
    return indexed.select("g", F.explode(steps).alias("s")).select("g", "s.*")


def search_blocks(points: DataFrame, queries: DataFrame, size: int, k: int) -> DataFrame:
    """(q, g, score): per block (key, block) the best ``k`` points of each query. Both sides have key, block, g, v."""
    def side(df, number):
        return df.select("key", "block", F.lit(number).alias("side"), "g", "v")

    both = side(points, 1).unionByName(side(queries, 0))
    rows = both.repartition("key", "block").sortWithinPartitions("key", "block", "side", "g")

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            keys = np.stack([held.column(c).to_numpy() for c in ("key", "block")], axis=1)
            cuts = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
            if cuts:
                yield from results(held.slice(0, cuts[-1]), [0, *cuts])
                held = held.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield from results(held, [0, held.num_rows])

    def results(table, cuts):
        table = table.combine_chunks()
        side, ids = table.column("side").to_numpy(), table.column("g").to_numpy()
        v = _matrix(table.column("v"), size)
        found = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            m = a + int(np.searchsorted(side[a:b], 1))
            for i in range(a, m, 256):
                j = min(m, i + 256)
                if m < b:
                    found.append(best(v[i:j], ids[i:j], v[m:b], ids[m:b], k))
        if found:
            columns = [np.concatenate(c) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["q", "g", "score"])

    return rows.mapInArrow(run, "q long, g long, score double")


def best(q: np.ndarray, q_ids: np.ndarray, p: np.ndarray, p_ids: np.ndarray, k: int):
    """For each query the ``k`` points of largest inner product, and any within SLACK of the last; scores summed in one order."""
    scores = q @ p.T
    if scores.shape[1] > k:
        last = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        row, col = np.nonzero(scores >= last[:, None] - SLACK * np.maximum(1, np.abs(last))[:, None])
    else:
        row, col = (x.ravel() for x in np.indices(scores.shape))
    exact = np.add.reduce(q[row] * p[col], axis=1)
    return q_ids[row], p_ids[col], exact


def neighbours(
    df: DataFrame,
    is_query,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    trees: int = TREES,
    symbols: int = SYMBOLS,
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product found for each row where ``is_query`` holds.

    Nearest first, ties to the smaller id; a query isn't its own neighbour. Rows that repeat an id and its vector count once. Fewer than ``k``
    candidates are all returned. See :func:`usable` for rows without part. Runs jobs and writes working tables.
    """
    spark = df.sparkSession
    rows, size = usable(df, vec_id, vector)
    if not size:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    folded = rows.groupBy("v").agg(F.min("vec_id").alias("first")).withColumn("g", F.monotonically_increasing_id())
    folded = materialize(folded, "forest-vectors")
    members = materialize(rows.join(folded.select("v", "g"), "v").select("g", "vec_id").distinct(), "forest-members")
    asked = materialize(members.filter(is_query("vec_id")), "forest-queries")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    folded = folded.withColumn("norm", norm)
    top = folded.agg(F.max("norm")).collect()[0][0]
    points = folded.withColumn("fill", F.sqrt(F.greatest(F.lit(0.0), F.lit(top * top) - F.col("norm") ** 2)))
    queries = folded.join(asked.select("g").distinct(), "g", "left_semi").withColumn("fill", F.lit(0.0))
    points_at = materialize(index(points, size, trees, symbols), "forest-index")
    queries_at = materialize(index(queries, size, trees, symbols), "forest-index")

    sizes = materialize(counts(points_at, symbols), "forest-counts")
    where = materialize(places(queries_at, symbols).join(sizes, ["depth", "tree", "prefix"], "left"), "forest-places")
    reach = where.groupBy("g", "depth").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    reach = reach.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("depth", "n"))).alias("reach"))
    reach = materialize(reach, "forest-reach")
    enough = measured(folded.select("g", "v"), points_at, queries_at, reach, size, k, symbols, recall)

    depth = F.lit(0)
    for d in range(1, symbols + 1):
        depth = F.when(F.col("reach")[d] >= enough[d], F.lit(d)).otherwise(depth)
    chosen = materialize(reach.select("g", depth.alias("depth")), "forest-chosen")
    weight = members.groupBy("g").agg(F.count(F.lit(1)).alias("w"))
    vectors, found = folded.select("g", "v"), None
    while True:
        met = materialize(searched(where, points_at, vectors, chosen, size, k, symbols), "forest-found")
        found = met if found is None else found.unionByName(met)
        # a vector may stand in the stretches of many trees: queries that met fewer than k different rows ascend a symbol further
        rows_met = met.select("q", "g").distinct().join(weight, "g").groupBy(F.col("q").alias("g")).agg(F.sum("w").alias("w"))
        short = chosen.join(rows_met, "g", "left").filter((F.coalesce("w", F.lit(0)) <= k) & (F.col("depth") > 0))
        chosen = materialize(short.select("g", (F.col("depth") - 1).alias("depth")), "forest-short")
        if chosen.isEmpty():
            break
    tidy(spark)

    near = Window.partitionBy("g").orderBy("vec_id")
    few = members.withColumn("n", F.row_number().over(near)).filter(F.col("n") <= k + 1).drop("n")
    groups = found.groupBy("q", "g").agg(F.max("score").alias("score"))
    ids = groups.join(few, "g").select("q", "score", "vec_id")
    rank = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ids = ids.withColumn("n", F.row_number().over(rank)).filter(F.col("n") <= k + 1).drop("n")
    out = asked.select(F.col("g").alias("q"), F.col("vec_id").alias("query_id")).join(ids, "q").filter("query_id != vec_id")
    rank = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    out = out.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def searched(where: DataFrame, points_at: DataFrame, vectors: DataFrame, chosen: DataFrame, size: int, k: int, symbols: int) -> DataFrame:
    """(q, g, score): the best points in the stretches of each query in ``chosen`` (g, depth), in all trees."""
    stretch = where.join(chosen, ["g", "depth"]).filter("n > 0").withColumn("key", _key())
    wanted = stretch.groupBy("key", "depth", "tree", "prefix").agg(F.first("n").alias("n"))
    blocks = F.expr(f"CAST((n + {BLOCK} - 1) DIV {BLOCK} AS INT)")
    wanted = materialize(wanted.withColumn("blocks", blocks), "forest-wanted")
    depths = [r.depth for r in wanted.select("depth").distinct().collect()]
    ask = stretch.select("g", "key").join(wanted.select("key", "blocks"), "key")
    ask = ask.select("g", "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).join(vectors, "g")
    own = places(points_at, symbols, depths).join(wanted.select("depth", "tree", "prefix", "key", "blocks"), ["depth", "tree", "prefix"])
    own = own.withColumn("block", F.pmod(F.xxhash64("g"), F.col("blocks")).cast("int"))
    return search_blocks(own.select("g", "key", "block").join(vectors, "g"), ask, size, k + 1)


def _key():
    return F.xxhash64("depth", "tree", "prefix")


def measured(folded, points_at, queries_at, reach, size: int, k: int, symbols: int, recall: float) -> dict[int, int]:
    """For each depth the number of candidates at which a query stops there, from an exact search of a bounded sample."""
    asked = queries_at.filter("tree = 0").select("g")
    picked = folded.join(asked, "g").orderBy(F.xxhash64("v"), "g").limit(SAMPLE).select("g", "v").collect()
    sample = {r.g: r.v for r in picked}
    spark = points_at.sparkSession
    shared = spark.sparkContext.broadcast(sample)

    def exact(batches):
        ids = np.array(sorted(shared.value))
        q = np.array([shared.value[g] for g in ids.tolist()], np.float64).reshape(-1, size)
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                made = best(q, ids, _matrix(part.column("v"), size), part.column("g").to_numpy(), k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=["q", "g", "score"])

    near = folded.select("g", "v").mapInArrow(exact, "q long, g long, score double")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "g")
    true = near.filter("q != g").withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k).select("q", "g")
    true = materialize(true, "forest-sample")
    prefixes = [f"p{d + 1}" for d in range(symbols)]
    mine = queries_at.select(F.col("g").alias("q"), "tree", *[F.col(p).alias(f"q_{p}") for p in prefixes])
    same = sum((F.col(p) == F.col(f"q_{p}")).cast("int") for p in prefixes)
    hits = true.join(mine, "q").join(points_at.select("g", "tree", *prefixes), ["g", "tree"])
    hits = hits.groupBy("q", "g").agg(F.max(same).alias("depth")).groupBy("q", "depth").count().collect()
    sizes = {r.g: r.reach for r in reach.join(true.select(F.col("q").alias("g")).distinct(), "g").collect()}
    if not sizes:
        return {d: 1 << 62 for d in range(1, symbols + 1)}
    found = {q: np.zeros(symbols + 1) for q in sizes}
    for r in hits:
        found[r.q][: r.depth + 1] += r["count"]
    enough, total = {}, sum(f[0] for f in found.values())
    goal = recall * total
    rows = [(f, [sizes[q].get(d, 0) for d in range(symbols + 1)]) for q, f in found.items()]
    levels = sorted({n for _, s in rows for n in s[1:]} | {1 << 62})
    for least in levels:
        hit = 0.0
        for f, s in rows:
            d = max((d for d in range(1, symbols + 1) if s[d] >= least), default=0)
            hit += f[d]
        if hit >= goal:
            break
    return {d: int(least) for d in range(1, symbols + 1)}
