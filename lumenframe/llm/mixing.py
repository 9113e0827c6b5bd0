"""Mixing sources to target weights by a splitting tree over block quotas; DataFrame functions only.

Every source is cut into blocks by a hash of its documents, in a permuted order. A source's target says how many whole passes
over its blocks the mix takes and how many words of one more; the last pass takes blocks in order until the next would exceed
it, and goes on in that block with finer blocks. This gives exact quotas of blocks for each source. A binary tree deals them out
among the output shards: every node sends a random half of its blocks to the left, whatever their source (a multivariate
hypergeometric draw), so that quotas stay exact in every node. A shard then draws its quota of each source from the permuted
blocks that no other shard has, and its rows are shuffled locally.

Statistics are sums over blocks, so that a source of any size is spread; windows see blocks, never documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.sources.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: A document's words are taken at most so often.
MOST = 3
#: Blocks of a source, and finer blocks within the block at a target's end, twice.
BLOCKS, FINER = 256, 1024
#: Levels of the splitting tree: two to this power output shards.
LEVELS = 4


def size_of(text: str = "text"):
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _number(*parts):
    """60 random bits that depend on the parts alone."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def _order(*parts):
    return F.md5(F.concat_ws(":", *parts))


def _key(source: str):
    """The source as a text that is never null and sorts null last."""
    return F.coalesce(F.concat(F.lit("0"), F.col(source)), F.lit("1"))


def sized(df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``df`` with size, mix_key and the block numbers of each row. Rows without an id are dealt by their text."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text), F.lit("")))))
    out = df.withColumns({"size": size_of(text), "mix_key": _key(source), "__h": _number(F.lit("doc"), name)})
    return out.withColumns(
        {
            "block": F.col("__h") % BLOCKS,
            "finer": F.expr(f"(__h DIV {BLOCKS}) % {FINER}"),
            "finest": F.expr(f"(__h DIV {BLOCKS * FINER}) % {FINER}"),
        }
    ).drop("__h")


def targets(sizes: DataFrame) -> DataFrame:
    """(mix_key, source_size) with target: shares by weight, cut at MOST times the size, the excess shared again by weight.

    In order of how soon a source reaches its limit, the level is what the sources before leave for each unit of weight; the
    first source that stays under its limit has the level of all after it.
    """
    ranked = sizes.withColumn("at", F.row_number().over(Window.orderBy("mix_key")) - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("at") % len(WEIGHTS)).cast("int") + 1).cast("double")
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * MOST)
    ranked = ranked.withColumn("reach", F.col("most") / F.col("weight"))
    before = Window.orderBy("reach", "mix_key").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("reach", "mix_key").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.orderBy("reach", "mix_key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    used = F.coalesce(F.sum("most").over(before), F.lit(0))
    ranked = ranked.withColumn("level", (F.sum("source_size").over(every) - used) / F.sum("weight").over(onward))
    fits = F.when(F.col("level") <= F.col("reach"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(every)
    target = F.when(F.col("reach") <= level, F.col("most").cast("double")).otherwise(level * F.col("weight"))
    return ranked.select("mix_key", "source_size", target.alias("target"))


def _until(groups: DataFrame, unit: str, salt: str) -> DataFrame:
    """(mix_key, unit, number of the unit in permuted order, whole, edge, rest): units within ``rest`` words, and the next."""
    order = Window.partitionBy("mix_key").orderBy(_order(F.lit(salt), "mix_key", F.col(unit).cast("string")))
    out = groups.withColumn("number", F.row_number().over(order)).withColumn("end", F.sum("words").over(order))
    whole = F.col("end") <= F.col("rest")
    edge = ~whole & (F.col("end") - F.col("words") <= F.col("rest"))
    out = out.withColumns({"whole": whole, "edge": edge, "left": F.col("rest") - (F.col("end") - F.col("words"))})
    return out.select("mix_key", unit, "number", "whole", "edge", "left", *[c for c in ("passes", "target", "source_size") if c in out.columns])


def _finer(rows: DataFrame, edges: DataFrame, keys: list[str], unit: str, last: bool = False) -> DataFrame:
    """The same choice among the finer units of the units at the edge; the ``last`` time the one at the edge too, if nearer."""
    at = edges.filter("edge").select("mix_key", *keys, F.col("left").alias("rest"))
    groups = rows.join(at, ["mix_key", *keys]).groupBy("mix_key", *keys, unit)
    groups = groups.agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    kept = groups.select("mix_key", *keys, unit, "words", "rest")
    order = Window.partitionBy("mix_key").orderBy(_order(F.lit(unit), "mix_key", F.col(unit).cast("string")))
    kept = kept.withColumn("end", F.sum("words").over(order))
    whole = F.col("end") <= F.col("rest")
    edge = ~whole & (F.col("end") - F.col("words") <= F.col("rest"))
    left = F.col("rest") - (F.col("end") - F.col("words"))
    if last:
        whole = whole | (edge & (left * 2 >= F.col("words")))
    return kept.select("mix_key", *keys, unit, whole.alias(f"whole_{unit}"), edge.alias("edge"), left.alias("left"))


def deal(quotas: DataFrame) -> DataFrame:
    """(mix_key, item, shard) for items 1 to ``items`` of each source: the splitting tree, then each shard's next permuted items."""
    labels = quotas.filter("items > 0").select("mix_key", F.explode(F.sequence(F.lit(1), F.col("items").cast("int"))).alias("label"))
    nodes = labels.withColumn("shard", F.lit(0))
    for level in range(1, LEVELS + 1):
        by = Window.partitionBy("shard")
        order = _order(F.lit(f"split {level}"), "mix_key", F.col("label").cast("string"))
        rank = F.row_number().over(by.orderBy(order, "mix_key", "label"))
        right = (rank > F.expr("(__n + 1) DIV 2")).cast("int")
        nodes = nodes.withColumn("__n", F.count(F.lit(1)).over(by)).withColumn("shard", F.col("shard") * 2 + right).drop("__n")
    item = F.row_number().over(Window.partitionBy("mix_key").orderBy("shard", "label"))
    return nodes.select("mix_key", item.alias("item"), "shard")


def mix(df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``df`` with size, source_size, target, copies (int), taken (size times copies) and shards, the shard of each copy.

    Runs jobs over the sizes and writes small tables of blocks. Columns of these names are replaced, as are mix_key, block, finer
    and finest. An empty table stays empty; documents without words are never worth more than 0 taken words.
    """
    own = "size source_size target copies taken shards mix_key block finer finest".split()
    df = df.select(*[c for c in df.columns if c.lower() not in own])
    kept = df.columns
    rows = sized(df, doc_id, source, text)
    slim = materialize(rows.select("mix_key", "size", "block", "finer", "finest"), "mix-sizes")
    blocks = materialize(slim.groupBy("mix_key", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    plan = targets(blocks.groupBy("mix_key").agg(F.sum("words").alias("source_size")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    first = materialize(_until(blocks.join(plan, "mix_key"), "block", "block"), "mix-choice")
    second = materialize(_finer(slim, first, ["block"], "finer"), "mix-choice")
    third = materialize(_finer(slim, second, ["block", "finer"], "finest", last=True), "mix-choice")

    quotas = first.groupBy("mix_key").agg(
        F.first("passes").alias("passes"), F.count(F.lit(1)).alias("blocks"), F.sum((F.col("whole") | F.col("edge")).cast("int")).alias("more")
    )
    quotas = quotas.withColumn("items", F.col("passes") * F.col("blocks") + F.col("more"))
    dealt = deal(quotas).join(quotas.select("mix_key", "blocks"), "mix_key")
    dealt = dealt.withColumn("pass", F.expr("(item - 1) DIV blocks")).withColumn("number", ((F.col("item") - 1) % F.col("blocks") + 1).cast("int"))
    lists = dealt.groupBy("mix_key", "number").agg(F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("__dealt"))
    first = first.join(lists, ["mix_key", "number"], "left").select(
        "mix_key", "block", "source_size", "target", "passes", "whole", F.col("edge").alias("__edge"), F.col("__dealt.shard").alias("__shards")
    )
    first = materialize(first, "mix-blocks")
    joined = rows.join(first, ["mix_key", "block"])
    joined = joined.join(second.select("mix_key", "block", "finer", "whole_finer"), ["mix_key", "block", "finer"], "left")
    joined = joined.join(third.select("mix_key", "block", "finer", "finest", "whole_finest"), ["mix_key", "block", "finer", "finest"], "left")
    more = F.col("whole") | (F.col("__edge") & (F.coalesce("whole_finer", F.lit(False)) | F.coalesce("whole_finest", F.lit(False))))
    copies = F.when(F.col("size") > 0, F.col("passes") + more.cast("int")).otherwise(0).cast("int")
    joined = joined.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies"))
    shards = F.when(F.col("copies") > 0, F.slice("__shards", F.lit(1), F.col("copies"))).otherwise(F.array().cast("array<int>"))
    return joined.select(*kept, "size", "source_size", "target", "copies", "taken", shards.alias("shards"))


def mixed_rows(mixed: DataFrame) -> DataFrame:
    """One row for each copy that the mix takes, with its ``shard``."""
    return mixed.withColumn("shard", F.explode("shards"))


def write_mix(mixed: DataFrame, path: str, doc_id: str = "doc_id", tasks_per_shard: int = 8) -> None:
    """Parquet under ``path/shard=...``, each file in random order."""
    rows = mixed_rows(mixed).withColumn("__o", F.xxhash64(F.lit("shuffle"), F.col("shard"), F.col(doc_id)))
    rows = rows.repartition("shard", F.pmod("__o", F.lit(tasks_per_shard))).sortWithinPartitions("shard", "__o")
    rows.drop("__o").write.partitionBy("shard").parquet(path)


def digest(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.concat_ws(",", F.col("shards").cast("array<string>")).alias("shards"))


def _sql() -> str:
    def bits(text: str) -> str:
        return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"

    split = "".join(
        f""", t{n} AS (SELECT mix_key, label, shard * 2 + CASE WHEN row_number() OVER (PARTITION BY shard ORDER BY
        md5('split {n}:' || mix_key || ':' || label), mix_key, label) > (count(*) OVER (PARTITION BY shard) + 1) // 2 THEN 1 ELSE 0 END AS shard FROM t{n - 1})"""
        for n in range(1, LEVELS + 1)
    )

    def finer(name: str, edge: str, keys: str, unit: str) -> str:
        nearer = ' OR ("end" > rest AND (rest - ("end" - words)) >= 0 AND (rest - ("end" - words)) * 2 >= words)' if unit == "finest" else ""
        return f"""{name} AS (
    SELECT *, "end" <= rest{nearer} AS whole, "end" > rest AND "end" - words <= rest AS edge, rest - ("end" - words) AS "left" FROM (
      SELECT *, sum(words) OVER (PARTITION BY mix_key ORDER BY md5('{unit}:' || mix_key || ':' || {unit})) AS "end" FROM (
        SELECT d.mix_key, {", ".join("d." + k for k in keys.split())}, d.{unit}, sum(d.size)::BIGINT AS words, any_value(e."left") AS rest
        FROM d JOIN {edge} e ON e.edge AND d.mix_key = e.mix_key {" ".join(f"AND d.{k} = e.{k}" for k in keys.split())} GROUP BY ALL)))"""

    return f"""WITH d0 AS (
    SELECT doc_id, coalesce('0' || source, '1') AS mix_key, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
      {bits("'doc:' || coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, '')))")} AS h FROM documents),
  d AS (SELECT doc_id, mix_key, size, h % {BLOCKS} AS block, (h // {BLOCKS}) % {FINER} AS finer, (h // {BLOCKS * FINER}) % {FINER} AS finest FROM d0),
  blocks AS (SELECT mix_key, block, sum(size)::BIGINT AS words FROM d GROUP BY ALL),
  s0 AS (SELECT mix_key, sum(words)::BIGINT AS source_size FROM blocks GROUP BY ALL),
  s1 AS (SELECT *, CAST([{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY mix_key) - 1) % {len(WEIGHTS)} + 1] AS DOUBLE) AS weight FROM s0),
  s2 AS (SELECT *, source_size * {MOST} AS most, (source_size * {MOST}) / weight AS reach FROM s1),
  s3 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY reach, mix_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / sum(weight) OVER (ORDER BY reach, mix_key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s2),
  s4 AS (SELECT *, (SELECT arg_min(level, (reach, mix_key)) FROM s3 WHERE level <= reach) AS chosen FROM s3),
  plan AS (SELECT mix_key, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes
    FROM (SELECT *, CASE WHEN reach <= chosen THEN most::DOUBLE ELSE chosen * weight END AS target FROM s4)),
  first AS (
    SELECT *, "end" <= rest AS whole, "end" > rest AND "end" - words <= rest AS edge, rest - ("end" - words) AS "left" FROM (
      SELECT b.*, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS rest,
        row_number() OVER w AS number, sum(words) OVER w AS "end" FROM blocks b JOIN plan p USING (mix_key)
      WINDOW w AS (PARTITION BY b.mix_key ORDER BY md5('block:' || b.mix_key || ':' || block)))),
  {finer("second", "first", "block", "finer")}, {finer("third", "second", "block finer", "finest")},
  q AS (SELECT mix_key, count(*) AS blocks, any_value(passes) * count(*) + sum((whole OR edge)::INT) AS items FROM first GROUP BY ALL),
  t0 AS (SELECT mix_key, unnest(range(1, items::BIGINT + 1)) AS label, 0 AS shard FROM q){split},
  dealt AS (SELECT mix_key, row_number() OVER (PARTITION BY mix_key ORDER BY shard, label) - 1 AS item, shard FROM t{LEVELS}),
  lists AS (SELECT mix_key, item % blocks + 1 AS number, list(shard ORDER BY item // blocks) AS shards FROM dealt JOIN q USING (mix_key) GROUP BY ALL),
  c AS (SELECT d.*, f.source_size, f.target, l.shards, CASE WHEN d.size > 0 THEN f.passes + (f.whole OR f.edge AND
      (coalesce(s.whole, FALSE) OR coalesce(t.whole, FALSE)))::INT ELSE 0 END AS copies
    FROM d JOIN first f USING (mix_key, block) LEFT JOIN lists l USING (mix_key, number) LEFT JOIN second s USING (mix_key, block, finer)
    LEFT JOIN third t USING (mix_key, block, finer, finest))
  SELECT doc_id, size, source_size, target, size * copies AS taken, coalesce(array_to_string(shards[:copies], ','), '') AS shards FROM c"""


SQL = _sql()
