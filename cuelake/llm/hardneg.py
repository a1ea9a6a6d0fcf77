"""Hard negatives of anchors, by score bounds along spanning trees of the anchors.

Vectors hold integers, so scores (inner products) and their order are exact. Anchors are dealt into
blocks of about `BLOCK` by the signs of random projections; each block has a minimum spanning tree over
its vectors. Rows are dealt into chunks by a hash, and every block meets every chunk. There the tree is
walked from its root: a row's score at a child lies within edge length times row norm of its score (or
bounds) at the parent, and only rows whose bounds reach into a window still open are scored again.

First walk: the window of an anchor is everything from its fifth best row of the same label so far.
Second walk: for each positive found, the scores the rule allows, from the tenth best so far up. A
chunk returns at most that many rows an anchor and positive; the best over all chunks are ranked.

Defined cases: rows with a null id, label or vector, or a null component, take no part, nor do vectors of another
length than most; rows equal in id, label and vector count once, rows that share an id only are rows
of their own; an anchor without positives or negatives returns nothing; a negative positive score
admits none; other columns are ignored; scores must fit a long (OverflowError).
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuelake.llm.common import read, stage

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
BLOCK = 1024
CHUNK = 65_536
TILE = 2048
EXACT = float(1 << 53)


def _ints(column):
    import numpy as np

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1), np.int64)


def _scores(rows, anchor):
    """Inner products as whole numbers; doubles hold them exactly unless components are huge."""
    import numpy as np

    top = float(np.abs(rows).max(initial=0)) * float(np.abs(anchor).max(initial=0)) * len(anchor)
    if top < EXACT:
        return (rows @ anchor).astype(np.int64)
    exact = rows.astype(np.int64).astype(object) @ anchor.astype(np.int64).astype(object)
    return np.array([int(x) for x in exact], dtype=np.int64)


def spanning_tree(points):
    """Minimum spanning tree from the first point: (order, parent, edge), parents come before children."""
    import numpy as np

    n = len(points)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    gap = np.full(n, np.inf)
    done = np.zeros(n, bool)
    now = 0
    for k in range(n):
        order[k], done[now] = now, True
        far = np.sqrt(((points - points[now]) ** 2).sum(axis=1))
        nearer = ~done & (far < gap)
        gap[nearer], parent[nearer] = far[nearer], now
        if k + 1 < n:
            now = int(np.where(done, np.inf, gap).argmin())
            edge[now] = gap[now]
    return order, parent, edge


class Best:
    """The first `k` (score, id, row) seen: higher scores first, then smaller ids."""

    def __init__(self, k: int):
        import numpy as np

        self.k, self.score, self.id, self.row = k, *(np.zeros(0, np.int64) for _ in range(3))

    @property
    def bar(self):
        return self.score[-1] if len(self.score) == self.k else -math.inf

    def add(self, score, ids, rows):
        import numpy as np

        score, ids, rows = np.concatenate([self.score, score]), np.concatenate([self.id, ids]), np.concatenate([self.row, rows])
        first = np.lexsort((rows, ids, -score))[: self.k]
        self.score, self.id, self.row = score[first], ids[first], rows[first]


def walk(anchors, parent, edge, rows, norms, wanted, take):
    """Visit a tile's rows at every anchor, parents first. `wanted(a)` gives the rows that may count and
    the score windows still open; `take(a, at, scores)` gets the rows scored whose bounds met a window."""
    import numpy as np

    low, high = np.zeros((len(anchors), len(rows))), np.zeros((len(anchors), len(rows)))
    for a in range(len(anchors)):
        may, windows = wanted(a)
        if parent[a] < 0:
            score = rows @ anchors[a]
            low[a], high[a] = score - 1e-9 * np.abs(score), score + 1e-9 * np.abs(score)
            at = np.flatnonzero(may)
        else:
            room = edge[a] * norms
            room = room + 1e-9 * (1 + room + np.abs(low[parent[a]]) + np.abs(high[parent[a]]))
            low[a], high[a] = low[parent[a]] - room, high[parent[a]] + room
            reach = np.zeros(len(rows), bool)
            for bottom, top in windows:
                reach |= (high[a] >= bottom) & (low[a] <= top)
            at = np.flatnonzero(reach & may)
        if not len(at):
            continue
        exact = _scores(rows[at], anchors[a])
        low[a][at] = high[a][at] = exact
        take(a, at, exact)


def _prepared(left: pa.Table, right: pa.Table):
    import numpy as np

    order = np.argsort(left.column("place").to_numpy())
    left = left.take(pa.array(order))
    anchors, rows = _ints(left.column("vec")).astype(np.float64), _ints(right.column("vec")).astype(np.float64)
    ids, keys, labels = (right.column(x).to_numpy() for x in ("vec_id", "row", "label"))
    return left, anchors, left.column("parent").to_numpy(), left.column("edge").to_numpy(), left.column("row").to_numpy(), left.column("label").to_numpy(), rows, ids, keys, labels


def _tiles(rows, ids, keys, labels):
    import numpy as np

    for at in range(0, len(rows), TILE):
        tile = rows[at : at + TILE]
        yield tile, np.sqrt((tile**2).sum(axis=1)), ids[at : at + TILE], keys[at : at + TILE], labels[at : at + TILE]


def _positives(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    import numpy as np

    if not left.num_rows or not right.num_rows:
        return pa.table({x: np.zeros(0, np.int64) for x in ("row", "positive_row", "positive_id", "positive_score")})
    left, anchors, parent, edge, own, kinds, *rest = _prepared(left, right)
    best = [Best(k) for _ in own]
    for rows, norms, ids, keys, labels in _tiles(*rest):
        walk(anchors, parent, edge, rows, norms,
             lambda a, keys=keys, labels=labels: ((labels == kinds[a]) & (keys != own[a]), [(best[a].bar, math.inf)]),
             lambda a, at, score, ids=ids, keys=keys: best[a].add(score, ids[at], keys[at]))
    sizes = [len(b.id) for b in best]
    return pa.table({"row": np.repeat(own, sizes), "positive_row": np.concatenate([b.row for b in best]),
                     "positive_id": np.concatenate([b.id for b in best]), "positive_score": np.concatenate([b.score for b in best])})


def _negatives(left: pa.Table, right: pa.Table, k: int, low: int, high: int) -> pa.Table:
    import numpy as np

    names = ("row", "turn", "negative_id", "negative_row", "negative_score")
    if not left.num_rows or not right.num_rows:
        return pa.table({x: np.zeros(0, np.int64) for x in names})
    left, anchors, parent, edge, own, kinds, *rest = _prepared(left, right)
    allowed = [[(-(-low * int(s) // 100), high * int(s) // 100) for s in scores] for scores in left.column("scores").to_pylist()]
    best = [[Best(k) for _ in windows] for windows in allowed]

    def wanted(a, labels):
        open_ = [(max(bottom, b.bar), top) for (bottom, top), b in zip(allowed[a], best[a], strict=True)]
        return labels != kinds[a], [(bottom, top) for bottom, top in open_ if bottom <= top]

    def take(a, at, score, ids, keys):
        for (bottom, top), b in zip(allowed[a], best[a], strict=True):
            fits = (score >= max(bottom, b.bar)) & (score <= top)
            if fits.any():
                b.add(score[fits], ids[at][fits], keys[at][fits])

    for rows, norms, ids, keys, labels in _tiles(*rest):
        walk(anchors, parent, edge, rows, norms, lambda a, labels=labels: wanted(a, labels), lambda a, at, score, ids=ids, keys=keys: take(a, at, score, ids, keys))
    found = [(own[a], turn, b) for a, of in enumerate(best) for turn, b in enumerate(of) if len(b.id)]
    sizes = [len(b.id) for *_, b in found]
    parts = [[b.id for *_, b in found], [b.row for *_, b in found], [b.score for *_, b in found]]
    flat = [np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts]
    return pa.table(dict(zip(names, [np.repeat(np.array([x[0] for x in found], np.int64), sizes), np.repeat(np.array([x[1] for x in found], np.int64), sizes), *flat], strict=True)))


def anchor_trees(anchors: DataFrame, n: int, d: int, block: int = BLOCK, seed: int = 3) -> tuple[DataFrame, int]:
    """The anchors with their place in their block's tree, and the number of blocks. What the driver gets
    is the number of anchors by sign code: about two entries for every `block` anchors."""
    import numpy as np

    bits = max(0, math.ceil(math.log2(max(1, n / block))))
    planes = np.random.default_rng(seed).standard_normal((d, bits))

    def coded(batches):
        for batch in batches:
            m = _ints(batch.column(batch.schema.get_field_index("vec"))).astype(np.float64)
            code = ((m @ planes) >= 0) @ (np.int64(1) << np.arange(bits, dtype=np.int64)) if len(m) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code.astype(np.int64))], names=[*batch.schema.names, "code"])

    fields = ", ".join(f"{name} {kind}" for name, kind in anchors.dtypes)
    codes = stage(anchors.mapInArrow(coded, f"{fields}, code long"), "anchors")
    sizes, total = [], 0
    for r in codes.groupBy("code").count().orderBy("code").collect():
        share = -(-r["count"] // block)
        sizes.append((r["code"], total, share))
        total += share
    table = anchors.sparkSession.createDataFrame(sizes, "code long, first long, share long")
    dealt = codes.join(table, "code").withColumn("block", F.col("first") + F.pmod(F.xxhash64("row"), F.col("share")))

    def grown(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        order, parent, edge = spanning_tree(_ints(rows.column("vec")).astype(np.float64))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return rows.append_column("place", pa.array(place)).append_column("parent", pa.array(np.where(parent < 0, -1, place[parent]))).append_column("edge", pa.array(edge))

    names = ["block", *anchors.columns]
    shape = "block long, " + fields
    return stage(dealt.select(*names).groupBy("block").applyInArrow(grown, f"{shape}, place long, parent long, edge double"), "trees"), total


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (vec_id, label, vec) tables with
    whole-number components; `anchors` (vec_id) names the rows that are anchors."""
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    v = F.col("vec")
    own = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.cast("array<long>").alias("vec"))
    own = own.where("vec_id is not null and label is not null and vec is not null and size(vec) > 0").where(F.forall("vec", lambda x: x.isNotNull()))
    top = own.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not top:
        return empty
    d, n = top[0]["d"], top[0]["count"]
    own = stage(own.where(F.size("vec") == d).distinct().withColumn("row", F.monotonically_increasing_id()), "rows")
    asked = stage(own.join(anchors.select(F.col("vec_id").cast("long").alias("vec_id")).where("vec_id is not null").distinct(), "vec_id", "left_semi").select("row", "vec_id", "label", "vec"), "asked")
    count = asked.count()
    if not count:
        return empty
    trees, blocks = anchor_trees(asked, count, d, block)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(-(-n // chunk), min(parts, -(-n // TILE)))
    spread = own.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks))).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    keys = ["chunk", "block"]
    side = spread.select(*keys, "row", "vec_id", "label", "vec").groupBy(*keys)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))

    found = trees.withColumn("chunk", every).groupBy(*keys).cogroup(side).applyInArrow(lambda a, b: _positives(a, b, positives), "row long, positive_row long, positive_id long, positive_score long")
    order = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    found = stage(found.withColumn("turn", F.row_number().over(order) - 1).where(F.col("turn") < positives), "positives")
    lists = found.groupBy("row").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "positive_score"))), lambda x: x["positive_score"]).alias("scores"))
    second = trees.join(lists, "row", "left").withColumn("scores", F.coalesce("scores", F.array().cast("array<long>"))).withColumn("chunk", every)
    met = second.groupBy(*keys).cogroup(side).applyInArrow(lambda a, b: _negatives(a, b, negatives, low, high), "row long, turn long, negative_id long, negative_row long, negative_score long")
    order = Window.partitionBy("row", "turn").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = found.withColumn("turn", F.col("turn").cast("long")).join(asked.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return ranked.join(named, ["row", "turn"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("vec"))
    return hard_negatives(rows, rows.where("vec_id % 100 = 0").select("vec_id"))


SQL = """
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM r a JOIN r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
f AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM f WHERE rank <= 10
"""
