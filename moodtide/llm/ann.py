"""Approximate nearest neighbours by inner product over balanced posting lists.

Vectors are lifted to a sphere, so that the largest inner product is the smallest distance. Centroids
are fitted on a bounded sample; every vector goes to the list of its nearest centroid and, near a
boundary, to some of the next. A query walks a graph of the centroids in memory, keeps the lists whose
distance is within a ratio of the nearest, and all vectors of those lists are compared exactly.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from moodtide.llm.common import written


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the vectors that centroids are fitted on, ``max_lists`` the centroids (which are
    sent to all tasks). ``replicas`` and ``boundary``: copies of a vector, up to this ratio of distances.
    ``ratio``: lists up to this ratio of the nearest distance are read, and the ``least_lists`` nearest always;
    ``beam``: centroids a walk visits at least before it stops beyond that ratio. A list of over ``list_rows`` vectors is read in several parts.
    """

    sample: int = 16_384
    list_size: int = 256
    max_lists: int = 2_048
    replicas: int = 4
    boundary: float = 1.1
    beam: int = 64
    ratio: float = 1.2
    least_lists: int = 32
    list_rows: int = 4_096


class Centroids:
    def __init__(self, points: np.ndarray, n: int, rounds: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        c = points[rng.choice(len(points), n, replace=False)]
        radius = np.sqrt((points**2).sum(axis=1).max())
        price = np.zeros(n)  # crowded lists become dearer, which balances them
        for _ in range(rounds):
            d = self._distances(points, c)
            nearest = np.argmin(d + price, axis=1)
            size = np.bincount(nearest, minlength=n)
            total = np.stack([np.bincount(nearest, points[:, j], minlength=n) for j in range(points.shape[1])], axis=1)
            # back onto the sphere, else the mean of many vectors is near to all of them
            length = np.linalg.norm(total, axis=1, keepdims=True)
            c = np.where(length > 0, total / np.maximum(length, 1e-300) * radius, c)
            price += 0.1 * d.min(axis=1).mean() * (size / max(size.mean(), 1) - 1)
            price = np.maximum(price - price.min(), 0)
        self.points = c
        d = self._distances(c, c)
        # each centroid's nearest ones, and a few far ones: groups of centroids stay within reach of each other
        near = np.argsort(d, axis=1, kind="stable")[:, 1:25]
        far = rng.integers(0, n, (n, 8))
        self.graph = np.concatenate([near, far], axis=1)
        self.entries = np.unique(np.linspace(0, n - 1, max(8, 4 * int(np.sqrt(n)))).astype(int))

    @staticmethod
    def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
        d = (x**2).sum(axis=1)[:, None] + (c**2).sum(axis=1) - 2 * x @ c.T
        return np.sqrt(np.maximum(d, 0))

    def assign(self, x: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
        """(vector, list) pairs: the nearest list of each vector, and boundary copies."""
        d = self._distances(x, self.points)
        m = min(s.replicas, d.shape[1])
        near = np.argpartition(d, m - 1, axis=1)[:, :m]
        rank = np.take_along_axis(d, near, 1)
        keep = rank <= s.boundary * rank.min(axis=1, keepdims=True)
        who, which = np.nonzero(keep)
        return who, near[who, which]

    def search(self, q: np.ndarray, s: Settings) -> np.ndarray:
        """Lists to read for one query: best-first walk over the graph, then the distance ratio."""
        norm = (self.points**2).sum(axis=1)

        def away(ids: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(q @ q + norm[ids] - 2 * self.points[ids] @ q, 0))

        seen = np.zeros(len(self.points), bool)
        seen[self.entries] = True
        found = list(zip(away(self.entries).tolist(), self.entries.tolist(), strict=True))
        todo = list(found)
        heapq.heapify(todo)
        nearest, steps = min(found)[0], 0
        # on as long as lists within the ratio turn up, however many; ``beam`` steps at least
        while todo:
            x, i = heapq.heappop(todo)
            if x > s.ratio * nearest and steps >= s.beam:
                break
            steps += 1
            new = np.unique(self.graph[i][~seen[self.graph[i]]])
            seen[new] = True
            more = list(zip(away(new).tolist(), new.tolist(), strict=True))
            found += more
            for pair in more:
                heapq.heappush(todo, pair)
                nearest = min(nearest, pair[0])
        found.sort()
        limit = s.ratio * found[0][0]
        return np.array([i for n, (x, i) in enumerate(found) if x <= limit or n < s.least_lists])


def usable(vector: Column) -> Column:
    """Not null, not zero, all components present and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(top - (x**2).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, in double precision."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1).astype(np.float64)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    settings: Settings | None = None,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` found neighbours of each query, largest product first.

    Equal vectors are one entry of the index, with its ``k + 1`` smallest ids (no query can list
    more), so a vector that repeats in a third of the rows is compared once. Ties go to the smaller
    id. Vectors that ``usable`` refuses, null ids, and vectors of another length than the most
    common take no part; rows that repeat an id and its vector count once; fewer candidates, fewer
    rows. Scores are double-precision products of the stored components.
    """
    s = settings or Settings()
    e = F.col("v")
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(embedding).alias("v"), is_query.alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & usable(e))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dims = lengths["n"] if lengths else 0
    rows = rows.filter(F.size("v") == dims)
    # two 64-bit hashes name a vector
    key = F.concat(F.hex(F.xxhash64(e)), F.hex(F.xxhash64(F.lit(1), e)))
    rows = rows.withColumn("key", key)
    smallest = Window.partitionBy("key").orderBy("id")
    members = written(
        rows.groupBy("key", "id").agg(F.first("v").alias("v"), F.max(F.coalesce("q", F.lit(False))).alias("q"))
        .withColumn("n", F.row_number().over(smallest))
        .filter(F.col("n") <= k + 1)
        .select("key", "id", "n", F.when(F.col("n") == 1, F.col("v")).alias("v")),
        "vector-members",
    )
    queries = rows.filter("q").select("key", F.col("id").alias("query_id")).distinct()
    distinct = members.filter("n = 1").select("key", "id", "v")
    asked = written(distinct.join(queries.select("key").distinct(), "key", "left_semi").select("key", "v"), "vector-queries")

    id_type = rows.schema["id"].dataType.simpleString()
    v_type = rows.schema["v"].dataType.simpleString()  # components as stored
    result = f"query string, key string, id {id_type}, score double"
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, top = distinct.agg(F.count("*"), F.max(norm)).first()
    spark = vectors.sparkSession
    if not n:
        found = spark.createDataFrame([], result)
    else:
        sample = distinct.orderBy(F.xxhash64("key"), "key").limit(s.sample).select("v").toArrow()
        points = _lift(_matrix(sample.column("v")), top)
        lists = max(1, min(s.max_lists, n // s.list_size, len(points)))
        shared = spark.sparkContext.broadcast(Centroids(points, lists))

        def post(batches):
            for batch in batches:
                if batch.num_rows:
                    who, where = shared.value.assign(_lift(_matrix(batch.column("v")), top), s)
                    rows = pa.array(who)
                    columns = [pa.array(where, pa.int32()), *(batch.column(c).take(rows) for c in ("key", "id", "v"))]
                    yield pa.RecordBatch.from_arrays(columns, names=["list", "key", "id", "v"])

        def probe(batches):
            for batch in batches:
                if batch.num_rows:
                    x = _lift(_matrix(batch.column("v")), 0.0)
                    hits = [shared.value.search(q / np.linalg.norm(q) * np.sqrt(top), s) for q in x]
                    who = pa.array(np.repeat(np.arange(len(hits)), list(map(len, hits))))
                    columns = [*(batch.column(c).take(who) for c in ("key", "v")), pa.array(np.concatenate(hits), pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "v", "list"])

        posted = written(distinct.mapInArrow(post, f"list int, key string, id {id_type}, v {v_type}"), "vector-lists")
        sizes = posted.groupBy("list").count().collect()  # one row a list, max_lists at most
        parts = {r["list"]: -(-r["count"] // s.list_rows) for r in sizes}
        split = {i: p for i, p in parts.items() if p > 1}
        parts_of = F.lit(1)
        if split:
            parts_of = F.coalesce(F.create_map(*[F.lit(x) for p in split.items() for x in p])[F.col("list")], F.lit(1))
        posted = posted.withColumn("part", F.pmod(F.xxhash64("key"), parts_of).cast("int"))
        probes = (
            asked.mapInArrow(probe, f"key string, v {v_type}, list int")
            .withColumn("part", F.explode(F.sequence(F.lit(0), parts_of - 1)))
        )

        def compare(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                kinds = (pa.string(), pa.string(), left.schema.field("id").type, pa.float64())
                return pa.table({n: pa.array([], t) for n, t in zip(("query", "key", "id", "score"), kinds, strict=True)})
            mine, parts = _matrix(left.column("v")), []
            asked = _matrix(right.column("v"))
            m = min(k + 1, len(mine))
            for a in range(0, len(asked), 1024):
                scores = asked[a : a + 1024] @ mine.T
                limit = np.partition(scores, len(mine) - m, axis=1)[:, len(mine) - m]
                who, what = np.nonzero(scores >= limit[:, None])  # with all that tie with the last
                parts.append((who + a, what, scores[who, what]))
            who, what, score = (np.concatenate(x) for x in zip(*parts, strict=True))
            return pa.table(
                {
                    "query": right.column("key").take(pa.array(who)),
                    **{c: left.column(c).take(pa.array(what)) for c in ("key", "id")},
                    "score": pa.array(score),
                }
            )

        found = posted.groupBy("list", "part").cogroup(probes.groupBy("list", "part")).applyInArrow(compare, result)

    def first(df: DataFrame, by: list[str], order: list, limit: int) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*order)
        return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)

    # the k + 1 best vectors of a query vector hold its k + 1 best rows; copies in several lists go first
    merged = found.groupBy("query", "key", "id").agg(F.max("score").alias("score"))
    vectors_found = first(merged, ["query"], [F.desc("score"), "id"], k + 1).drop("rank", "id")
    rows_found = first(
        vectors_found.join(members.select("key", "id"), "key"), ["query"], [F.desc("score"), "id"], k + 1
    )
    answers = rows_found.drop("rank", "key").join(queries.withColumnRenamed("key", "query"), "query")
    own = first(answers.filter("id <> query_id"), ["query_id"], [F.desc("score"), "id"], k)
    return own.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
