"""Exact top-k search by inner product: columnar branch and bound.

Queries come in groups of bounded size; a group is sent to all tasks, each of which
passes once over its share of the vectors, in blocks held dimension by dimension.
Scores grow by blocks of dimensions. After each, what a pair can still gain is at most
the sum, over the blocks to come, of the product of both sides' lengths there
(Cauchy-Schwarz); pairs that cannot reach their query's k-th best score so far
drop out. While many pairs are left they stay a matrix; once few are, they
are compacted to a list. Blocks where the queries have most mass come first.

Scores are integers, computed in floating point wherever they and all partial sums
are exact there, else in Python's integers. Bounds are widened by more than
their rounding error, so no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citypulse.llm import common
from citypulse.session import scratch_path

_LONG = 2 ** 63 - 1
_WIDE = 10 ** 38 - 1
_MOST = np.finfo(np.float64).max
_SLACK = 1e-9


def scaled(col: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the column that take part, their floor(scale * x) as a matrix of
    whole doubles). Shorter vectors are filled up with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    many = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(col)), many)
    flat = col.flatten()
    x = pc.fill_null(pc.cast(flat, pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        y = np.clip(np.floor(x * scale), -_MOST, _MOST)
    good = np.ones(len(col), bool) & ~col.is_null().to_numpy(zero_copy_only=False)
    good[owner[~np.isfinite(x)]] = False
    out = np.zeros((len(col), int(many.max()) if len(many) else 0))
    out[owner, np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)] = y
    rows = np.flatnonzero(good)
    return rows, out[rows]


def _fill(x: np.ndarray, dims: int) -> np.ndarray:
    return x if x.shape[1] >= dims else np.pad(x, ((0, 0), (0, dims - x.shape[1])))


class Search:
    """The best ``k`` of the vectors seen, for each of some queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, step: int = 8):
        self.ids, self.vectors, self.k, self.step = ids, vectors, k, step
        self.best = np.full((len(ids), k), -np.inf)  # scores, best first
        self.who = np.full((len(ids), k), _LONG)
        self.plan = None

    def _planned(self, dims: int):
        """Dimension blocks by falling mass of the queries, and the queries' lengths there."""
        if self.plan is None or self.plan[0] != dims:
            q = _fill(self.vectors, dims)
            blocks = [slice(a, min(a + self.step, dims)) for a in range(0, dims, self.step)]
            size = np.stack([np.sqrt(np.square(q[:, b]).sum(1)) for b in blocks], 1) if blocks else np.zeros((len(q), 0))
            order = np.argsort(-np.square(size).sum(0), kind="stable")
            self.plan = dims, q, [blocks[i] for i in order], size[:, order]
        return self.plan

    def add(self, ids: np.ndarray, vectors: np.ndarray, rows: int = 4096, queries: int = 256) -> None:
        """Take in some candidates."""
        for a in range(0, len(ids), rows):
            self._block(ids[a:a + rows], vectors[a:a + rows], queries)

    def _block(self, ids: np.ndarray, vectors: np.ndarray, queries: int) -> None:
        dims = max(vectors.shape[1], self.vectors.shape[1])
        _, q, blocks, q_size = self._planned(dims)
        columns = np.ascontiguousarray(_fill(vectors, dims).T)  # one row a dimension
        top = (np.abs(q).max(initial=0), np.abs(columns).max(initial=0))
        most = top[0] * top[1] * max(1, dims)
        if not most < 2 ** 53 or self.best.dtype == object:  # exact integers, however large
            return self._large(ids, _fill(vectors, dims), queries)
        kind = np.float32 if most < 2 ** 24 else np.float64
        columns = columns.astype(kind)
        size = np.stack([np.sqrt(np.square(columns[b], dtype=np.float64).sum(0)) for b in blocks]) if blocks else np.zeros((0, len(ids)))
        for lo in range(0, len(q), queries):
            part = slice(lo, lo + queries)
            self._group(part, q[part].astype(kind), q_size[part], ids, columns, blocks, size)

    def _group(self, part, q, q_size, ids, columns, blocks, size) -> None:
        floor = self.best[part, -1]
        own = self.ids[part][:, None] == ids[None, :]
        score = np.zeros((len(q), len(ids)), q.dtype)
        at, pairs = 0, None
        while at < len(blocks) and pairs is None:
            score += q[:, blocks[at]] @ columns[blocks[at]]
            at += 1
            if at * 2 < len(blocks):  # so early the bound seldom tells
                continue
            reach = q_size[:, at:] @ size[at:]
            alive = score + reach * (1 + _SLACK) + _SLACK >= floor[:, None]
            alive &= ~own
            if alive.sum() * 8 < alive.size or at == len(blocks):
                pairs = np.nonzero(alive)
        row, col = pairs if pairs is not None else np.nonzero(~own)
        score = score[row, col]
        while at < len(blocks) and len(row):  # the few pairs left, one column after another
            for d in range(blocks[at].start, blocks[at].stop):
                score += q[row, d] * columns[d, col]
            at += 1
            reach = np.einsum("ij,ij->i", q_size[row, at:], size[at:, col].T)
            keep = score + reach * (1 + _SLACK) + _SLACK >= floor[row]
            row, col, score = row[keep], col[keep], score[keep]
        self._take(part, row, ids[col], score.astype(np.float64))

    def _large(self, ids: np.ndarray, vectors: np.ndarray, queries: int) -> None:
        whole = lambda x: np.array([[int(v) for v in r] for r in x.tolist()], object).reshape(x.shape)
        q, v = whole(_fill(self.vectors, vectors.shape[1])), whole(vectors)
        if self.best.dtype != object:
            self.best = self.best.astype(object)
        for lo in range(0, len(q), queries):
            part = slice(lo, lo + queries)
            score = q[part].dot(v.T) if q.shape[1] else np.zeros((len(q[part]), len(v)), object)
            row, col = np.nonzero(self.ids[part][:, None] != ids[None, :])
            self._take(part, row, ids[col], score[row, col])

    def _take(self, part, row, ids, score) -> None:
        """Merge pairs into the best so far: higher scores, then smaller ids."""
        if not len(row):
            return
        best, who = self.best[part], self.who[part]
        row = np.concatenate((np.repeat(np.arange(len(best)), self.k), row))
        score = np.concatenate((best.ravel(), score))
        who = np.concatenate((who.ravel(), ids))
        if score.dtype == object:
            order = np.array(sorted(range(len(row)), key=lambda i: (row[i], -score[i], who[i])))
        else:
            order = np.lexsort((who, -score, row))
        first = np.searchsorted(row[order], np.arange(len(best)))
        pick = order[first[:, None] + np.arange(self.k)]  # each row has k entries at least
        self.best[part], self.who[part] = score[pick], who[pick]

    def rows(self) -> pa.RecordBatch:
        q, r = np.nonzero(self.best > -np.inf)
        score = [Decimal(max(-_WIDE, min(_WIDE, int(x)))) for x in self.best[q, r]]
        return pa.RecordBatch.from_arrays([pa.array(self.ids[q]), pa.array(self.who[q, r]), pa.array(score, pa.decimal128(38, 0))],
                                          ["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
          group_bytes: int = 8 << 20) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: for each query (a row where
    ``is_query``) the ``k`` other rows with the highest inner product of
    floor(``scale`` * x), all if there are fewer; ties go to the smaller id.

    Rows without an id, without a vector, or with a null or non-finite component take no
    part. Vectors of different lengths count as filled up with zeros; empty ones score
    0. Scaled components beyond a double's range are cut to it. Repeated rows are candidates of their own (a row of a query's id is never its
    candidate), and a repeated query is answered once, by the first of its vectors in
    order. Scores beyond a long's range are cut to it after ranking, those beyond 38 digits
    to these before. An empty
    table, or one without queries, gives no rows. Other columns are not read.

    Queries are sent to tasks in groups of about ``group_bytes`` (by a hash of the id; a
    longer vector is a group of its own), one group after another, each passing once over
    the vectors; a group's result is written before the next begins."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("q"))
    rows = rows.where("id is not null and v is not null")
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    asked = rows.where(F.col("q") & usable).groupBy("id").agg(F.min("v").alias("v"))
    size = F.size("v") * 8 + 64
    total = rows.where(F.col("q") & usable).agg(F.sum(size)).first()[0] or 0
    groups = -(-total // group_bytes)
    spread = F.pmod(F.xxhash64("id"), F.lit(max(1, groups)))
    path = scratch_path(spark, "search-queries")
    asked.withColumn("part", spread).write.partitionBy("part").parquet(path)
    found = [_one_group(rows, spark.read.schema("id long, v array<double>, part long").parquet(path).where(F.col("part") == g), k, scale)
             for g in range(groups)]
    if not found:
        return spark.createDataFrame([], RANKED)
    return spark.read.schema(RANKED).parquet(*found)


RANKED = "query_id long, rank int, vec_id long, score long"


def _one_group(rows: DataFrame, asked: DataFrame, k: int, scale: int) -> str:
    """Write the ranked rows of one group of queries; returns their folder."""
    spark = rows.sparkSession
    own = asked.select("id", "v").toArrow()
    kept, matrix = scaled(own.column("v"), scale)  # all of them, as they were checked
    sent = spark.sparkContext.broadcast((own.column("id").to_numpy()[kept], matrix))

    def run(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*sent.value, k)
        for batch in batches_in:
            part, found = scaled(batch.column("v"), scale)
            search.add(batch.column("id").to_numpy()[part], found)
        yield search.rows()

    near = common.map_arrow(rows.select("id", "v"), run, "query_id long, vec_id long, score decimal(38,0)")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    path = scratch_path(spark, "search-ranked")
    score = F.greatest(F.least("score", F.lit(_LONG)), F.lit(-_LONG - 1)).cast("long").alias("score")
    ranked.select("query_id", "rank", "vec_id", score).write.parquet(path)
    sent.destroy()
    return path
