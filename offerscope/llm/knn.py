"""Exact top-k search by inner product: a Voronoi join of queries and data.

Pivots are a sample of the vectors that grows with the square root of the queries. Queries and data are grouped by their nearest pivot.
First every query is solved within its own group, which gives it a real k-th score. A query group needs a vector only if its bound
reaches the least of these scores. Two bounds hold for a query q of the group and a vector x, and the lower one counts: along the
pivot's direction and across it, q.x <= max(a)(x along) + max|q across||x across| by Cauchy and Schwarz, and q.x <= p.x + u|x| with
the group's radius u. Summaries of the data groups (radius, longest vector) rule out whole pairs of groups first. What is sent is counted,
queries go to as many shares as their group received, blocks and shares of bounded size are solved locally, and the best are merged.

Of rows with equal vectors only the k + 1 smallest ids can be among the best k without a query's own id, so a vector that a third of
the table holds is sent that often at most.

Scores are integers and exact; bounds are computed in floating point with some slack and only ever keep too much.

Defined cases: vectors null or with null or non-finite components take no part, nor do rows without an id; finite components of any
size do, and a scaled component or a score that does not fit a long ends the query with an error; shorter vectors count as padded with
zeros; a row that repeats id and vector counts once, other rows of the query's own id are no candidates; ties go to the smaller id; very
long vectors are held a batch at a time; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerscope.llm.common import arrow_schema, batch_of, in_batches, stored

#: Queries of one block, and vectors of one share.
BLOCK, SHARE = 1024, 1 << 17
#: Bytes of all pivots at most.
PIVOT_BYTES = 64 << 20
STEP = 4096
CELLED = "cell int, id long, vector binary"
PLACED = "cell int, block int, share int, id long, vector binary"
FOUND = "cell int, query_id long, vec_id long, score long"


def quantised(embedding: Column, scale: float) -> Column:
    """floor(scale * x) per component; null where the vector takes no part."""
    values = F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * F.when(
        F.abs(x.cast("double")) < float("inf"), x.cast("double"))))  # null for infinite and, as NaN is above all, for NaN
    return F.when(~F.exists(values, lambda x: F.coalesce(x.isNull(), F.lit(True))), values)


def _fitting(embedding: Column, scale: float) -> Column:
    """An error for components that do not fit a long after scaling; else null."""
    too_large = F.exists(embedding, lambda x: F.coalesce(
        (F.abs(x.cast("double")) < float("inf")) & (F.abs(x.cast("double")) * float(scale) >= 2.0 ** 63), F.lit(False)))
    return F.when(too_large, F.raise_error(F.lit("a scaled component does not fit a long")))


def _packed(values: list[int]) -> bytes:
    """Components as 32-bit integers where all fit, else as 64-bit ones; the first byte tells."""
    data = np.array(values, dtype="<i8")
    small = not len(data) or (data.min() >= -(1 << 31) and data.max() < 1 << 31)
    return b"\4" + data.astype("<i4").tobytes() if small else b"\b" + data.tobytes()


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), dtype=np.int64)
    for i, packed in enumerate(column.to_pylist()):
        values = np.frombuffer(packed, dtype=f"<i{packed[0]}", offset=1)
        out[i, :len(values)] = values
    return out


@dataclass(frozen=True)
class Grouping:
    """Pivots, and what is known of query and data groups."""

    pivots: np.ndarray
    reach: np.ndarray | None = None  # radius of the query groups; negative: no query
    along: tuple[np.ndarray, np.ndarray] | None = None  # least and greatest part of the queries along the pivot's direction
    across: np.ndarray | None = None  # longest part of a query across it
    floor: np.ndarray | None = None  # a score that every query of the group reaches
    allowed: np.ndarray | None = None  # data group x query group

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        squares = (vectors ** 2).sum(1)[:, None] - 2 * vectors @ self.pivots.T + (self.pivots ** 2).sum(1)[None, :]
        group = squares.argmin(1)
        far = np.sqrt(((vectors - self.pivots[group]) ** 2).sum(1))
        return group, far * (1 + 1e-9) + 1e-3

    def parts(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lengths along and across the direction of every pivot, the latter a little too long."""
        length = np.sqrt((self.pivots ** 2).sum(1))
        along = vectors @ (self.pivots / np.maximum(length, 1e-300)[:, None]).T
        squares = (vectors ** 2).sum(1)[:, None]
        return along, np.sqrt(np.maximum(squares - along ** 2, 0) + 1e-9 * squares) + 1e-3

    def upper(self, vectors: np.ndarray) -> np.ndarray:
        """No query of a group scores higher with a vector."""
        along, across = self.parts(vectors)
        size = np.sqrt((vectors ** 2).sum(1))[:, None]
        reach = np.maximum(self.reach, 0)[None, :]
        first = np.maximum(self.along[0] * along, self.along[1] * along) + self.across * across
        second = vectors @ self.pivots.T + reach * size
        slack = 1 + 1e-9 * size * (np.sqrt((self.pivots ** 2).sum(1))[None, :] + reach)
        return np.minimum(first, second) + slack


def best(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """The k highest scores of every query, ties to smaller ids; the query's own id is left out."""
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    limit = queries.shape[1] * max(1.0, np.abs(queries.astype(float)).max(initial=0)) * max(1.0, np.abs(vectors.astype(float)).max(initial=0))
    exact = limit < 2.0 ** 53  # floating-point products and sums are then exact
    short = limit < 2.0 ** 49  # score and position fit one integer
    kind = np.float64 if exact else np.int64 if limit < 2.0 ** 62 else object  # Python's integers have no limit
    left, vectors = queries.astype(kind), vectors.astype(kind)
    scores = np.full((len(queries), 0), 0, dtype=np.int64)
    names = np.zeros((len(queries), 0), dtype=np.int64)
    lowest = np.iinfo(np.int64).min
    for at in range(0, len(ids), STEP):
        part = vectors[at:at + STEP]
        got = left @ part.T
        if kind is object and len(part) and len(left) and (got.max() >= 1 << 62 or got.min() <= -(1 << 62)):
            raise OverflowError("a score does not fit a long")
        got = got.astype(np.int64)
        named = ids[at:at + STEP]
        own = query_ids[:, None] == named[None, :]
        if short:
            place = np.where(own, lowest, got * STEP + (STEP - 1 - np.arange(len(named)))[None, :])
            if len(named) > k:
                place = np.partition(place, len(named) - k, axis=1)[:, -k:]
            column = STEP - 1 - place % STEP
            value = np.where(place == lowest, lowest, place // STEP)
            column = np.where(place == lowest, 0, column)
        else:
            got[own] = lowest
            column = np.argsort(-np.maximum(got, lowest + 1), axis=1, kind="stable")[:, :k]
            value = np.take_along_axis(got, column, axis=1)
        scores, names = np.concatenate([scores, value], axis=1), np.concatenate([names, named[column]], axis=1)
        by_name = np.argsort(names, axis=1, kind="stable")
        scores, names = np.take_along_axis(scores, by_name, axis=1), np.take_along_axis(names, by_name, axis=1)
        by_score = np.argsort(-np.maximum(scores, lowest + 1), axis=1, kind="stable")[:, :k]
        scores, names = np.take_along_axis(scores, by_score, axis=1), np.take_along_axis(names, by_score, axis=1)
    row, column = np.nonzero(scores != lowest)
    return query_ids[row], names[row, column], scores[row, column]


def top_k(df: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
          embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores among all other rows."""
    packed = arrow_schema("id long, query boolean, vector binary")

    def pack(batch: pa.RecordBatch):
        yield batch_of(packed, batch.column(0), batch.column(1), [_packed(v) for v in batch.column(2).to_pylist()])

    vector = F.coalesce(_fitting(F.col(embedding), scale), quantised(F.col(embedding), scale))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"),
                     vector.alias("vector")).where("id is not null and vector is not null")
    rows = stored(in_batches(rows, pack, "id long, query boolean, vector binary").distinct(), "vectors")
    size = rows.agg(F.count_if("query").alias("queries"), F.max(F.octet_length("vector")).alias("bytes")).first()
    if not size["queries"]:
        return rows.where("false").select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
                                          F.lit(0).cast("long").alias("score"))
    width = max(1, (size["bytes"] - 1) // 4)
    count = max(1, min(max(4, isqrt(size["queries"]) // 3), PIVOT_BYTES // (8 * width)))
    sample = rows.orderBy(F.xxhash64("id"), "id", "vector").limit(count).select("vector").toArrow().column(0)
    grouping = Grouping(_matrix(sample, width).astype(np.float64))
    groups = len(grouping.pivots)
    queries, data = _celled(rows, grouping, width, k)
    local = stored(_best_of(_solved(queries, data, width, k, groups), k), "own-group-best")
    grouping = _with_bounds(grouping, queries, data, local, width, k)
    away = _solved(queries, _sent(data, grouping, width), width, k, groups)
    return _best_of(local.drop("rank").unionByName(away), k).select("query_id", "rank", "vec_id", "score")


def _best_of(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("cell", "query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def _celled(rows: DataFrame, grouping: Grouping, width: int, k: int) -> tuple[DataFrame, DataFrame]:
    """(cell, id, vector) of the queries, and of the data: of rows with equal vectors those that can be among the best."""
    schema = arrow_schema(CELLED)

    def assign(whole: pa.RecordBatch):
        for at in range(0, whole.num_rows, STEP):
            batch = whole.slice(at, STEP)
            group, _ = grouping.nearest(_matrix(batch.column(1), width).astype(np.float64))
            yield batch_of(schema, group.astype(np.int32), batch.column(0), batch.column(1))

    nth = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    some = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    return tuple(stored(in_batches(table.select("id", "vector"), assign, CELLED), name)
                 for table, name in ((rows.where("query"), "queries"), (some, "data")))


def _counts(celled: DataFrame, groups: int) -> np.ndarray:
    out = np.zeros(groups, dtype=np.int64)
    for r in celled.groupBy("cell").count().collect():  # one row per pivot
        out[r["cell"]] = r["count"]
    return out


def _summed(celled: DataFrame, width: int, of: Callable[[np.ndarray, np.ndarray], list[np.ndarray]], groups: int, n: int) -> list[np.ndarray]:
    """Greatest values per cell of the n columns that `of` makes of vectors and their cells; -inf where a cell is empty."""
    ddl = "cell int, kind int, value double"
    schema = arrow_schema(ddl)

    def run(batches):
        most = np.full((n, groups), -np.inf)
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                batch = whole.slice(at, STEP)
                cell = batch.column(0).to_numpy()
                for kind, values in enumerate(of(_matrix(batch.column(1), width).astype(np.float64), cell)):
                    np.maximum.at(most[kind], cell, values)
        kind, cell = np.nonzero(most > -np.inf)
        yield batch_of(schema, cell.astype(np.int32), kind.astype(np.int32), most[kind, cell])

    out = np.full((n, groups), -np.inf)
    for r in celled.select("cell", "vector").mapInArrow(run, ddl).groupBy("cell", "kind").agg(F.max("value").alias("value")).collect():
        out[r["kind"], r["cell"]] = r["value"]
    return list(out)


def _with_bounds(grouping: Grouping, queries: DataFrame, data: DataFrame, local: DataFrame, width: int, k: int) -> Grouping:
    """What the own groups' results and summaries tell: every query of a group reaches `floor`; `allowed` pairs of groups can matter."""
    groups, floor = len(grouping.pivots), np.full(len(grouping.pivots), -np.inf)
    asking = {r["cell"]: r["n"] for r in queries.groupBy("cell").agg(F.count_distinct("id").alias("n")).collect()}
    full = local.where(F.col("rank") == k).groupBy("cell").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    for r in full.collect():
        if r["n"] == asking.get(r["cell"]):
            floor[r["cell"]] = r["least"]

    def of_queries(vectors: np.ndarray, cell: np.ndarray) -> list[np.ndarray]:
        along, across = (m[np.arange(len(cell)), cell] for m in grouping.parts(vectors))
        far = np.sqrt(((vectors - grouping.pivots[cell]) ** 2).sum(1)) * (1 + 1e-9) + 1e-3
        return [far, -along, along, across]

    def of_data(vectors: np.ndarray, cell: np.ndarray) -> list[np.ndarray]:
        far = np.sqrt(((vectors - grouping.pivots[cell]) ** 2).sum(1)) * (1 + 1e-9) + 1e-3
        return [far, np.sqrt((vectors ** 2).sum(1)) * (1 + 1e-9)]

    reach, least, most, across = _summed(queries.select("cell", "vector"), width, of_queries, groups, 4)
    radius, longest = _summed(data.select("cell", "vector"), width, of_data, groups, 2)
    has = reach >= 0
    length = np.sqrt((grouping.pivots ** 2).sum(1))
    upper = (grouping.pivots @ grouping.pivots.T + np.maximum(radius, 0)[:, None] * length[None, :]
             + np.maximum(longest, 0)[:, None] * np.maximum(reach, 0)[None, :])
    allowed = (upper + 1 + 1e-9 * np.abs(upper) >= floor[None, :]) & has[None, :] & (radius >= 0)[:, None]
    np.fill_diagonal(allowed, False)
    return Grouping(grouping.pivots, reach, (np.where(has, -least, 0.0), np.where(has, most, 0.0)), np.where(has, across, 0.0), floor, allowed)


def _sent(data: DataFrame, grouping: Grouping, width: int) -> DataFrame:
    """(cell, id, vector) for every other group that a vector may matter to."""
    schema = arrow_schema(CELLED)

    def send(whole: pa.RecordBatch):
        for at in range(0, whole.num_rows, STEP):
            batch = whole.slice(at, STEP)
            vectors = _matrix(batch.column(2), width).astype(np.float64)
            row, to = np.nonzero(grouping.allowed[batch.column(0).to_numpy()] & (grouping.upper(vectors) >= grouping.floor[None, :]))
            row = pa.array(row)
            yield batch_of(schema, to.astype(np.int32), batch.column(1).take(row), batch.column(2).take(row))

    return in_batches(data, send, CELLED)


def _mixed(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)


def _solved(queries: DataFrame, received: DataFrame, width: int, k: int, groups: int) -> DataFrame:
    """Every query's best among what its group received; queries go to the shares that exist, data to the blocks that exist."""
    asking, got = _counts(queries, groups), _counts(received, groups)
    blocks, shares = -(-asking // BLOCK), -(-got // SHARE)
    schema, found = arrow_schema(PLACED), arrow_schema(FOUND)

    def spread(over: np.ndarray, within: np.ndarray, asks: bool):
        def run(whole: pa.RecordBatch):
            for begin in range(0, whole.num_rows, STEP):
                batch = whole.slice(begin, STEP)
                cell, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                many = np.where(within[cell] > 0, over[cell], 0)
                at = np.repeat(np.arange(len(cell)), many)
                nth = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
                own = (_mixed(ids) % np.maximum(within[cell], 1).astype(np.uint64)).astype(np.int32)[at]
                block, share = (own, nth.astype(np.int32)) if asks else (nth.astype(np.int32), own)
                yield batch_of(schema, cell[at], block, share, ids[at], batch.column(2).take(pa.array(at)))
        return run

    def solve(asked: pa.Table, sent: pa.Table) -> pa.Table:
        if not asked.num_rows or not sent.num_rows:
            return found.empty_table()
        (ids, mine), (names, vectors) = ((t.column(3).to_numpy(), _matrix(t.column(4), width)) for t in (asked, sent))
        query, vec, score = best(mine, ids, vectors, names, k)
        return pa.Table.from_batches([batch_of(found, np.full(len(query), asked.column(0)[0].as_py(), dtype=np.int32), query, vec, score)], found)

    asked = in_batches(queries, spread(shares, blocks, True), PLACED)
    sent = in_batches(received, spread(blocks, shares, False), PLACED)
    keys = ("cell", "block", "share")
    return asked.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(solve, FOUND)
