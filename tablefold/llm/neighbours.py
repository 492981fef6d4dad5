"""Nearest neighbours by largest inner product, over randomly rotated one-bit codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablefold.llm.common import stored

CODE_BITS = 512
#: Half width of the error bound of an estimate, in standard deviations.
EPSILON = 3.0
SEED = 20240229
QUERY_BLOCK = 2_048
DATA_BLOCK = 8_192


def rotation(dims: int, bits: int = CODE_BITS, seed: int = SEED) -> np.ndarray:
    """Random orthonormal columns that carry vectors of ``dims`` into ``bits`` dimensions, lengths kept."""
    bits = max(bits, dims)
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dims)))
    return q * np.sign(np.diag(r))


def codes(vectors: np.ndarray, turned_by: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated vectors, their lengths, and the inner product of each unit vector with its code."""
    length = np.linalg.norm(vectors, axis=1)
    turned = (vectors / length[:, None]) @ turned_by.T
    correction = np.abs(turned).sum(1) / np.sqrt(turned.shape[1])
    return np.packbits(turned > 0, axis=1), length, correction


def estimates(bits: np.ndarray, length: np.ndarray, correction: np.ndarray, queries: np.ndarray, turned_by: np.ndarray, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of unit queries (rows) with the coded vectors (columns), and their error bounds."""
    width = turned_by.shape[0]
    signs = np.unpackbits(bits, axis=1, count=width).astype(np.float32) * 2 - 1
    turned = (queries / np.linalg.norm(queries, axis=1)[:, None] @ turned_by.T).astype(np.float32)
    scale = length / (correction * np.sqrt(width))
    error = length * np.sqrt(np.maximum(1 - correction**2, 0)) / correction / np.sqrt(max(width - 1, 1)) * epsilon
    return (turned @ signs.T) * scale.astype(np.float32), error


def inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner product of each row of ``x`` with ``y``, added up in order of the components."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += x[:, k] * y[k]
    return total


def indexed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", bits: int = CODE_BITS) -> DataFrame:
    """``vec_id, vector, dims, code, length, correction`` of every vector that takes part.

    Null, empty or zero vectors, those with null or non-finite components, and
    rows with a null identifier take no part; rows that repeat an identifier
    count as one, with the smallest vector. Nothing is fitted: the rotation is drawn
    from a fixed seed.
    """
    vector = F.col(vector_col).cast("array<double>")
    given = vectors.select(F.col(id_col).alias("vec_id"), vector.alias("vector")).filter("vec_id is not null and vector is not null")
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    one = given.filter(sound).groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("dims", F.size("vector"))

    def coded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turned_by: dict[int, np.ndarray] = {}
        for frame in frames:
            for dims, part in frame.groupby("dims"):
                turn = turned_by.setdefault(dims, rotation(dims, bits))
                code, length, correction = codes(np.stack(part["vector"].to_list()), turn)
                yield part.assign(code=[c.tobytes() for c in code], length=length, correction=correction)

    kind = dict(vectors.dtypes)[id_col]
    return one.mapInPandas(coded, f"vec_id {kind}, vector array<double>, dims int, code binary, length double, correction double")


def search(
    index: DataFrame, queries: DataFrame, k: int = 20, bits: int = CODE_BITS, epsilon: float = EPSILON,
    query_block: int = QUERY_BLOCK, data_block: int = DATA_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of ``index`` with the largest inner product with each query.

    ``queries`` are rows of an index; a query's own row is no candidate, nor are
    rows of other dimensions. Queries and rows are cut into blocks by a hash of
    the identifier, and every pair of blocks is one group of bounded size: the
    codes give each inner product within an error bound, rows that may be among
    the ``k`` nearest of the block are scored from the original vectors, and at
    most ``k`` per query leave the block. Order: score, then smaller ``vec_id``;
    all candidates if there are fewer than ``k``, no row for none.
    """
    index, queries = stored(index), stored(queries.select("vec_id", "vector", "dims"))
    n_queries, n_rows = queries.count(), index.count()
    query_blocks, row_blocks = -(-n_queries // query_block) or 1, -(-n_rows // data_block) or 1

    def block(n: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    rows = index.withColumn("row_block", block(row_blocks)).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = queries.withColumn("query_block", block(query_blocks)).withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    kind = dict(index.dtypes)["vec_id"]

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        for dims, own in left.groupby("dims"):
            part = right[right["dims"] == dims]
            if part.empty:
                continue
            turned_by = rotation(dims, bits)
            ids, vectors = part["vec_id"].to_numpy(), np.stack(part["vector"].to_list())
            packed = np.frombuffer(b"".join(part["code"]), np.uint8).reshape(len(part), -1)
            length, correction = part["length"].to_numpy(), part["correction"].to_numpy()
            asked_ids, asked_vectors = own["vec_id"].to_numpy(), np.stack(own["vector"].to_list())
            for at in range(0, len(own), 256):
                guess, error = estimates(packed, length, correction, asked_vectors[at : at + 256], turned_by, epsilon)
                for q, row in enumerate(guess):
                    query_id, query = asked_ids[at + q], asked_vectors[at + q]
                    size = np.linalg.norm(query)
                    low = (row - error) * size
                    low[ids == query_id] = -np.inf
                    floor = np.partition(low, -k)[-k] if len(low) > k else -np.inf
                    near = np.flatnonzero(((row + error) * size >= floor) & (ids != query_id))
                    if len(near) > k:
                        rough = vectors[near] @ query
                        near = near[rough >= np.partition(rough, -k)[-k] - 1e-9 * (1 + abs(rough).max())]
                    score = inner(vectors[near], query)
                    best = np.lexsort((ids[near], -score))[:k]
                    out["query_id"].append(np.full(len(best), query_id))
                    out["vec_id"].append(ids[near][best])
                    out["score"].append(score[best])
        return pd.DataFrame({c: np.concatenate(x) if x else np.empty(0) for c, x in out.items()})

    found = asked.groupBy("query_block", "row_block").cogroup(rows.groupBy("query_block", "row_block")).applyInPandas(
        nearest, f"query_id {kind}, vec_id {kind}, score double"
    )
    # at most k rows per query and block of rows meet here
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
