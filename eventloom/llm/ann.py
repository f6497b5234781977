"""Largest inner products by randomly rotated one-bit codes.

A vector is rotated at random (the same rotation for all) and kept as one bit per dimension with two scalars: its norm, and the
inner product of its direction with the code's. From bits and scalars the inner product with a query is estimated together
with a bound of the error. Of each block the vectors of the best estimates are compared in full; their k-th best score is what the
upper bound of any other vector has to reach to be compared too.
Queries and vectors meet in blocks. Of equal vectors no more than k + 1 rows, those of the smallest ids, can be among
the nearest, so a vector with very many copies is indexed by these.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

#: Width of the error bound in standard deviations of the estimate.
BOUND = 3.5
#: Vectors of the best estimates that set what others have to reach, for each one asked for.
FIRST = 4
BLOCK_VECTORS = 16_384
BLOCK_QUERIES = 4_096
SEED = 7

_ROTATIONS: dict[int, np.ndarray] = {}


def rotation(size: int) -> np.ndarray:
    """The random orthogonal matrix of a dimension, from a fixed seed."""
    if size not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))
        _ROTATIONS[size] = q * np.sign(np.diag(r))
    return _ROTATIONS[size]


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rotated vectors; the dimension is filled up to a multiple of 64 first."""
    size = -(-vectors.shape[1] // 64) * 64
    return np.pad(vectors, ((0, 0), (0, size - vectors.shape[1]))) @ rotation(size)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bits, norms, and each direction's inner product with that of its code."""
    turned = rotated(vectors)
    norms = np.sqrt((turned**2).sum(1))
    agreement = np.abs(turned).sum(1) / np.sqrt(turned.shape[1]) / norms
    return np.packbits(turned > 0, axis=1), norms, agreement


class Codes:
    """Codes of a block, unpacked once for all queries."""

    def __init__(self, bits: np.ndarray, norms: np.ndarray, agreement: np.ndarray):
        signs = np.unpackbits(bits, axis=1).astype(np.float32) * 2 - 1
        size = signs.shape[1]
        # The code's direction, as long as its vector is along it.
        self.directions = (signs * (norms / agreement / np.sqrt(size)).astype(np.float32)[:, None]).T
        spread = norms * np.sqrt(np.maximum(1 - agreement**2, 0)) / agreement * (BOUND / np.sqrt(size - 1))
        # Single precision adds its own error.
        self.spread = (spread + 1e-5 * norms).astype(np.float32)

    def estimate(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products and the half-widths of their bounds; a row for each query."""
        length = np.sqrt((queries**2).sum(1)).astype(np.float32)
        return rotated(queries).astype(np.float32) @ self.directions, length[:, None] * self.spread[None, :]


def estimate(bits: np.ndarray, norms: np.ndarray, agreement: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return Codes(bits, norms, agreement).estimate(queries)


def chosen(guess: np.ndarray, width: np.ndarray, own: np.ndarray, vectors: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """For each query the vectors that may be among its k nearest: whose upper bound reaches a score that k of them have."""
    if guess.shape[1] <= FIRST * k + 1:
        return ~own
    guess = np.where(own, -np.inf, guess)
    first = np.argpartition(guess, -FIRST * k, axis=1)[:, -FIRST * k :]
    scores = np.einsum("qnd,qd->qn", vectors[first], queries)
    scores[np.take_along_axis(own, first, axis=1)] = -np.inf
    least = np.partition(scores, -k, axis=1)[:, -k]
    return (guess + width >= least[:, None]) & ~own


def _vectors(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def search(vectors: DataFrame, k: int = 20, every: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every`` its k nearest other rows.

    Nearest first by inner product in double precision, ties to the smaller id; all candidates where there are fewer. Vectors
    that are null, empty, zero or hold null or non-finite components take no part, nor do rows without an id; vectors of
    different dimension never meet. Rows of the query's own id are its own. Repeated rows count once. Other columns are not read.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding")).filter(
        "vec_id IS NOT NULL AND exists(embedding, x -> x <> 0) AND "
        "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    )
    nearest = Window.partitionBy("embedding").orderBy("vec_id")
    once = rows.groupBy("embedding", "vec_id").agg(F.lit(1).alias("one"))
    distinct = once.withColumn("copy", F.row_number().over(nearest)).filter(F.col("copy") <= k + 1).select("vec_id", "embedding")

    def index(batches):
        for batch in batches:
            sizes = np.asarray(pa.compute.list_value_length(batch.column("embedding"))) if batch.num_rows else np.zeros(0, int)
            for size in np.unique(sizes):
                part = pa.Table.from_batches([batch]).filter(pa.array(sizes == size))
                bits, norms, agreement = encode(_vectors(part["embedding"], int(size)))
                yield pa.record_batch(
                    [
                        part["vec_id"].combine_chunks(),
                        part["embedding"].combine_chunks(),
                        pa.array([b.tobytes() for b in bits], pa.binary()),
                        pa.array(norms),
                        pa.array(agreement),
                    ],
                    names=["vec_id", "embedding", "bits", "norm", "agreement"],
                )

    coded = materialize(distinct.mapInArrow(index, "vec_id long, embedding array<double>, bits binary, norm double, agreement double"))
    n = coded.count()
    # The queries are the stated set itself: a copy beyond k + 1 is no candidate, but may be a query.
    queries = once.filter(F.col("vec_id") % every == 0).select("vec_id", "embedding")
    n_queries = queries.count()
    blocks, query_blocks = max(1, -(-n // BLOCK_VECTORS)), max(1, -(-n_queries // BLOCK_QUERIES))
    size = F.size("embedding").alias("size")
    none = [F.lit(None).cast("binary").alias("bits"), F.lit(None).cast("double").alias("norm"), F.lit(None).cast("double").alias("agreement")]
    place = lambda count, name: F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(count)).cast("int").alias(name)
    each = lambda count, name: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    both = coded.select("*", size, place(blocks, "block"), each(query_blocks, "query_block"), F.lit(False).alias("asks")).unionByName(
        queries.select("*", *none, size, place(query_blocks, "query_block"), each(blocks, "block"), F.lit(True).alias("asks"))
    )

    def compare(table: pa.Table) -> pa.Table:
        asks = np.asarray(table["asks"])
        names = ["query_id", "vec_id", "score"]
        if asks.all() or not asks.any():
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        dimension = table["size"][0].as_py()
        asked, there = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
        ids, vectors_ = np.asarray(there["vec_id"]), _vectors(there["embedding"], dimension)
        bits = np.frombuffer(b"".join(there["bits"].to_pylist()), np.uint8).reshape(len(ids), -1)
        norms, agreement = np.asarray(there["norm"]), np.asarray(there["agreement"])
        query_ids, query_vectors = np.asarray(asked["vec_id"]), _vectors(asked["embedding"], dimension)
        codes, out = Codes(bits, norms, agreement), []
        for part in range(0, len(query_ids), 128):
            asked_vectors = query_vectors[part : part + 128]
            own = query_ids[part : part + 128, None] == ids[None, :]
            near = chosen(*codes.estimate(asked_vectors), own, vectors_, asked_vectors, k)
            for i, query in enumerate(query_ids[part : part + 128]):
                some = np.flatnonzero(near[i])
                scores = (vectors_[some] * asked_vectors[i]).sum(1)
                best = np.lexsort((ids[some], -scores))[:k]
                out.append((np.full(len(best), query), ids[some][best], scores[best]))
        return pa.table([pa.array(np.concatenate([o[c] for o in out])) for c in range(3)], names=names)

    met = both.groupBy("size", "block", "query_block").applyInArrow(compare, "query_id long, vec_id long, score double")
    ranked = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
