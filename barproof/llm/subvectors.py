"""Clustering around centroids, with blocks of dimensions encoded by dictionaries of subvectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barproof.session import materialize

#: Dimensions of a block. Pairs of small integers repeat often; longer blocks hardly do.
WIDTH = 2
#: Vectors that share dictionaries.
CHUNK = 8192
#: Largest absolute component: distances and their partial sums then fit 64 bits.
LARGEST = 1 << 27
#: Candidates that the smallest hashes are sought among, about; more are taken where that is too few.
CANDIDATES = 256

_ENCODED = "ids array<bigint>, codes binary, subvectors binary, counts array<int>"


@dataclass(frozen=True)
class Chunk:
    """Vectors as codes: block b of vector i is row ``codes[i, b]`` of dictionary b."""

    codes: np.ndarray
    dictionaries: list[np.ndarray]

    @classmethod
    def of(cls, vectors: np.ndarray, width: int) -> Chunk:
        """Encode the rows of an integer matrix; no two entries of a dictionary are equal."""
        codes, dictionaries = [], []
        for start in range(0, vectors.shape[1], width):
            block = vectors[:, start : start + width]
            code = np.zeros(len(block), np.int64)
            for column in block.T:
                values, place = np.unique(column, return_inverse=True)
                # Both factors are at most the number of rows, so the product fits.
                _, first, code = np.unique(code * len(values) + place, return_index=True, return_inverse=True)
            codes.append(code)
            dictionaries.append(block[first])
        return cls(np.column_stack(codes), dictionaries)

    @classmethod
    def read(cls, row: dict, dims: int, width: int) -> Chunk:
        n, blocks = len(row["ids"]), -(-dims // width)
        kind = np.uint16 if len(row["codes"]) == 2 * n * blocks else np.uint32
        entries, at, dictionaries = np.frombuffer(row["subvectors"], np.int32), 0, []
        for block, count in enumerate(row["counts"]):
            size = min(width, dims - block * width)
            dictionaries.append(entries[at : at + count * size].reshape(count, size).astype(np.int64))
            at += count * size
        return cls(np.frombuffer(row["codes"], kind).reshape(n, blocks), dictionaries)

    def row(self, ids: list) -> dict:
        kind = np.uint16 if len(ids) <= 1 << 16 else np.uint32
        return {
            "ids": ids,
            "codes": self.codes.astype(kind).tobytes(),
            "subvectors": b"".join(d.astype(np.int32).tobytes() for d in self.dictionaries),
            "counts": [len(d) for d in self.dictionaries],
        }

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and the squared distance, of each vector.

        Each distinct subvector meets each centroid once; a vector's distances are sums by code.
        """
        total = np.zeros((len(self.codes), len(centroids)), np.int64)
        at = 0
        for block, entries in enumerate(self.dictionaries):
            part = centroids[:, at : at + entries.shape[1]]
            distances = np.square(entries[:, None, :] - part[None, :, :]).sum(axis=2)
            total += distances[self.codes[:, block]]
            at += entries.shape[1]
        cluster = total.argmin(axis=1)  # the first of equal ones
        return cluster, total[np.arange(len(total)), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Sums of the vectors of each cluster: how often a code occurs there, times its subvector."""
        out = []
        for block, entries in enumerate(self.dictionaries):
            often = np.bincount(cluster * len(entries) + self.codes[:, block], minlength=k * len(entries))
            out.append(often.reshape(k, len(entries)) @ entries)
        return np.concatenate(out, axis=1)


@dataclass(frozen=True)
class Clustering:
    """``assigned``: vec_id, cluster, distance of each vector. ``centroids``: final integer rows."""

    assigned: DataFrame
    centroids: list[list[int]]


def integer_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id and ``v``, floor(scale * x) of each component; other than whole finite vectors go."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return vectors.where((F.size("embedding") == dims) & finite).select(F.col("vec_id").cast("long"), scaled.alias("v"))


def encode(kept: DataFrame, dims: int, width: int = WIDTH, chunk: int = CHUNK) -> DataFrame:
    """A row for each chunk of vectors, with codes and dictionaries; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, chunk):
                batch = whole.slice(start, chunk)
                values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                if np.abs(values).max() > LARGEST:
                    raise ValueError(f"A component is beyond {LARGEST}; distances would not fit.")
                row = Chunk.of(values, width).row(batch.column("vec_id").to_pylist())
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema(
        [("ids", pa.list_(pa.int64())), ("codes", pa.binary()), ("subvectors", pa.binary()), ("counts", pa.list_(pa.int32()))]
    )
    return kept.mapInArrow(run, _ENCODED)


def _order(seed: int) -> Column:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    return F.sha2(name.cast("binary"), 256)


def first_centroids(kept: DataFrame, rows: int, k: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest hashes; rows that repeat an id follow by their components.

    Hashes below a threshold that the number of rows gives are looked at, so that the tasks
    together send a bounded number of vectors.
    """
    share = min(1.0, CANDIDATES / max(1, rows))
    while True:
        some = kept.withColumn("order", _order(seed))
        if share < 1:
            some = some.where(F.col("order") < f"{int(share * 16**12):012x}")
        found = some.orderBy("order", "v").limit(k).collect()
        if len(found) == k or share == 1:
            return [[int(x) for x in row.v] for row in found]
        share = min(1.0, share * 16)


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1,
    width: int = WIDTH, chunk: int = CHUNK,
) -> Clustering:
    """Cluster ``vectors`` (vec_id, embedding) around k centroids, in whole numbers and exactly.

    Vectors of exactly ``dims`` finite components are kept, and each component x becomes
    floor(scale * x). Centroids start as the kept vectors with the smallest sha256 of
    ``<seed>:<vec_id>``. A round gives each vector to the nearest centroid (squared Euclidean
    distance, ties to the smaller number) and replaces each centroid that has vectors by the floor
    of their mean; after the rounds vectors are given out once more.

    How: the vectors are read once and written as chunks. In a chunk, each block of ``width``
    dimensions is a dictionary of its distinct subvectors and a code for each vector, without loss.
    A round computes the exact distances between subvectors and centroids once for each dictionary
    entry and adds them up by code; new centroids are counts of codes times subvectors. Of a round,
    only k rows of sums leave a task, so copies of one vector cost no more than others.

    Edge cases: a null embedding, or one with a null, NaN or infinite component, is not kept; a null
    vec_id hashes as an empty text, stays null and is clustered like others; repeated rows are
    vectors of their own. With fewer than k vectors there are as many centroids as vectors; without
    any, no rows. Components beyond 2**27 in magnitude fail the job. Other columns are ignored.
    """
    kept = integer_vectors(vectors, dims, scale)
    encoded = materialize(encode(kept, dims, width, chunk))
    rows = encoded.agg(F.sum(F.size("ids"))).first()[0] or 0
    centroids = first_centroids(kept, rows, k, seed)

    def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = np.array(centroids, np.int64).reshape(-1, dims)
        sums, counts = np.zeros((len(middle), dims), np.int64), np.zeros(len(middle), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                read = Chunk.read(row, dims, width)
                nearest, _ = read.nearest(middle)
                sums += read.sums(nearest, len(middle))
                counts += np.bincount(nearest, minlength=len(middle))
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.RecordBatch.from_pydict(
                {"cluster": pa.array(some, pa.int32()), "members": counts[some], "sums": sums[some].tolist()}
            )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = np.array(centroids, np.int64).reshape(-1, dims)
        for batch in batches:
            for row in batch.to_pylist():
                nearest, distance = Chunk.read(row, dims, width).nearest(middle)
                yield pa.RecordBatch.from_pydict(
                    {"vec_id": pa.array(row["ids"], pa.int64()), "cluster": pa.array(nearest, pa.int32()), "distance": distance}
                )

    for _ in range(rounds if centroids else 0):
        parts = encoded.mapInArrow(partial_sums, "cluster int, members bigint, sums array<bigint>")
        totals = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims)]
        moved = list(centroids)
        for row in parts.groupBy("cluster").agg(F.sum("members").alias("members"), *totals).collect():
            moved[row.cluster] = [row[f"s{i}"] // row.members for i in range(dims)]
        centroids = moved
    return Clustering(encoded.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"), centroids)


def clustered(vectors: DataFrame, **settings) -> DataFrame:
    """The assignment with each cluster's and the total inertia, and the digest of its centroid."""
    spark = vectors.sparkSession
    found = cluster(vectors, **settings)
    assigned = materialize(found.assigned)
    inertia = {r.cluster: r.inertia for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    total = sum(inertia.values())
    facts = [
        (number, inertia[number], total, hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
        for number, centroid in enumerate(found.centroids)
        if number in inertia
    ]
    names = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    return assigned.join(F.broadcast(spark.createDataFrame(facts, names)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _sql(k: int = 16, rounds: int = 3) -> str:
    """Rounds written out one after the other."""
    steps = [
        f"""c0 as (
  select cluster, unnest(range(64)) as dim, unnest(v) as x from (
    select row_number() over (order by sha256('1:' || vec_id)) - 1 as cluster, v from kept
    order by sha256('1:' || vec_id) limit {k})
)"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""d{i} as materialized (
  select vec_id, cluster, sum((p.x - c.x) * (p.x - c.x)) as distance from parts p join c{i} c using (dim)
  group by vec_id, cluster
), a{i} as materialized (
  select vec_id, cluster, distance from d{i}
  qualify row_number() over (partition by vec_id order by distance, cluster) = 1
), m{i} as (
  select cluster, dim, sum(x) as total, count(*) as n from a{i} join parts using (vec_id) group by cluster, dim
), c{i + 1} as materialized (
  select cluster, dim, case when n is null then x
         else cast((total - ((total % n) + n) % n) // n as bigint) end as x
  from c{i} left join m{i} using (cluster, dim)
)"""
        )
    last = rounds
    return f"""
with kept as materialized (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings
  where len(embedding) = 64 and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(cast(x as double)), false)))
), parts as materialized (
  select vec_id, unnest(range(64)) as dim, unnest(v) as x from kept
), {', '.join(steps)}, digests as (
  select cluster, sha256(string_agg(cast(x as varchar), ',' order by dim)) as centroid_sha256 from c{last} group by cluster
)
select vec_id, cast(cluster as integer) as cluster, cast(distance as bigint) as distance,
       cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
       cast(sum(distance) over () as bigint) as inertia, centroid_sha256
from a{last} join digests using (cluster)
"""


SQL = _sql()
