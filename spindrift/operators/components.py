"""Connected components by alternating star contraction.

Every round runs a large-star and a small-star step over the edges, each a
grouped minimum and a join, so that no vertex's neighbours are ever collected.
The edges' number never grows, and rounds are logarithmic in the vertices. The
entries of vertices with very many neighbours, as the centre of a large component
has, are broadcast; the others are joined by shuffle.

A graph of at most SMALL edges, between vertices of bounded size, is settled in one
task instead: min labels with pointer jumps, which give the same rows. A round of
the distributed steps costs more than such a graph's whole work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindrift.storage import discard, materialise, ship

MAX_ROUNDS = 60
#: Edges that one task settles; bytes of a vertex there.
SMALL, SMALL_VERTEX = 100_000, 256
#: Neighbours from which a vertex is a hub, and the most hubs that are broadcast.
HUB, MOST_HUBS = 1_000, 50_000
#: Rounds of the last call, for reports; 0 if one task settled it.
last_rounds = 0


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, least member) that connect what the pairs connect: min-label rounds with pointer jumps, on distinct values."""
    if not len(a):
        return a, b
    names, inverse = np.unique(np.r_[a, b], return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    label = np.arange(len(names))
    while True:
        before = label.copy()
        m = np.minimum(label[x], label[y])
        np.minimum.at(label, x, m)
        np.minimum.at(label, y, m)
        np.minimum.at(label, before, label.copy())
        label = label[label]
        if np.array_equal(label, before):
            break
    moved = np.flatnonzero(label != np.arange(len(names)))
    return names[moved], names[label[moved]]


def _settle(batches):
    """The one task of a small graph: (u, v) in, each vertex with the least one of its component out."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches).combine_chunks()
    kind = table.schema.field("u").type
    u, v = (table.column(c).to_numpy() for c in ("u", "v"))
    member, least = forest(u, v)
    yield pa.RecordBatch.from_arrays([pa.array(member, kind), pa.array(least, kind)], ["u", "v"])


def _joined(edges: DataFrame, least: DataFrame, hub: int | None) -> DataFrame:
    """edges with their u's row of least (u, m, n); entries with n of `hub` or more are broadcast."""
    if hub is None:
        return edges.join(least.drop("n"), "u")
    hubs = F.broadcast(least.where(F.col("n") >= hub).drop("n"))
    rest = edges.join(hubs.select("u"), "u", "left_anti").join(least.where(F.col("n") < hub).drop("n"), "u")
    return edges.join(hubs, "u").unionByName(rest)


def _large_star(edges: DataFrame, hub: int | None) -> DataFrame:
    """Each vertex's larger neighbours, linked to the least of its neighbours and itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return _joined(both.where("v > u"), least, hub).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, hub: int | None) -> DataFrame:
    """Each vertex and its smaller neighbours, linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    joined = _joined(down, least, hub)
    return joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    """(most edges of one vertex, edges, a checksum of all edges), from one job."""
    per = edges.select(F.explode(F.array(F.struct(F.col("u").alias("at"), F.lit(1).alias("own")), F.struct(F.col("v").alias("at"), F.lit(0).alias("own")))).alias("x"), F.xxhash64("u", "v").cast("decimal(38,0)").alias("h"))
    per = per.groupBy("x.at").agg(F.count("*").alias("n"), F.sum("x.own").alias("own"), F.sum(F.when(F.col("x.own") == 1, F.col("h"))).alias("h"))
    most, n, h = per.agg(F.max("n"), F.sum("own"), F.sum("h")).first()
    return most or 0, n or 0, h


def _is_small(edges: DataFrame) -> bool:
    """Whether one task may settle the edges; long vertices, as texts are, count by their length."""
    kind = edges.schema["u"].dataType
    if isinstance(kind, T.StringType):
        n, longest = edges.agg(F.count("*"), F.max(F.greatest(F.octet_length("u"), F.octet_length("v")))).first()
        return n <= SMALL and (longest or 0) <= SMALL_VERTEX
    return isinstance(kind, (T.LongType, T.IntegerType)) and edges.count() <= SMALL


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(vertex, component): the least vertex that each vertex of an edge is connected with. Null ends are dropped; loops keep their vertex."""
    global last_rounds
    last_rounds = 0
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    loops = edges.where("u = v").select(F.col("u").alias("vertex")).distinct()
    edges = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if _is_small(edges):
        ship(edges.sparkSession)
        settled = materialise(edges.coalesce(1).mapInArrow(_settle, edges.schema))
        discard(edges)
        edges = settled
    else:
        edges = _contracted(edges)
    found = edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    found = found.union(edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())
    return found.union(loops.join(found, "vertex", "left_anti").select("vertex", F.col("vertex").alias("component")))


def _contracted(edges: DataFrame) -> DataFrame:
    """Stars of the components, by rounds until nothing changes."""
    global last_rounds
    now, before = _state(edges), None
    for last_rounds in range(MAX_ROUNDS):  # noqa: B007
        if now == before or not now[1]:
            return edges
        hub = max(HUB, -(-2 * now[1] // MOST_HUBS))
        hub = hub if now[0] >= hub else None
        contracted = materialise(_small_star(_large_star(edges, hub), hub).where("u <> v").distinct())
        discard(edges)
        edges = contracted
        now, before = _state(edges), now
    raise RuntimeError(f"no fixpoint after {MAX_ROUNDS} rounds")
