"""Approximate nearest neighbours by largest inner product, with an adaptive dimension scan.

Equal vectors are one entry that keeps its smallest ids, as many as a result can use.  A
k-means on a bounded sample gives the lists; every vector is placed in the list of its nearest
centre, and a query probes the lists whose centres have the largest product with it.  The
number of probed lists is the smallest that finds ``TARGET`` of the true neighbours of sample
queries; a query whose lists hold fewer candidates than a result can use goes on to its next lists.  Long lists are dealt into chunks, so no task gets a whole hot list.

Within a list vectors are rotated at random and scanned in column blocks.  A query starts
with a bound, its k-th best product with the sample's vectors in its lists.  After each block, the part of the product still missing is, by the rotation, spread around 0 with
deviation ``|rest of q| |rest of x| / sqrt(dimensions left)``.  A candidate whose partial product
plus ``EPSILON`` deviations is below the query's current bound is abandoned.  Survivors are
scored in double precision on the original vectors.

Vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part.  Ties go to the smaller id.  An id that repeats counts once for
each distinct vector.  Other columns are ignored.  Without vectors the result is empty.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import fit_in_task
from tidewell.session import materialize

SAMPLE_VECTORS = 20_000
LIST_SIZE = 256
MAX_LISTS = 2048
TARGET = 0.97
EPSILON = 4.0
COLUMNS = 16
CHUNK = 4096
# Candidates of a slice, and the share of live pairs from which a block is one matrix product.
SLICE = 512
DENSE = 0.1
# Bytes of sample vectors that give the first bounds.
FLOOR_BYTES = 32 << 20
SLACK = 1e-6
HELD = 50_000


def _vectors(column: pa.ListArray, dim: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the vectors that take part."""
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(sizes == dim)
    # a null component becomes NaN; -0 becomes 0
    x = column.take(pa.array(places)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    x = x.reshape(len(places), dim).astype(kind) + np.zeros(1, kind)
    good = np.isfinite(x).all(axis=1) & x.any(axis=1)
    return places[good], x[good]


def _hashed(vectors: DataFrame, dim: int, kind: str) -> DataFrame:
    """``id``, ``same`` (a hash of the vector) and ``vec`` (its bytes)."""
    def run(batches):
        for batch in batches:
            places, x = _vectors(batch.column(1), dim, kind)
            data = [r.tobytes() for r in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(places)), pa.array([xxhash.xxh3_128_digest(d) for d in data], pa.binary()),
                 pa.array(data, pa.binary())], names=["id", "same", "vec"])

    return vectors.mapInArrow(run, "id bigint, same binary, vec binary")


def _distinct(hashed: DataFrame, every: int, keep: int) -> DataFrame:
    """One row for each distinct vector: ``rep`` (smallest id), ``vec``, ``ids`` (the smallest
    ``keep``) and ``asked``, whether a query has it.  Tasks reduce their rows first."""
    def run(batches):
        held: dict[bytes, list] = {}

        def flush():
            rows = [(k, v, sorted(-i for i in ids), a) for k, (v, ids, a) in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.bool_())],
                names=["same", "vec", "ids", "asked"])

        for batch in batches:
            for i, same, vec in zip(*[c.to_pylist() for c in batch.columns]):
                entry = held.setdefault(same, [vec, [], False])
                entry[2] = entry[2] or i % every == 0
                if -i not in entry[1]:
                    (heapq.heappush if len(entry[1]) < keep else heapq.heappushpop)(entry[1], -i)
            if len(held) >= HELD:
                yield flush()
        yield flush()

    part = hashed.mapInArrow(run, "same binary, vec binary, ids array<bigint>, asked boolean")
    merged = part.groupBy("same").agg(F.first("vec").alias("vec"), F.max("asked").alias("asked"),
                                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"))
    return merged.select(F.col("ids")[0].alias("rep"), "same", "vec",
                         F.slice("ids", 1, keep).alias("ids"), "asked")


def fit_lists(data: list[bytes], dim: int, total: int, k: int, kind: str = "<f4",
              max_lists: int = MAX_LISTS) -> dict:
    """Centres, the rotation, and the number of lists to probe."""
    x = np.frombuffer(b"".join(data), kind).reshape(-1, dim).astype(float)
    rng = np.random.default_rng(3)
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    lists = max(1, min(max_lists, total // LIST_SIZE, len(x)))
    centres = x[rng.choice(len(x), lists, replace=False)]

    def nearest(c):
        out = np.empty(len(x), np.int64)
        for s in range(0, len(x), 4096):
            out[s:s + 4096] = np.argmax(x[s:s + 4096] @ c.T - 0.5 * (c * c).sum(axis=1), axis=1)
        return out

    for _ in range(8):
        owner = nearest(centres)
        count = np.bincount(owner, minlength=lists)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, x)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    owner = nearest(centres)
    asked = rng.choice(len(x), min(300, len(x)), replace=False)
    products = x[asked] @ x.T
    products[np.arange(len(asked)), asked] = -np.inf
    top = np.argsort(-products, axis=1, kind="stable")[:, :min(k, max(1, len(x) - 1))]
    place = np.argsort(np.argsort(-(x[asked] @ centres.T), axis=1, kind="stable"), axis=1)
    needed = np.take_along_axis(place, owner[top], axis=1) + 1
    share = [(needed <= p).mean() for p in range(1, lists + 1)]
    probes = next((p for p, s in enumerate(share, 1) if s >= TARGET), lists)
    kept = rng.permutation(len(x))[:max(k, FLOOR_BYTES // (4 * dim))]
    return {"centres": centres, "rotation": rotation, "probes": probes, "dim": dim,
            "sample": x[kept].astype(kind), "owner": owner[kept]}


def floors(q: np.ndarray, probes: np.ndarray, model: dict, k: int) -> np.ndarray:
    """For each query a score that ``k`` candidates of its probed lists reach: the k-th best
    product with the sample's vectors in those lists."""
    sample, owner = model["sample"].astype(float), model["owner"]
    out = np.full(len(q), -np.inf)
    if len(sample) < k:
        return out
    slack = SLACK * np.sqrt((sample ** 2).sum(axis=1).max())
    for s in range(0, len(q), 256):
        products = q[s:s + 256] @ sample.T
        probed = np.zeros((len(products), len(model["centres"])), bool)
        np.put_along_axis(probed, probes[s:s + 256], True, axis=1)
        products[~probed[:, owner]] = -np.inf
        out[s:s + 256] = np.partition(products, -k, axis=1)[:, -k]
    return out - slack * np.sqrt((q ** 2).sum(axis=1))


def scan(q: np.ndarray, x: np.ndarray, rotation: np.ndarray, k: int,
         floor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places and exact scores of its ``k`` best candidates, unordered;
    candidates below the query's ``floor`` are left out.

    Candidates come in slices; the bound of a query is its k-th best score so far, at least its
    floor.  While many pairs of a slice are alive, a block is one matrix product for all of
    them; afterwards only the pairs that are left are computed.
    """
    dim = q.shape[1]
    rq, rx = q @ rotation, x @ rotation
    rest_q = np.sqrt(np.maximum(np.cumsum((rq ** 2)[:, ::-1], axis=1)[:, ::-1], 0))
    rest_x = np.sqrt(np.maximum(np.cumsum((rx ** 2)[:, ::-1], axis=1)[:, ::-1], 0))
    best = np.repeat(floor[:, None], k, axis=1)
    found: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, len(x), SLICE):
        end = min(begin + SLICE, len(x))
        bound = best.min(axis=1)
        partial, first = np.zeros((len(q), end - begin)), 0
        while True:
            last = min(first + COLUMNS, dim)
            partial += rq[:, first:last] @ rx[begin:end, first:last].T
            first = last
            if first == dim:
                alive = partial >= (bound - SLACK * rest_q[:, 0] * rest_x[:, 0].max())[:, None]
                break
            alive = partial >= bound[:, None] - _reach(
                rest_q[:, first, None], rest_x[None, begin:end, first], dim - first)
            if np.count_nonzero(alive) < alive.size * DENSE:
                break
        row, col = np.nonzero(alive)
        value, col = partial[row, col], col + begin
        while first < dim:
            last = min(first + COLUMNS, dim)
            value = value + np.einsum("ij,ij->i", rq[row, first:last], rx[col, first:last])
            if last < dim:
                going = value + _reach(rest_q[row, last], rest_x[col, last], dim - last) >= bound[row]
                row, col, value = row[going], col[going], value[going]
            first = last
        exact = np.einsum("ij,ij->i", q[row], x[col])
        good = exact >= bound[row]
        row, col, exact = row[good], col[good], exact[good]
        found.append((row, col, exact))
        if end < len(x):
            hit, at = np.unique(row, return_inverse=True)
            place = np.arange(len(row)) - np.searchsorted(row, row)  # rows come in order
            fresh = np.full((len(hit), place.max(initial=-1) + 1), -np.inf)
            fresh[at, place] = exact
            best[hit] = np.partition(np.hstack([best[hit], fresh]), -k, axis=1)[:, -k:]
    row, col, exact = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(row, kind="stable")
    cuts = np.searchsorted(row[order], np.arange(1, len(q)))
    return list(zip(np.split(col[order], cuts), np.split(exact[order], cuts)))


def _reach(a, b, left: int):
    """What the missing columns may add; never more than the product of the lengths."""
    return a * b * min(1.0, EPSILON / math.sqrt(left)) + SLACK * a * b


def nearest_neighbours(vectors: DataFrame, *, id_column: str = "vec_id", vector: str = "embedding",
                       every: int = 20, k: int = 20, sample_vectors: int = SAMPLE_VECTORS,
                       max_lists: int = MAX_LISTS) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest found of each query.

    Queries are the rows whose id ``every`` divides; candidates are all other rows.  Components that are
    floats are kept as such, all others as doubles.  Lists are fitted on about ``sample_vectors`` vectors;
    there are at most ``max_lists`` of them, about ``LIST_SIZE`` vectors each below that: raise both for tables of
    more than a million vectors.
    """
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    spark, keep = vectors.sparkSession, k + 1
    table = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).alias("v")).filter(
        "id is not null")
    sizes = table.filter("v is not null").groupBy(F.size("v").alias("n")).count().orderBy(
        F.desc("count"), "n").first()
    if sizes is None or sizes[0] < 1:
        return spark.createDataFrame([], empty)
    dim = sizes[0]
    kind = "<f4" if dict(vectors.dtypes)[vector] == "array<float>" else "<f8"
    entries = materialize(_distinct(_hashed(table, dim, kind), every, keep), "vectors")
    total = entries.count()
    if total == 0:
        return spark.createDataFrame([], empty)
    share = min(1 << 30, int(sample_vectors / total * (1 << 30)))
    sample = entries.filter(F.pmod(F.xxhash64("same"), F.lit(1 << 30)) < share).limit(2 * sample_vectors)
    if total <= 1000:
        sample = entries
    model = fit_in_task(sample.select("vec"), lambda rows: fit_lists(
        rows["vec"].to_pylist(), dim, total, k, kind, max_lists))
    shared = spark.sparkContext.broadcast(model)  # at most MAX_LISTS centres and FLOOR_BYTES

    def lists(batches, asked, held=None):
        m = shared.value
        c = m["centres"]
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), kind).reshape(-1, dim).astype(float)
            if asked:
                found = np.argsort(-(x @ c.T), axis=1, kind="stable")
                short = (np.cumsum(held[found], axis=1) < keep).sum(axis=1) + 1
                wanted = np.minimum(np.maximum(short, m["probes"]), len(c))
                taken = np.arange(len(c)) < wanted[:, None]
            else:
                found = np.argmax(x @ c.T - 0.5 * (c * c).sum(axis=1), axis=1)[:, None]
                taken = np.ones(found.shape, bool)
            owner = pa.array(np.repeat(np.arange(len(x)), taken.sum(axis=1)))
            names, columns = batch.schema.names, batch.columns
            if asked:
                probed = np.where(taken, found, found[:, :1])[:, :wanted.max(initial=1)]
                names, columns = [*names, "floor"], [*columns, pa.array(floors(x, probed, m, keep))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[taken], pa.int32()), *[col.take(owner) for col in columns]],
                names=["list", *names])

    placed = materialize(entries.select("rep", "vec", "ids").mapInArrow(
        lambda b: lists(b, False), "list int, rep bigint, vec binary, ids array<bigint>"), "lists")
    ids_held = np.zeros(len(model["centres"]), np.int64)
    for r in placed.groupBy("list").agg(F.sum(F.size("ids"))).collect():  # at most MAX_LISTS rows
        ids_held[r[0]] = r[1]
    probes = materialize(entries.filter("asked").select("rep", "vec").mapInArrow(
        lambda b: lists(b, True, ids_held), "list int, rep bigint, vec binary, floor double"), "probes")

    def split(rows: DataFrame):
        """Into how many parts of about ``CHUNK`` rows each list is dealt, as a literal array."""
        counts = dict(rows.groupBy("list").count().collect())  # at most MAX_LISTS rows
        parts = [-(-counts.get(i, 0) // CHUNK) or 1 for i in range(len(model["centres"]))]
        return F.array(*[F.lit(p) for p in parts])[F.col("list")], max(parts)

    (chunks, most), (sides, widest) = split(placed), split(probes)
    several = lambda parts, more: F.explode(F.sequence(F.lit(0), parts - 1)) if more > 1 else F.lit(0)
    probes = probes.withColumn("side", F.pmod(F.xxhash64("rep"), sides).cast("int")).select(
        "list", several(chunks, most).alias("chunk"), "side", "rep", "vec", "floor")
    base = placed.withColumn("chunk", F.pmod(F.xxhash64("rep"), chunks).cast("int")).select(
        "list", "chunk", several(sides, widest).alias("side"), "rep", "vec", "ids")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            left = left.sort_by("rep")
            x, q = [np.frombuffer(b"".join(t["vec"].to_pylist()), kind).reshape(-1, dim).astype(float)
                    for t in (left, right)]
            ids, reps = left["ids"].to_pylist(), right["rep"].to_pylist()
            floor = right["floor"].to_numpy()
            for start in range(0, len(q), 512):
                stop = start + 512
                found = scan(q[start:stop], x, shared.value["rotation"], keep, floor[start:stop])
                for rep, (where, scores) in zip(reps[start:stop], found):
                    if not len(where):
                        continue
                    rows = sorted((-s, i) for w, s in zip(where, scores.tolist()) for i in ids[w])[:keep]
                    out[0].append(rep)
                    out[1].append([-s for s, _ in rows])
                    out[2].append([i for _, i in rows])
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.float64())),
                         pa.array(out[2], pa.list_(pa.int64()))], names=["rep", "scores", "ids"])

    parts = base.groupBy("list", "chunk", "side").cogroup(probes.groupBy("list", "chunk", "side")).applyInArrow(
        meet, "rep bigint, scores array<double>, ids array<bigint>")
    # A query has at most probes * chunks rows of keep neighbours.
    best = parts.withColumn("near", F.arrays_zip((F.transform("scores", lambda s: -s)).alias("worse"), "ids")) \
        .select("rep", F.transform("near", lambda n: F.struct(n["worse"].alias("worse"), n["ids"].alias("id"))).alias("near")) \
        .groupBy("rep").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, keep).alias("near"))
    queries = (_hashed(table.filter(F.col("id") % every == 0), dim, kind).select("id", "same").distinct()
               .join(entries.select("same", "rep"), "same").join(best, "rep"))
    return (queries.select(F.col("id").alias("query_id"), F.posexplode(F.slice(F.filter(
        "near", lambda n: n["id"] != F.col("id")), 1, k)))
        .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("col.id").alias("vec_id"),
                (-F.col("col.worse")).alias("score")))
