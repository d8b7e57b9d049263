"""What the text operators share: folds, bounded samples, fitting in one task, hashing."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.joins import sized_for_broadcast

# Distinct words whose values a task remembers before it starts afresh.
MEMO_ENTRIES = 300_000


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts


def most_rows(per_stratum: int) -> int:
    """The bound of a sample that aims at so many rows of a value."""
    return int(1.1 * per_stratum) + 100


def bounded_sample(df: DataFrame, key: str, stratum: str, per_stratum: int) -> DataFrame:
    """About ``per_stratum`` distinct rows of each value of ``stratum``, chosen by a hash of ``key``.

    The choice depends on the key alone, so a retried task finds the same rows.  All values
    are sampled in one pass, by the share that each one's count asks for.  Rows whose value
    is null are left out.
    """
    shares = (df.filter(F.col(stratum).isNotNull()).groupBy(stratum)
              .agg((F.least(F.lit(per_stratum) / F.count(F.lit(1)), F.lit(1.0)) * (1 << 30))
                   .cast("bigint").alias("__share")))
    place = F.pmod(F.xxhash64(F.lit(7), F.col(key)), F.lit(1 << 30))
    return (df.join(sized_for_broadcast(shares), stratum).filter(place < F.col("__share"))
            .select(*df.columns).distinct())


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                    parts: int, held_out: int) -> DataFrame:
    """(doc_id, text, label) of a bounded sample of labelled rows outside the held-out fold.

    Ids are sampled before any text is read; the join broadcasts only those ids, whose
    number ``per_class`` bounds but for the chance of the hash.  Of an id that has many rows, so many texts go in that the
    whole stays within the bound of both classes.
    """
    ids = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
           .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()
                   & (fold("doc_id", parts) != held_out)).distinct())
    ids = bounded_sample(ids, "doc_id", "label", per_class)
    return (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .limit(2 * most_rows(per_class)))


def fit_in_task(sample: DataFrame, fit: Callable[[pa.Table], object]) -> object:
    """Run ``fit`` over a bounded sample in one task; the driver gets the small model.

    Rows reach ``fit`` in the order of their columns, so the model does not depend on
    the order in which tasks finish.
    """
    kinds = {f.name: f.dataType.simpleString() for f in sample.schema.fields}
    kinds = {name: kind if kind in ("string", "binary") else "bigint" for name, kind in kinds.items()}
    arrow = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}
    schema = pa.schema([pa.field(name, arrow[kind]) for name, kind in kinds.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [pa.Table.from_batches([b]).cast(schema) for b in batches]
        rows = pa.concat_tables(found) if found else schema.empty_table()
        rows = rows.sort_by([(name, "ascending") for name in rows.column_names])
        model = pickle.dumps(fit(rows))
        yield pa.RecordBatch.from_pydict({"model": pa.array([model], pa.binary())})

    typed = sample.select(*[F.col(name).cast(kind) for name, kind in kinds.items()])
    row = typed.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(row[0]) if row else fit(schema.empty_table())  # no task without rows


def map_documents(docs: DataFrame, columns: list[str], schema: str,
                  make: Callable[[], Callable[..., Iterable[tuple]]]) -> DataFrame:
    """One pass over ``columns`` of ``docs`` in Arrow batches.

    ``make()`` runs once in each task and returns a function that takes the columns of a
    batch as lists and gives the result rows as tuples.
    """
    spark = docs.sparkSession
    fields = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                rows = list(work(*[c.to_pylist() for c in part.columns]))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return docs.select(*columns).mapInArrow(run, fields)


def text_pieces(batch: pa.RecordBatch, column: str, piece_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``piece_bytes``; a longer text is a slice by itself."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        before = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + piece_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to


class Memo(dict):
    """Values of words, computed at first use; starts afresh at ``MEMO_ENTRIES``."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        value = self[word] = self.make(word)
        return value


def word_hash(word: bytes) -> int:
    """An unsigned 64-bit hash of a word."""
    return xxhash.xxh3_64_intdigest(word)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of unsigned 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def words_of(text: str | None) -> list[bytes]:
    """A-Z in lower case, cut at ASCII white space; other letters stay as they are."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Words are hashed by a polynomial over random values of their bytes, for all words at once:
# prefix sums of value * R**place, brought back to place 0 by the inverse of R.
_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(41).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_HASHED_BYTES = 1 << 20


def _powers(factor: int, n: int) -> np.ndarray:
    steps = np.full(n, factor, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def hash_words(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one after the other, and words of each text.

    Words lie between ASCII white space, A-Z counts as a-z, null as empty.
    """
    data = [t.encode("utf-8", "replace").lower() if t else b"" for t in texts]
    found, sizes, at = [], [], 0
    while at < len(data):
        stop, size = at, 0
        while stop < len(data) and (stop == at or size + len(data[stop]) <= _HASHED_BYTES):
            size += len(data[stop]) + 1
            stop += 1
        raw = np.frombuffer(b"\n" + b"\n".join(data[at:stop]) + b"\n", np.uint8)
        space = _SPACE[raw]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        begin, end = edge[::2], edge[1::2]
        if len(_POWERS[0]) < len(raw):
            _POWERS[:] = _powers(_R, len(raw) * 2), _powers(_R_INVERSE, len(raw) * 2)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[raw] * _POWERS[0][:len(raw)], out=total[1:])
        found.append(mix64((total[end] - total[begin]) * _POWERS[1][begin]
                           + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        first = np.cumsum([1] + [len(d) + 1 for d in data[at:stop]])
        sizes.append(np.diff(np.searchsorted(begin, first)))
        at = stop
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(sizes)


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
