"""What several operators share: words, row keys, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crispstar.session import materialize

# A word is a longest run of other characters than these; bytes.split() cuts at the same ones.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def text_of(name: str | Column) -> Column:
    """The text with NULL as empty."""
    return F.coalesce(F.col(name) if isinstance(name, str) else name, F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sliced(batch: pa.RecordBatch, name: str, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``most`` bytes of a text column, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    first, size = 0, 0
    for i, n in enumerate(sizes.tolist(), 1):
        size += n
        if size >= most or i == batch.num_rows:
            yield batch.slice(first, i - first)
            first, size = i, 0


def raw(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes, NULL as empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def identified(df: DataFrame, id_col: str, key: str = "row_key") -> DataFrame:
    """``df`` with a long ``key`` that no two rows share.

    The id itself where it is unique and never NULL. Otherwise the rows are
    written once with a number each, because a number that is computed anew
    after a lost executor could differ.
    """
    taken = df.groupBy(F.col(id_col).alias("id")).count()
    if taken.filter(F.col("id").isNull() | (F.col("count") > 1)).isEmpty():
        return df.withColumn(key, F.col(id_col).cast("long"))
    return materialize(df.withColumn(key, F.monotonically_increasing_id()), "numbered")


def in_arrow(df: DataFrame, rows: Callable[[pa.RecordBatch], Iterable[tuple]], schema: str, chunk: int = 20_000) -> DataFrame:
    """``mapInArrow`` over a function that yields output rows for one input batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from batched(rows(batch), names, types, chunk)

    names, types = arrow_types(df, schema)
    return df.mapInArrow(run, schema)


def arrow_types(df: DataFrame, schema: str) -> tuple[list[str], list[pa.DataType]]:
    """Names and Arrow types of a Spark schema text."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema).fields
    return [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]


def batched(rows: Iterable[tuple], names: list[str], types: list[pa.DataType], chunk: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of at most ``chunk`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == chunk:
            yield _batch(held, names, types)
            held = []
    if held:
        yield _batch(held, names, types)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


class BoundedCache(dict):
    """Results by text key in two generations, so that what comes often outlasts what came once; long keys are not kept.

    ``cost`` is what a result holds beside its key. When keys and results hold over half of ``most`` bytes,
    they become the older generation and the older one goes; a result found there moves up again.
    Text without spaces is one long chunk a document, which will not come again.
    """

    def __init__(self, make: Callable, cost: Callable, most: int = 32 << 20, longest: int = 64):
        super().__init__()
        self.make, self.cost, self.most, self.longest, self.size = make, cost, most, longest, 0
        self.older: dict = {}

    def __missing__(self, key):
        made = self.older.pop(key, None)
        if made is None:
            made = self.make(key)
            if len(key) > self.longest:
                return made
        # An entry of a dictionary with its key costs about 150 bytes more than the key's text.
        held = 150 + len(key) + self.cost(made)
        self.size += held
        if 2 * self.size > self.most:
            self.older, self.size = dict(self), held
            self.clear()
        self[key] = made
        return made
