"""A user's own rule over sorted groups, streamed.

The rows are shuffled by key and sorted inside the partitions, where the sort
may spill; one Arrow iterator per partition then walks over them.  A group is
handed to the rule as an iterator of chunks and never held: a chunk is a run
of the group's rows inside one Arrow batch, and what the rule keeps between
chunks (its local variables) is the only state.  A group of any size passes
in the memory of one batch; it is walked by one task, since a rule of this
kind may depend on all rows before.  The built-in rules (`intervals`) do not
have that limit.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..schema import ENTER, EXIT

# Functions of this module travel to the workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A rule gets the key's values and the group's rows in order, as record
#: batches of the other columns, and yields output rows.
Rule = Callable[[tuple, Iterator[pa.RecordBatch]], Iterable[tuple]]
OUTPUT_ROWS = 8192


def _runs(batches: Iterable[pa.RecordBatch], width: int):
    """(key, rows) of the runs of equal values in the first `width` columns;
    a null equals a null."""
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.array([False] * (batch.num_rows - 1), pa.bool_())
        for i in range(width):
            a, b = batch.column(i).slice(0, batch.num_rows - 1), batch.column(i).slice(1)
            differs = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
            new = pc.or_(new, differs)
        starts = [0, *(i + 1 for i in pc.indices_nonzero(new).to_pylist()), batch.num_rows]
        rest = pa.RecordBatch.from_arrays(batch.columns[width:], names=batch.schema.names[width:])
        for start, stop in itertools.pairwise(starts):
            yield tuple(batch.column(i)[start].as_py() for i in range(width)), rest.slice(start, stop - start)


def apply_sorted(df: DataFrame, keys: list[str], order: list[str], rule: Rule, schema: str) -> DataFrame:
    """The rows that `rule` yields for each group of `keys`, whose rows it
    sees in the ascending order of `order` (nulls first), as `schema` (DDL)."""
    others = [c for c in df.columns if c not in keys]
    width, out = len(keys), to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        def rows():
            for key, chunks in itertools.groupby(_runs(batches, width), key=lambda x: x[0]):
                yield from rule(key, (chunk for _, chunk in chunks))

        produced = rows()
        while some := list(itertools.islice(produced, OUTPUT_ROWS)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*some), out.types)], schema=out)

    return (df.select(*keys, *others).repartition(*keys).sortWithinPartitions(*keys, *order)
            .mapInArrow(run, schema))


def robust_rule(key: tuple, chunks: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The robust pairing rule as a user would write it, over `times,
    register` rows: one open stay and one exit that waits for its next row."""
    opened = closing = None
    for chunk in chunks:
        for time, code in zip(chunk["times"].to_pylist(), chunk["register"].to_pylist()):
            if closing is not None and code == ENTER:
                yield (*key, opened, closing)
                opened = None
            closing = None
            if opened is None:
                opened = time if code == ENTER else None
            elif code == EXIT:
                closing = time
    if closing is not None:
        yield (*key, opened, closing)
