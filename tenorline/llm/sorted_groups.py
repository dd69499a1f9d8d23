"""Groups out of partitions that are already sorted by a key (inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table per run of equal ``keys``.

    Only the run that a batch ends in is carried on, so memory follows the largest group;
    callers bound the size of their groups by the key itself.
    """
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = None
        for key in keys:
            c = batch.column(batch.schema.get_field_index(key))
            differs = pc.not_equal(c.slice(1), c.slice(0, len(c) - 1))
            changed = differs if changed is None else pc.or_(changed, differs)
        starts = [0] + [int(i) + 1 for i in pc.indices_nonzero(changed)] + [batch.num_rows]
        if rest:
            last = rest[-1]
            if any(last.column(k)[last.num_rows - 1].as_py() != batch.column(k)[0].as_py() for k in keys):
                yield pa.Table.from_batches(rest)
                rest = []
        for a, b in zip(starts, starts[1:]):
            rest.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(rest)
                rest = []
    if rest:
        yield pa.Table.from_batches(rest)
