"""Helper inside tasks: lines of a split of a quoted CSV file to records."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc

FIELDS = pa.schema([("value", pa.string()), ("place", pa.string()), ("file", pa.string()), ("begins", pa.int64()),
                    ("block", pa.int64())])
ROW = "value string, place string, file string, begins long, block long"


def records(batches):
    """Lines ``value, file, block, begins``, splits in file order -> rows of ``FIELDS``.

    ``begins`` is null for a split that begins outside quotes, else the split where the record began that reaches
    into it.  A record is complete where it holds an even number of quotes.  ``place`` is ``first`` for the first
    of a file, ``whole`` for others, ``part`` for a part of a record that other splits hold the rest of, ``first part``
    for that of the first.  A part has the split where its record begins.  Blank records go.
    """
    at, held, begins, first = None, [], None, False

    def row(place):
        file, block = at
        return "\n".join(held), place, file, block if begins is None else begins, block

    def left_open():
        return [row("first part" if first else "part")] if held else []

    def batch_of(rows):
        return pa.RecordBatch.from_pydict({f.name: [r[i] for r in rows] for i, f in enumerate(FIELDS)}, FIELDS)

    for batch in batches:
        out = []
        odd = pc.bit_wise_and(pc.count_substring(batch.column(0), '"'), 1).to_pylist()
        for value, file, block, since, quote in zip(*[batch.column(i).to_pylist() for i in range(4)], odd):
            if (file, block) != at:
                out += left_open()
                at, held, begins, first = (file, block), [], since, block == 0
            inside = bool(held) or begins is not None
            held.append(value)
            if bool(quote) == inside:
                if begins is not None:
                    out.append(row("part"))
                elif any(h.strip() for h in held):
                    out.append(row("first" if first else "whole"))
                    first = False
                held, begins = [], None
        yield batch_of(out)
    yield batch_of(left_open())
