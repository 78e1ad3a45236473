"""Selectors given as text, run over a table of pages.

All selectors of a page share one pass over its tags.  Pages stay in the task that reads them, and only what the
selectors ask for leaves it.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dom
from .sizing import spread

# Tasks get the helper with the job; nothing has to be installed on executors.
cloudpickle.register_pickle_by_value(dom)

TEXTS = T.ArrayType(T.StringType())


@dataclass(frozen=True)
class Each:
    """One entry per element that ``at`` finds, with the texts of each field inside it.

    ``at`` and the fields are selectors or chains of them, each searched within what the one before found.
    """
    at: str | tuple[str, ...]
    fields: dict[str, str | tuple[str, ...]]


def select_fields(pages: DataFrame, fields: dict, keep: tuple[str, ...], html: str = "html") -> DataFrame:
    """``keep`` and, for each field, what its selector finds in the page, in document order and as written.

    A field is a selector, a chain of selectors, or ``Each``.  The first two give an array of the text nodes or
    attribute values found, ``Each`` an array of structs of such arrays.  Entities are not decoded.  A null
    page has empty arrays.  One row out per row in; no shuffle (but see ``spread``).  Field names must differ
    from the kept ones.
    """
    plan = {}
    schema = T.StructType(spread(pages).select(*keep).schema.fields)
    for name, spec in fields.items():
        if name in keep:
            raise ValueError(f"field {name!r} has the name of a kept column")
        if isinstance(spec, Each):
            plan[name] = (dom.compiled(spec.at), {k: dom.compiled(v) for k, v in spec.fields.items()})
            schema.add(name, T.ArrayType(T.StructType([T.StructField(k, TEXTS) for k in spec.fields])))
        else:
            plan[name] = (dom.compiled(spec), None)
            schema.add(name, TEXTS)
    texts = pa.list_(pa.string())
    kinds = {n: texts if inner is None else pa.list_(pa.struct([(k, texts) for k in inner])) for n, (_, inner) in plan.items()}

    def run(batches):
        for batch in batches:
            found = {name: [] for name in plan}
            for html_text in batch.column(batch.num_columns - 1):
                page = dom.Page(html_text.as_py())
                for name, (chain, inner) in plan.items():
                    found[name].append(page.values(chain) if inner is None else [
                        {k: page.values(c, i) for k, c in inner.items()} for i in page.select(chain)])
            columns = batch.columns[:-1] + [pa.array(found[n], kinds[n]) for n in plan]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], *plan])

    return spread(pages).select(*keep, F.col(html).alias("_html")).mapInArrow(run, schema)
