"""JSON-array documents (the S3 input format) written from a table.

``read_documents`` reads such files whole, one row per array element.  This
module produces them from any DataFrame so that S3 runs over the given tables:
each task writes one file holding one JSON array of its rows.  The array is
streamed out line by line (``[`` before the first record, ``,`` before the
others, ``]`` at the end), so no task builds a document-sized value, and no
group or partition is gathered anywhere.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The Arrow function runs in Python workers; ship this module by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def array_lines(batches):
    """``mapInArrow`` body: one task's JSON records -> the lines of one array."""
    import pyarrow as pa
    import pyarrow.compute as pc

    opened = False
    empty = pa.scalar("")
    for b in batches:
        if not b.num_rows:
            continue
        recs = b.column(0)
        lead = pc.binary_join_element_wise(pa.scalar(","), recs, empty)
        if not opened:
            first = pc.binary_join_element_wise(pa.scalar("["), recs.slice(0, 1), empty)
            lead = pa.concat_arrays([first, lead.slice(1)])
            opened = True
        yield pa.RecordBatch.from_arrays([lead], names=["value"])
    if opened:
        yield pa.RecordBatch.from_arrays([pa.array(["]"])], names=["value"])


def write_documents(df: DataFrame, path: str, pretty: bool = False) -> None:
    """Write ``df`` as JSON-array documents under ``path``: one file per task,
    each a JSON array of that task's rows as objects (NULL fields omitted), each on
    a line of its own or, if ``pretty``, over several."""
    recs = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"pretty": str(pretty).lower()}).alias("value"))
    recs.mapInArrow(array_lines, "value string").write.text(path)
