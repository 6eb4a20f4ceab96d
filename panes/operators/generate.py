"""User-defined generators (U2): a function that gives 0 to n rows for each row.

The function is a table function of its own, which says what columns it gives from
the arguments it is called with (``analyze``), and is joined laterally: each row
with what the function gives for it.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def generator(function: Callable[..., Iterable[tuple]], columns: Callable[[list[AnalyzeArgument]], StructType]):
    """A table function from ``function(*arguments)``, which gives tuples, and
    ``columns(arguments)``, which gives their names and types when a query is planned."""
    class Generated:
        @staticmethod
        def analyze(*arguments: AnalyzeArgument) -> AnalyzeResult:
            return AnalyzeResult(columns(list(arguments)))

        def eval(self, *arguments):
            yield from function(*arguments)

    return F.udtf(Generated, useArrow=True)


def flat_map(df: DataFrame, table_function, *arguments: Column | str, outer: bool = False) -> DataFrame:
    """The rows of ``df``, each with every row ``table_function`` gives for it; ``outer``
    keeps a row that it gives none for, with NULLs."""
    columns = [(F.col(a) if isinstance(a, str) else a).outer() for a in arguments]
    return df.lateralJoin(table_function(*columns), F.lit(True), "left") if outer else df.lateralJoin(table_function(*columns))


def _elements(line):
    import json

    for i, x in enumerate(json.loads(line)):
        yield i, x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)


def _element_columns(arguments: list[AnalyzeArgument]) -> StructType:
    if len(arguments) != 1 or arguments[0].dataType != StringType():
        raise ValueError("give one text: a JSON array")
    return StructType([StructField("pos", IntegerType()), StructField("element", StringType())])


#: The elements of a JSON array line: ``pos`` and ``element`` (texts as they are, the rest as JSON).
json_elements = generator(_elements, _element_columns)
