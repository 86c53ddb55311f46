"""User functions from a row to any number of rows, as table functions of SQL.

A function gives a list of values for a value; its bound arguments are constants of the call. Rows come out with
the place of each value in its list, under the column name and type that the call asks for::

    flat_map(spark, "lines", split_lines)
    SELECT d.doc_id, p.place, p.text FROM documents d, LATERAL lines(d.text, named_struct('low', 62, 'high', 126), 'text string') p

A function over groups gets a table ``PARTITION BY`` the group's columns and ``ORDER BY`` others, and adds columns to its rows; it
holds no rows::

    batches(spark)
    SELECT * FROM batches(TABLE(documents) PARTITION BY lang ORDER BY (doc_id), 28)
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


#: Types that a call may name.
KINDS = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
         "boolean": T.BooleanType(), "array<string>": T.ArrayType(T.StringType()), "array<int>": T.ArrayType(T.IntegerType())}


def flat_map(spark: SparkSession, name: str, function: Callable[..., Iterable]) -> None:
    """Register ``function(value, **arguments)`` as the table function ``name(value, arguments, column)``.

    ``column`` is a constant such as ``'text string'``: what the values are called and of which type. ``arguments`` is a
    struct of constants, or null. A null value, and a function that gives none, give no rows.
    """
    class FlatMap:
        @staticmethod
        def analyze(value: AnalyzeArgument, arguments: AnalyzeArgument, column: AnalyzeArgument) -> AnalyzeResult:
            if not column.isConstantExpression or not isinstance(column.value, str):
                raise ValueError("the column must be a constant such as 'text string'")
            if not (isinstance(arguments.dataType, (T.StructType, T.NullType))):
                raise ValueError("the arguments must be a struct or null")
            column_name, _, kind = column.value.strip().rpartition(" ")
            if not column_name or kind not in KINDS:
                raise ValueError(f"not a name and one of {', '.join(KINDS)}: {column.value}")
            return AnalyzeResult(T.StructType([T.StructField("place", T.IntegerType()),
                                               T.StructField(column_name.strip(), KINDS[kind])]))

        def eval(self, value, arguments, column):
            if value is not None:
                yield from enumerate(function(value, **(arguments.asDict() if arguments is not None else {})))

    spark.udtf.register(name, udtf(FlatMap))


def batches(spark: SparkSession, name: str = "batches") -> None:
    """Register ``name(TABLE(t) PARTITION BY ... ORDER BY ..., size)``: the rows with ``batch_id`` and ``place``, counted by group."""
    class Batches:
        def __init__(self) -> None:
            self.seen = 0

        @staticmethod
        def analyze(row: AnalyzeArgument, size: AnalyzeArgument) -> AnalyzeResult:
            if not row.isTable:
                raise ValueError("the first argument must be a table")
            if not size.isConstantExpression or not isinstance(size.value, int) or size.value < 1:
                raise ValueError("the size must be a constant above 0")
            return AnalyzeResult(T.StructType([*row.dataType.fields, T.StructField("batch_id", T.LongType()),
                                               T.StructField("place", T.IntegerType())]))

        def eval(self, row, size):
            yield (*row, self.seen // size, self.seen % size)
            self.seen += 1

    spark.udtf.register(name, udtf(Batches))
