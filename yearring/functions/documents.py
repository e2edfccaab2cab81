"""JSON documents kept as text: parsed once into variants, read by typed paths, flattened into rows.

Text that is no JSON is treated as NULL: it has no fields and no elements, and :func:`document_quality` counts it.  A path that leads
nowhere, or to a value that does not fit the type asked for, gives NULL as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def document(text: str | Column) -> Column:
    """The text as a variant; NULL for NULL and for malformed text."""
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def field(doc: str | Column, path: str, kind: str = "string") -> Column:
    """Value at a path such as ``$.columns[0].name``, in the type ``kind``."""
    return F.try_variant_get(F.col(doc) if isinstance(doc, str) else doc, path, kind)


def typed(text: str | Column, ddl: str) -> Column:
    """A whole document in a declared type, for columns that are to be stored typed."""
    return F.try_variant_get(document(text), "$", ddl)


def flattened(df: DataFrame, text_column: str, fields: dict[str, tuple[str, str]], keep: list[str], as_text: tuple[str, ...] = ()) -> DataFrame:
    """One row per element of the array in ``text_column``: ``keep`` and the ``fields`` (name to path and type) of the element.

    Fields in ``as_text`` are JSON text of whatever lies at their path, with object keys in order.  Objects and single values are not
    arrays and give no rows.
    """
    spark = df.sparkSession
    # Columns of the exploded side have names of their own, so that they can't clash with the kept ones.
    documents = df.select(*keep, document(text_column).alias("_document"))
    elements = spark.tvf.variant_explode(F.col("_document").outer()).select(F.col("key").alias("_key"), F.col("value").alias("_element"))
    values = [
        (F.to_json(field("_element", path, "variant")) if name in as_text else field("_element", path, kind)).alias(name)
        for name, (path, kind) in fields.items()
    ]
    return documents.lateralJoin(elements).filter(F.col("_key").isNull()).select(*keep, *values)


def document_quality(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per text column: rows, NULLs, malformed texts, arrays with their elements, and other documents."""
    measures = []
    for c in columns:
        doc = document(c)
        elements = field(doc, "$", "array<variant>")
        some = doc.isNotNull()
        counts = {
            "row_count": F.lit(True),
            "null_texts": F.col(c).isNull(),
            "malformed": F.col(c).isNotNull() & ~some,
            "arrays": elements.isNotNull(),
            "others": some & elements.isNull(),
        }
        found = [F.count_if(v).alias(n) for n, v in counts.items()]
        total = F.coalesce(F.sum(F.size(elements)), F.lit(0)).alias("elements")
        measures.append(F.struct(F.lit(c).alias("column_name"), *found, total))
    return df.select(*columns).agg(F.array(*measures).alias("m")).select(F.inline("m"))


def document_shape(df: DataFrame, column: str) -> DataFrame:
    """The type that all documents of a column fit, as DDL: one row, merged from partial types."""
    return df.agg(F.schema_of_variant_agg(document(column)).alias("shape"))
