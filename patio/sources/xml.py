"""Report rows as XML.

Elements are made row by row and files are written in order, so no document and no group is
ever collected into one value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def element(tag: str, attributes: dict[str, Column]) -> Column:
    """An element with attributes; NULL ones are left out and text is escaped."""
    # Dates go in as text: inside a nested value they would come out as day numbers.
    fields = [value.cast("string").alias(f"_{name}") for name, value in attributes.items()]
    return F.to_xml(F.struct(*fields), {"rowTag": tag})


def to_xml_rows(df: DataFrame, row_tag: str, names: dict[str, str] | None = None) -> DataFrame:
    """One element per row, columns as attributes (renamed by `names`), as column `xml`."""
    names = names or {}
    return df.select(
        element(row_tag, {names.get(c, c): F.col(f"`{c}`") for c in df.columns}).alias("xml")
    )


def to_xml_nested(
    rows: DataFrame,
    opens: str,
    closes: str,
    parent_tag: str,
    child_tag: str,
    parent_attributes: dict[str, str],
    child_attributes: dict[str, str],
    order_parents: Sequence[str],
    order_children: Sequence[str],
    siblings: bool = False,
) -> DataFrame:
    """Parent elements with child elements as text lines with sortable keys, from one pass.

    Every row is a child that carries its parent's columns; `opens` and `closes` are true on the
    first and the last row of a parent. With `siblings` the children follow a closed parent
    element instead of sitting inside it. Sorting by the `o*` columns and writing `xml` gives the
    document body, however many children one parent has.
    """
    head = element(parent_tag, {a: F.col(c) for a, c in parent_attributes.items()})
    opening = head if siblings else F.regexp_replace(head, r"/>$", ">")
    child = element(child_tag, {a: F.col(c) for a, c in child_attributes.items()})

    def line(place: int, xml: Column) -> Column:
        own = [
            (F.col(c) if place == 1 else F.lit(None).cast(rows.schema[c].dataType)).alias(f"oc{i}")
            for i, c in enumerate(order_children)
        ]
        return F.struct(F.lit(place).alias("o_lugar"), *own, xml.alias("xml"))

    lines = [F.when(F.col(opens), line(0, opening)), line(1, child)]
    if not siblings:
        lines.append(F.when(F.col(closes), line(2, F.lit(f"</{parent_tag}>"))))
    parents = [F.col(c).alias(f"o{i}") for i, c in enumerate(order_parents)]
    return rows.select(*parents, F.inline(F.array_compact(F.array(*lines))))


def in_document_order(lines: DataFrame) -> DataFrame:
    """Global order by range partitioning; equal keys only occur for equal lines."""
    return lines.orderBy(*[c for c in lines.columns if c != "xml"]).select("xml")


def write_xml(lines: DataFrame, path: str, root_tag: str) -> None:
    """A folder whose files, in name order, make up one document; also for no rows."""
    spark = lines.sparkSession
    first = spark.range(1).select(F.lit(f"<{root_tag}>").alias("xml"))
    last = spark.range(1).select(F.lit(f"</{root_tag}>").alias("xml"))
    # A union keeps the partition order, so the root's two ends surround the sorted body.
    first.union(lines.select("xml")).union(last).write.mode("errorifexists").text(path)
