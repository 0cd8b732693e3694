"""Column expressions on arrays of structs that hold arrays of structs.

Everything here compiles to Catalyst higher-order functions: no Python runs in the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """A top-level column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def nested_ids(array: str, id_field: str) -> Column:
    """The id of every element of ``array``, in order; a null array gives null."""
    return column(array).getField(id_field)


def id_set(array: str, id_field: str) -> Column:
    """The distinct ids of ``array``, sorted, so that equal sets are equal arrays; never null."""
    ids = F.array_distinct(nested_ids(array, id_field))
    return F.coalesce(F.sort_array(ids), F.array())


def lookup_or_default(value: Column, default: str) -> Column:
    """``value``, or ``default`` where it is missing or null."""
    return F.coalesce(value, F.lit(default))


def add_nested_field(
    array: str,
    inner: str,
    field: str,
    names: Column,
    value: Callable[[Column], Column],
) -> Column:
    """``array`` with ``field`` set in every struct of every ``inner`` array.

    ``names`` holds one entry per outer element, so each is looked up once however many inner
    elements receive it. Null and empty arrays stay as they are.
    """

    def outer(element: Column, name: Column) -> Column:
        written = value(name)
        return element.withField(
            inner,
            F.transform(element.getField(inner), lambda item: item.withField(field, written)),
        )

    return F.zip_with(column(array), names, outer)


def inner_counts(array: str, inner: str) -> Column:
    """The number of inner elements under every outer element."""
    return F.transform(
        column(array), lambda element: F.coalesce(F.array_size(element.getField(inner)), F.lit(0))
    )


def array_total(counts: Column) -> Column:
    """The sum of an array of counts as a long; null and empty arrays give 0."""
    return F.coalesce(
        F.aggregate(counts, F.lit(0).cast("long"), lambda total, n: total + n), F.lit(0)
    )
