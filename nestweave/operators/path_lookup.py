"""Lookups of ids at any depth of a document, written wherever a path says.

The strategies are those of :mod:`nestweave.operators.lookup`: a small dimension travels with the tasks and documents
are not shuffled; for a larger one the sets of ids meet the dimension and come back as one map per set.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestweave.functions.nested import column, lookup_or_default
from nestweave.functions.paths import values_at, with_value
from nestweave.operators.dimension import find_in_table, lookup_table
from nestweave.operators.lookup import NOT_FOUND, attach_maps, choose, entries_of, stored
from nestweave.operators.spread import HotKeys


@dataclass(frozen=True)
class PathDomain:
    """One lookup: the ids at ``id_path`` in ``dimension``, their names written at ``out_path``.

    ``id_path`` but for its last field must be a beginning of ``out_path`` (:func:`nestweave.functions.paths.with_value`).
    ``dimension`` has one name per ``dim_id``; more are an error.
    """

    id_path: str
    out_path: str
    dimension: DataFrame
    dim_id: str
    dim_name: str
    default: str = NOT_FOUND
    computed: bool = False

    @property
    def array(self) -> str:
        return self.id_path

    def entries(self) -> DataFrame:
        return entries_of(self)

    def stored(self) -> PathDomain:
        return stored(self)

    def id_set(self) -> Column:
        """The distinct ids of a document, sorted; never null."""
        return F.sort_array(F.array_distinct(values_at(self.id_path)))


def enrich_paths(
    docs: DataFrame, domains: Sequence[PathDomain], strategy: str = "auto", hot_keys: HotKeys | None = HotKeys()
) -> DataFrame:
    """``docs`` with the names of all ``domains`` written in, one after the other; every other column is untouched."""
    columns = [column(c) for c in docs.columns]
    domains = [d.stored() for d in domains]
    for d in domains:
        have = docs.select(d.id_set().alias("ids")).schema["ids"].dataType.elementType
        want = d.dimension.schema[d.dim_id].dataType
        if have != want:
            raise TypeError(f"{d.id_path} is {have.simpleString()}, but {d.dim_id} of its dimension is {want.simpleString()}")
    in_memory = choose(domains, strategy)
    by_documents = [i for i in range(len(domains)) if i not in in_memory]
    work = attach_maps(docs, domains, by_documents, hot_keys) if by_documents else docs
    for i, buckets in in_memory.items():
        work = work.withColumn(f"_table_{i}", lookup_table(domains[i].entries(), "id", "name", buckets).scalar())
    for i, d in enumerate(domains):

        def name(key: Column, i: int = i, d: PathDomain = d) -> Column:
            found = find_in_table(F.col(f"_table_{i}"), key, in_memory[i]) if i in in_memory else F.element_at(F.col(f"_map_{i}"), key)
            return lookup_or_default(found, d.default)

        top, changed = with_value(d.out_path, d.id_path, name)
        work = work.withColumn(top, changed)
    return work.select(*columns)
