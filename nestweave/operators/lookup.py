"""Looks up the ids inside nested documents and writes the names found back into the nesting.

Two strategies give the same rows:

``in_memory``
    The dimension, measured to be small, becomes one bucketed map that travels with the tasks.
    The documents are read once and not shuffled at all.

``document_maps``
    For dimensions of any size. Only the sets of ids are joined to the dimension; what comes back
    is one small map per distinct set, and the documents are shuffled once to meet it. A map is
    never larger than the ids of one document.

``auto`` measures the dimensions and decides for each of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from nestweave.functions.nested import (
    add_nested_field,
    column,
    id_set,
    lookup_or_default,
    nested_ids,
)
from nestweave.operators.dimension import (
    buckets_for,
    dimension_sizes,
    find_in_table,
    lookup_table,
)
from nestweave.operators.metrics import metric_columns
from nestweave.operators.spread import (
    HotKeys,
    assign_piece,
    copy_to_pieces,
    join_pieces,
    row_salt,
)
from nestweave.session import shared_folder

NOT_FOUND = "NOT_FOUND"
STRATEGIES = ("auto", "in_memory", "document_maps")

# Largest dimension that may travel with the tasks.
IN_MEMORY_ROWS = 200_000
IN_MEMORY_BYTES = 16 << 20

_SET = "_id_set"
_SET_PIECE = "_id_set_piece"


@dataclass(frozen=True)
class Domain:
    """One lookup: ``array[].id_field`` in ``dimension``, written to ``array[].inner[].out_field``.

    ``dimension`` has one name per ``dim_id``; more are an error, whatever the strategy. With
    ``struct_field`` the name is written as a struct with that one field instead of a plain string.
    ``computed`` says that the dimension is costly to compute: it is written to the shared folder once,
    and measured and looked up there.
    """

    array: str
    id_field: str
    inner: str
    dimension: DataFrame
    dim_id: str
    dim_name: str
    default: str = NOT_FOUND
    out_field: str = "ENRICH"
    struct_field: str | None = None
    computed: bool = False

    def entries(self) -> DataFrame:
        return entries_of(self)

    def id_set(self) -> Column:
        return id_set(self.array, self.id_field)

    def stored(self) -> Domain:
        return stored(self)

    def value(self, name: Column) -> Column:
        """What is written into an inner struct for a name that was found or not."""
        found = lookup_or_default(name, self.default)
        return F.struct(found.alias(self.struct_field)) if self.struct_field else found


def entries_of(domain: Domain) -> DataFrame:
    """The dimension of a domain reduced to its ids and names."""
    rows = domain.dimension.select(column(domain.dim_id).alias("id"), column(domain.dim_name).alias("name"))
    return rows.where(F.col("id").isNotNull())


def stored(domain: Domain) -> Domain:
    """The same domain, its dimension written if it is ``computed``."""
    if not domain.computed:
        return domain
    folder = shared_folder(domain.dimension.sparkSession, "dimension")
    rows = domain.dimension.select(column(domain.dim_id), column(domain.dim_name))
    rows.write.option("compression", "zstd").parquet(folder)
    return replace(domain, dimension=rows.sparkSession.read.schema(rows.schema).parquet(folder), computed=False)


def enrich(
    docs: DataFrame,
    domains: Sequence[Domain],
    strategy: str = "auto",
    observation: Observation | None = None,
    hot_keys: HotKeys | None = HotKeys(),
) -> DataFrame:
    """``docs`` with the names of all ``domains`` written in; every other column is untouched.

    ``observation`` receives row, hit and miss counts while the result is written, without a
    pass of its own (:mod:`nestweave.operators.metrics`). Put filters on ``docs`` rather than on
    the result, so that they reach the scan. ``docs`` is read more than once by
    ``document_maps``: write rows to a table first if they would differ from one reading to the
    next. ``hot_keys=None`` skips the count of hot ids.
    """
    _check(docs, domains)
    domains = [d.stored() for d in domains]
    in_memory = choose(domains, strategy)
    columns = [column(c) for c in docs.columns]

    by_documents = [i for i in range(len(domains)) if i not in in_memory]
    work = attach_maps(docs, domains, by_documents, hot_keys) if by_documents else docs
    for i, buckets in in_memory.items():
        table = lookup_table(domains[i].entries(), "id", "name", buckets)
        # Spark's optimiser moves this subquery into the expression below, so the table is
        # evaluated once and never copied into rows; tests check the plan for it.
        work = work.withColumn(_helper("table", i), table.scalar())

    names = [_names(d, i, in_memory.get(i)) for i, d in enumerate(domains)]
    work = work.select(*columns, *names)
    if observation is not None:
        shapes = [(d.array, d.inner, _helper("names", i)) for i, d in enumerate(domains)]
        work = work.observe(observation, *metric_columns(shapes))

    enriched = {
        d.array: add_nested_field(
            d.array, d.inner, d.out_field, F.col(_helper("names", i)), d.value
        ).alias(d.array)
        for i, d in enumerate(domains)
    }
    return work.select(*[enriched.get(c, column(c)) for c in docs.columns])


def lookup_sizes(docs: DataFrame, domains: Sequence[Domain]) -> DataFrame:
    """Per domain: distinct ids in the documents, and how many of them the dimension names."""

    def sizes(d: Domain) -> DataFrame:
        ids = docs.select(F.explode(nested_ids(d.array, d.id_field)).alias("id"))
        found = ids.where(F.col("id").isNotNull()).distinct().join(d.entries(), "id", "left")
        return found.agg(
            F.lit(d.array).alias("domain"),
            F.count("id").alias("ids"),
            F.count("name").alias("found"),
        )

    return reduce(DataFrame.union, [sizes(d) for d in domains])


def prune_dimensions(docs: DataFrame, domains: Sequence[Domain]) -> list[Domain]:
    """The same domains with dimensions cut to the ids that occur in ``docs``.

    Worth its pass over the ids when a batch uses few of many ids: what is left may then be small
    enough to travel in memory.
    """

    def pruned(d: Domain) -> Domain:
        ids = docs.select(F.explode(nested_ids(d.array, d.id_field)).alias("_id")).distinct()
        kept = d.dimension.join(ids, column(d.dim_id) == F.col("_id"), "left_semi")
        return replace(d, dimension=kept, computed=True)

    return [pruned(d) for d in domains]


def _check(docs: DataFrame, domains: Sequence[Domain]) -> None:
    if len({d.array for d in domains}) != len(domains):
        raise ValueError("two domains write into the same array")
    for d in domains:
        id_type = docs.schema[d.array].dataType.elementType[d.id_field].dataType
        dim_type = d.dimension.schema[d.dim_id].dataType
        if id_type != dim_type:
            raise TypeError(
                f"{d.array}.{d.id_field} is {id_type.simpleString()}, "
                f"but {d.dim_id} of its dimension is {dim_type.simpleString()}"
            )


def choose(domains: Sequence[Domain], strategy: str) -> dict[int, int]:
    """Index → number of buckets of the domains to look up in memory."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if not domains:
        return {}
    sizes = dimension_sizes([(d.entries(), "id", "name") for d in domains])
    chosen = {}
    for i, (rows, size, conflicts) in enumerate(sizes):
        if conflicts:
            raise ValueError(
                f"dimension of {domains[i].array} has several names for {conflicts} ids: "
                "choose one with last_wins_dimension"
            )
        if strategy == "document_maps":
            continue
        if rows <= IN_MEMORY_ROWS and size <= IN_MEMORY_BYTES:
            chosen[i] = buckets_for(rows)
        elif strategy == "in_memory":
            raise ValueError(
                f"dimension of {domains[i].array} is too large to hold in memory: "
                f"{rows} rows, {size} bytes"
            )
    return chosen


def _helper(kind: str, i: int) -> str:
    return f"_{kind}_{i}"


def _names(d: Domain, i: int, buckets: int | None) -> Column:
    """One name (or null) per outer element of the domain."""
    ids = nested_ids(d.array, d.id_field)
    if buckets is None:
        found = F.transform(ids, lambda key: F.element_at(F.col(_helper("map", i)), key))
    else:
        table = F.col(_helper("table", i))
        found = F.transform(ids, lambda key: find_in_table(table, key, buckets))
    return found.alias(_helper("names", i))


def attach_maps(
    docs: DataFrame, domains: Sequence[Domain], indexes: Sequence[int], hot_keys: HotKeys | None
) -> DataFrame:
    """``docs`` with one id → name map column per domain.

    Documents meet their maps by a hash of their own ids. Documents with the same ids share a
    map, and so would different sets with the same hash: lookups are by id, so a larger map
    changes nothing. No document key is needed, and none can be null or repeated.
    """
    ids = {i: domains[i].id_set() for i in indexes}
    set_hash = F.xxhash64(*ids.values()).alias(_SET)
    id_columns = [expr.alias(_helper("ids", i)) for i, expr in ids.items()]

    # Only id columns are read for the sets, and copies of a set collapse on the map side.
    keyed = docs.select(set_hash, *id_columns)
    id_names = [_helper("ids", i) for i in indexes]
    if hot_keys:
        hot = hot_keys.find(keyed, single=[_SET], arrays=id_names)
    else:
        hot = dict.fromkeys([_SET, *id_names])
    sets = copy_to_pieces(keyed.distinct(), hot[_SET], _SET, _SET_PIECE)
    set_keys = [_SET] if hot[_SET] is None else [_SET, _SET_PIECE]

    def named(i: int) -> DataFrame:
        # The outer explode keeps the sets the same for all domains, so Spark computes them once;
        # the null id of an empty set finds nothing.
        pairs = sets.select(*set_keys, F.explode_outer(_helper("ids", i)).alias("id"))
        salt = F.xxhash64(*set_keys)
        hot_ids = hot[_helper("ids", i)]
        found = join_pieces(pairs, domains[i].entries(), "id", "inner", hot_ids, salt)
        return found.select(*set_keys, F.struct("id", "name").alias(_helper("entry", i)))

    entries = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [named(i) for i in indexes]
    )
    maps = entries.groupBy(*set_keys).agg(
        *[
            F.map_from_entries(F.collect_set(_helper("entry", i))).alias(_helper("map", i))
            for i in indexes
        ]
    )
    hashed = docs.select("*", set_hash)
    whole = assign_piece(hashed, hot[_SET], _SET, row_salt(docs), _SET_PIECE)
    return whole.join(maps, set_keys, "left")
