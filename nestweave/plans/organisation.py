"""The organisation documents: which ids are looked up where, and the two jobs as functions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nestweave.operators.conform import conform
from nestweave.operators.dimension import chosen_names, last_wins_dimension
from nestweave.operators.keys import domain_keys
from nestweave.operators.lookup import NOT_FOUND, Domain, enrich
from nestweave.schemas import ENRICH_FIELD, ENRICHED_ARRAYS, document_schema, enriched_schema
from nestweave.sources.documents import nested_file_stream, table_stream
from nestweave.streaming.control import trigger_policy
from nestweave.streaming.enrichment import Sink, enrich_stream
from nestweave.streaming.ingest import append_stream_to_table

# Id field of a document array, and the reference columns it is looked up in.
_LOOKUPS = {
    "teams": ("teamId", "teamId", "teamName"),
    "projects": ("projectId", "projectId", "projectName"),
    "departments": ("deptId", "deptId", "deptName"),
}


def organisation_domains(
    reference: DataFrame,
    order: Sequence[str],
    defaults: dict[str, str] | None = None,
    struct_fields: dict[str, str] | None = None,
    names: DataFrame | None = None,
) -> list[Domain]:
    """Teams, projects and departments, each with its own dimension cut from the wide reference.

    ``order`` names the reference columns that decide which of several names of an id is the
    last. ``defaults`` and ``struct_fields`` are per array. With ``names`` (:func:`batch_names`) the
    names were chosen before and the reference isn't read.
    """
    domains = []
    for array, (id_field, id_column, name_column) in _LOOKUPS.items():
        if names is None:
            dimension = last_wins_dimension(reference, id_column, name_column, order)
        else:
            own = names.where(F.col("domain") == array)
            dimension = own.select(F.col("id").alias(id_column), F.col("name").alias(name_column))
        domains.append(
            Domain(
                array=array,
                id_field=id_field,
                inner=ENRICHED_ARRAYS[array],
                dimension=dimension,
                dim_id=id_column,
                dim_name=name_column,
                default=(defaults or {}).get(array, NOT_FOUND),
                out_field=ENRICH_FIELD,
                struct_field=(struct_fields or {}).get(array),
            )
        )
    return domains


def batch_names(docs: DataFrame, reference: DataFrame, order: Sequence[str]) -> DataFrame:
    """(domain, id, name) of all ids that ``docs`` use, from one scan of the reference."""
    keys = domain_keys(docs, {array: id_field for array, (id_field, _, _) in _LOOKUPS.items()})
    columns = {array: (i, n) for array, (_, i, n) in _LOOKUPS.items()}
    return chosen_names(reference, columns, order, keys)


def enrich_organisations(
    docs: DataFrame,
    reference: DataFrame,
    order: Sequence[str],
    strategy: str = "auto",
    observation: Observation | None = None,
    prune: bool = False,
    names: DataFrame | None = None,
) -> DataFrame:
    """Enriched documents in exactly the declared schema.

    ``prune`` cuts the reference to the ids of ``docs`` first. ``names`` are what it was cut to, for
    a caller that keeps them: they are read by the job that measures them and by the lookup.
    """
    if names is None and prune:
        names = batch_names(docs, reference, order)
    domains = organisation_domains(reference, order, names=names)
    return conform(enrich(docs, domains, strategy, observation), enriched_schema())


def import_documents(
    spark: SparkSession,
    source: str,
    glob: str,
    table: str,
    checkpoint: str,
    trigger: str = "ONCE",
    file_format: str = "avro",
    path: str | None = None,
    table_format: str = "parquet",
    source_options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """First job: document files whose names match ``glob``, appended to ``table``."""
    stream = nested_file_stream(
        spark, source, document_schema(), glob, file_format, **(source_options or {})
    )
    return append_stream_to_table(
        stream, table, checkpoint, trigger_policy(trigger), table_format, path
    )


def enrich_documents(
    spark: SparkSession,
    table: str,
    reference: Callable[[], DataFrame],
    order: Sequence[str],
    sink: Sink,
    checkpoint: str,
    trigger: str = "ONCE",
    max_files: int | None = None,
    max_bytes: int | None = None,
    on_batch: Callable[[int, dict[str, object]], None] | None = None,
    strategy: str = "auto",
    persist: StorageLevel | None = StorageLevel.MEMORY_AND_DISK,
    source_options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Second job: the documents appended to ``table``, enriched batch by batch into ``sink``.

    ``reference`` is called for every micro-batch, so each sees the reference data of its time, cut
    to the ids of the batch by one scan for all domains. The batch and the names are kept while the
    batch is written. ``max_files`` and ``max_bytes`` exclude each other; a batch is one file unless
    one of them is given, and ``max_files=0`` is no limit.
    """
    if max_files is None and max_bytes is None:
        max_files = 1
    max_files = None if max_files == 0 else max_files
    stream = table_stream(spark, table, max_files, max_bytes, **(source_options or {}))
    kept: list[DataFrame] = []

    def transform(batch: DataFrame, observation: Observation) -> DataFrame:
        rows = reference()
        names = batch_names(batch, rows, order).persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(names)
        return enrich_organisations(batch, rows, order, strategy, observation, names=names)

    def write(batch: DataFrame, batch_id: int) -> None:
        try:
            sink(batch, batch_id)
        finally:
            while kept:
                kept.pop().unpersist()

    return enrich_stream(
        stream,
        transform,
        write,
        checkpoint,
        trigger_policy(trigger),
        on_batch,
        persist,
    )
