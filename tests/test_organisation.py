"""Golden cases on organisation documents, for both strategies."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import org
from nestweave import Domain, enrich, enriched_schema, last_wins_dimension
from nestweave.operators.lookup import lookup_sizes, prune_dimensions
from nestweave.operators.spread import HotKeys
from nestweave.plans.organisation import enrich_organisations, organisation_domains
from nestweave.schemas import document_schema

BOTH = pytest.mark.parametrize("strategy", ["in_memory", "document_maps"])


def run(spark, strategy, **kwargs):
    domains = organisation_domains(org.reference(spark), ["ord"], **kwargs)
    rows = enrich(org.documents(spark), domains, strategy).collect()
    return {row.orgName: row for row in rows}


def names(outer, inner):
    return [item.ENRICH for item in outer[inner]]


@BOTH
def test_hits_take_the_last_name(spark, strategy):
    row = run(spark, strategy)["hit"]
    assert names(row.teams[0], "members") == ["Design Team"] * 2
    assert names(row.teams[1], "members") == ["AI Team"] * 2
    assert names(row.projects[0], "tasks") == ["CUSTOMER Project"]
    assert names(row.departments[0], "employees") == ["AI Department"]


@BOTH
def test_misses_take_the_default(spark, strategy):
    row = run(spark, strategy)["miss"]
    assert names(row.teams[0], "members") == ["NOT_FOUND"] * 2
    assert names(row.projects[0], "tasks") == ["NOT_FOUND"]
    assert names(row.departments[0], "employees") == ["NOT_FOUND"]


@BOTH
def test_null_id_null_name_and_null_scalars(spark, strategy):
    row = run(spark, strategy)["nulls"]
    assert names(row.teams[0], "members") == ["NOT_FOUND"] * 2
    assert names(row.projects[0], "tasks") == ["NOT_FOUND"]
    assert row.departments[0].budget is None
    assert row.departments[0].employees[0].salary is None
    assert names(row.departments[0], "employees") == ["Sales"]
    assert row.offices is None


@BOTH
def test_null_and_empty_arrays_stay(spark, strategy):
    rows = run(spark, strategy)
    assert rows["empty"].teams is None
    assert rows["empty"].projects == []
    assert rows["empty"].departments[0].employees == []
    assert rows["empty inner"].teams[0].members is None


@BOTH
def test_quotes_repeated_keys_null_keys_and_null_elements(spark, strategy):
    rows = run(spark, strategy)
    assert names(rows["quote"].teams[0], "members") == ["O'Brien's Team"] * 2
    assert [names(t, "members") for t in rows["again"].teams] == [["Design Team"] * 2] * 2
    assert names(rows["keyless"].teams[0], "members") == ["Design Team"] * 2
    assert rows["null element"].teams[0] is None
    assert names(rows["null element"].teams[1], "members") == ["Design Team"] * 2


def without_enrich(array, inner):
    def strip(x):
        return x.withField(inner, F.transform(x[inner], lambda y: y.dropFields("ENRICH")))

    return F.transform(array, strip)


@BOTH
def test_nothing_else_changes(spark, strategy):
    """All fields where they were, in their order; offices untouched; no helper columns."""
    docs = org.documents(spark)
    domains = organisation_domains(org.reference(spark), ["ord"])
    enriched = enrich(docs, domains, strategy)
    assert enriched.schema.simpleString() == enriched_schema().simpleString()
    back = enriched
    for d in domains:
        back = back.withColumn(d.array, without_enrich(d.array, d.inner))
    assert back.schema.simpleString() == docs.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.collect()))


@BOTH
def test_defaults_and_struct_form(spark, strategy):
    row = run(
        spark,
        strategy,
        defaults={"teams": "team"},
        struct_fields={"teams": "TEAMNAME", "projects": "PROJECTNAME"},
    )["miss"]
    assert row.teams[0].members[0].ENRICH.TEAMNAME == "team"
    assert row.projects[0].tasks[0].ENRICH.PROJECTNAME == "NOT_FOUND"
    assert row.departments[0].employees[0].ENRICH == "NOT_FOUND"


@BOTH
def test_empty_dimension_keeps_all_documents(spark, strategy):
    domains = organisation_domains(org.reference(spark).limit(0), ["ord"])
    rows = enrich(org.documents(spark), domains, strategy).collect()
    assert len(rows) == len(org.DOCUMENTS)
    found = {m.ENRICH for r in rows for t in r.teams or [] if t for m in t.members or []}
    assert found == {"NOT_FOUND"}


@BOTH
def test_no_documents(spark, strategy):
    domains = organisation_domains(org.reference(spark), ["ord"])
    assert enrich(org.documents(spark, []), domains, strategy).collect() == []


@BOTH
def test_hot_keys_cut_into_pieces_change_nothing(spark, strategy):
    domains = organisation_domains(org.reference(spark), ["ord"])
    docs = org.documents(spark, org.DOCUMENTS * 20).repartition(3)
    plain = enrich(docs, domains, strategy)
    cut = enrich(docs, domains, strategy, hot_keys=HotKeys(floor=2, share=50))
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))


def test_mixed_strategies(spark, monkeypatch):
    """A dimension that is too large for memory does not take the others with it."""
    monkeypatch.setattr("nestweave.operators.lookup.IN_MEMORY_ROWS", 3)
    domains = organisation_domains(org.reference(spark), ["ord"])
    auto = enrich(org.documents(spark), domains)
    monkeypatch.undo()
    plain = enrich(org.documents(spark), domains, "document_maps")
    assert sorted(map(str, auto.collect())) == sorted(map(str, plain.collect()))
    with pytest.raises(ValueError, match="strategy"):
        enrich(org.documents(spark), domains, "other")


def test_in_memory_refuses_a_large_dimension(spark, monkeypatch):
    monkeypatch.setattr("nestweave.operators.lookup.IN_MEMORY_BYTES", 10)
    domains = organisation_domains(org.reference(spark), ["ord"])
    with pytest.raises(ValueError, match="too large"):
        enrich(org.documents(spark), domains, "in_memory")


@BOTH
def test_observation_counts_in_the_same_pass(spark, strategy):
    domains = organisation_domains(org.reference(spark), ["ord"])
    observation = Observation("metrics")
    enrich(org.documents(spark), domains, strategy, observation).collect()
    m = observation.get
    assert m["documents"] == len(org.DOCUMENTS)
    for array in ("teams", "projects", "departments"):
        assert m[f"{array}_hits"] + m[f"{array}_misses"] == m[f"{array}_elements"]
    assert (m["teams_elements"], m["teams_hits"]) == (18, 14)
    assert (m["projects_elements"], m["projects_hits"]) == (3, 1)
    assert (m["departments_elements"], m["departments_hits"]) == (3, 2)


def test_lookup_sizes(spark):
    domains = organisation_domains(org.reference(spark), ["ord"])
    sizes = {r.domain: (r.ids, r.found) for r in lookup_sizes(org.documents(spark), domains).collect()}
    assert sizes == {"teams": (4, 3), "projects": (3, 1), "departments": (3, 2)}


def test_pruned_dimensions_hold_only_ids_in_use(spark):
    domains = organisation_domains(org.reference(spark), ["ord"])
    teams = prune_dimensions(org.documents(spark), domains)[0].dimension
    ids = {r.teamId for r in teams.collect()}
    assert ids == {"TEAM_DESIGN_1", "TEAM_AI_RESEARCH_6", "TEAM_O'BRIEN"}


@BOTH
def test_pruning_the_reference_changes_nothing(spark, strategy):
    docs, ref = org.documents(spark), org.reference(spark)
    plain = enrich_organisations(docs, ref, ["ord"], strategy)
    pruned = enrich_organisations(docs, ref, ["ord"], strategy, prune=True)
    assert sorted(map(str, pruned.collect())) == sorted(map(str, plain.collect()))


def test_last_wins_is_deterministic(spark):
    ref = org.reference(spark)
    for shuffled in (ref, ref.orderBy(F.desc("ord")), ref.repartition(3)):
        got = dict(map(tuple, last_wins_dimension(shuffled, "projectId", "projectName", ["ord"]).collect()))
        assert got["PRJ_CUSTOMER_PORTAL_1"] == "CUSTOMER Project"
        assert got["PRJ_NAMELESS"] is None
    tied = spark.createDataFrame([("k", "a", 1), ("k", "b", 1), (None, "c", 1)], "id string, name string, o int")
    assert [tuple(r) for r in last_wins_dimension(tied, "id", "name", ["o"]).collect()] == [("k", "b")]


def test_other_ids_of_the_reference(spark):
    """Offices go through the same operator, with their facilities as the inner array."""
    offices = last_wins_dimension(org.reference(spark), "officeId", "loc", ["ord"])
    rows = [("A", "x", None, None, None, [("OFFICE_UK_LON_1", "?", 1, [("F", "f", 1, True)])])]
    domain = Domain("offices", "officeId", "facilities", offices, "officeId", "loc")
    row = enrich(org.documents(spark, rows), [domain]).first()
    assert row.offices[0].facilities[0].ENRICH == "UK Office"


def test_conflicting_dimension_is_an_error(spark):
    ref = org.reference(spark).select("projectId", "projectName").distinct()
    domain = Domain("projects", "projectId", "tasks", ref, "projectId", "projectName")
    for strategy in ("in_memory", "document_maps"):
        with pytest.raises(Exception, match="several names"):
            enrich(org.documents(spark), [domain], strategy).collect()


def test_types_must_agree(spark):
    numbers = spark.range(3).withColumn("name", F.lit("x"))
    domain = Domain("teams", "teamId", "members", numbers, "id", "name")
    with pytest.raises(TypeError, match="teams.teamId is string"):
        enrich(org.documents(spark), [domain])
    teams = organisation_domains(org.reference(spark), ["ord"])[0]
    with pytest.raises(ValueError, match="same array"):
        enrich(org.documents(spark), [teams, teams])


def test_declared_schemas(spark):
    raw, enriched = document_schema(), enriched_schema()
    assert raw.names == enriched.names
    extra = 0
    for array in ("teams", "projects", "departments", "offices"):
        before = raw[array].dataType.elementType.fields[-1].dataType.elementType.names
        after = enriched[array].dataType.elementType.fields[-1].dataType.elementType.names
        assert after in (before, [*before, "ENRICH"])
        extra += len(after) - len(before)
    assert extra == 3


def test_enriched_documents_have_the_declared_schema(spark):
    enriched = enrich_organisations(org.documents(spark), org.reference(spark), ["ord"])
    assert enriched.schema.simpleString() == enriched_schema().simpleString()
    hit = enriched.where("orgName = 'hit'").first()
    assert hit.teams[0].members[0].asDict() == {
        "memberId": "m-7",
        "memberName": "Iris Holm",
        "position": "bassoon",
        "ENRICH": "Design Team",
    }
