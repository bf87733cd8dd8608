import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from ticketlake import schemas
from ticketlake.plans import fixtures as fx
from ticketlake.plans import jobs
from ticketlake.plans.queries import as_csv, pipeline_incidents_changes
from ticketlake.session import scratch_path
from ticketlake.sources import readers, tables

GOLD = [
    "societe", "categorie", "etat", "priorite", "ouvert_par", "groupe", "date_ouverture", "date_maj",
    "factSupervision_gold", "description", "collaborateur", "plage_horaires", "date_ouverture_mep",
    "date_maj_mep", "description_d", "collaborateur_d", "plage_horaires_d", "date_ouverture_d",
    "fermeture_d", "type", "factMep_gold", "factDemande_gold",
]


def load(spark, sf, root, part):
    incidents = readers.read_csv(spark, as_csv(fx.incident_loads(spark, sf)[part]), schemas.INCIDENTS_CSV)
    shift = readers.read_csv(spark, as_csv(fx.shift(spark, sf)), schemas.SHIFT_CSV)
    assignee = readers.read_csv(spark, as_csv(fx.assignee(spark, sf)), schemas.ASSIGNEE_CSV)
    number = F.substring("Numero", 4, 18).cast("bigint")
    deployments = fx.events_split(fx.deployments_raw(spark, sf), number)[part]
    requests = fx.events_split(fx.requests_raw(spark, sf), F.substring("Numero", 5, 18).cast("bigint"))[part]
    jobs.load_incidents(incidents, root, buckets=2, days=400)
    jobs.load_shift(shift, root)
    jobs.load_assignees(assignee, root, buckets=4)
    jobs.load_deployments(
        readers.read_csv(spark, as_csv(fx.deployments_csv(deployments)), schemas.DEPLOYMENTS_CSV), root,
        fx.HOLIDAYS, buckets=2, days=400)
    jobs.load_requests(
        readers.read_csv(spark, as_csv(fx.requests_csv(requests)), schemas.REQUESTS_CSV), root, buckets=2, days=400)
    jobs.load_incident_gold(spark, root, fx.group_types(spark), buckets=2, days=400)
    jobs.load_deployment_request_gold(spark, root, buckets=2, days=400)


def test_full_load_rerun_and_second_extract(spark, sf):
    root = scratch_path(spark, "lake")
    load(spark, sf, root, 0)
    first = {name: rows(jobs.gold(spark, root, name)) for name in GOLD}
    load(spark, sf, root, 0)
    for name in GOLD:
        assert rows(jobs.gold(spark, root, name)) == first[name], name

    load(spark, sf, root, 1)
    for name, spec in [("societe", "ID_Societe"), ("ouvert_par", "ID_Ouvert_par"), ("groupe", "ID_Groupe_affectation")]:
        known = {r[0]: r[1] for r in first[name]}
        now = {r[0]: r[1] for r in rows(jobs.gold(spark, root, name))}
        assert known.items() <= now.items(), name
        assert sorted(now) == list(range(1, len(now) + 1)), name
    fact = jobs.gold(spark, root, "factSupervision_gold")
    total = fx.incidents(spark, sf).count()
    assert fact.count() == total == fact.select("Numero").distinct().count()
    # a reassigned ticket has two silver rows, the fact shows its later group
    groups = dict(rows(jobs.gold(spark, root, "groupe").select("Groupe_affectation", "ID_Groupe_affectation")))
    moved = fact.filter(F.substring("Numero", 4, 18).cast("bigint") % 50 == 5)
    assert {r[0] for r in moved.select("ID_Groupe_affectation").distinct().collect()} == {groups["FURNITURE"]}
    assert fact.filter("ID_Etat IS NULL OR ID_Societe IS NULL").count() == 0
    assert jobs.gold(spark, root, "factMep_gold").count() == fx.deployments(spark, sf).count()
    assert jobs.gold(spark, root, "factDemande_gold").count() == fx.requests(spark, sf).count()

    jobs.register_views(spark, root, "gold", ["etat", "factSupervision_gold"])
    counted = spark.sql("SELECT Etat, count(*) n FROM factSupervision_gold JOIN etat USING (ID_Etat) GROUP BY Etat")
    assert sum(r.n for r in counted.collect()) == total


def test_changed_rows_load_like_all_rows(spark, sf):
    """A second load of the changed rows alone gives the same gold layer, and leaves silver unread."""
    number = F.substring("Numero", 4, 18).cast("bigint")
    parts = fx.events_split(fx.deployments(spark, sf), number)
    asked = fx.events_split(fx.requests(spark, sf), F.substring("Numero", 5, 18).cast("bigint"))
    layers = []
    for incremental in (False, True):
        root = scratch_path(spark, "lake")
        for i in (0, 1):
            for name, schema, rows_, keys, date in [
                ("MEP_silver", schemas.DEPLOYMENTS_SILVER, parts[i], schemas.DEPLOYMENT_KEYS, "Ouvert"),
                ("demandes_silver", schemas.REQUESTS_SILVER, asked[i], schemas.REQUEST_KEYS, "Cree"),
            ]:
                path = jobs.silver_path(root, name)
                tables.ensure_table(spark, path, schema, tables.Layout(["Numero"], 2, date, 400))
                tables.upsert_table(spark, path, rows_, keys)
            changed = (parts[i], asked[i]) if incremental and i else (None, None)
            jobs.load_deployment_request_gold(spark, root, *changed, buckets=2, days=400)
        layers.append({name: rows(jobs.gold(spark, root, name)) for name in GOLD[9:]})
    for name in GOLD[9:]:
        assert layers[0][name] == layers[1][name], name


def test_required_column_is_enforced(spark):
    path = scratch_path(spark, "required")
    tables.ensure_table(spark, path, schemas.REQUESTS_SILVER, tables.Layout(["Numero"], 2))
    assert not tables.read_path(spark, path).collect()
    day = dt.date(2025, 1, 2)
    bad = spark.createDataFrame(
        [(day, day, "R1", "d", "a", 1, "08:00:00", "09:00:00", "Shift 1", None)],
        ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.REQUESTS_SILVER))
    try:
        tables.upsert_table(spark, path, bad, ["Numero"])
    except Exception as error:
        assert "required column Type" in str(error)
    else:
        raise AssertionError("NULL in a required column was written")
    assert tables.read_path(spark, path).count() == 0


def test_merges_of_whole_tables_use_every_core(spark, sf, monkeypatch):
    """A bucket is one task's, so tables that a merge rewrites have no fewer buckets than there are cores."""
    layouts, ensure_table = {}, tables.ensure_table

    def ensure(spark, path, schema, layout=tables.Layout()):
        layouts[path.split("/")[-1]] = layout
        ensure_table(spark, path, schema, layout)

    monkeypatch.setattr(tables, "ensure_table", ensure)
    pipeline_incidents_changes(spark, sf)
    for name in ("supervision_silver", "factSupervision_gold"):
        assert layouts[name].buckets >= spark.sparkContext.defaultParallelism
