"""What the gold layer holds: dimension specs per ticket kind, and stored dimensions for reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ticketlake.operators import dims as d
from ticketlake.operators import facts
from ticketlake.plans import fixtures as fx
from ticketlake.session import scratch_path
from ticketlake.sources import tables


class ValueDim(NamedTuple):
    """A label dimension: the silver column it reads, its own label column and its key."""

    name: str
    column: str
    label: str
    id_col: str


class DateDim(NamedTuple):
    """A date dimension: the silver date and, when it is held apart, the time of day."""

    name: str
    date: str
    time: str | None = None


INCIDENT_DIMS = [
    ValueDim("societe", "Societe", "Societe", "ID_Societe"),
    ValueDim("categorie", "Categorie", "Categorie", "ID_Categorie"),
    ValueDim("etat", "Etat", "Etat", "ID_Etat"),
    ValueDim("priorite", "Priorite", "Priorite", "ID_Priorite"),
    ValueDim("ouvert_par", "Ouvert_par", "Ouvert_par", "ID_Ouvert_par"),
]
DEPLOYMENT_DIMS = [
    ValueDim("description", "Description_breve", "Description_breve", "ID_description"),
    ValueDim("collaborateur", "Ouvert_par", "Collaborateur", "ID_Collaborateur"),
    ValueDim("plage_horaires", "Plages_horaires", "Plages_horaires", "ID_Plage_Horaires"),
]
REQUEST_DIMS = [
    ValueDim("description_d", "Description_breve", "Description_breve", "ID_description"),
    ValueDim("collaborateur_d", "Affecte_a", "Collaborateur", "ID_Collaborateur"),
    ValueDim("plage_horaires_d", "Plages_horaires", "Plages_horaires", "ID_Plage_Horaires"),
]
INCIDENT_DATES = [DateDim("date_ouverture", "Ouvert"), DateDim("date_maj", "Mis_a_jour")]
DEPLOYMENT_DATES = [
    DateDim("date_ouverture_mep", "Ouvert", "Ovrt_h"), DateDim("date_maj_mep", "Mis_a_jour", "Mis_h"),
]
REQUEST_DATES = [
    DateDim("date_ouverture_d", "Cree", "Cree_h"), DateDim("fermeture_d", "Ferme", "Ferme_h"),
]


def value_dim(silver: DataFrame, spec: ValueDim, existing: DataFrame | None = None) -> DataFrame:
    members = d.distinct_members(silver, spec.column, spec.label)
    return d.extend_dim(members, existing, spec.label, spec.id_col)


def date_dim(silver: DataFrame, spec: DateDim) -> DataFrame:
    if spec.time is None:
        return d.date_dim_from_ts(silver, spec.date)
    return d.date_dim_from_date(silver, spec.date, spec.time)


# --- stored dimensions over the test views --------------------------------------------------------
_SILVER: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{spec.name: fx.incidents for spec in INCIDENT_DIMS},
    **{spec.name: fx.deployments for spec in DEPLOYMENT_DIMS},
    **{spec.name: fx.requests for spec in REQUEST_DIMS},
}
_SPECS = {spec.name: spec for spec in INCIDENT_DIMS + DEPLOYMENT_DIMS + REQUEST_DIMS}
_prepared: dict[tuple[str, str], str] = {}


def _build(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "groupe":
        members = d.distinct_members(fx.incidents(spark, sf_dir), "Groupe_affectation")
        return d.dim_group(members, fx.group_types(spark))
    if name == "type":
        members = d.union_members([fx.requests(spark, sf_dir), fx.deployments(spark, sf_dir)], "Type")
        return d.extend_dim(members, None, "Type", "ID_Type")
    return value_dim(_SILVER[name](spark, sf_dir), _SPECS[name])


def together(*loads: Callable[[], None], at_once: int = 4) -> None:
    """Run independent table loads side by side, so that small ones do not wait for each other."""
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(load) for load in loads]:
            done.result()


def _load(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, str]:
    """Folders of newly built dimensions; small ones are loaded side by side."""
    paths = {name: scratch_path(spark, f"dim-{name}") for name in names}
    together(*[
        lambda name=name, path=path: tables.overwrite_path(_build(spark, sf_dir, name), path)
        for name, path in paths.items()], at_once=8)
    return paths


def stored_dims(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Dimensions as the gold layer has them: written, then read back.

    Read from files they carry their true size, which is what decides how a lookup joins them.
    """
    paths = {name: _prepared[sf_dir, name] for name in names if (sf_dir, name) in _prepared}
    paths |= _load(spark, sf_dir, [name for name in names if name not in paths])
    return {name: tables.read_path(spark, paths[name]) for name in names}


@contextmanager
def prepared(spark: SparkSession, sf_dir: str) -> Iterator[None]:
    """Within this context the dimensions of one folder of tables are built once, on entering.

    For reports over a gold layer that is loaded beforehand; a benchmark times the load as its own entry.
    """
    names = [*_SPECS, "groupe", "type"]
    _prepared.update({(sf_dir, name): path for name, path in _load(spark, sf_dir, names).items()})
    try:
        yield
    finally:
        for name in names:
            _prepared.pop((sf_dir, name), None)


def _wanted(lookups, ids) -> list[str]:
    return [look.dim for look in lookups if ids is None or look.id_col in ids]


def incident_star(spark: SparkSession, sf_dir: str, ids=None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The incident fact with the keys a report needs, and their dimensions."""
    dims = stored_dims(spark, sf_dir, *_wanted(facts.INCIDENT_LOOKUPS, ids))
    return facts.fact_incidents(fx.incidents(spark, sf_dir), dims, ids), dims


def deployment_star(spark: SparkSession, sf_dir: str, ids=None) -> tuple[DataFrame, dict[str, DataFrame]]:
    dims = stored_dims(spark, sf_dir, *_wanted(facts.DEPLOYMENT_LOOKUPS, ids))
    return facts.fact_deployments(fx.deployments(spark, sf_dir), dims, ids), dims


def request_star(spark: SparkSession, sf_dir: str, ids=None) -> tuple[DataFrame, dict[str, DataFrame]]:
    dims = stored_dims(spark, sf_dir, *_wanted(facts.REQUEST_LOOKUPS, ids))
    return facts.fact_requests(fx.requests(spark, sf_dir), dims, ids), dims
