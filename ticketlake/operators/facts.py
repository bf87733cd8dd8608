"""Fact builders: star lookups of surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Lookup(NamedTuple):
    """How a fact column finds its key in a dimension."""

    dim: str
    fact_key: str
    dim_key: str
    id_col: str


INCIDENT_LOOKUPS = [
    Lookup("societe", "Societe", "Societe", "ID_Societe"),
    Lookup("priorite", "Priorite", "Priorite", "ID_Priorite"),
    Lookup("groupe", "Groupe_affectation", "Groupe_affectation", "ID_Groupe_affectation"),
    Lookup("etat", "Etat", "Etat", "ID_Etat"),
    Lookup("ouvert_par", "Ouvert_par", "Ouvert_par", "ID_Ouvert_par"),
    Lookup("categorie", "Categorie", "Categorie", "ID_Categorie"),
]
DEPLOYMENT_LOOKUPS = [
    Lookup("description", "Description_breve", "Description_breve", "ID_description"),
    Lookup("collaborateur", "Ouvert_par", "Collaborateur", "ID_Collaborateur"),
    Lookup("plage_horaires", "Plages_horaires", "Plages_horaires", "ID_Plage_Horaires"),
    Lookup("type", "Type", "Type", "ID_Type"),
]
REQUEST_LOOKUPS = [
    Lookup("description_d", "Description_breve", "Description_breve", "ID_description"),
    Lookup("collaborateur_d", "Affecte_a", "Collaborateur", "ID_Collaborateur"),
    Lookup("plage_horaires_d", "Plages_horaires", "Plages_horaires", "ID_Plage_Horaires"),
    Lookup("type", "Type", "Type", "ID_Type"),
]
INCIDENT_ATTRS = ["Numero", "N_du_ticket_externe", "Ouvert", "Mis_a_jour"]
DEPLOYMENT_ATTRS = ["Numero", "Ouvert", "Mis_a_jour", "Etat", "Ovrt_h", "Mis_h"]
REQUEST_ATTRS = ["Numero", "Cree", "Ferme", "Task_Duration", "Cree_h", "Ferme_h"]


def star_lookup(
    fact: DataFrame, dims: Mapping[str, DataFrame], lookups: Sequence[Lookup], attrs: Sequence[str]
) -> DataFrame:
    """Attributes plus one key per lookup; an unknown or NULL label gives a NULL key.

    Joins carry no hint. Dimensions read from tables have a known size: Spark broadcasts the ones
    under its threshold, so those lookups run in the scan's own stage, and sort-merges a larger one
    with AQE splitting its hot labels.
    """
    joined = fact
    for i, look in enumerate(lookups):
        dim = dims[look.dim].select(
            F.col(look.dim_key).alias(f"__label_{i}"), F.col(look.id_col).alias(f"__id_{i}")
        )
        joined = joined.join(dim, F.col(look.fact_key) == F.col(f"__label_{i}"), "left")
    keys = [F.col(f"__id_{i}").alias(look.id_col) for i, look in enumerate(lookups)]
    return joined.select(*attrs, *keys)


def _only(lookups: Sequence[Lookup], ids: Sequence[str] | None) -> list[Lookup]:
    return [look for look in lookups if ids is None or look.id_col in ids]


def fact_incidents(silver: DataFrame, dims: Mapping[str, DataFrame], ids=None) -> DataFrame:
    """Incident fact; `ids` limits the lookups to the keys a report needs."""
    return star_lookup(silver, dims, _only(INCIDENT_LOOKUPS, ids), INCIDENT_ATTRS)


def fact_deployments(silver: DataFrame, dims: Mapping[str, DataFrame], ids=None) -> DataFrame:
    """Deployment fact."""
    return star_lookup(silver, dims, _only(DEPLOYMENT_LOOKUPS, ids), DEPLOYMENT_ATTRS)


def fact_requests(silver: DataFrame, dims: Mapping[str, DataFrame], ids=None) -> DataFrame:
    """Request fact."""
    return star_lookup(silver, dims, _only(REQUEST_LOOKUPS, ids), REQUEST_ATTRS)
