"""Fixed schemas of the bronze extracts, silver tables and gold star schema."""

from pyspark.sql import types as T

S, D, TS, L, I = T.StringType(), T.DateType(), T.TimestampType(), T.LongType(), T.IntegerType()


def schema(*fields) -> T.StructType:
    """`(name, type)` or `(name, type, nullable)` triples to a StructType."""
    return T.StructType([T.StructField(*field) for field in fields])


# --- bronze extracts: fixed values, columns bind by position --------------------------------------
INCIDENTS_CSV = schema(
    ("Numero", S), ("Ouvert", TS), ("Mis_a_jour", TS), ("Societe", S), ("Priorite", S),
    ("Groupe_affectation", S), ("Etat", S), ("Ouvert_par", S), ("Categorie", S),
    ("N_du_ticket_externe", S),
)
SHIFT_CSV = schema(("Ouvert", TS), ("Plage_horaire", S))
ASSIGNEE_CSV = schema(("Numéro", S), ("Affecté à", S))
DEPLOYMENTS_CSV = schema(
    ("Numéro", S), ("Ouvert", D), ("Mis à jour", D), ("Société", S), ("Priorité", S),
    ("Description brève", S), ("Groupe d'affectation", S), ("État", S), ("Ouvert par", S),
    ("Catégorie", S), ("N° de ticket externe", S), ("Ovrt_h", S), ("Mis_h", S),
)
REQUESTS_CSV = schema(
    ("Créé", D), ("Fermé", D), ("Numéro", S), ("Description brève", S), ("Groupe d'affectation", S),
    ("Affecté à", S), ("Task Duration", L), ("Créé_h", S), ("Fermé_h", S),
)

# --- rename maps and dropped columns: fixed values ------------------------------------------------
ASSIGNEE_RENAMES = {"Numéro": "Numero", "Affecté à": "Affecte"}
DEPLOYMENT_RENAMES = {
    "Numéro": "Numero", "Mis à jour": "Mis_a_jour", "Société": "Societe", "Priorité": "Priorite",
    "Description brève": "Description_breve", "Groupe d'affectation": "Groupe_affectation",
    "État": "Etat", "Ouvert par": "Ouvert_par", "Catégorie": "Categorie",
    "N° de ticket externe": "Numero_ticket_externe",
}
REQUEST_RENAMES = {
    "Créé": "Cree", "Fermé": "Ferme", "Numéro": "Numero", "Description brève": "Description_breve",
    "Groupe d'affectation": "Groupe_affectation", "Affecté à": "Affecte_a",
    "Task Duration": "Task_Duration", "Créé_h": "Cree_h", "Fermé_h": "Ferme_h",
}
DEPLOYMENT_DROPS = ["Priorite", "Societe", "Groupe_affectation", "Numero_ticket_externe", "Categorie"]
REQUEST_DROPS = ["Groupe_affectation"]
DEPLOYMENT_TYPE = "Mise en production"
REQUEST_TYPE = "Demande"

# --- silver ---------------------------------------------------------------------------------------
INCIDENTS_SILVER = INCIDENTS_CSV
SHIFT_SILVER = SHIFT_CSV
ASSIGNEE_SILVER = schema(("Numero", S), ("Affecte", S))
DEPLOYMENTS_SILVER = schema(
    ("Numero", S), ("Ouvert", D), ("Mis_a_jour", D), ("Description_breve", S), ("Etat", S),
    ("Ouvert_par", S), ("Ovrt_h", S), ("Mis_h", S), ("Plages_horaires", S), ("Type", S),
)
REQUESTS_SILVER = schema(
    ("Cree", D), ("Ferme", D), ("Numero", S), ("Description_breve", S), ("Affecte_a", S),
    ("Task_Duration", L), ("Cree_h", S), ("Ferme_h", S), ("Plages_horaires", S), ("Type", S, False),
)

# silver merge keys and the columns a matching row refreshes
INCIDENT_KEYS = ["Numero", "Ouvert", "Societe", "Groupe_affectation"]
INCIDENT_UPDATES = ["Mis_a_jour", "Priorite", "Etat", "Ouvert_par", "Categorie", "N_du_ticket_externe"]
DEPLOYMENT_KEYS = ["Numero", "Ouvert"]
DEPLOYMENT_UPDATES = [
    "Mis_a_jour", "Description_breve", "Etat", "Ouvert_par", "Ovrt_h", "Mis_h", "Plages_horaires",
    "Type",
]
REQUEST_KEYS = ["Numero"]
REQUEST_UPDATES = [  # the creation date is kept from the first load, its time of day is refreshed
    "Ferme", "Description_breve", "Affecte_a", "Task_Duration", "Cree_h", "Ferme_h",
    "Plages_horaires", "Type",
]

# --- gold -----------------------------------------------------------------------------------------
DATE_PARTS = ["Jour", "Mois", "Annee", "Heure", "Minute", "Seconde"]


def date_dim_schema(key: str, key_type: T.DataType) -> T.StructType:
    return schema((key, key_type), *[(part, I) for part in DATE_PARTS])


def value_dim_schema(id_col: str, label: str) -> T.StructType:
    return schema((id_col, L), (label, S))


GROUP_DIM = schema(("ID_Groupe_affectation", L), ("Groupe_affectation", S), ("Type_Groupe", S))
INCIDENTS_FACT = schema(
    ("Numero", S), ("N_du_ticket_externe", S), ("Ouvert", TS), ("Mis_a_jour", TS), ("ID_Societe", L),
    ("ID_Priorite", L), ("ID_Groupe_affectation", L), ("ID_Etat", L), ("ID_Ouvert_par", L),
    ("ID_Categorie", L),
)
DEPLOYMENTS_FACT = schema(
    ("Numero", S), ("Ouvert", D), ("Mis_a_jour", D), ("Etat", S), ("Ovrt_h", S), ("Mis_h", S),
    ("ID_description", L), ("ID_Collaborateur", L), ("ID_Plage_Horaires", L), ("ID_Type", L),
)
REQUESTS_FACT = schema(
    ("Numero", S), ("Cree", D), ("Ferme", D), ("Task_Duration", L), ("Cree_h", S), ("Ferme_h", S),
    ("ID_description", L), ("ID_Collaborateur", L), ("ID_Plage_Horaires", L), ("ID_Type", L),
)
