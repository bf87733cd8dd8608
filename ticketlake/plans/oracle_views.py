"""The views of `fixtures` in SQL, as WITH clauses for the oracle queries."""

from __future__ import annotations


def minute_sql(time: str) -> str:
    parts = [f"TRY_CAST(string_split({time}, ':')[{i}] AS INTEGER)" for i in (1, 2, 3)]
    return (
        f"CASE WHEN len(string_split({time}, ':')) = 3 AND {parts[0]} IS NOT NULL AND {parts[1]} IS NOT NULL"
        f" AND {parts[2]} IS NOT NULL THEN {parts[0]} * 60 + {parts[1]} END"
    )


def hours_band_sql(date: str, time: str) -> str:
    minute = minute_sql(time)
    return (
        f"CASE WHEN {date} IS NULL OR {time} IS NULL THEN 'Inconnu'"
        f" WHEN {date} = DATE '2024-01-01' OR isodow({date}) >= 6 THEN 'HNO'"
        f" WHEN {minute} IS NULL THEN 'Invalide'"
        f" WHEN {minute} >= 510 AND {minute} < 1110 THEN 'HO' ELSE 'HNO' END"
    )


def shift_sql(time: str) -> str:
    minute = minute_sql(time)
    return (
        f"CASE WHEN {time} IS NULL THEN 'Inconnu' WHEN {minute} IS NULL THEN 'Invalide'"
        f" WHEN {minute} >= 420 AND {minute} < 900 THEN 'Shift 1'"
        f" WHEN {minute} >= 900 AND {minute} < 1380 THEN 'Shift 2' ELSE 'Shift 3' END"
    )


VIEWS = {
    "v_incidents": """
        SELECT 'INC' || lpad(o_orderkey::VARCHAR, 8, '0') AS Numero, o_orderdate AS Ouvert,
               o_orderdate + to_hours((o_orderkey % 720)::INTEGER) AS Mis_a_jour, n_name AS Societe,
               o_orderpriority AS Priorite,
               CASE WHEN o_orderkey % 97 <> 0 THEN c_mktsegment END AS Groupe_affectation,
               CASE o_orderstatus WHEN 'O' THEN 'En cours' WHEN 'P' THEN 'Résolu' WHEN 'F' THEN 'Clos' END AS Etat,
               c_name AS Ouvert_par,
               CASE WHEN o_orderkey % 89 <> 0 THEN 'CAT' || (o_orderkey % 7)::VARCHAR END AS Categorie,
               CASE WHEN o_orderkey % 3 = 0 THEN 'EXT' || o_orderkey::VARCHAR END AS N_du_ticket_externe
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "v_load1": "SELECT * FROM v_incidents WHERE substr(Numero, 4)::BIGINT % 10 < 7",
    "v_load2_once": """
        SELECT * REPLACE ('Clos' AS Etat) FROM v_incidents WHERE substr(Numero, 4)::BIGINT % 10 >= 5""",
    "v_load2": """
        SELECT * FROM v_load2_once UNION ALL
        SELECT * REPLACE ('FURNITURE' AS Groupe_affectation, Mis_a_jour + INTERVAL 1 HOUR AS Mis_a_jour)
        FROM v_load2_once WHERE substr(Numero, 4)::BIGINT % 50 = 5""",
    "v_deploy_raw": """
        SELECT 'CHG' || event_id::VARCHAR AS Numero, ts::DATE AS Ouvert, finish::DATE AS Mis_a_jour,
               event_type AS Description_breve,
               CASE WHEN event_id % 5 <> 0 THEN 'Clos' ELSE 'En cours' END AS Etat,
               'U' || user_id::VARCHAR AS Ouvert_par,
               CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN '08:30'
                    WHEN event_id % 107 = 0 THEN 'ab:cd:ef' ELSE strftime(ts, '%H:%M:%S') END AS Ovrt_h,
               strftime(finish, '%H:%M:%S') AS Mis_h
        FROM (SELECT *, ts + to_seconds(floor(value * 3600)::BIGINT) AS finish FROM events
              WHERE event_type IN ('error', 'purchase', 'signup'))""",
    "v_deploy": f"""
        SELECT *, {hours_band_sql('Ouvert', 'Ovrt_h')} AS Plages_horaires, 'Mise en production' AS Type
        FROM v_deploy_raw""",
    "v_request_raw": """
        SELECT ts::DATE AS Cree, CASE WHEN event_id % 11 <> 0 THEN finish::DATE END AS Ferme,
               'RITM' || event_id::VARCHAR AS Numero, event_type AS Description_breve,
               'U' || (user_id % 20)::VARCHAR AS Affecte_a, floor(value * 3600)::BIGINT AS Task_Duration,
               strftime(ts, '%H:%M:%S') AS Cree_h,
               CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 THEN strftime(finish, '%H:%M:%S') END AS Ferme_h
        FROM (SELECT *, ts + to_seconds(floor(value * 3600)::BIGINT) AS finish FROM events
              WHERE event_type IN ('click', 'view'))""",
    "v_request": f"""
        SELECT *, {shift_sql('Cree_h')} AS Plages_horaires, 'Demande' AS Type
        FROM v_request_raw WHERE Ferme IS NOT NULL AND Ferme_h IS NOT NULL""",
    "v_shift": f"""
        SELECT date_trunc('hour', ts)::TIMESTAMP AS Ouvert, {shift_sql("strftime(ts, '%H:%M:%S')")} AS Plage_horaire
        FROM events""",
    "v_assignee": """
        SELECT 'INC' || lpad(o_orderkey::VARCHAR, 8, '0') AS Numero, 'U' || (o_custkey % 25)::VARCHAR AS Affecte
        FROM orders""",
    "v_group_types": """
        SELECT * FROM (VALUES ('BUILDING', 'Exploitation'), ('MACHINERY', 'Exploitation'),
                              ('HOUSEHOLD', 'Supervision')) AS t(label, type)""",
    "v_group_types_revised": """
        SELECT * FROM (VALUES ('BUILDING', 'Exploitation'), ('MACHINERY', 'Supervision'),
                              ('FURNITURE', 'Exploitation')) AS t(label, type)""",
    "v_sla": """
        SELECT * FROM (VALUES ('1-URGENT', 24), ('2-HIGH', 72), ('3-MEDIUM', 168), ('4-NOT SPECIFIED', 336),
                              ('5-LOW', 720)) AS t(priority, hours)""",
}
_NEEDS = {
    "v_load1": ["v_incidents"], "v_load2_once": ["v_incidents"], "v_load2": ["v_load2_once"],
    "v_deploy": ["v_deploy_raw"], "v_request": ["v_request_raw"],
}


def with_views(sql: str) -> str:
    """Prefix a query with the WITH clauses of the views it names."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in VIEWS:
        if any(word == name for word in _words(sql)):
            add(name)
    body = sql.strip()
    if not wanted:
        return body
    clauses = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in wanted)
    if body.upper().startswith("WITH "):
        return f"WITH {clauses},\n{body[5:]}"
    return f"WITH {clauses}\n{body}"


def _words(sql: str) -> set[str]:
    return set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in sql).split())
