"""Schemas of the stored tables and of the raw extracts."""

from __future__ import annotations

STUDENT_COLUMNS = [
    "student_id", "annee_universitaire", "filiere", "age", "sexe", "bac_type", "mention_bac",
    "etablissement_origine", "boursier", "distance_domicile_km", "heures_travail_remunere_sem",
    "taux_presence_pct", "connexions_lms_30j", "heures_lms_total", "ressources_consultees",
    "retards_rendus", "nb_devoirs_total", "nb_devoirs_rendus", "messages_forum",
    "moyenne_partiels_s1", "nb_ue_total", "nb_ue_validees_s1", "motivation", "satisfaction",
    "sentiment_appartenance", "groupe_td", "couleur_carte_etudiante", "jour_inscription",
    "id_dossier", "date_inscription", "moyenne_finale", "abandon", "commentaire_tuteur",
]
CATALOGUE_COLUMNS = [
    "filiere", "faculte", "niveau", "ects_semestre", "capacite_accueil", "volume_horaire_s1",
    "taux_reussite_historique_pct",
]

# Columns that are plain numbers in the extracts (cast after the text read).
NUMBER_COLUMNS = [
    "age", "heures_travail_remunere_sem", "connexions_lms_30j", "heures_lms_total",
    "ressources_consultees", "retards_rendus", "nb_devoirs_total", "nb_devoirs_rendus",
    "messages_forum", "nb_ue_total", "nb_ue_validees_s1", "motivation", "satisfaction",
    "sentiment_appartenance", "moyenne_finale", "abandon",
]
CATALOGUE_NUMBER_COLUMNS = [
    "ects_semestre", "capacite_accueil", "volume_horaire_s1", "taux_reussite_historique_pct",
]

# Stored tables: name -> DDL. Every table but the two logs is partitioned by batch.
TABLES = {
    "ingestion_batch": (
        "id string, source_name string, source_uri string, status string, rows_bronze bigint, "
        "rows_silver bigint, rows_gold bigint, metadata_json string, expires_at timestamp, "
        "created_at timestamp, batch_id string"
    ),
    "bronze_student_raw": (
        "row_number bigint, payload_json string, parse_ok boolean, rejected_reason string, "
        "created_at timestamp, batch_id string"
    ),
    "bronze_catalogue_raw": (
        "row_number bigint, payload_json string, parse_ok boolean, rejected_reason string, "
        "created_at timestamp, batch_id string"
    ),
    "silver_student": (
        "row_number bigint, student_id string, id_dossier string, filiere string, abandon int, "
        "moyenne_finale double, payload_json string, created_at timestamp, batch_id string"
    ),
    "silver_catalogue": "filiere string, payload_json string, created_at timestamp, batch_id string",
    "gold_training_feature": (
        "student_id string, split_set string, label_abandon int, features_json string, "
        "created_at timestamp, batch_id string"
    ),
    "gold_prediction": (
        "id bigint, student_id string, proba_abandon double, alerte int, model_version string, "
        "threshold double, payload_json string, created_at timestamp, run_id string, batch_id string"
    ),
    "gold_drift_report": (
        "id string, status string, watch_count int, alert_count int, report_json string, "
        "created_at timestamp, run_id string, batch_id string"
    ),
    "privacy_audit_log": (
        "id string, action string, actor string, target_type string, target_id string, "
        "reason string, metadata_json string, created_at timestamp"
    ),
    "model_version": (
        "name string, version int, run_id string, source string, metrics map<string,double>, "
        "created_at timestamp"
    ),
    "model_alias_event": (
        "event_id bigint, name string, alias string, version int, moved_at timestamp"
    ),
    "training_run": "run_id string, key string, value string, logged_at timestamp",
    "job_run": "job string, day date, status string, result_json string, finished_at timestamp",
    "job_step": "job string, day date, step string, position int, result_json string, finished_at timestamp",
    "alert_state": (
        "subject string, triggered_at timestamp, resolved_at timestamp, written_at timestamp"
    ),
}
BATCH_TABLES = [name for name, ddl in TABLES.items() if "batch_id string" in ddl]
LAYER_TABLES = [name for name in BATCH_TABLES if name != "ingestion_batch"]
#: Tables that several runs write for one batch: a run replaces nothing but itself.
RUN_TABLES = [name for name in BATCH_TABLES if "run_id string" in TABLES[name]]


def partitions(table: str) -> list[str]:
    """Partition columns of a stored table."""
    return ["batch_id", "run_id"] if table in RUN_TABLES else ["batch_id"] if table in BATCH_TABLES else []
