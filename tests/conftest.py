"""One local session and the rebuilt fixtures."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[4]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


COHORT = (
    "student_id string, id_dossier string, filiere string, abandon int, moyenne_finale double, "
    "moyenne_partiels_s1 double, nb_ue_validees_s1 int, age int, sexe string, boursier string, "
    "nb_devoirs_total int, nb_devoirs_rendus int, connexions_lms_30j int, heures_lms_total double, "
    "ressources_consultees int, heures_travail_remunere int, commentaire_tuteur string, "
    "date_inscription string, distance_domicile_km string, taux_presence_pct string, groupe_td string, "
    "couleur_carte_etudiante string, jour_inscription string"
)


def _spread(i: int, salt: int, n: int) -> int:
    """A number below ``n`` that changes irregularly with the row."""
    return (i * 7919 + salt * 104_729 + i * i * 31) // 7 % n


def cohort_rows(n: int = 12) -> list[tuple]:
    """Rows of a made-up cohort: two programmes, every third row drops out, texts in mixed spellings."""
    out = []
    for i in range(n):
        leaves = i % 3 == 1
        out.append(
            (
                f"M{i:06d}", f"F{2 * i + 1:05d}", "Gestion" if i % 4 in (1, 2) else "Informatique", int(leaves),
                round(14.5 - 6 * leaves + _spread(i, 1, 30) / 10, 1), round(13.0 - 5 * leaves + _spread(i, 2, 40) / 10, 1),
                _spread(i, 3, 4) + 2 * (not leaves), 17 + _spread(i, 4, 9), "FM"[_spread(i, 5, 2)],
                ("oui", "non")[_spread(i, 6, 2)], 12, _spread(i, 7, 13), _spread(i, 8, 40), _spread(i, 9, 300) / 4,
                _spread(i, 10, 60), _spread(i, 11, 25), ("", "retards", None)[_spread(i, 12, 3)],
                f"{_spread(i, 13, 28) + 1:02d}/10/2023", f"{_spread(i, 14, 45)},{_spread(i, 15, 10)} km",
                f"{40 + _spread(i, 16, 61)} %", f"G{_spread(i, 17, 6)}", ("rouge", "verte")[i % 2], ("mardi", "jeudi")[_spread(i, 18, 2)],
            )
        )
    return out


@pytest.fixture(scope="session")
def cohort(spark):
    return spark.createDataFrame(cohort_rows(), COHORT)


@pytest.fixture(scope="session")
def big_cohort(spark):
    return spark.createDataFrame(cohort_rows(120), COHORT)


@pytest.fixture(scope="session")
def catalogue(spark):
    rows = [(" INFORMATIQUE", "Technologie", 75, 0.58), ("gestion ", "Commerce", 140, 0.66)]
    return spark.createDataFrame(
        rows, "filiere string, faculte string, capacite_accueil int, taux_reussite_moyen double"
    )
