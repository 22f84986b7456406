"""Run parameters and the zone-level configuration."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# ---- fixed values: zone levels, their code columns and gold tables ----
# level of silver.viajes -> (code column in the relations file, INE column,
# singular level name in the place catalogue, gold table name)
ZONE_LEVELS = ("municipios", "distritos", "gaus")


@dataclass(frozen=True)
class ZoneSpec:
    level: str          # plural, as in silver.viajes.tipo_zona
    mitma_col: str      # code column used by the trip files
    ine_col: str        # official code column it resolves to
    place_level: str    # singular, as in silver.lugares.tipo_zona
    gold_table: str


ZONES: dict[str, ZoneSpec] = {
    "municipios": ZoneSpec("municipios", "municipio_mitma", "municipio_ine", "municipio", "mobility_municipios_periodo"),
    "distritos": ZoneSpec("distritos", "distrito_mitma", "distrito_ine", "distrito", "mobility_distritos_periodo"),
    "gaus": ZoneSpec("gaus", "gau_mitma", "distrito_ine", "gau", "mobility_gaus_periodo"),
}

# ---- fixed values: default run parameters of the business questions ----
DEFAULT_POLYGON = "POLYGON((-0.5513 39.5784, -0.2104 39.5784, -0.2104 39.3175, -0.5513 39.3175, -0.5513 39.5784))"
DEFAULT_START_DATE = "2023-01-01"
DEFAULT_END_DATE = "2023-01-02"
DEFAULT_ZONE = "municipios"

# Zone levels the business questions accept.
QUESTION_LEVELS = ("municipios", "distritos")


def resolve_gold_table(tipo_zona: str) -> str:
    if tipo_zona not in QUESTION_LEVELS:
        raise ValueError(f"unsupported zone level for questions: {tipo_zona!r}")
    return ZONES[tipo_zona].gold_table


@dataclass(frozen=True)
class MobilityParams:
    """Parameters of the business questions, validated at construction."""

    polygon: str = DEFAULT_POLYGON
    start_date: str = DEFAULT_START_DATE
    end_date: str = DEFAULT_END_DATE
    tipo_zona: str = DEFAULT_ZONE
    k: int = 3
    seed: int = 42
    # False: places of every level join on id, as the reference does (an id
    # present at several levels repeats trips).  True: only places of the
    # question's level, and one population / income value per id.
    zone_filter: bool = False

    def __post_init__(self) -> None:
        resolve_gold_table(self.tipo_zona)
        d0 = _dt.date.fromisoformat(self.start_date)
        d1 = _dt.date.fromisoformat(self.end_date)
        if d1 < d0:
            raise ValueError("end_date before start_date")
        up = self.polygon.strip().upper()
        if not (up.startswith("POLYGON") or up.startswith("MULTIPOLYGON")):
            raise ValueError("polygon must be POLYGON or MULTIPOLYGON WKT")
        if self.k < 1:
            raise ValueError("k must be positive")
