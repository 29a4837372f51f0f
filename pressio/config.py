"""Pipeline parameters as one immutable object.

Every operator takes column names and constants from here; the as-of day is
an explicit argument so that a run is reproducible (never ``current_date()``).
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from dataclasses import dataclass


# --- Fixed values that must equal the published pipeline's -----------------
# Source-region spellings of the vaccination feed and their canonical names.
REFERENCE_RECODE = (
    ("Friuli-Venezia Giulia", "Friuli Venezia Giulia"),
    ("Provincia Autonoma Bolzano / Bozen", "P.A. Bolzano"),
    ("Provincia Autonoma Trento", "P.A. Trento"),
    ("Valle d'Aosta / Vallée d'Aoste", "Valle d'Aosta"),
)
# Display labels of the labelled snapshot, (label, column) in the published
# order. The same column labelled twice: the last label wins.
REFERENCE_TABLE_LABELS = (
    ("Indicatore Stress", "indicatore_stress"),
    ("Regione", "denominazione_regione"),
    ("Totale Casi", "totale_casi"),
    ("Casi TI", "terapia_intensiva"),
    ("Ricoverati con Sintomi", "ricoverati_con_sintomi"),
    ("Totale Casi (lag)", "totale_casi_lag"),
    ("Incremento (unità)", "incremento"),
    ("PL area non critica", "PL_area_non_critica"),
    ("PL TI", "PL_terapia_intensiva"),
    ("Popolazione", "popolazione"),
    ("Nuovi Vaccinati", "nuovi_vaccinati"),
    ("Vaccinati", "vaccinati"),
    ("Saturazione TI", "saturazione_ti"),
    ("Saturazione area non critica", "saturazione_area_non_critica"),
    ("Indicatore di Stress", "indicatore_stress"),
)
# Display labels of the scatter product.
REFERENCE_SCATTER_LABELS = (
    ("Vaccinati (%)", "vaccinati_perc"),
    ("Incidenza (100'000 abitanti)", "incidenza"),
)
# Parameters of the published run.
REFERENCE_TOTAL_LABEL = "Italia"
REFERENCE_SINGLE_DOSE_SUPPLIER = "Janssen"
REFERENCE_LAG_ROWS = 7
REFERENCE_EFFICACY = 0.95
REFERENCE_THRESHOLDS = (50, 150, 250)
REFERENCE_PER = 100000
REFERENCE_SNAPSHOT_LAG = 2
REFERENCE_PREVIOUS_LAG = 3
REFERENCE_LAST_DAYS = 60
REFERENCE_WEEKLY_START = dt.date(2021, 7, 5)
REFERENCE_AS_OF = dt.date(2022, 5, 19)  # the day the published files were made
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class PipelineConfig:
    """Column names and parameters of the stress-index pipeline."""

    # data model (names of the conformed inputs and of the result)
    date: str = "data"
    entity: str = "denominazione_regione"
    cases_cumulative: str = "totale_casi"
    icu: str = "terapia_intensiva"
    hospitalised: str = "ricoverati_con_sintomi"
    cases_lag: str = "totale_casi_lag"
    increment: str = "incremento"
    beds: str = "PL_area_non_critica"
    icu_beds: str = "PL_terapia_intensiva"
    population: str = "popolazione"
    supplier: str = "fornitore"
    age_band: str = "fascia_anagrafica"
    first_dose: str = "prima_dose"
    second_dose: str = "seconda_dose"
    prior_infection: str = "pregressa_infezione"
    course_total: str = "totale"
    new_vaccinated: str = "nuovi_vaccinati"
    vaccinated: str = "vaccinati"
    index: str = "indicatore_stress"

    # raw vaccination feed names (renamed on read)
    raw_vax_date: str = "data_somministrazione"
    raw_vax_entity: str = "nome_area"

    # parameters
    total_label: str = REFERENCE_TOTAL_LABEL
    single_dose_supplier: str = REFERENCE_SINGLE_DOSE_SUPPLIER
    recode: tuple = REFERENCE_RECODE
    delta: int = REFERENCE_LAG_ROWS
    efficacy: float = REFERENCE_EFFICACY
    thresholds: tuple = REFERENCE_THRESHOLDS
    per: int = REFERENCE_PER
    snapshot_lag: int = REFERENCE_SNAPSHOT_LAG
    previous_lag: int = REFERENCE_PREVIOUS_LAG
    last_days: int = REFERENCE_LAST_DAYS
    weekly_start: dt.date = REFERENCE_WEEKLY_START
    as_of: dt.date = REFERENCE_AS_OF
    table_labels: tuple = REFERENCE_TABLE_LABELS
    scatter_labels: tuple = REFERENCE_SCATTER_LABELS
    # weekly mean: "exact" (of the binary doubles, rounded once) or "avg"; see mean_by
    mean_method: str = "exact"
    # division by zero: "null" (default) or "inf" (IEEE parity with R)
    on_zero: str = "null"

    def with_(self, **changes) -> "PipelineConfig":
        return dataclasses.replace(self, **changes)

    @property
    def incidence_measures(self) -> tuple:
        return (self.cases_cumulative, self.icu, self.hospitalised)

    @property
    def dose_measures(self) -> tuple:
        return (self.first_dose, self.second_dose, self.prior_infection)

    def day(self, k: int) -> dt.date:
        """The as-of day minus ``k`` days."""
        return self.as_of - dt.timedelta(days=k)


REFERENCE = PipelineConfig()
