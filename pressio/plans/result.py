"""Feeds -> full result (P1): conform, totals, series, joins, KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ..config import PipelineConfig
from ..functions import as_col, parse_day
from ..operators import (lagged_increment, natural_join,
                         recode, running_total, stress_kpis, sum_by,
                         sum_with_total, with_grand_total, with_total)


def _day(df: DataFrame, column: str):
    """The column as DATE: kept when already a date (so filters push down),
    parsed from text otherwise (D1, D2)."""
    if isinstance(df.schema[column].dataType, DateType):
        return as_col(column)
    return parse_day(as_col(column))


def prepare_incidence(raw: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Select the five incidence columns and parse the day (F1, F4, D1, D2);
    rows without a day are dropped (F12)."""
    out = raw.select(
        _day(raw, cfg.date).alias(cfg.date),
        as_col(cfg.entity),
        *[as_col(m) for m in cfg.incidence_measures],
    )
    return out.filter(as_col(cfg.date).isNotNull())


def incidence_series(prepared: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Total entity per day (A1), then the row lag and increment."""
    totals = with_total(prepared, cfg.date, cfg.entity, cfg.incidence_measures,
                        cfg.total_label)
    return lagged_increment(totals, cfg.entity, cfg.date, cfg.cases_cumulative,
                            cfg.delta, cfg.cases_lag, cfg.increment)


def conform_vaccinations(raw: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Rename the raw columns, parse the day and recode entity names
    (F2, D1, F10); rows without a day are dropped (F12)."""
    out = raw.select(
        _day(raw, cfg.raw_vax_date).alias(cfg.date),
        as_col(cfg.raw_vax_entity).alias(cfg.entity),
        as_col(cfg.age_band), as_col(cfg.supplier),
        *[as_col(m) for m in cfg.dose_measures],
    )
    out = recode(out, cfg.entity, cfg.recode)
    return out.filter(as_col(cfg.date).isNotNull())


def dose_sums(conformed: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Strict sums of the dose columns per (day, entity, supplier)."""
    return sum_by(conformed, [cfg.date, cfg.entity, cfg.supplier])


def completed_courses(sums: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Completed courses per supplier row (F11): first dose for the
    single-dose supplier, else second dose; plus prior infections."""
    single = as_col(cfg.supplier) == F.lit(cfg.single_dose_supplier)
    total = F.when(single, as_col(cfg.first_dose) + as_col(cfg.prior_infection)) \
        .otherwise(as_col(cfg.second_dose) + as_col(cfg.prior_infection))
    return sums.withColumn(cfg.course_total, total)


def prepare_vaccinations(raw: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return completed_courses(dose_sums(conform_vaccinations(raw, cfg), cfg), cfg)


def daily_vaccinations(raw: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """New completed courses per (day, entity) with a total per day.

    Which dose completes a course depends on the row's supplier alone, so it
    is chosen row by row (F11) and A4, A2 and A5 are one aggregation: the
    strict sum of a day's rows is that of its suppliers' strict sums.
    """
    rows = completed_courses(conform_vaccinations(raw, cfg), cfg)
    return sum_with_total(rows, cfg.date, cfg.entity, cfg.course_total,
                          cfg.new_vaccinated, cfg.total_label)


def vaccination_series(daily: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The running total of new completed courses."""
    return running_total(daily, cfg.entity, cfg.date, cfg.new_vaccinated,
                         cfg.vaccinated)


def dimension_with_total(dim: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The dimension plus its grand-total row (A3)."""
    measures = [cfg.beds, cfg.icu_beds, cfg.population]
    base = dim.select(as_col(cfg.entity), *[as_col(m) for m in measures])
    return with_grand_total(base, cfg.entity, measures, cfg.total_label)


def join_dimension(incidence: DataFrame, dimension: DataFrame,
                   cfg: PipelineConfig) -> DataFrame:
    """Incidence left-joined with the dimension on the entity (J1). Whether a
    side is broadcast follows from its size in bytes, as adaptive execution
    measures it."""
    return natural_join(incidence, dimension, "left")


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the session's checkpoint folder and read it back.

    For the few columns that a product filters or pivots on: it stops
    predicates on KPI columns from being rewritten into the KPI expressions
    below (O3) and is computed once where it is read more often. The folder
    is the shared one named by ``spark.checkpoint.dir``.
    """
    return df.checkpoint(eager=True)


def full_result(incidence_raw: DataFrame, vaccination_raw: DataFrame,
                dimension_raw: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The 31-column result, one row per (day, entity) of the
    vaccination side.

    J1 precedes J2 on purpose: a vaccination row without an incidence row
    gets no population and so NULL KPIs.
    """
    inc = incidence_series(prepare_incidence(incidence_raw, cfg), cfg)
    x = join_dimension(inc, dimension_with_total(dimension_raw, cfg), cfg)
    vax = vaccination_series(daily_vaccinations(vaccination_raw, cfg), cfg)
    y = natural_join(x, vax, "right", never_null=[cfg.date])
    return stress_kpis(y, cfg)
