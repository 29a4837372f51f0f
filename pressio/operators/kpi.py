"""The stress-index columns (K1-K20), in the published order of operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions import as_col, ratio, round_r
from .conform import map_numeric


def kpi_steps(cfg: PipelineConfig) -> list:
    """KPI definitions grouped by dependency level: a list of levels, each a
    list of ``(name, Column)``; a level reads only columns of earlier levels.

    Operation order is kept as published (it decides the last binary digit,
    and with it ties of the final rounding). ``1 - efficacy`` stays a double
    expression (0.050000000000000044, not 0.05).
    """
    c = as_col
    z = cfg.on_zero
    per = float(cfg.per)
    pop_per = c(cfg.population) / F.lit(per)
    t0 = cfg.thresholds[0]
    level1 = [
        ("incidenza", ratio(c(cfg.increment), pop_per, z)),
        ("saturazione_ti", ratio(c(cfg.icu), c(cfg.icu_beds), z)),
        ("saturazione_area_non_critica", ratio(c(cfg.hospitalised), c(cfg.beds), z)),
    ]
    level1 += [(f"casi_soglia_{t}", pop_per * F.lit(float(t))) for t in cfg.thresholds]
    level1 += [("vaccinati_suscettibili",
                round_r(c(cfg.vaccinated) * F.lit(1.0 - cfg.efficacy), 0))]
    level2 = [("suscettibili",
               round_r(c(cfg.population) - c(cfg.vaccinated) + c("vaccinati_suscettibili"), 0))]
    level3 = [(f"casi_soglia_{t}_suscettibili",
               c("suscettibili") / F.lit(per) * F.lit(float(t))) for t in cfg.thresholds]
    level4 = [(f"soglia_{t}_effettiva",
               round_r(ratio(c(f"casi_soglia_{t}_suscettibili"), pop_per, z), 0))
              for t in cfg.thresholds]
    level4 += [("moltiplicatore_vaccini",
                ratio(c(f"casi_soglia_{t0}"), c(f"casi_soglia_{t0}_suscettibili"), z))]
    level5 = [(f"soglia_{t}_equivalente",
               round_r(F.lit(float(t)) * c("moltiplicatore_vaccini"), 0))
              for t in cfg.thresholds]
    level6 = [(cfg.index, ratio(c("incidenza"), c(f"soglia_{t0}_equivalente"), z))]
    return [level1, level2, level3, level4, level5, level6]


def stress_kpis(df: DataFrame, cfg: PipelineConfig, final_round: bool = True) -> DataFrame:
    """Add K1-K19, then round every numeric column to 2 decimals.

    K19 divides the *unrounded* incidence; the 2-decimal rounding comes last.
    Integer columns are unchanged by rounding and stay integers.
    """
    out = df
    for level in kpi_steps(cfg):
        out = out.withColumns(dict(level))
    if final_round:
        out = map_numeric(out, lambda x: round_r(x, 2), only_fractional=True)
    return out
