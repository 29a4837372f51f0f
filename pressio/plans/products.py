"""Published shapes derived from the full result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PipelineConfig
from ..functions import as_col, ratio, round_r, week_label, week_number
from ..operators import (as_of, compare_periods, date_range, drop_incomplete,
                         drop_last_key, map_numeric, mean_by, pivot_wide,
                         relabel, weighted_count, with_grand_total)


def snapshot(result: DataFrame, cfg: PipelineConfig, k: int | None = None) -> DataFrame:
    """Rows of the as-of day minus ``k``."""
    return as_of(result, cfg.date, cfg.as_of, cfg.snapshot_lag if k is None else k)


def snapshot_labelled(result: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The snapshot with display labels."""
    return relabel(snapshot(result, cfg), cfg.table_labels)


def snapshot_map(result: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Entity and index on the snapshot day."""
    return snapshot(result, cfg).select(as_col(cfg.entity), as_col(cfg.index))


def snapshot_scatter(result: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Index, incidence and vaccination share (rounded to 4 decimals,
    then times 100) on the snapshot day."""
    s = snapshot(result, cfg).select(
        as_col(cfg.entity), as_col(cfg.index), as_col("incidenza"),
        as_col(cfg.vaccinated), as_col(cfg.population))
    s = s.withColumn("vaccinati_perc",
                     round_r(ratio(cfg.vaccinated, cfg.population, cfg.on_zero), 4)
                     * F.lit(100.0))
    return relabel(s, cfg.scatter_labels)


def arrow(result: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """P5: index at t next to t-1, every entity of t-1 kept."""
    return compare_periods(result, cfg.entity, cfg.date, cfg.index,
                           cfg.day(cfg.snapshot_lag), cfg.day(cfg.previous_lag),
                           f"{cfg.index}_t", f"{cfg.index}_t1")


def weekly_long(result: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Weekly mean index per (week, year, entity) over [weekly_start, as_of],
    incomplete rows dropped (D3, D4, F7, A6, M3, F8), mean rounded as
    published."""
    s = date_range(result.select(as_col(cfg.date), as_col(cfg.entity), as_col(cfg.index)),
                   cfg.date, cfg.weekly_start, cfg.as_of)
    s = s.select(week_number(cfg.date).alias("week"), F.year(as_col(cfg.date)).alias("year"),
                 as_col(cfg.entity), as_col(cfg.index))
    m = mean_by(s, ["week", "year", cfg.entity], cfg.index,
                f"media_{cfg.index}", method=cfg.mean_method)
    m = drop_incomplete(m)
    return m.withColumn(f"media_{cfg.index}", round_r(f"media_{cfg.index}", 2))


def weekly_wide(result: DataFrame, cfg: PipelineConfig, names=None) -> DataFrame:
    """Weekly means pivoted to one column per entity, columns in order
    of first appearance along (week, year); ``week`` replaced by its Monday
    label; the greatest (week, year) row dropped (R1, F5, D6, F9)."""
    return weekly_wide_of(weekly_long(result, cfg), cfg, names)


def weekly_wide_of(long: DataFrame, cfg: PipelineConfig, names=None) -> DataFrame:
    """P6 from the weekly means, which are read three times (names, greatest
    week, cells): pass them materialised."""
    wide = pivot_wide(long, ["week", "year"], cfg.entity, f"media_{cfg.index}",
                      names=names, sort_names=False, order_by=["week", "year"])
    wide = map_numeric(wide, lambda x: round_r(x, 2), only_fractional=True)
    wide = drop_last_key(wide, ["week", "year"])
    return wide.withColumn("week", week_label("year", "week"))


def daily_wide(result: DataFrame, cfg: PipelineConfig, names=None) -> DataFrame:
    """The index of the last ``last_days`` days (to as_of - 2), one
    column per entity, names sorted (F7, R2)."""
    s = date_range(result.select(as_col(cfg.date), as_col(cfg.entity), as_col(cfg.index)),
                   cfg.date, cfg.day(cfg.last_days), cfg.day(cfg.snapshot_lag))
    return pivot_wide(s, [cfg.date], cfg.entity, cfg.index, names=names,
                      sort_names=True)


def population_by_entity(population_raw: DataFrame, cfg: PipelineConfig,
                         weight: str = "totale_generale",
                         out: str = "popolazione_totale") -> DataFrame:
    """P8 (inactive in the published pipeline): weighted count per entity plus the
    total row (A7, A8). Order (R4, count descending, total last) is applied
    by :func:`population_order` at the sink."""
    counts = weighted_count(population_raw, [cfg.entity], weight, out)
    return with_grand_total(counts, cfg.entity, [out], cfg.total_label)


def snapshot_order(cfg: PipelineConfig, entity: str | None = None):
    """Published row order of the snapshots: entities, the total row last."""
    e = as_col(entity or cfg.entity)
    return [(e == F.lit(cfg.total_label)).asc(), e.asc_nulls_last()]


def arrow_order(cfg: PipelineConfig):
    """Entities present at t first (total last), then those only at t-1."""
    return [as_col(cfg.date).isNull().asc()] + snapshot_order(cfg)


def weekly_order():
    """Published row order of the weekly pivot: by week number, then year.
    The week number is recovered from its Monday label (inverse of D6)."""
    jan1 = F.make_date(F.col("year"), F.lit(1), F.lit(1))
    first_sunday = F.date_add(jan1, ((F.lit(8) - F.dayofweek(jan1)) % 7).cast("int"))
    week_no = F.floor((F.datediff(F.col("week"), first_sunday) - 1) / 7) + 1
    return [week_no.asc(), F.col("year").asc()]


def population_order(cfg: PipelineConfig, out: str = "popolazione_totale"):
    return [(as_col(cfg.entity) == F.lit(cfg.total_label)).asc(), as_col(out).desc(),
            as_col(cfg.entity).asc()]
