"""Synthetic edge rows of the fixtures: NULL branches, NULL keys, zero
denominators, negative increments."""

import datetime as dt

from pressio import REFERENCE
from pressio.operators import stress_kpis, sum_by
from pressio.plans.result import completed_courses

CARRIED = ("data date, denominazione_regione string, totale_casi long, terapia_intensiva long, "
           "ricoverati_con_sintomi long, totale_casi_lag long, incremento long, "
           "PL_area_non_critica long, PL_terapia_intensiva long, popolazione long, "
           "nuovi_vaccinati long, vaccinati long")


def test_null_supplier_takes_the_default_branch(spark):
    df = spark.createDataFrame([(None, 5, 7, 1), ("Janssen", 5, 7, 1), ("Pfizer", 5, 7, 1)],
                               "fornitore string, prima_dose long, seconda_dose long, "
                               "pregressa_infezione long")
    got = [r["totale"] for r in completed_courses(df, REFERENCE).collect()]
    assert got == [8, 6, 8]


def test_null_group_key_is_its_own_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("A", 5)], "k string, x long")
    got = {r["k"]: r["x"] for r in sum_by(df, ["k"]).collect()}
    assert got == {None: 3, "A": 5}


def test_kpis_with_zero_denominators_and_negative_increment(spark):
    d = dt.date(2022, 5, 17)
    rows = [
        (d, "zero_pop", 10, 1, 1, 5, 5, 10, 10, 0, 1, 0),
        (d, "zero_beds", 10, 1, 1, 5, 5, 0, 0, 100000, 1, 0),
        (d, "no_susceptible", 10, 1, 1, 5, 5, 10, 10, 100000, 1, 105263),
        (d, "falling", 10, 1, 1, 14, -4, 10, 10, 100000, 1, 50000),
    ]
    out = {r["denominazione_regione"]: r for r in
           stress_kpis(spark.createDataFrame(rows, CARRIED), REFERENCE).collect()}
    z = out["zero_pop"]
    assert z["incidenza"] is None and z["indicatore_stress"] is None
    b = out["zero_beds"]
    assert b["saturazione_ti"] is None and b["saturazione_area_non_critica"] is None
    assert b["incidenza"] == 5.0
    n = out["no_susceptible"]
    assert n["suscettibili"] == 0.0 and n["moltiplicatore_vaccini"] is None
    assert n["indicatore_stress"] is None
    f = out["falling"]
    assert f["incremento"] == -4 and f["incidenza"] == -4.0 and f["indicatore_stress"] < 0
