"""Declared schemas of the three inputs; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType

INCIDENCE = StructType([
    StructField("data", StringType()),  # date-time text; the date token is used
    StructField("denominazione_regione", StringType()),
    StructField("totale_casi", LongType()),
    StructField("terapia_intensiva", LongType()),
    StructField("ricoverati_con_sintomi", LongType()),
])

VACCINATION = StructType([
    StructField("data_somministrazione", StringType()),  # parsed by parse_day
    StructField("nome_area", StringType()),
    StructField("fascia_anagrafica", StringType()),
    StructField("fornitore", StringType()),
    StructField("prima_dose", LongType()),
    StructField("seconda_dose", LongType()),
    StructField("pregressa_infezione", LongType()),
])

DIMENSION = StructType([
    StructField("denominazione_regione", StringType()),
    StructField("PL_area_non_critica", LongType()),
    StructField("PL_terapia_intensiva", LongType()),
    StructField("popolazione", LongType()),
])

POPULATION = StructType([
    StructField("denominazione_regione", StringType()),
    StructField("totale_generale", LongType()),
])

BY_NAME = {
    "incidence": INCIDENCE,
    "vaccination": VACCINATION,
    "dimension": DIMENSION,
    "population": POPULATION,
}
