"""Reference dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Source systems.
SOURCES = [(1, "qMS"), (2, "Инфоклиника")]
# Business units.
BUSINESS_UNITS = [
    (1, 'ОО ФК "Хадасса Медикал ЛТД"'),
    (2, 'ООО "Медскан"'),
    (3, 'ООО "Клинический госпиталь на Яузе"'),
]
# Identity document types.
DOCUMENT_TYPES = [
    (1, "Паспорт"), (2, "Паспорт СССР"), (3, "Заграничный паспорт РФ"),
    (4, "Заграничный паспорт СССР"), (5, "Свидетельство о рождении"),
    (6, "Удостоверение личности офицера"),
    (7, "Справка об освобождении из места лишения свободы"), (8, "Военный билет"),
    (9, "Дипломатический паспорт РФ"), (10, "Иностранный паспорт"), (11, "Свидетельство беженца"),
    (12, "Вид на жительство"), (13, "Удостоверение беженца"), (14, "Временное удостоверение"),
    (15, "Паспорт моряка"), (16, "Военный билет офицера запаса"), (17, "Иные документы"),
]
TABLES = {"sources": SOURCES, "businessunits": BUSINESS_UNITS, "documenttypes": DOCUMENT_TYPES}


def ref_dims(spark: SparkSession) -> dict[str, DataFrame]:
    """The three dimensions (2, 3 and 17 rows: safe to broadcast at any data size)."""
    return {k: spark.createDataFrame(v, "id int, name string") for k, v in TABLES.items()}
