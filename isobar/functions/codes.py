"""Weather code labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive code ranges and their labels.
WEATHER_CODES = (
    (0, 0, "Ciel dégagé"),
    (1, 3, "Principalement dégagé, partiellement nuageux, couvert"),
    (45, 48, "Brouillard"),
    (51, 67, "Bruine et pluie"),
    (71, 77, "Neige"),
    (80, 82, "Averses"),
    (85, 86, "Averses de neige"),
    (95, 95, "Orage"),
    (96, 99, "Orage avec grêle"),
)


def weather_label(code: Column | str) -> Column:
    """Label of a weather code; null outside the listed ranges."""
    code = F.col(code) if isinstance(code, str) else code
    return F.coalesce(*(F.when(code.between(low, high), F.lit(label)) for low, high, label in WEATHER_CODES))
