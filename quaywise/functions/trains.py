"""What a train number says about the train."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Band(NamedTuple):
    low: int
    high: int
    type_train: str
    categorie_service: str
    axe_geographique: str | None = None
    region_origine: str | None = None
    vitesse_max_kmh: int | None = None


# Number bands and their meaning.
BANDS = (
    Band(1, 499, "Classique GL International", "Voyageurs", axe_geographique="International"),
    Band(7000, 7999, "TGV", "Voyageurs", axe_geographique="Nord Est"),
    Band(8000, 8999, "TGV", "Voyageurs", axe_geographique="Atlantique"),
    Band(50000, 50199, "Messagerie Express", "Fret", vitesse_max_kmh=160),
    Band(52000, 52999, "Combiné", "Fret", vitesse_max_kmh=100),
    Band(70000, 99999, "Train Entier", "Fret"),
    Band(110000, 119999, "Transilien", "Voyageurs", region_origine="Paris Est / RER E"),
    Band(300000, 399999, "Machines seules", "Service"),
    Band(700000, 749999, "Train Vide (W)", "Voyageurs vides"),
    Band(750000, 799999, "Retour Vide / Acheminement", "Voyageurs vides"),
    Band(854000, 856999, "TER", "Voyageurs", region_origine="Bretagne"),
)
NOT_A_NUMBER = "Numéro non numérique – non décodable"
OUT_OF_RANGE = "Numéro inconnu ou hors plage"


#: Numbers of one bin of the join between numbers and bands.
BIN = 1000
ATTRIBUTES = (
    "type_train", "categorie_service", "axe_geographique", "region_origine", "vitesse_max_kmh",
)
BAND_SCHEMA = (
    "low bigint, high bigint, type_train string, categorie_service string, axe_geographique string, "
    "region_origine string, vitesse_max_kmh int"
)


def bands(spark: SparkSession, given: Sequence[Band] = BANDS) -> DataFrame:
    """The bands as a table."""
    return spark.createDataFrame([tuple(b) for b in given], BAND_SCHEMA)


def binned(table: DataFrame) -> DataFrame:
    """Each band once for every bin it touches, so that a range is found by an equal bin."""
    touched = F.sequence(F.floor(F.col("low") / BIN), F.floor(F.col("high") / BIN))
    return table.withColumn("bin", F.explode(touched))


def decoded(rows: DataFrame, column: str, table: DataFrame | None = None) -> DataFrame:
    """``rows`` with what the train number in ``column`` (text) says of the train.

    Bands come from a table of the columns of :data:`BAND_SCHEMA`; its bins are
    joined by equality and the range is checked within the bin. Bands must not
    overlap (``checks.overlapping_bands``): of those that do, each gives a row.
    """
    number = F.col(column)
    digits = number.rlike("^[0-9]+$")
    # numbers too long for a bigint are outside every band anyway
    value = F.when(digits, number.try_cast("bigint"))
    even = F.substring(number, -1, 1).isin("0", "2", "4", "6", "8")
    nothing = F.lit(None).cast("string")
    ranges = binned(bands(rows.sparkSession) if table is None else table)
    ranges = ranges.withColumn("plage_numero", F.concat(F.col("low").cast("string"), F.lit("–"), "high"))
    valued = rows.withColumn("_value", value).withColumn("_bin", F.floor(F.col("_value") / BIN))
    found = valued.join(
        ranges, (F.col("_bin") == F.col("bin")) & F.col("_value").between(F.col("low"), F.col("high")), "left"
    )
    return found.select(
        *rows.columns,
        F.when(digits & even, "Pair").when(digits, "Impair").alias("sens_circulation"),
        "type_train",
        nothing.alias("sous_type"),
        *ATTRIBUTES[1:],
        "plage_numero",
        *(nothing.alias(c) for c in ("code_mission", "origine_mission", "destination_mission", "periode_service")),
        F.when(~digits, NOT_A_NUMBER).when(F.col("low").isNotNull(), "").otherwise(OUT_OF_RANGE).alias("commentaire"),
    )
