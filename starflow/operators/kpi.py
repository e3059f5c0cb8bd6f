"""Bed KPIs by gender.

Both take the fact table and a patient dimension, and mean an inner join on
``patient_sk``.  Given current versions a fact counts once; given all versions it
counts once per version, as the KPI was first written.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Counts of a date, patient and bed, from which both KPIs follow.
PARTIALS = T.StructType(
    [
        T.StructField("admission_date", T.DateType()),
        T.StructField("patient_sk", T.StringType()),
        T.StructField("bed_id", T.IntegerType()),
        T.StructField("facts", T.LongType()),
        T.StructField("occupied", T.LongType()),
    ]
)


def partials(facts: DataFrame, *by: str) -> DataFrame:
    """Facts, and those still admitted, of each patient and bed (and ``by``).

    A fact is one row; the upsert sees to that.  Counts of several sets of facts add up.
    """
    return (
        facts.filter(F.col("patient_sk").isNotNull())
        .groupBy(*by, "patient_sk", "bed_id")
        .agg(F.count(F.lit(1)).alias("facts"), F.count_if("is_currently_admitted").alias("occupied"))
    )


def bed_occupancy(facts: DataFrame, patients: DataFrame) -> DataFrame:
    """Share of stays with the patient still admitted, in percent.

    The counts are additive, so facts are counted per patient and versions per
    (patient, gender) before the join and multiplied after it.  The join then has
    one row per patient on one side: facts times versions never exist as rows, and
    a hot patient is gone after the partial aggregate.
    """
    stays = (
        facts.filter(F.col("patient_sk").isNotNull())
        .groupBy("patient_sk")
        .agg(
            F.count("bed_id").alias("beds"),
            F.count(F.when(F.col("is_currently_admitted"), F.col("bed_id"))).alias("occupied"),
        )
    )
    return _occupancy(stays, patients)


def occupancy_of(counts: DataFrame, patients: DataFrame) -> DataFrame:
    """The same from :func:`partials`."""
    has_bed = F.col("bed_id").isNotNull()
    stays = counts.groupBy("patient_sk").agg(
        *[F.sum(F.when(has_bed, F.col(c)).otherwise(0)).alias(name) for c, name in (("facts", "beds"), ("occupied", "occupied"))]
    )
    return _occupancy(stays, patients)


def _occupancy(stays: DataFrame, patients: DataFrame) -> DataFrame:
    versions = patients.groupBy("patient_sk", "gender").agg(F.count(F.lit(1)).alias("versions"))
    totals = (
        stays.join(versions, "patient_sk")
        .groupBy("gender")
        .agg(
            F.sum(F.col("beds") * F.col("versions")).alias("beds"),
            F.sum(F.col("occupied") * F.col("versions")).alias("occupied"),
        )
    )
    share = F.try_divide(F.col("occupied").cast("double"), F.col("beds").cast("double"))
    return totals.select("gender", (share * 100).alias("bed_occupancy_percent"))


def bed_turnover(facts: DataFrame, patients: DataFrame) -> DataFrame:
    """Distinct facts per distinct bed."""
    return turnover_of(partials(facts), patients)


def turnover_of(counts: DataFrame, patients: DataFrame) -> DataFrame:
    """The same from :func:`partials`.

    A distinct count does not see how often a fact is repeated, so one row per
    (patient, gender) stands for all versions, and a fact belongs to one patient: counts
    meet the patients once and are added up, beside one distinct count of beds.  A hot
    patient is a row for each bed by then.  Facts whose ids collide count each, as they should.
    """
    genders = patients.select("patient_sk", "gender").distinct()
    totals = counts.join(genders, "patient_sk").groupBy("gender")
    totals = totals.agg(F.sum("facts").alias("facts"), F.count_distinct("bed_id").alias("beds"))
    rate = F.try_divide(F.col("facts").cast("double"), F.col("beds").cast("double"))
    return totals.select("gender", rate.alias("bed_turnover_rate"))
