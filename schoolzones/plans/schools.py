"""Approved schools with position, locale class and catchment radius."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import classify, constants as K, geo, text
from ..operators import filters, joins, reshape


def approved_schools(enrolment: DataFrame, contacts: DataFrame) -> DataFrame:
    """High schools by grade span, without the schools whose name marks them as alternative.

    All rows sharing an id with an alternative school go. Address and position come from the
    contact list; a school that is not listed keeps NULLs.
    """
    spanned = enrolment.withColumn(
        "unique_school_id", text.composite_key("system_id", "school_id")
    ).filter(filters.grade_span("grade_range"))
    alternative = spanned.filter(
        filters.ilike_any(
            {"school_name": K.SCHOOL_NAME_PATTERNS, "system_name": K.SYSTEM_NAME_PATTERNS}
        )
    )
    kept = joins.delete_in(spanned, alternative, "unique_school_id")
    places = contacts.select(
        text.composite_key("district_id", "school_id").alias("unique_school_id"),
        "school_address",
        "school_city",
        "state",
        "lat",
        "lon",
    )
    x, y = geo.conic_xy("lon", "lat")
    return (
        kept.join(places, "unique_school_id", "left").withColumn("school_x", x).withColumn("school_y", y)
    )


def buffer_lookup(existing: DataFrame) -> DataFrame:
    """Radius in miles per locale class; classes already listed keep their radius."""
    rows = existing.sparkSession.createDataFrame(K.BUFFER_MILES, "locale_type string, buffer_distance double")
    return reshape.insert_if_absent(existing, rows, "locale_type")


def default_buffers(spark) -> DataFrame:
    return spark.createDataFrame(K.BUFFER_MILES, "locale_type string, buffer_distance double")


def add_locale(schools: DataFrame, districts: DataFrame) -> DataFrame:
    """Locale code of the school's district (the smallest, if several) and its class."""
    coded = districts.select(
        text.second_part("state_district_id").try_cast("int").alias("_district"), "locale_code"
    )
    located = joins.single_match_update(schools, coded, "system_id", "_district", "locale_code")
    return located.withColumn("locale", classify.locale_class("locale_code"))


def add_buffer(schools: DataFrame, buffers: DataFrame) -> DataFrame:
    """Radius of the locale class in miles; an unknown locale has none."""
    return joins.lookup_update(schools, buffers, "locale", "locale_type", "buffer_distance")


def locale_and_buffer(schools: DataFrame, districts: DataFrame, buffers: DataFrame) -> DataFrame:
    return add_buffer(add_locale(schools, districts), buffers)
