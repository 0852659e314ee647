"""Course and school logic codes, and the representation index per school."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import classify, constants as K, text
from ..operators import aggregates, clean, joins

SCHOOL = "unique_school_id"
COURSE_KEYS = [SCHOOL, "course_number", "course_title"]


def keyed(df: DataFrame) -> DataFrame:
    """Add the school id built from the two padded codes."""
    return clean.add_if_absent(df, SCHOOL, text.zfill_key("system_id", "school_id"))


def clean_roster(roster: DataFrame) -> DataFrame:
    """School id, numeric certificate, lower-case title and teacher, virtual flag."""
    return (
        clean.lower_text(keyed(roster), "course_title", "teacher_last_name")
        .withColumn("certificate_id", text.null_if_in("certificate_id"))
        .withColumn("certificate_id", text.to_whole_number("certificate_id"))
        .withColumn("is_virtual", text.is_virtual("teacher_last_name"))
        .select(*COURSE_KEYS, "certificate_id", "teacher_last_name", "is_virtual")
    )


def clean_courses(courses: DataFrame) -> DataFrame:
    return clean.lower_text(keyed(courses), "course_title")


def with_course_logic(merged: DataFrame, titles, suffix: str = "") -> DataFrame:
    """Approved flag, certified flag and the two-digit code."""
    approved = F.col("course_title").isin(*titles)
    return (
        merged.withColumn(f"approved_flag{suffix}", text.as_flag(approved))
        .withColumn("certified_flag", text.as_flag(F.col("certificate_id").isNotNull()))
        .withColumn(f"course_logic{suffix}", text.flags_to_code(f"approved_flag{suffix}", "certified_flag"))
    )


def course_logic(courses: DataFrame, roster: DataFrame, titles=K.APPROVED_TITLES) -> DataFrame:
    """One row per school, course and teacher with its logic code.

    Courses and roster are cleaned tables. A course without a teacher has NULL teacher
    columns and counts neither as in person nor as virtual.
    """
    merged = joins.outer_enrich(courses, roster, COURSE_KEYS)
    return with_course_logic(merged, titles).select(
        *COURSE_KEYS, "approved_flag", "certified_flag", "course_logic",
        "certificate_id", "teacher_last_name", "is_virtual",
    )


def school_logic(course_rows: DataFrame, title_lists: dict[str, list[str]], certified: str | None = None) -> DataFrame:
    """Three-digit code per school and title list: in person, virtual, extra teacher.

    ``title_lists`` maps the output column to its titles. All lists are served by one
    aggregate per school and certificate, then one per school; ``certified`` adds the number
    of certificates. Repeated rows and rows without a teacher do not change the answer, so
    the cleaned roster serves as well as the course logic table.
    """
    # Bit i of a row's mask: its title is in list i. Three aggregates then serve all lists.
    bits = [2**i for i in range(len(title_lists))]
    listed = [
        F.when(F.col("course_title").isin(*titles), bit).otherwise(0)
        for bit, titles in zip(bits, title_lists.values())
    ]
    masked = course_rows.filter(F.col(SCHOOL).isNotNull()).select(
        SCHOOL, "certificate_id", "is_virtual", sum(listed, F.lit(0)).alias("_mask")
    )
    teachers = masked.groupBy(SCHOOL, "certificate_id").agg(
        F.bit_or(F.when(~F.col("is_virtual"), F.col("_mask")).otherwise(0)).alias("_in_person"),
        F.bit_or(F.when(F.col("is_virtual"), F.col("_mask")).otherwise(0)).alias("_virtual"),
        F.bit_or("_mask").alias("_valid"),
    )
    unlisted = F.when(F.col("certificate_id").isNotNull(), F.bitwise_not("_valid")).otherwise(0)
    schools = teachers.groupBy(SCHOOL).agg(
        F.bit_or("_in_person").alias("_in_person"),
        F.bit_or("_virtual").alias("_virtual"),
        F.bit_or(unlisted).alias("_extra"),
        F.count("certificate_id").alias(certified or "_certified"),
    )
    flags = ("_in_person", "_virtual", "_extra")
    codes = [
        text.flags_to_code(*[F.col(f).bitwiseAND(bit) != 0 for f in flags]).alias(out)
        for bit, out in zip(bits, title_lists)
    ]
    return schools.select(SCHOOL, *codes, *([certified] if certified else []))


def enrolment_totals(enrolment: DataFrame) -> DataFrame:
    """Numbers of the enrolment table; masked totals are NULL, masked groups 0."""
    return keyed(enrolment).select(
        SCHOOL,
        text.to_number("total_enrollment").alias("total_enrollment"),
        *[text.number_or_zero(g).alias(f"total_{g}") for g in K.DEMOGRAPHICS],
    )


def cs_totals(courses: DataFrame, titles=K.APPROVED_TITLES) -> DataFrame:
    """Course takers per school over the approved titles."""
    sums = {"takers": "cs_enrollment", **{g: f"cs_{g}" for g in K.DEMOGRAPHICS}}
    return aggregates.group_sums(courses.filter(F.col("course_title").isin(*titles)), [SCHOOL], sums)


def with_representation_index(df: DataFrame, groups=K.RI_GROUPS) -> DataFrame:
    """RI per group: share among course takers minus share in the school."""
    return df.withColumns(
        {
            f"ri_{g}": classify.share_gap(f"cs_{g}", "cs_enrollment", f"total_{g}", "total_enrollment")
            for g in groups
        }
    )


def school_representation(
    schools: DataFrame, enrolment: DataFrame, courses: DataFrame, roster: DataFrame
) -> DataFrame:
    """RI and logic codes of every approved school.

    ``schools`` brings the ids; the other tables are raw. A school without enrolment stays
    with zero counts and NULL indices; one without course rows has the code ``000``.
    """
    courses, roster = clean_courses(courses), clean_roster(roster)
    cs = ["cs_enrollment", *[f"cs_{g}" for g in K.DEMOGRAPHICS]]
    # Only rows with enrolment are joined, so a school without any keeps a NULL total: those
    # are the schools to append, and no second pass has to look for them. The roster gives
    # codes and certificates in one pass.
    enrolled = enrolment_totals(enrolment).filter(F.col("total_enrollment") > 0)
    titles = {"logic_class": K.APPROVED_TITLES, "logic_class_2": K.EXPANDED_TITLES}
    merged = (
        schools.select(SCHOOL)
        .join(enrolled, SCHOOL, "left")
        .join(cs_totals(courses), SCHOOL, "left")
        .join(school_logic(roster, titles, "certified_teachers"), SCHOOL, "left")
        .fillna("000", subset=list(titles))
    )
    appended = F.col("total_enrollment").isNull()
    zero_if_appended = {
        c: F.when(appended, F.lit(0)).otherwise(F.col(c)) for c in [*cs, "certified_teachers"]
    }
    indexed = with_representation_index(clean.fill_zero(merged, cs))
    return indexed.withColumns(
        {**zero_if_appended, **{f"ri_{g}": F.when(~appended, F.col(f"ri_{g}")) for g in K.RI_GROUPS}}
    ).select(SCHOOL, *cs, "certified_teachers", *[f"ri_{g}" for g in K.RI_GROUPS], *titles)


def representation_by_locale(representation: DataFrame, schools: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Schools over, at and under parity per group and locale, with a Total row per group.

    All groups go through one join and one aggregate.
    """
    located = representation.select(SCHOOL, *[f"ri_{g}" for g in groups]).join(
        schools.select(SCHOOL, "locale"), SCHOOL, "left"
    )
    each = F.array(*[F.struct(F.lit(g).alias("race"), F.col(f"ri_{g}").alias("ri")) for g in groups])
    rows = located.select("locale", F.inline(each))
    return aggregates.category_counts_by(rows, "locale", "ri", ["race"])
