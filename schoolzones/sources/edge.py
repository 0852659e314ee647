"""Published column headings of each input table and the names used inside."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Headings of the published files.
ENROLMENT = {
    "SYSTEM_ID": "system_id",
    "SCHOOL_ID": "school_id",
    "SYSTEM_NAME": "system_name",
    "SCHOOL_NAME": "school_name",
    "GRADE_RANGE": "grade_range",
    "Total Student Count": "total_enrollment",
    "Race: Asian": "asian",
    "Race: Black": "black",
    "Race: White": "white",
    "Ethnicity: Hispanic": "hispanic",
    "Female": "female",
    "Male": "male",
}
CONTACTS = {
    "District ID": "district_id",
    "School ID": "school_id",
    "School Address": "school_address",
    "School City": "school_city",
    "State": "state",
    "lat": "lat",
    "lon": "lon",
}
DISTRICTS = {"State District ID": "state_district_id", "Locale Code": "locale_code"}
ZONES = {"GEOID": "geoid", "cbgpolygeom": "rings"}
COURSES = {
    "SYSTEM_ID": "system_id",
    "SCHOOL_ID": "school_id",
    "COURSE_NUMBER": "course_number",
    "COURSE_TITLE": "course_title",
    "COURSE_TAKER_CT": "takers",
    "Race: Asian": "asian",
    "Race: Black": "black",
    "Race: White": "white",
    "Ethnicity: Hispanic": "hispanic",
    "Female": "female",
    "Male": "male",
}
ROSTER = {
    "SYSTEM_ID": "system_id",
    "SCHOOL_ID": "school_id",
    "COURSE_NUMBER": "course_number",
    "COURSE_TITLE": "course_title",
    "TEACHER_LAST_NAME": "teacher_last_name",
    "CERTIFICATE_ID": "certificate_id",
}
COURSE_LOGIC = {
    "unique_school_id": "UNIQUESCHOOLID",
    "course_number": "COURSE_NUMBER",
    "course_title": "COURSE_TITLE",
    "approved_flag": "approved_flag",
    "certified_flag": "certified_flag",
    "course_logic": "COURSE_LOGIC",
    "certificate_id": "CERTIFICATE_ID",
    "teacher_last_name": "TEACHER_LAST_NAME",
    "is_virtual": "is_virtual",
}
REPRESENTATION = {
    "unique_school_id": "UNIQUESCHOOLID",
    "cs_enrollment": "CS_Enrollment",
    "cs_asian": "CS_Asian",
    "cs_black": "CS_Black",
    "cs_white": "CS_White",
    "cs_hispanic": "CS_Hispanic",
    "cs_female": "CS_Female",
    "cs_male": "CS_Male",
    "certified_teachers": "Certified_Teachers",
    "ri_asian": "RI_Asian",
    "ri_black": "RI_Black",
    "ri_hispanic": "RI_Hispanic",
    "ri_white": "RI_White",
    "ri_female": "RI_Female",
    "logic_class": "LOGIC_CLASS",
    "logic_class_2": "LOGIC_CLASS_2",
}


def inside(df: DataFrame, headings: dict[str, str]) -> DataFrame:
    """Rename published headings; other columns are carried along."""
    return df.select(*[F.col(f"`{c}`").alias(headings.get(c, c)) for c in df.columns])


def published(df: DataFrame, headings: dict[str, str]) -> DataFrame:
    """Keep and rename the published columns."""
    return df.select(*[F.col(c).alias(name) for c, name in headings.items()])
