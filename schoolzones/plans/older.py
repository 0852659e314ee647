"""The older school classification, extra-teacher report and disproportion index."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import classify, constants as K
from ..operators import aggregates

SCHOOL = "unique_school_id"


def school_report(rows: DataFrame, titles=K.OLDER_APPROVED_TITLES) -> DataFrame:
    """Teaching mode and extra-teacher mark per school from course rows (text as published)."""
    valid = F.col("course_title").isin(*titles)
    modes = aggregates.teaching_mode(rows, SCHOOL, "teacher_last_name")
    extra = aggregates.extra_teacher_schools(rows, SCHOOL, "certificate_id", valid)
    return modes.join(extra, SCHOOL)


def disproportion_index(df: DataFrame, groups=K.RACES) -> DataFrame:
    """Share gap per group, rounded to three digits; NULL where a total is zero."""
    return df.withColumns(
        {
            f"di_{g.lower()}": classify.rounded_share_gap(
                F.col(f"cs_{g.lower()}").cast("double"), F.col("cs_enrollment").cast("double"),
                F.col(f"total_{g.lower()}").cast("double"), F.col("total_enrollment").cast("double"),
            )
            for g in groups
        }
    )
