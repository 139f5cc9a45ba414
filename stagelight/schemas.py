"""Table schemas, and the fixed values that define stages, bands and dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# First day of the calendar and the name of every stage, recruiter, source and role.
BASE_DATE = dt.date(2024, 1, 1)
STAGE_NAMES = ["Applied", "Screened", "Interviewed", "Offered", "Hired"]
RECRUITERS = ["Rita", "Sam", "Ava", "Leo"]
SOURCES = ["Referral", "LinkedIn", "Job Board", "Career Site"]
ROLES = ["Data Analyst", "Data Engineer", "ML Engineer", "BI Analyst"]
# Each band holds the scores below its limit; the last band takes all other rows, NULL included.
SCORE_BANDS = [("Very Low", 2500), ("Low", 4000), ("Medium", 6000), ("High", 9000), ("Very High", None)]


class Stage(NamedTuple):
    """One stage of the funnel.

    ``reads`` names the table that holds the columns ``passes`` needs: "applications", "candidates" or "raw".
    Stages are independent of each other: an application can be Offered without being Interviewed.
    """

    name: str
    days: int
    reads: str
    passes: Callable[[], Column]


# The days after application and the thresholds of every stage, in the order of the funnel.
STAGES = [
    Stage("Applied", 0, "applications", lambda: F.lit(True)),
    Stage("Screened", 1, "candidates", lambda: (F.col("score") >= 4000) | (F.col("education_level") == "Graduate")),
    Stage("Interviewed", 7, "candidates", lambda: (F.col("python_exp") == 1) | (F.col("years_experience") >= 1)),
    Stage("Offered", 14, "raw", lambda: F.col("offer_history") > 0),
    Stage("Hired", 21, "raw", lambda: F.col("recruitment_status") == "Y"),
]


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_long, _int, _text, _real, _date = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.DateType()

RAW = _table(
    serial_no=_long,
    gender=_text,
    education=_text,
    experience_years=_int,
    python_exp=_text,
    internship=_text,
    score=_int,
    location=_text,
    salary_band=_real,
    offer_history=_int,
    recruitment_status=_text,
)

# The raw file's own column names, in the order of RAW.
RAW_SOURCE_NAMES = [
    "Serial_no",
    "Gender",
    "Education",
    "Experience_Years",
    "Python_exp",
    "Internship",
    "Score",
    "Location",
    "Salary * 10E4",
    "Offer_History",
    "Recruitment_Status",
]

TABLES = {
    "candidates": _table(
        candidate_id=_long,
        gender=_text,
        education_level=_text,
        years_experience=_int,
        python_exp=_int,
        internship=_int,
        score=_int,
        location=_text,
        salary_band=_real,
    ),
    "applications": _table(application_id=_long, candidate_id=_long, applied_at=_date, hired=_int),
    "stage_events": _table(
        stage_event_id=_long,
        application_id=_long,
        stage_name=_text,
        stage_entered_at=_date,
        stage_exited_at=_date,
    ),
    "dim_education": _table(education_key=_int, education_level=_text),
    "dim_location": _table(location_key=_int, location=_text),
    "dim_python": _table(python_key=_int, has_python=_int),
    "dim_internship": _table(internship_key=_int, has_internship=_int),
    "dim_recruiter": _table(recruiter_key=_int, recruiter_name=_text),
    "dim_source": _table(source_key=_int, source_name=_text),
    "dim_role": _table(role_key=_int, role_name=_text),
    "dim_time": _table(date_key=_date, year=_int, quarter=_int, month=_int, week=_int),
    "fact_application": _table(
        application_id=_long,
        candidate_id=_long,
        applied_date_key=_date,
        education_key=_int,
        location_key=_int,
        python_key=_int,
        internship_key=_int,
        recruiter_key=_int,
        source_key=_int,
        role_key=_int,
        years_experience=_int,
        score=_int,
        salary_band=_real,
        hired=_int,
    ),
    "fact_stage_event": _table(
        stage_event_id=_long,
        application_id=_long,
        stage_name=_text,
        stage_entered_at=_date,
        stage_exited_at=_date,
    ),
}


class Rules(NamedTuple):
    """Declared constraints of one table; ``foreign`` maps a column to (parent table, parent column)."""

    key: str
    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    foreign: dict[str, tuple[str, str]] = {}


def _dim(key: str, value: str, is_flag: bool = False) -> Rules:
    return Rules(key, required=(value,), unique=(value,), flags=(value,) if is_flag else ())


# The constraints each table declares.
CONSTRAINTS = {
    "candidates": Rules("candidate_id"),
    "applications": Rules(
        "application_id",
        required=("candidate_id", "applied_at", "hired"),
        foreign={"candidate_id": ("candidates", "candidate_id")},
    ),
    "stage_events": Rules(
        "stage_event_id",
        required=("application_id", "stage_name", "stage_entered_at"),
        foreign={"application_id": ("applications", "application_id")},
    ),
    "dim_education": _dim("education_key", "education_level"),
    "dim_location": _dim("location_key", "location"),
    "dim_python": _dim("python_key", "has_python", is_flag=True),
    "dim_internship": _dim("internship_key", "has_internship", is_flag=True),
    "dim_recruiter": _dim("recruiter_key", "recruiter_name"),
    "dim_source": _dim("source_key", "source_name"),
    "dim_role": _dim("role_key", "role_name"),
    "dim_time": Rules("date_key"),
    "fact_application": Rules(
        "application_id",
        required=("candidate_id", "applied_date_key", "hired"),
        flags=("hired",),
        foreign={
            "applied_date_key": ("dim_time", "date_key"),
            "education_key": ("dim_education", "education_key"),
            "location_key": ("dim_location", "location_key"),
            "python_key": ("dim_python", "python_key"),
            "internship_key": ("dim_internship", "internship_key"),
            "recruiter_key": ("dim_recruiter", "recruiter_key"),
            "source_key": ("dim_source", "source_key"),
            "role_key": ("dim_role", "role_key"),
        },
    ),
}
