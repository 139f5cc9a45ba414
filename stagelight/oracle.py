"""Independent SQL for every query in ``registry``, for DuckDB over the same Parquet tables."""

from __future__ import annotations

_RAW = """raw as (
  select o_orderkey + 1 as serial_no,
    case when o_orderkey % 2 = 0 then 'Female' else 'Male' end as gender,
    case when o_orderkey % 97 = 0 then null
         when c_mktsegment in ('AUTOMOBILE', 'FURNITURE', 'MACHINERY') then 'Graduate'
         else 'Not Graduate' end as education,
    cast(o_custkey % 4 as int) as experience_years,
    case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'Yes' else 'No' end as python_exp,
    case when o_orderstatus = 'P' then 'Yes' else 'No' end as internship,
    case when o_orderkey % 89 = 0 then null else cast(floor(o_totalprice / 40) as int) end as score,
    case c_nationkey % 3 when 0 then 'Urban' when 1 then 'Semiurban' else 'Rural' end as location,
    c_acctbal as salary_band,
    case when o_orderkey % 83 = 0 then null when o_orderstatus in ('F', 'P') then 1 else 0 end as offer_history,
    case when o_orderstatus = 'F' and o_totalprice > 100000 then 'Y' else 'N' end as recruitment_status,
    cast(o_orderdate as date) as ordered_on
  from orders join customer on c_custkey = o_custkey)"""

_APP = """app as (
  select serial_no as application_id, serial_no as candidate_id,
    date '2024-01-01' + cast(serial_no as int) as applied_at,
    cast(recruitment_status is not distinct from 'Y' as int) as hired,
    gender, education as education_level, experience_years as years_experience,
    cast(python_exp is not distinct from 'Yes' as int) as python_exp,
    cast(internship is not distinct from 'Yes' as int) as internship,
    score, location, salary_band, offer_history, recruitment_status, ordered_on
  from raw)"""

# Stages with their place, their days after application and their thresholds.
_EVENT = """event as (
  select application_id * 10 + s.pos as stage_event_id, application_id, s.stage_name,
    applied_at + s.days as stage_entered_at
  from app join (values (1, 'Applied', 0), (2, 'Screened', 1), (3, 'Interviewed', 7), (4, 'Offered', 14),
                        (5, 'Hired', 21)) s(pos, stage_name, days)
    on (s.pos = 1)
    or (s.pos = 2 and (score >= 4000 or education_level = 'Graduate'))
    or (s.pos = 3 and (python_exp = 1 or years_experience >= 1))
    or (s.pos = 4 and offer_history > 0)
    or (s.pos = 5 and recruitment_status = 'Y'))"""

_CLOSED = """closed as (
  select *, lead(stage_entered_at) over (partition by application_id order by stage_entered_at) as stage_exited_at
  from event)"""

_EDUCATION = """dim_education as (
  select cast(row_number() over (order by v) as int) as education_key, v as education_level
  from (select distinct education_level as v from app where education_level is not null))"""

_LOCATION = """dim_location as (
  select cast(row_number() over (order by v) as int) as location_key, v as location
  from (select distinct location as v from app where location is not null))"""

# The members of the listed dimensions with their keys.
_PYTHON = "dim_python as (select * from (values (1, 0), (2, 1)) t(python_key, has_python))"
_INTERNSHIP = "dim_internship as (select * from (values (1, 0), (2, 1)) t(internship_key, has_internship))"
_RECRUITER = """dim_recruiter as (
  select * from (values (1, 'Rita'), (2, 'Sam'), (3, 'Ava'), (4, 'Leo')) t(recruiter_key, recruiter_name))"""
_SOURCE = """dim_source as (
  select * from (values (1, 'Referral'), (2, 'LinkedIn'), (3, 'Job Board'), (4, 'Career Site'))
    t(source_key, source_name))"""
_ROLE = """dim_role as (
  select * from (values (1, 'Data Analyst'), (2, 'Data Engineer'), (3, 'ML Engineer'), (4, 'BI Analyst'))
    t(role_key, role_name))"""

_TIME = """dim_time as (
  select d as date_key, cast(year(d) as int) as year, cast((month(d) + 2) // 3 as int) as quarter,
    cast(month(d) as int) as month, cast(strftime(d, '%W') as int) as week
  from (select cast(unnest(generate_series(min(applied_at), max(applied_at), interval 1 day)) as date) as d
        from app))"""

_FACT = """fact as (
  select application_id, candidate_id, applied_at as applied_date_key, education_key, location_key, python_key,
    internship_key, cast(candidate_id % 4 + 1 as int) as recruiter_key,
    cast(candidate_id % 4 + 1 as int) as source_key, cast(candidate_id % 4 + 1 as int) as role_key,
    years_experience, score, salary_band, hired
  from app
    left join dim_education using (education_level)
    left join dim_location using (location)
    left join dim_python on has_python = python_exp
    left join dim_internship on has_internship = internship)"""

_BASE = [_RAW, _APP]
_EVENTS = [*_BASE, _EVENT]
_CLOSED_EVENTS = [*_EVENTS, _CLOSED]
_LISTED = [_PYTHON, _INTERNSHIP, _RECRUITER, _SOURCE, _ROLE]
_STAR = [*_BASE, _EDUCATION, _LOCATION, *_LISTED, _FACT]


def _with(parts: list[str], query: str) -> str:
    return "with " + ",\n".join(parts) + "\n" + query


def _ratio(part: str, whole: str) -> str:
    """Quotient of two non-negative integers, rounded half up to 3 decimals."""
    return f"((2000 * ({part}) + ({whole})) // (2 * nullif({whole}, 0))) / 1000.0"


_MEAN_DAYS = "((200 * sum(stage_exited_at - stage_entered_at) + count(*)) // (2 * count(*))) / 100.0"

_DURATIONS = f"""select stage_name, {_MEAN_DAYS} as avg_days_in_stage
from closed where stage_exited_at is not null group by stage_name"""

_FUNNEL = "select stage_name, count(distinct application_id) as apps from event group by stage_name"

_OVERALL = f"""select *,
  {_ratio("screened", "applied")} as conv_applied_to_screened,
  {_ratio("interviewed", "screened")} as conv_screened_to_interviewed,
  {_ratio("offered", "interviewed")} as conv_interviewed_to_offered,
  {_ratio("hired", "offered")} as conv_offered_to_hired,
  {_ratio("hired", "applied")} as conv_overall
from (select
  count(distinct application_id) filter (stage_name = 'Applied') as applied,
  count(distinct application_id) filter (stage_name = 'Screened') as screened,
  count(distinct application_id) filter (stage_name = 'Interviewed') as interviewed,
  count(distinct application_id) filter (stage_name = 'Offered') as offered,
  count(distinct application_id) filter (stage_name = 'Hired') as hired
  from event)"""

_FLAT = """select application_id, candidate_id, applied_at, hired, gender, education_level, years_experience,
  python_exp, internship, score, location, salary_band from app"""

_SLICE = """select role_name, source_name, recruiter_name, stage_name, count(distinct application_id) as apps
from event join fact using (application_id) join dim_role using (role_key) join dim_source using (source_key)
  join dim_recruiter using (recruiter_key)
group by all"""


def _conversion(column: str, rate: str = "conversion_rate", source: str = "app") -> str:
    return f"""select {column}, count(*) as apps, cast(sum(hired) as bigint) as hires,
  {_ratio("sum(hired)", "count(*)")} as {rate} from {source} group by {column}"""


def _cohort(day: str) -> str:
    counts = ", ".join(
        f"nullif(count(distinct application_id) filter (stage_name = '{stage}'), 0) as {stage.lower()}"
        for stage in ["Applied", "Screened", "Interviewed", "Offered", "Hired"]
    )
    return f"""select strftime({day}, '%Y-%m') as cohort_month, {counts}
from app join event using (application_id) group by cohort_month"""


def _members(key: str, value: str, dim: str, match: str) -> str:
    return f"""select {key}, {value}, count(application_id) as apps from {dim} left join app on {match}
group by {key}, {value}"""


_STAR_FLAT = """select application_id, candidate_id, applied_date_key, hired, years_experience, score, salary_band,
  education_level, location, has_python as python_exp, has_internship as internship, recruiter_name, source_name,
  role_name
from fact left join dim_education using (education_key) left join dim_location using (location_key)
  left join dim_python using (python_key) left join dim_internship using (internship_key)
  left join dim_recruiter using (recruiter_key) left join dim_source using (source_key)
  left join dim_role using (role_key)"""

# The limits of the score bands.
_BANDED = """banded as (
  select coalesce((select band from (values ('Very Low', 2500), ('Low', 4000), ('Medium', 6000), ('High', 9000))
                     b(band, ceiling) where score < ceiling order by ceiling limit 1), 'Very High') as score_band,
    hired from app)"""


def _export_lines() -> str:
    def line(name: str, columns: list[str], query: str) -> str:
        texts = [f"coalesce(regexp_replace(cast({c} as varchar), '\\.0$', ''), '')" for c in columns]
        return f"select '{name}' as export_name, {" || ',' || ".join(texts)} as line from ({query})"

    rates = ["apps", "hires", "conversion_rate"]
    return "\nunion all ".join(
        [
            line("funnel_counts", ["stage_name", "apps"], _FUNNEL),
            line("stage_durations", ["stage_name", "avg_days_in_stage"], _DURATIONS),
            line("conversion_by_education", ["education_level", *rates], _conversion("education_level")),
            line("conversion_by_location", ["location", *rates], _conversion("location")),
        ]
    )


# What each table declares, as (table, column); foreign keys add the parent table and column.
_PRIMARY = [
    ("candidates", "candidate_id"), ("applications", "application_id"), ("stage_events", "stage_event_id"),
    ("dim_education", "education_key"), ("dim_location", "location_key"), ("dim_python", "python_key"),
    ("dim_internship", "internship_key"), ("dim_recruiter", "recruiter_key"), ("dim_source", "source_key"),
    ("dim_role", "role_key"), ("dim_time", "date_key"), ("fact_application", "application_id"),
]
_VALUES = [
    ("dim_education", "education_level"), ("dim_location", "location"), ("dim_python", "has_python"),
    ("dim_internship", "has_internship"), ("dim_recruiter", "recruiter_name"), ("dim_source", "source_name"),
    ("dim_role", "role_name"),
]
_REQUIRED = [
    ("applications", "candidate_id"), ("applications", "applied_at"), ("applications", "hired"),
    ("stage_events", "application_id"), ("stage_events", "stage_name"), ("stage_events", "stage_entered_at"),
    *_VALUES,
    ("fact_application", "candidate_id"), ("fact_application", "applied_date_key"), ("fact_application", "hired"),
]
_ZERO_ONE = [("dim_python", "has_python"), ("dim_internship", "has_internship"), ("fact_application", "hired")]
_FOREIGN = [
    ("applications", "candidate_id", "candidates", "candidate_id"),
    ("stage_events", "application_id", "applications", "application_id"),
    ("fact_application", "applied_date_key", "dim_time", "date_key"),
    ("fact_application", "education_key", "dim_education", "education_key"),
    ("fact_application", "location_key", "dim_location", "location_key"),
    ("fact_application", "python_key", "dim_python", "python_key"),
    ("fact_application", "internship_key", "dim_internship", "internship_key"),
    ("fact_application", "recruiter_key", "dim_recruiter", "recruiter_key"),
    ("fact_application", "source_key", "dim_source", "source_key"),
    ("fact_application", "role_key", "dim_role", "role_key"),
]


def _violations() -> str:
    tables = {"candidates": "app", "applications": "app", "stage_events": "closed", "fact_application": "fact"}

    def rule(table: str, column: str, name: str, checked: str, violations: str) -> str:
        return f"""select '{table}' as table_name, '{column}' as column_name, '{name}' as rule,
  {checked} as rows_checked, {violations} as violations from {tables.get(table, table)} t"""

    rules = [rule(t, c, "primary_key", "count(*)", f"count(*) - count(distinct {c})") for t, c in _PRIMARY]
    rules += [rule(t, c, "not_null", "count(*)", f"count(*) - count({c})") for t, c in _REQUIRED]
    rules += [rule(t, c, "unique", f"count({c})", f"count({c}) - count(distinct {c})") for t, c in _VALUES]
    rules += [rule(t, c, "in_0_1", "count(*)", f"count(*) filter ({c} not in (0, 1))") for t, c in _ZERO_ONE]
    rules += [
        rule(t, c, "foreign_key", f"count(t.{c})", f"count(t.{c}) filter (p.k is null)")
        + f" left join (select distinct {key} as k from {tables.get(parent, parent)}) p on p.k = t.{c}"
        for t, c, parent, key in _FOREIGN
    ]
    return "\nunion all ".join(rules)


def _lasting(name: str, column: str) -> str:
    """Members numbered by the batch they first came in, then by value."""
    return f"""select cast(row_number() over (order by batch, {column}) as int) as {name}_key, {column}
from (select {column}, min(case location when 'Urban' then 1 when 'Semiurban' then 2 else 3 end) as batch
      from app where {column} is not null group by {column})"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "raw_row_count": _with([_RAW], "select count(*) as raw_rows from raw"),
        "candidates": _with(
            _BASE,
            """select candidate_id, gender, education_level, years_experience, python_exp, internship, score,
              location, salary_band from app""",
        ),
        "applications": _with(_BASE, "select application_id, candidate_id, applied_at, hired from app"),
        "base_table_counts": _with(
            _BASE,
            """select t.table_name, count(*) as row_count
               from app, (values ('candidates'), ('applications')) t(table_name) group by t.table_name""",
        ),
        "stage_events": _with(_EVENTS, "select * from event"),
        "stage_events_closed": _with(_CLOSED_EVENTS, "select * from closed"),
        "stage_counts_unfiltered": _with(_EVENTS, _FUNNEL),
        "dim_education": _with([*_BASE, _EDUCATION], "select * from dim_education"),
        "dim_location": _with([*_BASE, _LOCATION], "select * from dim_location"),
        "dim_python": _with(
            [*_BASE, _PYTHON], _members("python_key", "has_python", "dim_python", "has_python = python_exp")
        ),
        "dim_internship": _with(
            [*_BASE, _INTERNSHIP],
            _members("internship_key", "has_internship", "dim_internship", "has_internship = internship"),
        ),
        "dim_time": _with([*_BASE, _TIME], "select * from dim_time"),
        "fact_application": _with(_STAR, "select * from fact"),
        "funnel_counts": _with(_EVENTS, _FUNNEL),
        "conversion_overall": _with(_EVENTS, _OVERALL),
        "stage_durations": _with(_CLOSED_EVENTS, _DURATIONS),
        "conversion_by_education": _with(_BASE, _conversion("education_level")),
        "conversion_by_location": _with(_BASE, _conversion("location")),
        "applications_flat": _with(_BASE, _FLAT),
        "applications_flat_star": _with(_STAR, _STAR_FLAT),
        "funnel_by_slice": _with([*_STAR, _EVENT], _SLICE),
        "cohort_conversion": _with(_EVENTS, _cohort("applied_at")),
        "cohort_conversion_by_order_date": _with(_EVENTS, _cohort("ordered_on")),
        "score_band": _with([*_BASE, _BANDED], _conversion("score_band", "hire_rate", "banded")),
        "export_csv": _with(_CLOSED_EVENTS, _export_lines()),
        "constraint_violations": _with([*_STAR, _TIME, _EVENT, _CLOSED], _violations()),
    }
    for name, column in [("education", "education_level"), ("location", "location")]:
        sql[f"dim_{name}_by_batches"] = _with(_BASE, _lasting(name, column))
    sql["stored_ids"] = _with(
        [_RAW],
        """select count(*) as batch_rows, count(distinct serial_no) as batch_ids,
             count(distinct serial_no) filter (location = 'Urban') as stored_ids from raw""",
    )
    sql["constraint_violations_by_bits"] = sql["constraint_violations"]
    sql["stage_events_closed_by_batches"] = sql["stage_events_closed"]
    sql["applications_flat_star_by_batches"] = sql["applications_flat_star"]
    sql["dim_time_by_batches"] = sql["dim_time"]
    for name in [
        "funnel_by_slice",
        "cohort_conversion",
        "stage_durations",
        "conversion_overall",
        "conversion_by_education",
        "score_band",
    ]:
        sql[f"{name}_from_states"] = sql[name]
    for role, part in [("recruiter", _RECRUITER), ("source", _SOURCE), ("role", _ROLE)]:
        match = f"{role}_key = candidate_id % 4 + 1"
        sql[f"dim_{role}"] = _with([*_BASE, part], _members(f"{role}_key", f"{role}_name", f"dim_{role}", match))
    sql["fact_stage_event"] = sql["stage_events_closed"]
    sql["stage_events_closed_from_events"] = sql["stage_events_closed"]
    sql["stage_durations_star"] = sql["stage_durations"]
    for name in ["funnel_counts", "conversion_overall"]:
        sql[f"{name}_from_events"] = sql[name]
    for name in ["funnel_by_slice", "cohort_conversion"]:
        sql[f"{name}_from_facts"] = sql[f"{name}_from_buckets"] = sql[name]
    for name in [
        "stage_events",
        "fact_application",
        "conversion_by_education",
        "conversion_by_location",
        "applications_flat",
    ]:
        sql[f"{name}_from_tables"] = sql[name]
    return sql
