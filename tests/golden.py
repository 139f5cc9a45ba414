"""A made-up raw table of 614 rows that yields the published results."""

from stagelight.schemas import RAW

# Education, score, passes the Interviewed / Offered / Hired rule, number of rows.
GROUPS = [
    ("Graduate", 3000, 1, 1, 1, 221),
    ("Graduate", 3000, 1, 1, 0, 72),
    ("Graduate", 3000, 1, 0, 1, 26),
    ("Graduate", 3000, 1, 0, 0, 12),
    ("Graduate", 3000, 0, 1, 1, 55),
    ("Graduate", 3000, 0, 1, 0, 25),
    ("Graduate", 3000, 0, 0, 1, 38),
    ("Graduate", 3000, 0, 0, 0, 31),
    ("Not Graduate", 4000, 1, 1, 1, 27),
    ("Not Graduate", 4000, 1, 1, 0, 15),
    ("Not Graduate", 3999, 1, 1, 1, 38),
    ("Not Graduate", 3999, 1, 1, 0, 12),
    ("Not Graduate", 3999, 1, 0, 1, 4),
    ("Not Graduate", 3999, 1, 0, 0, 2),
    ("Not Graduate", 3999, 0, 1, 1, 7),
    ("Not Graduate", 3999, 0, 1, 0, 3),
    ("Not Graduate", 3999, 0, 0, 1, 6),
    ("Not Graduate", 3999, 0, 0, 0, 20),
]
# Locations of the rows with and without a hire, in order.
LOCATIONS = {
    1: ["Rural"] * 110 + ["Semiurban"] * 179 + ["Urban"] * 133,
    0: ["Rural"] * 69 + ["Semiurban"] * 54 + ["Urban"] * 69,
}

# The published results.
FUNNEL = [("Applied", 614), ("Screened", 522), ("Interviewed", 429), ("Offered", 475), ("Hired", 422)]
DURATIONS = [("Screened", 8.22), ("Interviewed", 7.51), ("Offered", 7.0), ("Applied", 1.99)]
BY_EDUCATION = [("Graduate", 480, 340, 0.708), ("Not Graduate", 134, 82, 0.612)]
BY_LOCATION = [("Rural", 179, 110, 0.615), ("Semiurban", 233, 179, 0.768), ("Urban", 202, 133, 0.658)]
OVERALL = (614, 522, 429, 475, 422, 0.85, 0.822, 1.107, 0.888, 0.687)


def raw_rows():
    rows, places = [], {hired: iter(names) for hired, names in LOCATIONS.items()}
    for education, score, interviewed, offered, hired, n in GROUPS:
        for _ in range(n):
            rows.append(
                {
                    "serial_no": len(rows) + 1,
                    "gender": "Female",
                    "education": education,
                    "experience_years": 0,
                    "python_exp": "Yes" if interviewed else "No",
                    "internship": "No",
                    "score": score,
                    "location": next(places[hired]),
                    "salary_band": 1.5,
                    "offer_history": offered,
                    "recruitment_status": "Y" if hired else "N",
                }
            )
    return rows


def golden_raw(spark):
    return spark.createDataFrame(raw_rows(), RAW).repartition(5, "location")
