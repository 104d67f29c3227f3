"""Words, labels, edges and patterns that results must match exactly."""

# --- fixed values: structured table columns, in output order -----------------
TABLE_COLUMNS = [
    "title", "category", "slug", "soc_code",
    "median_pay_annual", "median_pay_hourly",
    "entry_education", "work_experience", "training",
    "num_jobs_2024", "projected_employment_2034",
    "outlook_pct", "outlook_desc", "employment_change",
    "url",
]
MASTER_COLUMNS = ["title", "slug", "category", "url"]

# --- fixed values: report bands (name, low, high) -----------------------------
TIERS = [
    ("Minimal (0-1)", 0, 1),
    ("Low (2-3)", 2, 3),
    ("Moderate (4-5)", 4, 5),
    ("High (6-7)", 6, 7),
    ("Very high (8-10)", 8, 10),
]
PAY_BANDS = [
    ("<$35K", 0, 35000),
    ("$35-50K", 35000, 50000),
    ("$50-75K", 50000, 75000),
    ("$75-100K", 75000, 100000),
    ("$100K+", 100000, None),
]

# --- fixed values: education groups and short names ---------------------------
EDUCATION_GROUPS = [
    ("No degree / HS diploma",
     ["No formal educational credential", "High school diploma or equivalent"]),
    ("Postsecondary / Associate's",
     ["Postsecondary nondegree award", "Some college, no degree", "Associate's degree"]),
    ("Bachelor's", ["Bachelor's degree"]),
    ("Master's", ["Master's degree"]),
    ("Doctoral / Professional", ["Doctoral or professional degree"]),
]
EDUCATION_SHORT = {
    "High school diploma or equivalent": "HS diploma",
    "Bachelor's degree": "Bachelor's",
    "Master's degree": "Master's",
    "Doctoral or professional degree": "Doctoral",
    "Associate's degree": "Associate's",
    "Postsecondary nondegree award": "Postsecondary",
    "No formal educational credential": "No formal",
    "Some college, no degree": "Some college",
    "See How to Become One": "Varies",
}

# --- fixed values: page structure ----------------------------------------------
FACT_TABLE = "quickfacts"
PROJECTION_TABLE = "outlook-table"
PANES = "panes"
SECTION_TABS = ["tab-2", "tab-3", "tab-4", "tab-5", "tab-6"]
PROJECTION_TAB = "tab-6"
CHART_CLASS = "ooh-chart"
INDEX_CLASS = "a-z-list"
UPDATE_CLASS = "update"
UNTITLED = "Unknown Occupation"
NO_DATA = "Get data"
NO_CODE = "—"
PROJECTION_LABELS = [
    "Occupational Title", "SOC Code", "Employment 2024",
    "Projected Employment 2034", "Change % 2024-34", "Change Numeric 2024-34",
]
# Phrase found in a lower-cased fact label -> fact kind; the first phrase wins.
FACT_KINDS = [
    ("median pay", "pay"),
    ("entry-level education", "education"),
    ("work experience", "experience"),
    ("on-the-job training", "training"),
    ("number of jobs", "jobs"),
    ("job outlook", "outlook"),
    ("employment change", "change"),
]

# --- fixed values: text rules ----------------------------------------------------
HOURS_PER_YEAR = 2080
ALIAS_MARKS = [", see:", ", see "]
AMOUNT = r"(?U)\$([\d,]+(?:\.\d+)?)"
PERCENT_WITH_NOTE = r"(?Ud)^(-?\d+)%[\s\x1c-\x1f]*\((.+)\)"
PERCENT = r"(?U)^(-?\d+)%"
WHOLE_NUMBER = r"(?U)^-?\d+$"
# the characters of (?U)[\s\x1c-\x1f]; the first range rules most characters out at once
WHITESPACE = (
    r"[[^!-~]&&[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]+")

# --- fixed values: rating scale and outlook thresholds ---------------------------
RATING_LOW, RATING_HIGH = 0, 10
DECLINING_BELOW = 0
GROWING_FROM = 10
TEMPERATURE = 0.2

# --- fixed values: report headings --------------------------------------------------
HEADINGS = {
    "title": "AI Exposure of the US Job Market",
    "totals": "## Aggregate statistics",
    "tiers": "### Breakdown by exposure tier",
    "bands": "### Average exposure by pay band (job-weighted)",
    "groups": "### Average exposure by education level (job-weighted)",
    "down": "### BLS-projected declining occupations",
    "up": "### Fastest-growing occupations (10%+ projected growth)",
    "order": "Sorted by AI exposure (descending), then by number of jobs (descending).",
}

# --- fixed values: head and rule of each table of the report -----------------------
TABLE_HEADS = {
    "tiers": ["| Tier | Occupations | Jobs | % of jobs | Wages | % of wages | Avg pay |",
              "|------|-------------|------|-----------|-------|------------|---------|"],
    "bands": ["| Pay band | Avg exposure | Jobs |", "|----------|-------------|------|"],
    "groups": ["| Education | Avg exposure | Jobs |", "|-----------|-------------|------|"],
    "movers": ["| Occupation | Exposure | Outlook | Jobs |", "|-----------|----------|---------|------|"],
    "listing": ["| # | Occupation | Pay | Jobs | Outlook | Education | Rationale |",
                "|---|-----------|-----|------|---------|-----------|-----------|"],
}
