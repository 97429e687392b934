"""Fixed values. They decide results, so they are stated plainly and in one place."""

# --- fixed values: posting URLs ------------------------------------------------
TRACKING_PARAMS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "src", "ref", "domain", "start", "sort_by", "pid",
]
# platform label -> host fragments
PLATFORM_HOSTS = {
    "greenhouse": ["greenhouse.io"],
    "lever": ["lever.co"],
    "workday": ["myworkdayjobs.com", "workday.com"],
}
DEFAULT_PLATFORM = "generic"
BOARD_DOMAINS = [
    "greenhouse.io", "lever.co", "workday.com", "myworkdayjobs.com",
    "linkedin.com", "indeed.com", "glassdoor.com", "ziprecruiter.com",
    "smartrecruiters.com", "icims.com", "taleo.net", "ashbyhq.com",
]
PROFILE_URL = "linkedin.com/in/"

# --- fixed values: page text -----------------------------------------------------
NOISE_TAGS = [
    "script", "style", "noscript", "header", "nav", "footer",
    "aside", "form", "iframe", "svg", "img",
]
SECTION_NOISE_TAGS = [
    "script", "style", "noscript", "header", "nav", "footer", "aside", "form",
]
SECTION_CLASSES = ["section", "page-centered"]
RESULT_LINK_CLASS = "result__a"
MAX_TEXT = 12_000
PREVIEW_CHARS = 400
ANALYSIS_CHARS = 8_000
DRAFT_POSTING_CHARS = 3_000
DRAFT_RESUME_CHARS = 4_000

# --- fixed values: job families, in order, with their search terms -------------------
JOB_FAMILIES = [
    ("Software Engineering", ["technical recruiter", "engineering recruiter"]),
    ("Data Science / ML", ["technical recruiter", "machine learning recruiter"]),
    ("Data Analytics", ["technical recruiter", "data recruiter"]),
    ("Business Analytics", ["talent acquisition", "recruiter"]),
    ("Business Development / Sales", ["sales recruiter", "talent acquisition"]),
    ("Product Management", ["technical recruiter", "product recruiter"]),
    ("Design / UX", ["design recruiter", "creative recruiter"]),
    ("DevOps / Infrastructure", ["technical recruiter", "infrastructure recruiter"]),
    ("Cybersecurity", ["security recruiter", "technical recruiter"]),
    ("Marketing", ["marketing recruiter", "talent acquisition"]),
    ("Finance / Accounting", ["finance recruiter", "talent acquisition"]),
    ("Legal / Compliance", ["legal recruiter", "talent acquisition"]),
    ("Research", ["research recruiter", "technical recruiter"]),
    ("Operations", ["operations recruiter", "talent acquisition"]),
    ("Policy / Government Affairs", ["recruiter", "talent acquisition"]),
    ("Other", ["recruiter", "talent acquisition"]),
]
DEFAULT_FAMILY = "Other"
DEFAULT_TERMS = ["recruiter", "talent acquisition"]
FALLBACK_TERM = "talent"

# --- fixed values: search backends in failover order, and their source tags -----------
BACKENDS = ["ddg", "brave", "tavily", "google_cse"]
BACKEND_SOURCES = {"ddg": "duckduckgo", "brave": "brave", "tavily": "tavily", "google_cse": "google_cse"}

# --- fixed values: names of countries and US states, never taken as a city ------------
STATES_AND_COUNTRIES = [
    "usa", "us", "united states", "uk", "united kingdom", "canada", "india",
    "china", "germany", "france", "japan", "australia", "singapore",
    "alabama", "alaska", "arizona", "arkansas", "california", "colorado",
    "connecticut", "delaware", "florida", "georgia", "hawaii", "idaho",
    "illinois", "indiana", "iowa", "kansas", "kentucky", "louisiana",
    "maine", "maryland", "massachusetts", "michigan", "minnesota",
    "mississippi", "missouri", "montana", "nebraska", "nevada",
    "new hampshire", "new jersey", "new mexico", "new york", "north carolina",
    "north dakota", "ohio", "oklahoma", "oregon", "pennsylvania",
    "rhode island", "south carolina", "south dakota", "tennessee", "texas",
    "utah", "vermont", "virginia", "washington", "west virginia",
    "wisconsin", "wyoming",
    "al", "ak", "az", "ar", "ca", "co", "ct", "de", "fl", "ga", "hi",
    "id", "il", "in", "ia", "ks", "ky", "la", "me", "md", "ma", "mi",
    "mn", "ms", "mo", "mt", "ne", "nv", "nh", "nj", "nm", "ny", "nc",
    "nd", "oh", "ok", "or", "pa", "ri", "sc", "sd", "tn", "tx", "ut",
    "vt", "va", "wa", "wv", "wi", "wy", "d.c.", "dc",
]

# --- fixed values: address patterns, most common first ----------------------------------
ADDRESS_PATTERNS = [
    "{first}.{last}",
    "{f}{last}",
    "{first}{l}",
    "{first}",
    "{f}.{last}",
    "{first}{last}",
]
# a local part: dot- or hyphen-separated segments, each starting with a letter
# a local part is such segments joined by dots or hyphens
LOCAL_SEGMENT = r"[a-z][a-z0-9]*"
SHORT_LOCAL_PART = 5

# --- fixed values: outreach ---------------------------------------------------------------
GREETING = "Hi there,"
CLOSING = "Best,"
MAX_RESULTS = 5
MAX_SEND = 3
LOOKBACK_MINUTES = 30
WAIT_SECONDS = 300
NOTICE_PAGE = 50
KEY_CHARS = 40
