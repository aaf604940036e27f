"""These lists, thresholds and formats must equal the published feed's for right results."""

# Words dropped from a company name before matching.
COMPANY_SUFFIXES = ["inc", "corp", "corporation", "ltd", "limited", "llc", "co", "company"]
# Legal forms dropped from the stored company name.
STORED_NAME_FORMS = ["INC", "LLC", "LTD", "GMBH"]
# Words dropped from a sector label.
SECTOR_STOP_WORDS = ["and", "the", "of", "in", "for", "services", "industry"]
# Gender notes dropped from a title.
GENDER_TAGS = ["(m/w/d)", "(m/f/d)", "(gn)"]

# Sector by company name; the first sector with a hit wins.
COMPANY_SECTOR_WORDS = {
    "technology": ["software", "tech", "data", "cloud", "ai", "digital", "cyber", "saas"],
    "finance": ["bank", "financial", "fintech", "insurance", "investment", "capital"],
    "healthcare": ["health", "medical", "pharma", "biotech", "hospital", "clinic"],
    "retail": ["retail", "ecommerce", "shop", "store", "marketplace"],
    "manufacturing": ["manufacturing", "automotive", "industrial", "engineering"],
    "education": ["education", "university", "school", "learning", "training"],
    "consulting": ["consulting", "advisory", "strategy"],
    "media": ["media", "publishing", "entertainment", "streaming"],
    "energy": ["energy", "oil", "gas", "renewable", "utility"],
    "transportation": ["logistics", "transport", "shipping", "delivery"],
}
# Sector by title; the first sector with a hit wins.
TITLE_SECTOR_WORDS = {
    "technology": ["developer", "engineer", "data scientist", "devops", "software", "programmer", "architect"],
    "finance": ["accountant", "financial analyst", "auditor", "controller", "trader"],
    "healthcare": ["nurse", "doctor", "clinician", "therapist", "medical"],
    "education": ["teacher", "professor", "instructor", "tutor"],
    "consulting": ["consultant", "advisor", "analyst"],
    "marketing": ["marketing", "brand manager", "seo", "content"],
    "sales": ["sales", "account executive", "business development"],
}
COMPANY_SECTOR_CONFIDENCE = 0.85
TITLE_SECTOR_CONFIDENCE = 0.75

# Title shapes: (pattern, canonical role, confidence), tried in order after the dictionary.
ROLE_PATTERNS = [
    (r"(?i)^(senior|sr|lead)\s*software\s*(engineer|dev)", "Senior Software Engineer", 0.9),
    (r"(?i)^(junior|jr)\s*software\s*(engineer|dev)", "Junior Software Engineer", 0.9),
    (r"(?i)^software\s*(engineer|dev)", "Software Engineer", 0.85),
    (r"(?i)^(senior|sr|lead)\s*data\s*scientist", "Senior Data Scientist", 0.9),
    (r"(?i)^data\s*scientist", "Data Scientist", 0.85),
    (r"(?i)^(senior|sr)\s*product\s*manager", "Senior Product Manager", 0.9),
    (r"(?i)^product\s*manager", "Product Manager", 0.85),
]
ROLE_THRESHOLD = 0.65
# Seniority by a word in the canonical title, first match wins.
SENIORITY_WORDS = [("Senior", "SENIOR"), ("Lead", "SENIOR"), ("Junior", "ENTRY"), ("Chief", "EXECUTIVE")]

# Identity rules: confidence of a match by each key.
IDENTITY_RULES = {"EXACT_MATCH": 1.0, "COMPOSITE_HASH": 0.95, "COMPANY_TITLE": 0.85}

# US dollars per unit of a currency, as decimal text; unknown currencies count 1.
USD_RATES = {"USD": "1.0", "EUR": "1.10", "GBP": "1.25", "CAD": "0.75", "AUD": "0.65", "INR": "0.012"}

# Days after which a quarantined record of a status is alerted, archived and deleted.
RETENTION_DAYS = {
    "REPROCESSED": {"archive": 30, "delete": 90},
    "DISCARDED": {"archive": 7, "delete": 30},
    "PENDING": {"alert": 60, "archive": 180, "delete": 365},
    "REPROCESS_FAILED": {"archive": 60, "delete": 180},
}

# Enumerations, declared once for writers and rules alike.
REMOTE_TYPES = ["REMOTE", "HYBRID", "ONSITE", "UNKNOWN"]
QUALITY_STATUSES = ["PASS", "FAIL", "WARN", "NOT_VALIDATED", "IN_PROGRESS"]
SALARY_SOURCES = ["POSTED", "INFERRED", "REPORTED"]
SALARY_PERIODS = ["ANNUAL", "MONTHLY", "HOURLY", "WEEKLY", "DAILY"]
SEVERITIES = ["ERROR", "WARNING", "INFO"]
CURRENCIES = ["USD", "EUR", "GBP", "CAD", "AUD", "INR", "JPY", "CHF", "CNY"]
SECTOR_METHODS = ["ML_MODEL", "RULE_BASED", "MANUAL", "LOOKUP", "AI_INFERENCE"]
TAXONOMY_TYPES = ["NAICS", "SIC", "CUSTOM", "INDUSTRY_STANDARD"]
REPROCESS_STATUSES = ["PENDING", "IN_PROGRESS", "RESOLVED", "DISCARDED", "REPROCESSED", "REPROCESS_FAILED"]
