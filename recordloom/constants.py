"""Fixed values that decide results: word lists, character classes, formats."""

# Characters ECMAScript counts as white space (`\s`, `trim`). Java's `\s` and
# Spark's `trim` know far fewer of them.
WS_CHARS = (
    "\t\n\x0b\f\r \u00A0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200A"
    "\u2028\u2029\u202F\u205F\u3000\uFEFF"
)
WS_BODY = r"\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"
WS = f"[{WS_BODY}]"

# Entities decoded, in this order (so "&amp;lt;" ends as "<").
ENTITIES = [
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&#34;", '"'),
]

# Boilerplate removed by the cleaner, any case.
FILLER_PHRASES = [
    "Please contact provider for more information",
    "Please contact the provider for more information",
    "For more information contact the provider",
    "National Qualification Framework (NQF)",
    "National Qualification Framework",
    "See website for details",
    "See our website for details",
    "For more information",
    "Contact provider",
    "Fees and charges apply",
    "Subject to change without notice",
    "Enrol now",
    "Limited places available",
]

# ISO-3 country codes of the work grid, and the EQF levels.
COUNTRY_CODES = [
    "ALA", "ALB", "AUT", "BEL", "BGR", "CYP", "CZE", "DNK", "EST", "FIN", "FRA", "GUF",
    "DEU", "GRC", "GLP", "HUN", "ISL", "IRL", "ITA", "LVA", "LIE", "LTU", "LUX", "MLT",
    "MTQ", "MYT", "MDA", "MNE", "NLD", "MKD", "NOR", "POL", "PRT", "REU", "ROU", "MAF",
    "SRB", "SVK", "SVN", "ESP", "SWE", "TUR", "UKR",
]
LEVELS = list(range(1, 9))

# Vocabulary prefixes and parameters of a search request.
COUNTRY_URI = "http://publications.europa.eu/resource/authority/country/"
LEVEL_URI = "http://data.europa.eu/snb/eqf/"
REQUEST_LANGUAGE = "en"
REQUEST_VERSION = "1.8"

# Crawl limits.
PAGE_SIZE = 10
LARGE_PAGE_SIZE = 150
STALL_SECONDS = 300
MILESTONE_STEP = 100
RECENT_LIMIT = 100

# Joiners of the flat text columns.
NOTE_PIPE = " | "
NOTE_SEMICOLON = " ; "
PARAGRAPH = "\n\n"
TITLE_DASH = " \u2014 "

# Columns that must be filled for a row to count as complete.
LO_REQUIRED = [
    "title",
    "countryCode.prefLabel",
    "EQFLevel.prefLabel",
    "learningOutcomeSummary.noteLiteral",
    "learningOutcome",
]
QUAL_REQUIRED = [
    "qualificationName",
    "qualificationLevel",
    "description",
    "learningOutcomes",
    "country",
]
