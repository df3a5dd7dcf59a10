"""Values that have to equal the published behaviour for right results."""

# Text standing in for NULL inside a surrogate key.
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"

# Month names as they occur in release file names and page headers.
MONTH_NAMES = [
    "january",
    "february",
    "march",
    "april",
    "may",
    "june",
    "july",
    "august",
    "september",
    "october",
    "november",
    "december",
]

# Pattern of one printed number (sign, thousands commas, decimals).
NUMBER_PATTERN = r"[+-]?\p{Nd}+(?:,\p{Nd}{3})*(?:\.\p{Nd}+)?"

# Start of the page footer line.
FOOTER_PREFIX = "www.acea.auto"

# Words that mark a line opening with a digit as a footnote.
FOOTNOTE_WORDS = [
    "acea estimation",
    "includes",
    "dodge",
    "maserati",
    "ram",
    "bentley",
    "bugatti",
    "lamborghini",
    "man",
]

# Region labels written to the parsed records.
REGION_ALL = "EU + EFTA + UK"
REGION_EU = "European Union (EU)"
REGION_EFTA = "EFTA"

# Header that opens the table of a report, and lines inside it that carry no data.
SECTION_HEADER = "NEW CAR REGISTRATIONS BY MANUFACTURER"
HEADER_PREFIXES = ["% SHARE", "% CHANGE"]
YEAR_HEADER = "2025 2024"
HEADER_LINES = ["(EU)", "EU", "M"]

# Label of the remainder row, and the least count of numbers on a data line.
REMAINDER_LABEL = "Others"
MIN_NUMBERS = 9

# The nine metrics of the mart, in output order.
METRICS = [
    "UNITS",
    "YTD",
    "TTM",
    "UNITS_PoP",
    "YTD_PoP",
    "TTM_PoP",
    "UNITS_YoY",
    "YTD_YoY",
    "TTM_YoY",
]
