"""Fixed values the cleaning rules must share with the system they replace.

These are constants, not logic: changing any of them changes which cells
survive cleaning and therefore the row hash keys already stored in targets.
"""

# --- fixed values: keep exactly as written -----------------------------------

# A cleaned number must match this after commas are removed and spaces trimmed.
NUMERIC_PATTERN = r"^-?\d+(\.\d+)?$"

# Timestamp text that is junk: one to three letters only.
LETTERS_ONLY_PATTERN = r"^[A-Za-z]{1,3}$"

# Text is junk as a time when it is this short or carries no digit.
JUNK_MAX_LENGTH = 3
HAS_DIGIT_PATTERN = r"\d"  # our spelling of "has a digit"

# A date text in this shape takes the ISO path (future dates kept).
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"

# Characters a printed timestamp may hold; anything else marks it invalid.
TIMESTAMP_CHARS_PATTERN = r"[0-9\-:. ]"

# Oldest year a timestamp may carry; the newest is the year of as_of plus one.
MIN_YEAR = 1900
MAX_YEARS_AHEAD = 1

# Boolean tokens, compared after lower-casing and without trimming.
TRUE_TOKENS = ("true", "1", "yes", "t")
FALSE_TOKENS = ("false", "0", "no", "f")

# Text written for tokens in boolean-as-string columns.
TRUE_TEXT = "TRUE"
FALSE_TEXT = "FALSE"

# Separator of the row-hash text.
KEY_SEPARATOR = "||"

# Zone the source system's naive times are written in.
DEFAULT_SOURCE_ZONE = "America/New_York"

# --- end of fixed values -----------------------------------------------------
