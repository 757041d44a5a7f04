"""Values that results must carry literally, kept in one place."""

# ---- fixed values: landing folders per domain -------------------------------
LANDING_FOLDERS = {
    "guests": "guests",
    "reservations": "reservations",
    "rooms": "rooms",
    "housekeeping": "housekeeping_maintenance",
    "billing": "billing_payments",
}

# ---- fixed values: text read as NULL in CSV fields --------------------------
NULL_TOKENS = ("NULL", "null", "")

# ---- fixed values: accepted e-mail shape ------------------------------------
EMAIL_LIKE = "%@%.%"

# ---- fixed values: status names after normalisation -------------------------
CONFIRMED = "Confirmed"
CANCELLED = "Cancelled"
NO_SHOW = "No_Show"
COMPLETED = "Completed"
CLEANING = "CLEANING"
MAINTENANCE = "MAINTENANCE"

# ---- fixed values: audit error types and texts ------------------------------
DEDUP = "DEDUP"
REF_INTEGRITY = "REF_INTEGRITY"
TEMPORAL = "TEMPORAL"
VALUE = "VALUE"
GUEST_MISSING = "guest_id not in GUESTS"
ROOM_MISSING = "room_id not in ROOMS"
RESERVATION_MISSING = "reservation_id not in RESERVATIONS"

# ---- fixed values: anomaly rule names ---------------------------------------
DOUBLE_BOOKING = "DOUBLE_BOOKING"
HK_SLA_BREACH = "HK_SLA_BREACH"
MAINTENANCE_OVERDUE = "MAINTENANCE_OVERDUE"
BILLING_MISMATCH = "BILLING_MISMATCH"
SUSPICIOUS_CANCELLATION = "SUSPICIOUS_CANCELLATION"

# ---- fixed values: business thresholds --------------------------------------
SLA_MINUTES = 120
OVERDUE_HOURS = 24
BILLING_TOLERANCE = 10
CANCELLATION_LIMIT = 3
CANCELLATION_HOURS = 24

# ---- fixed values: date dimension -------------------------------------------
DATE_DIM_START = "2020-01-01"
DATE_DIM_DAYS = 3650

# ---- fixed values: hotel attributes without a source ------------------------
UNKNOWN = "Unknown"

# ---- fixed values: masking --------------------------------------------------
PRIVILEGED_ROLE = "ACCOUNTADMIN"
EMAIL_MASK_PATTERN = r"(.{2}).+(@.+)"
EMAIL_MASK_REPLACEMENT = "$1***$2"
PHONE_MASK_PREFIX = "XXXXXX"
PHONE_VISIBLE_DIGITS = 4

# ---- fixed values: characters after which a word starts (plus white space) --
WORD_BREAKS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"
