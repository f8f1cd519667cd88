"""Settings that decide results.

Everything here is a plain value so a run can be reproduced from the code
alone.  Change a value and every downstream table changes with it.
"""

# ---------------------------------------------------------------------------
# These must stay equal to the reference warehouse's settings,
# otherwise results stop matching it.
# ---------------------------------------------------------------------------
FINGERPRINT_BITS = 2048          # bits per fingerprint (256 bytes packed)
TOP_N = 10                       # neighbours kept per source
BATCH_ROWS = 50_000              # rows per output file / chunk
INPUT_KEY_PATTERN = r".*batch_.*\.csv$"   # matched against the whole key
INPUT_COLUMNS = [
    "compound_id", "compound_name",
    "molecular_weight", "logp",
    "ic50_nm", "assay_date", "lab_id",
]
INPUT_COLUMN_ALIASES = {
    "IC50_nM": "ic50_nm",
    "collection_date": "assay_date",
}
NAME_OVERRIDES = {
    "paracetamol": "acetaminophen",
}
# ---------------------------------------------------------------------------

# Layout of the packed fingerprint used inside Spark: 32 signed 64-bit words.
# Bit b lives in word b // 64 at position 63 - b % 64 (most significant bit
# first), so the big-endian bytes of the words are exactly the 256-byte
# MSB-first packed form.
WORD_BITS = 64
N_WORDS = FINGERPRINT_BITS // WORD_BITS

# Feature rule (the chemistry library is not available; features are words):
# lower-case, split on anything that is not a letter or a digit of any script,
# drop empty pieces, hash = first 32 bits of md5(feature) as an unsigned
# integer, bit = hash mod FINGERPRINT_BITS.  Reproducible in any SQL engine
# with md5.  Callers may pass features of their own instead.
TOKEN_SPLIT_PATTERN = r"[^\p{L}\p{N}]+"
HASH_HEX_DIGITS = 8

# Scoring: rows of a block of sources and of a block of candidates (256 bytes
# each); two blocks meet in one task.
BLOCK_SOURCES = 512
BLOCK_CANDIDATES = 4096

# Number of sources picked for the pivot view (the reference hardcodes ten).
PIVOT_SOURCES = 10

# Date forms the safe date cast accepts, tried in order: ISO with one- or
# two-digit parts (also with a time after it), month first with slashes,
# compact, and with month names.
DATE_FORMATS = ["yyyy-M-d", "yyyy-M-d H:mm:ss", "yyyy-M-d H:mm", "yyyy-M-d'T'H:mm:ss", "yyyy-M-d'T'H:mm", "yyyy/M/d",
                "M/d/yyyy", "M/d/yy", "yyyyMMdd", "d MMM yyyy", "d-MMM-yyyy", "MMM d, yyyy", "MMMM d, yyyy"]

# Text that counts as a number: decimal digits, a point and an exponent, with
# white space around; no type suffix, no hexadecimal form, no NaN or infinity.
NUMBER_PADDING = " \t\n\x0b\f\r"
NUMBER_PATTERN = r"^[ \t\n\x0B\f\r]*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\n\x0B\f\r]*$"
