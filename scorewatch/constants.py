"""Fixed values shared by every operator.

The strings and numbers below are the vocabulary of the monitored tables. They must equal what the
tables hold, so they are listed once, as plain text.
"""

# Class names of the binary classifier (label 1 / label 0).
POSITIVE_CLASS = "PNEUMONIA"
NEGATIVE_CLASS = "NORMAL"

# Outcome of one review, prediction first, truth second.
TRUE_POSITIVE = "true-positive"
FALSE_POSITIVE = "false-positive"
TRUE_NEGATIVE = "true-negative"
FALSE_NEGATIVE = "false-negative"
UNKNOWN_OUTCOME = "unknown"
HITS = (TRUE_POSITIVE, TRUE_NEGATIVE)
MISSES = (FALSE_POSITIVE, FALSE_NEGATIVE)
OUTCOMES = (TRUE_POSITIVE, FALSE_POSITIVE, TRUE_NEGATIVE, FALSE_NEGATIVE)

# Reviewer certainty.
CONFIRMED = "confirmed"
UNCERTAIN = "uncertain"
NEEDS_REVIEW = "needs_review"
CERTAINTY_LEVELS = (CONFIRMED, UNCERTAIN, NEEDS_REVIEW)

# Dataset splits.
SPLITS = ("train", "val", "test")

# Labels of the two halves of a correctness report.
CORRECT = "Correct"
INCORRECT = "Incorrect"

# Model families, their name patterns and display names.
TORCH_PATTERN = "%pytorch%"
CLASSIFIER_PATTERN = "%classifier%"
TORCH_FAMILY = "PyTorch"
KERAS_FAMILY = "Keras"

# File size bands (upper limits in bytes, exclusive) and their names.
SMALL_LIMIT_BYTES = 30000
MEDIUM_LIMIT_BYTES = 60000
SMALL_BAND = "Small (<30KB)"
MEDIUM_BAND = "Medium (30-60KB)"
LARGE_BAND = "Large (>60KB)"

# Thresholds and formats.
DECISION_THRESHOLD = 0.5
HIGH_CONFIDENCE = 0.8
ATTRIBUTION_BAND_MS = 5000
BATCH_ID_FORMAT = "yyyyMMdd_HHmmss"
DISPLAY_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
SOURCE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
STORAGE_PREFIX = "dbfs:"
IMAGE_SUFFIX = ".jpeg"
SCORE_PATH = "$.predictions[0][0]"
IMAGE_LINK_PREFIX = "?image="
FEEDBACK_ID_PREFIX = "fb-"
PREDICTION_ID_PREFIX = "pred-"
ID_HEX_DIGITS = 32
ID_PREVIEW_CHARS = 16

# Decision rule of the champion / challenger comparison.
CHI_SQUARE_CRITICAL_5PCT = 3.841459  # one degree of freedom, p = 0.05
MIN_REVIEWED_PER_MODEL = 30
PROMOTE = "PROMOTE"
KEEP_TESTING = "KEEP TESTING"
ROLLBACK = "ROLLBACK"

# Targets of a healthy model.
TARGET_PRECISION = 0.85
TARGET_RECALL = 0.90
TARGET_F1 = 0.87
