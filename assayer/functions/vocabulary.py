"""Fixed values of the classification task."""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Ordered label vocabulary; a label's position is its integer code.
LABELS = ("negative", "neutral", "positive")

# Spellings accepted in labeled input besides the vocabulary itself.
LABEL_ALIASES = {"bearish": "negative", "mixed": "neutral", "bullish": "positive"}

# A prediction containing one of these (as a substring) is flagged.
UNSUPPORTED_TOKENS = ("buy", "sell", "upgrade", "downgrade", "price target")

# Prompt around the stripped text.
PROMPT_HEAD = "Classify the financial sentiment as negative, neutral, or positive.\nText: "
PROMPT_TAIL = "\nLabel:"

# Unicode code points that count as whitespace when texts are stripped or split.
WHITESPACE_CODES = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)

# Decimal places of reported metrics.
METRIC_DIGITS = 4
LATENCY_DIGITS = 2

# Defaults of dataset building and evaluation.
DEFAULT_SEED = 7
DEFAULT_TEST_SIZE = 0.2
DEFAULT_BINS = 10
SOURCE_ID_PREFIX = "fpb-"
EXAMPLE_ID_PREFIX = "ex-"
ABLATION_ID_FORMAT = "ablation-%03d"
# ----------------------------------------------------------------------------

WHITESPACE = "".join(map(chr, WHITESPACE_CODES))
