"""Declared schemas of the record sets."""

LABELED = "id STRING, text STRING, label STRING"
# As it arrives: the text may be in either of two fields.
LABELED_INPUT = "id STRING, text STRING, sentence STRING, label STRING"
SFT = "id STRING, prompt STRING, response STRING, text STRING, label STRING"
PREFERENCE = "id STRING, prompt STRING, chosen STRING, rejected STRING"
PREDICTION = (
    "id STRING, label STRING, prediction STRING, confidence DOUBLE, latency_ms DOUBLE"
)
