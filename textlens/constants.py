"""Values that must stay equal to the behaviour being reproduced.

FIXED VALUES — these are contract values (label names, column-name priority
lists, numeric label conventions, platform order, pandas' missing-value
tokens).  Change them only together with the data they describe.
"""

from __future__ import annotations

# --- fixed values: sentiment labels and their ids (id = position) ---------
LABELS: tuple[str, ...] = ("Positive", "Neutral", "Negative")
LABEL2ID: dict[str, int] = {name: i for i, name in enumerate(LABELS)}
ID2LABEL: dict[int, str] = {i: name for i, name in enumerate(LABELS)}

# --- fixed values: CSV column resolution ----------------------------------
# text column: first name of this list that the file has
TEXT_COL_PRIORITY: tuple[str, ...] = (
    "text_clean", "text", "tweet", "sentence", "content", "comment", "full_text",
)
# label column: first column *in file order* whose name is in this set
LABEL_COLS: frozenset[str] = frozenset(
    {"sentiment", "label", "target", "class", "sentiment_label"}
)
SOURCE_COL = "source_file"

# --- fixed values: numeric label conventions ------------------------------
# default convention: 0=Positive, 1=Neutral, 2=Negative (string and integer
# codes both map)
DEFAULT_NUMERIC_LABELS: dict[str, str] = {"0": "Positive", "1": "Neutral", "2": "Negative"}
# origins whose numeric codes follow another convention (string codes only)
FILE_NUMERIC_LABELS: dict[str, dict[str, str]] = {
    "sentimen_twitter_labeled_4.csv": {"0": "Neutral", "1": "Positive", "2": "Negative"},
}

# --- fixed values: model label -> downstream sentiment enum ---------------
LABEL_TO_SENTIMENT: dict[str, str] = {
    "Positive": "positive", "Neutral": "neutral", "Negative": "negative",
}

# --- fixed values: ingest platforms, in processing order ------------------
PLATFORMS: tuple[str, ...] = ("instagram", "x", "tiktok")

# --- fixed value: the collection of batches that is ingested --------------
TARGET_COLLECTION = "posts_with_comments"

# --- fixed values: pandas' default missing-value tokens (read_csv) --------
NA_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- operating parameters (defaults of the reproduced commands) -----------
MIN_WORDS = 4
NEAR_DUP_THRESHOLD = 0.8          # cosine similarity (radius 0.2 in distance)
TEST_SIZE = 0.2
SPLIT_SEED = 42
AUDIT_THRESHOLD = 0.90
EARLY_STOP_PATIENCE = 3
