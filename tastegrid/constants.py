"""They must equal the published behaviour for results to agree."""

# Rating scale: play counts are mapped to [1, 5] and kept with 4 decimals.
RATING_MIN = 1.0
RATING_MAX = 5.0
RATING_DECIMALS = 4
POINTS_PER_UNIT = 10_000

# Split: share of each user's rows that goes to test, seed, fewest rows to split.
TEST_SHARE = 0.20
SPLIT_SEED = 42
MIN_ROWS_TO_SPLIT = 2

# Tags: names kept in the text column, width and document floor of the term matrix.
TOP_TAGS = 10
MAX_TERMS = 100
MIN_DOC_FREQUENCY = 2

# Evaluation: a rating from this value on counts as liked; list length; train-count bands.
LIKED_FROM = 3.5
TOP_K = 10
COLD_MAX = 5
NEAR_COLD_MAX = 20

# Composer spellings tried after the exact name, in this order.
COMPOSER_ALIASES = {
    "johann sebastian bach": ["j s bach", "js bach", "bach"],
    "ludwig van beethoven": ["beethoven"],
    "franz schubert": ["schubert"],
    "frederic chopin": ["chopin"],
    "wolfgang amadeus mozart": ["mozart"],
    "joseph haydn": ["haydn"],
    "claude debussy": ["debussy"],
    "antonin dvorak": ["dvorak"],
    "felix mendelssohn": ["mendelssohn"],
    "robert schumann": ["schumann"],
    "sergei rachmaninoff": ["rachmaninoff", "rachmaninov"],
}

# Text patterns.  WHITESPACE spells out what a Unicode-aware \s matches.
WHITESPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"
NOT_PRINTABLE_ASCII = r"[^\x20-\x7E]+"
NOT_IN_TAG = r"[^a-z0-9+\-]+"
TOKEN_EDGES = "+-"

# Audio feature columns of one recording, in output order.
AUDIO_FEATURES = [
    *[f"mfcc_{i}_{s}" for i in range(1, 21) for s in ("mean", "std")],
    "tempo",
    "rms_mean",
    *[f"chroma_{i}_mean" for i in range(1, 13)],
    *[f"contrast_{i}_mean" for i in range(1, 8)],
]
