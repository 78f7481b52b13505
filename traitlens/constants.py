"""Fixed values.

Everything in this module is a value that must equal the source model's
for results to agree: lexicons, label texts, band thresholds, accepted
value lists and recommender vocabularies. They are stated plainly, in the
order the model states them, and are not derived from anything.
"""

# --------------------------------------------------------------------------
# FIXED VALUES: trait lexicons (lower-case; an item counts when its
# lower-cased, trimmed text is in the set). Sets overlap on purpose.
# --------------------------------------------------------------------------
LEXICONS: dict[str, tuple[str, ...]] = {
    "social": ("affectionate", "friendly", "loving", "companionable", "gentle",
               "sweet-tempered", "sociable", "outgoing", "cheerful", "happy", "joyful"),
    "energy": ("energetic", "active", "lively", "playful", "spirited", "agile",
               "boisterous", "athletic", "keen", "eager"),
    "intelligence": ("intelligent", "trainable", "obedient", "responsive", "quick",
                     "clever", "bright", "alert"),
    "protective": ("protective", "loyal", "devoted", "faithful", "watchful",
                   "territorial", "dominant", "confident", "fearless", "brave", "courageous"),
    "independent": ("independent", "stubborn", "strong willed", "aloof", "reserved",
                    "self-assured", "proud", "dignified"),
    "calm": ("calm", "quiet", "gentle", "patient", "steady", "even tempered",
             "composed", "docile", "stable"),
    "family": ("affectionate", "friendly", "gentle", "patient", "loving",
               "companionable", "familial", "trustworthy", "tolerant"),
    "working": ("hardworking", "dutiful", "reliable", "responsible", "cooperative",
                "eager", "trainable", "obedient"),
}

# Output column names of the trait dimension, per lexicon: (count, score).
LEXICON_COLUMNS: dict[str, tuple[str, str]] = {
    "social": ("social_traits_count", "social_score"),
    "energy": ("energy_traits_count", "energy_score"),
    "intelligence": ("intelligence_traits_count", "intelligence_score"),
    "protective": ("protective_traits_count", "protective_score"),
    "independent": ("independent_traits_count", "independent_score"),
    "calm": ("calm_traits_count", "calm_score"),
    "family": ("family_friendly_traits", "family_friendliness_score"),
    "working": ("working_traits_count", "working_score"),
}

# FIXED VALUES: primary category, in priority order (first maximum wins).
PRIMARY_CATEGORIES: tuple[tuple[str, str], ...] = (
    ("social", "Social/Friendly"),
    ("energy", "High-Energy/Active"),
    ("intelligence", "Intelligent/Trainable"),
    ("protective", "Protective/Guardian"),
    ("independent", "Independent/Strong-Willed"),
    ("calm", "Calm/Gentle"),
)
UNCLASSIFIED = "Unclassified"

# FIXED VALUES: family-friendliness regexes over the lower-cased raw trait text.
FAMILY_PATTERN = "friendly|gentle|patient|loving|affectionate|companionable|familial"
GUARD_PATTERN = "protective|alert|watchful|territorial|dominant"
GUARD_EXCLUDE_PATTERN = "friendly|gentle|patient"

# FIXED VALUES: activity level by group.
ACTIVITY_BY_GROUP: tuple[tuple[tuple[str, ...], str], ...] = (
    (("Sporting", "Herding"), "High"),
    (("Working", "Terrier"), "Medium-High"),
    (("Hound",), "Medium"),
    (("Toy", "Non-Sporting"), "Low-Medium"),
)
ACTIVITY_DEFAULT = "Unknown"

# FIXED VALUES: bands as (operator, bound, label), tested in order.
SIZE_BANDS = (("<=", 25, "Small"), ("<=", 60, "Medium"), ("<=", 90, "Large"))
SIZE_TOP = "Extra Large"
SIZE_OPEN_LOW = "Very Small"
LONGEVITY_BANDS = ((">=", 14, "Long-lived"), (">=", 12, "Average lifespan"),
                   (">=", 10, "Moderate lifespan"))
LONGEVITY_DEFAULT = "Short-lived"
BUILD_BANDS = ((">=", 15, "Heavy Build"), (">=", 10, "Sturdy Build"),
               (">=", 7, "Balanced Build"), (">=", 4, "Lean Build"))
BUILD_REST = "Very Lean Build"
WEIGHT_CONSISTENCY_BANDS = (("<=", 10, "Consistent Size"), ("<=", 30, "Moderate Variation"))
HEIGHT_CONSISTENCY_BANDS = (("<=", 2, "Consistent Size"), ("<=", 5, "Moderate Variation"))
CONSISTENCY_REST = "High Variation"
LIFESPAN_PREDICTABILITY_BANDS = (("<=", 2, "Predictable Lifespan"), ("<=", 4, "Moderate Variation"))
PREDICTABILITY_REST = "High Variation"
COMPLEXITY_BANDS = ((">=", 8, "Complex"), (">=", 5, "Moderate"), (">=", 2, "Simple"))
COMPLEXITY_DEFAULT = "Minimal"

# FIXED VALUES: metric completeness by number of present measures (3, 2, 1, else).
METRIC_COMPLETENESS = ((3, 1.0), (2, 0.67), (1, 0.33))
METRIC_COMPLETENESS_DEFAULT = 0.0

# FIXED VALUES: family suitability and training difficulty labels.
SUITABILITY_LABELS = ("Excellent for Families", "Good for Families", "Moderate for Families",
                      "Good Guard Dog", "Needs Experienced Owner")
TRAINING_LABELS = ("Easy to Train", "Moderate to Train", "Challenging to Train",
                   "Very Challenging to Train")

# FIXED VALUES: accepted-value lists of the quality rules.
ACCEPTED_GROUPS = ("Sporting", "Hound", "Working", "Terrier", "Toy", "Non-Sporting",
                   "Herding", "Mixed", "")
ACCEPTED_SIZES = ("Very Small", "Small", "Medium", "Large", "Extra Large")
ACCEPTED_LONGEVITY = ("Long-lived", "Average lifespan", "Moderate lifespan", "Short-lived")
ACCEPTED_ACTIVITY = ("High", "Medium-High", "Medium", "Low-Medium", "Unknown")
ACCEPTED_FRIENDLINESS = ("Family-Friendly", "Protective/Guardian", "Moderate", "Unknown")
ACCEPTED_BUILDS = ("Heavy Build", "Sturdy Build", "Balanced Build", "Lean Build", "Very Lean Build")
ACCEPTED_CONSISTENCY = ("Consistent Size", "Moderate Variation", "High Variation")
ACCEPTED_PREDICTABILITY = ("Predictable Lifespan", "Moderate Variation", "High Variation")
ACCEPTED_PRIMARY = ("Social/Friendly", "High-Energy/Active", "Intelligent/Trainable",
                    "Protective/Guardian", "Independent/Strong-Willed", "Calm/Gentle",
                    "Unclassified")
ACCEPTED_COMPLEXITY = ("Complex", "Moderate", "Simple", "Minimal")

# --------------------------------------------------------------------------
# FIXED VALUES: recommender vocabularies and points.
# --------------------------------------------------------------------------
SIZE_WORDS: tuple[tuple[tuple[str, ...], str], ...] = (
    (("toy", "tiny", "small", "apartment"), "small"),
    (("medium",), "medium"),
    (("big", "large", "giant"), "large"),
)
ACTIVE_WORDS = ("active", "run", "running", "hike", "hiking", "energetic", "sport", "agile")
CALM_WORDS = ("calm", "relaxed", "low energy", "quiet", "easygoing", "laid-back")
FAMILY_WORDS = ("family", "kids", "children", "child")
GUARD_WORDS = ("guard", "protect", "watchdog", "protective", "alert")
APARTMENT_WORD = "apartment"

ACTIVE_TRAITS = ("energetic", "active", "athletic")
CALM_TRAITS = ("calm", "gentle", "laid back", "quiet")
GUARD_TRAITS = ("protective", "alert", "confident")
APARTMENT_SIZES = ("small", "medium")
APARTMENT_MAX_KG = 15
# Family points by lower-cased suitability label, as the source model scores it.
FAMILY_POINTS_LITERAL = {"high": 3, "medium": 2}
POINTS = {"size": 3, "apartment_size": 2, "apartment_weight": 2, "active": 2,
          "calm": 2, "guard": 2, "lifespan": 1}
LIFESPAN_BONUS_YEARS = 12
SUGGESTIONS_PER_REQUEST = 5

REC_PREFIX = ("I couldn't use the AI model due to quota limits. Based on your description, "
              "here are heuristic suggestions grounded in the dataset:")
REC_SUFFIX = ("If you'd like, refine your preferences (home size, time for exercise, "
              "shedding tolerance).")

# FIXED VALUES: sample request texts (one per intent branch).
REQUEST_TEXTS = (
    "I live in an apartment and want a calm, small dog. Any suggestions?",
    "We have young kids and enjoy weekend hikes. Which breeds fit?",
    "Looking for a medium-sized, low-shedding dog with a long lifespan.",
    "A giant dog to guard and protect the house",
    "toy or large, either is fine",
    "my dog should grunt less",
)

# FIXED VALUES: grounding excerpt texts.
EXCERPT_HEAD = (
    "Dataset excerpt for grounding (do not hallucinate beyond this):",
    "Columns: breed | group | size | avg_weight_kg | avg_lifespan_years | "
    "family_suitability | temperament_traits",
)
EXCERPT_MAX_ROWS = 80
REC_EMPTY = "I cannot suggest breeds because the dataset for the current filters is empty."
EXCERPT_EMPTY = "No rows matched the current filters."
CONTEXT_MAX_ROWS = 300

# FIXED VALUES: recency rule of the raw source (newest row within 7 days).
RECENCY_DAYS = 7
