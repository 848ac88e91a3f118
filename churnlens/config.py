"""Fixed values that must equal the source pipeline's for identical results.

FIXED VALUES (kept as plain text, in their natural order):
"""

# Membership sub-categories excluded from every cohort.
EXCLUDED_SUBCATEGORIES = ["Unvaccinated", "Prepay", "Complimentary"]
# Fixed value: the only membership category in the weekly panel.
CONTRACT_CATEGORIES = ["Contract"]
# Fixed value: origin excluded by the dashboard variant of the weekly panel.
EXCLUDED_ORIGINS = ["Transfer (Club to Club)"]
# Fixed value: minimum visits in the trailing year to be eligible.
MIN_VISITS_12M = 12
# Fixed value: churn window of the weekly label, in weeks.
CHURN_WINDOW_WEEKS = 52
# Fixed value: sentinel for "never accessed / accessed after the as-of date".
NO_ACCESS_SENTINEL = 999999

# Payment bands (upper bound inclusive, label), else '45+'.
PAYMENT_BANDS = [(20, "<20"), (25, "<25"), (30, "<30"), (35, "<35"), (40, "<40"), (45, "<45")]
PAYMENT_BAND_ELSE = "45+"
# Payment-frequency prefixes and their groups, else 'UnDefined'.
FREQUENCY_GROUPS = [("Fort", "Fortnightly"), ("Mon", "Monthly"), ("Wee", "Weekly")]
# Term prefixes and their groups, else 'UnDefined'.
TERM_GROUPS = [("12", "12Months"), ("6", "6Months"), ("24", "24Months")]
UNDEFINED = "UnDefined"
# Documented maps from band/group back to numbers.
PAYMENT_BAND_TO_NUMBER = {"<20": 20, "<25": 25, "<30": 30, "<35": 35, "<40": 40, "<45": 45, "45+": 50}
FREQUENCY_TO_NUMBER = {"Weekly": 52, "Fortnightly": 26, "Monthly": 12, "UnDefined": 0}

# EWS smoothing and reason thresholds.
EMA_SPAN = 4
ZSCORE_EPS = 1e-6
K_WEEKS = 6
DROUGHT_EVENT_WEEKS = 8
MOMENTUM_Z_CUT = -0.5
VOLATILITY_Z_CUT = 0.75
WEEKLY_FLAGS = ["payment_failed", "discount_active", "price_change", "negative_feedback", "campaign_exposed"]

# Reason tags in the order they are emitted.
REASON_TAGS = ["negative_momentum", "drought_streak", "erratic_usage", "payment_issue", "price_sensitivity"]
# Preference order when picking the primary reason.
PRIMARY_REASON_ORDER = ["drought_streak", "negative_momentum", "erratic_usage", "paused_state", "none"]
# Outreach severity order (position = rank), unknown -> 99.
SEVERITY_ORDER = ["drought_streak", "payment_issue", "negative_momentum", "erratic_usage",
                  "price_sensitivity", "none", "paused_state"]
SEVERITY_UNKNOWN = 99
# Risk-band cut-offs on the EWS percentile (lower bound inclusive).
RISK_BANDS = [(0.97, "Critical"), (0.85, "High"), (0.65, "Medium")]
RISK_BAND_ELSE = "Low"
BAND_ORDER = ["Low", "Medium", "High", "Critical"]
# Band spellings repaired by the evaluation.
BAND_TYPO_FIXES = {"Lowe": "Low", "Meduim": "Medium"}
# Relabelled reasons in published snapshots.
REASON_RELABEL = {"erratic_usage": "Irregular_Movement", "drought_streak": "Continously_Inactive"}

# Outreach playbook (reason -> tag, subject, body); unknown reasons use 'none'.
PLAYBOOK = [
    ("negative_momentum", "Routine nudge", "We saved your spot this week",
     "You’ve been active recently—nice! To keep the rhythm, here’s an easy next step for this week. Book now → {quick_link}"),
    ("erratic_usage", "Consistency plan", "A simple weekly rhythm just for you",
     "Let’s make it easier to stay consistent. Pick one slot each week (we suggest {suggested_slot}) and we’ll remind you."),
    ("drought_streak", "Reactivation", "We miss you—ready for a fresh start?",
     "We haven’t seen you lately. We’ve added a small credit and a friction-free next step. Reactivate in 1 click → {winback_link}"),
    ("paused_state", "Paused — check-in", "We’ll be ready when you are",
     "Your pause is active. Want to pick your return week now? It takes 10 seconds → {resume_link}"),
    ("none", "No outreach", "", ""),
]
OUTREACH_CAPACITY = 500
COOLDOWN_DAYS = 21

# 3-class model labels.
CLASS_LABELS = {0: "Churn_0-3mo", 1: "Churn_3-6mo", 2: "NoChurn"}
CLASS_WEIGHTS = {0: 10.0, 1: 10.0, 2: 1.0}
# Per-class threshold search.
THRESHOLD_STEPS = 101
THRESHOLD_FALLBACK = 0.5
# Joint threshold grid for classes 0 and 1; class 2 fixed.
JOINT_GRID = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7]
JOINT_CLASS2 = 0.5
JOINT_WEIGHTS = {0: 1.5, 1: 1.5, 2: 1.0}
# Balanced training set.
CLASS3_SAMPLE = 20000
SEED = 42

# Sizes of the trained models (defaults; every trainer takes them as parameters).
EWS_ITERATIONS = 500
NUM_TREES = [400, 500]
MAX_DEPTHS = [5, 6]
LEARNING_RATES = [0.05, 0.1]
ROW_SHARE, COLUMN_SHARE = 0.8, 0.8
