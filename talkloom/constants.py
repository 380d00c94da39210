"""Fixed values. Results depend on these numbers and strings being exactly as given."""

# Message admission, counted in code points, strict "greater than".
WAIT_ABOVE = 400
REJECT_ABOVE = 1200

# Request throttling and judging.
REQUEST_GAP_US = 1_200_000
JUDGE_THRESHOLD = 0.7

# Token limits.
CUTOFF_LEN = 2048
OLDER_CUTOFF_LEN = 4000
CONTEXT_IDS = 3096
LARGE_CONTEXT_IDS = 4000

# Ids put around a role-tagged message.
ROLE_IDS = {"system": 1788, "user": 1404, "bot": 9225}
LINEBREAK_ID = 13

# Trainer schedule.
MICRO_BATCH = 2
ACCUMULATION = 4
LOG_EVERY = 5
EVAL_EVERY = 20
GENERATIONS = 2

# Rewards.
REWARD_MATCH = 1.0
REWARD_MISMATCH = 0.0
REWARD_UNPARSABLE = -1.0

# Fixed values: `predicted` markers of the extracting scorer.
NO_JSON_MARKER = "ERROR: No JSON found"
BAD_JSON_MARKER = "ERROR: Invalid JSON"

# Markers around a wrapped target, pad token added when there is none.
TARGET_START = "START"
TARGET_END = "END"
PAD_TOKEN = "<|pad|>"

# Labels inside the reinforcement prompt.
ACTIONS_LABEL = "\nAvailableActions: "
USER_LABEL = "\nUser: "

# Outcome names of the scorers.
MATCH = "match"
MISMATCH = "mismatch"
BAD_JSON = "bad_json"
NO_JSON = "no_json"
MISSING_KEY = "missing_key"
BAD_STRUCTURE = "bad_structure"
MISSING_RESPONSE = "missing_response"
