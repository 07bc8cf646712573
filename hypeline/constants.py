"""Values that must equal the reference's for identical results.

Fixed values, in the order the pipeline uses them.
"""

# Fixed values -- landing
POST_LOOKBACK_HOURS = 48                      # posts fetched per run: the last 48 hours
GAME_DATE_FORMATS = ("MMM d, yyyy", "M/d/yyyy", "yyyy-M-d")   # "NOV 09, 2025", "11/09/2025", "2025-11-09"
SCHEDULE_DAY_FORMATS = ("M/d/yyyy", "yyyy-M-d")               # gameDate before the first space
EASTERN_TZ = "America/New_York"               # schedule wall-clock zone
OPTIONAL_DEFAULT = ""                         # value of an absent optional schedule key
SEASON_FLIP_MONTH = 10                        # seasons start in October: 2025-10 -> "2025-26"

# Fixed values -- models
DEFAULT_RUN_DT = "2025-01-01"                 # run date when none is given
STAGED_POST_LOOKBACK_DAYS = 1                 # staged posts re-read run_dt - 1 day
TITLE_KEEP_CLASS = "[^0-9A-Za-z_\\t\\n\\f\\r -]"   # [^\w\s-] with RE2's ASCII \w and \s
TOKEN_SEPARATOR = " "
NGRAM_MIN, NGRAM_MAX = 2, 3
NGRAM_SEPARATOR = " "
POST_TYPE_RULES = (("[Highlight]", "Highlight"), ("[Post Game Thread]", "Post Game Thread"))
POST_TYPE_DEFAULT = "Other"
MATCHUP_MARKERS = ("vs.", "@")                # removed, after the own team code, to leave the opponent
AWAY_MARKER, AWAY_LABEL, HOME_LABEL = "@", "away", "home"
NEXT_GAME_FALLBACK = "INTERVAL 7 DAYS"        # interval end of a player's last game
GAMES_FROM = "2026-01-09"                     # summary cut-over for games
POSTS_FROM = "2026-01-10"                     # summary cut-over for posts
