"""Names, limits and patterns shared by the whole package."""

from datetime import timedelta

# --------------------------------------------------------------------------
# Fixed values.  Everything in this module has to equal what existing data and
# its consumers use: a different value gives different results, not better ones.
# --------------------------------------------------------------------------

RECORD_TYPES = ("posts", "likes", "reposts", "follows")

COLLECTION_TO_RECORD_TYPE = {
    "app.bsky.feed.post": "posts",
    "app.bsky.feed.like": "likes",
    "app.bsky.feed.repost": "reposts",
    "app.bsky.graph.follow": "follows",
}
PROFILE_TYPE = "app.bsky.actor.profile"
MENTION_FACET = ("app.bsky.richtext.facet#mention", "did")
LINK_FACET = ("app.bsky.richtext.facet#link", "uri")
IMAGES = "app.bsky.embed.images"
VIDEO = "app.bsky.embed.video"
QUOTE = "app.bsky.embed.record"
QUOTE_WITH_MEDIA = "app.bsky.embed.recordWithMedia"
EXCLUDE_CLAUSES = {"reply": "-is:reply", "retweet": "-is:retweet", "quote": "-is:quote"}

REQUIRED_COLUMNS = {
    "posts": ("uri", "did", "created_at", "ingested_at"),
    "likes": ("uri", "did", "created_at", "ingested_at", "subject_uri"),
    "reposts": ("uri", "did", "created_at", "ingested_at", "subject_uri"),
    "follows": ("uri", "did", "created_at", "ingested_at", "subject_did"),
}

# How far created_at may lie before / after ingested_at.
MAX_BACKDATE = timedelta(days=7)
MAX_AHEAD = timedelta(days=1)
# The event log replaces created_at beyond this distance from ingested_at.
EVENT_LOG_MAX_SKEW = timedelta(hours=24)

FLUSH_BYTES = 2 * 1024**3
FLUSH_AGE = timedelta(minutes=30)

CONTRACT_TIMESTAMP_FORMAT = "yyyy_MM_dd-HH:mm:ss"
COMPRESSION = "zstd"
TARGET_FILE_BYTES = 256 * 1024 * 1024
MIN_SMALL_FILES = 5
COMPACT_DAYS = 3
MASK_DAYS = 21

PHONE_PATTERN = r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b|\(\d{3}\)\s?\d{3}[-.]?\d{4}|\b\d{10}\b"
URL_PATTERN = (
    r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
    r"|www\.(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),])+"
    r"|[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
)
TCO_PATTERN = r"https?://t\.co/\S+"
MENTION_PATTERN = r"(?i)(?:u/|r/)"
MARKDOWN_LINK_PATTERN = r"!\[[^\]]*\]\([^)]+\)|\[[^\]]+\]\([^)]+\)"
MEDIA_HOST_PATTERN = r"(?i)\b(?:imgur|i\.redd\.it|v\.redd\.it|youtube|youtu\.be|gfycat|redgifs)\b"
REMOVED_BODIES = ("[removed]", "[deleted]", "[removed by reddit]", "[unavailable]")
AUTOMODERATOR = "automoderator"
DELETED_AUTHOR = "[deleted]"

TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")

PROFILE_MIN_FOLLOWERS = 1000
PROFILE_MIN_RECENT_POSTS = 5
PROFILE_FEED_ITEMS = 30

VALID_MIN_FOLLOWERS = 10
VALID_MIN_FOLLOWEES = 10
VALID_MIN_ORIGINAL_POSTS = 20
VALID_MIN_INTERACTIONS = 20
ACTIVITY_DAYS = 183
BOOKMARK_TYPES = ("app.bsky.bookmark", "app.bsky.bookmark.bookmark")

USER_FEED_ITEMS = 25
TIMING_SCALES = (1, 10, 50)
LABEL_CHUNK = 64
SCORE_CHUNK = 90
LABEL_RETRIES = 3
COVERAGE_COMPLETE = 0.995

# First rule that matches names the bucket; each rule is a set of substrings.
ERROR_BUCKETS = (
    ("repo_not_found", ("reponotfound", "repo not found")),
    ("repo_takendown", ("repotakendown", "takendown")),
    ("repo_deactivated", ("repodeactivated", "deactivated")),
    ("pds_unreachable", ("pds_unreachable", "name or service not known")),
    ("rate_limit", ("429", "ratelimitexceeded", "rate limit exceeded")),
    ("timeout", ("timeout",)),
    ("network", ("network", "requestexception", "connect")),
    ("decode", ("decode",)),
)

PUT_TIER_OPERATIONS = (
    "PutObject",
    "CopyObject",
    "PostObject",
    "ListObjects",
    "ListObjectsV2",
    "ListBuckets",
    "ListMultipartUploads",
    "ListParts",
    "CreateMultipartUpload",
    "UploadPart",
    "UploadPartCopy",
    "CompleteMultipartUpload",
)
DELETE_TIER_OPERATIONS = ("DeleteObject", "DeleteObjects", "AbortMultipartUpload")
TIER_PRICES = {"put": 0.005 / 1000, "get": 0.0004 / 1000, "delete": 0.0, "glue": 1.0 / 100_000}

OBJECT_GET_PRICE = 0.0004 / 1000
OBJECT_PUT_PRICE = 0.005 / 1000
OBJECT_GB_MONTH = 0.023
READ_UNIT_PRICE_PER_MILLION = 0.25
WRITE_UNIT_PRICE_PER_MILLION = 1.25
KEY_VALUE_GB_MONTH = 0.25
READ_UNITS_PER_ITEM = 0.5
WRITE_UNITS_PER_ITEM = 1.0
BYTES_PER_ID = 80
MAX_SCALE_DEGRADATION = 3.0
MAX_CHECK_MS = 5000.0

# Scored attribute -> suffix of its prob_ / label_ columns.
SCORE_ATTRIBUTES = {
    "TOXICITY": "toxic",
    "SEVERE_TOXICITY": "severe_toxic",
    "IDENTITY_ATTACK": "identity_attack",
    "INSULT": "insult",
    "PROFANITY": "profanity",
    "THREAT": "threat",
    "AFFINITY_EXPERIMENTAL": "affinity",
    "COMPASSION_EXPERIMENTAL": "compassion",
    "CURIOSITY_EXPERIMENTAL": "curiosity",
    "NUANCE_EXPERIMENTAL": "nuance",
    "PERSONAL_STORY_EXPERIMENTAL": "personal_story",
    "REASONING_EXPERIMENTAL": "reasoning",
    "RESPECT_EXPERIMENTAL": "respect",
    "ALIENATION_EXPERIMENTAL": "alienation",
    "FEARMONGERING_EXPERIMENTAL": "fearmongering",
    "GENERALIZATION_EXPERIMENTAL": "generalization",
    "MORAL_OUTRAGE_EXPERIMENTAL": "moral_outrage",
    "SCAPEGOATING_EXPERIMENTAL": "scapegoating",
    "SEXUALLY_EXPLICIT": "sexually_explicit",
    "FLIRTATION": "flirtation",
    "SPAM": "spam",
}
EXAMPLE_COLUMN_ALIASES = {
    "post_id": ("post_id", "post_primary_key"),
    "post_handle": ("post_handle", "handle"),
    "post": ("post", "original_text"),
    "post_timestamp": ("post_timestamp",),
}
NO_RESPONSE_REASON = "No response from Perspective API"

BOOLEAN_RULE_COLUMNS = ("is_political", "is_self_contained", "is_structurally_complete")
EMPTY_TEXT_REASON = "Comment must be non-empty."
DATASET_ID_PATTERN = (
    r"^(bluesky|reddit|twitter)_[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
)
TIER_LOW_MAX = 0.1
TIER_HIGH_MIN = 0.7
NEWS_DOMAIN = ("news", "opinion", "neither")
STANCE_DOMAIN = ("left", "right", "neutral", "unclear")
TIER_DOMAIN = ("low", "medium", "high")
