"""Fixed values. These decide results, so they are stated once, as plain text."""

# Label thresholds, inclusive at both ends.
POSITIVE_FROM = 0.05
NEGATIVE_TO = -0.05

# Keyword extraction.
TOP_KEYWORDS = 20
MAX_FEATURES = 500
MIN_DOCS = 3
MIN_WORD_LENGTH = 3

# Entity extraction.
TOP_ENTITIES = 20
ENTITY_TYPES = ["ORG", "PERSON", "PRODUCT", "GPE"]
SURGE_ENTITY_TYPES = ["ORG", "PERSON", "PRODUCT"]

# Trend detection.
ROLLING_ROWS = 168
SPIKE_FACTOR = 2.0

# Post ingestion.
DELETED_AUTHOR = "[deleted]"
UNKNOWN_SUBREDDIT = "unknown"
LISTING_LIMIT = 100
LEGACY_KEY_CHARS = 20
DEFAULT_TARGETS = "technology"

# Social-media stop words, used next to an English list.
CUSTOM_STOPWORDS = [
    "reddit", "post", "like", "just", "think", "know", "also",
    "would", "could", "really", "actually", "going", "thing", "people",
    "year", "years", "month", "week", "day", "time", "way", "said",
    "https", "http", "www", "com", "amp",
]

# Words that are never reported as entities.
STOP_ENTITIES = [
    "reddit", "twitter", "google", "facebook", "amazon",
    "the", "a", "an", "this", "that",
    "monday", "tuesday", "wednesday", "thursday", "friday",
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

# Idioms of the published sentiment method and their valence.
IDIOMS = [
    ("the shit", 3.0), ("the bomb", 3.0), ("bad ass", 1.5), ("badass", 1.5), ("bus stop", 0.0),
    ("yeah right", -2.0), ("kiss of death", -1.5), ("to die for", 3.0), ("beating heart", 3.1),
    ("broken heart", -2.9),
]

# Emoji and their Unicode short names.
EMOJI = [
    ("😀", "grinning face"), ("😂", "face with tears of joy"), ("😊", "smiling face with smiling eyes"),
    ("😍", "smiling face with heart-eyes"), ("😢", "crying face"), ("😠", "angry face"),
    ("😞", "disappointed face"), ("👍", "thumbs up"), ("👎", "thumbs down"), ("❤", "red heart"),
    ("💔", "broken heart"), ("🎉", "party popper"), ("🔥", "fire"), ("🙏", "folded hands"),
]

# Feed name, topic and address.
FEEDS = [
    ("bbc_technology", "technology", "https://feeds.bbci.co.uk/news/technology/rss.xml"),
    ("sky_technology", "technology", "https://feeds.skynews.com/feeds/rss/technology.xml"),
    ("bbc_business", "business", "https://feeds.bbci.co.uk/news/business/rss.xml"),
    ("bbc_world", "world", "https://feeds.bbci.co.uk/news/world/rss.xml"),
]
