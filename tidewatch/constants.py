"""Values the data contract fixes: formats, word lists and lookup tables."""

# --- Fixed values -----------------------------------------------------------
# Type tag of a post record in the raw event feed.
POST_TYPE = "app.bsky.feed.post"

# Message topic that carries the selected posts, and its per-trigger intake cap.
POST_TOPIC = "text_posts"
MAX_OFFSETS_PER_TRIGGER = 700

# Accepted createdAt layouts, tried in this order; the Z is a literal.
CREATED_AT_PATTERNS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
)

# Longest keyword kept in the trend table.
MAX_KEYWORD_LENGTH = 100

# Dashboard look-back and the bucket its end is floored to.
LOOKBACK_HOURS = 72
BUCKET_MINUTES = 15

# Sentiment labels in report order.
SENTIMENT_LABELS = ("Positive", "Neutral", "Negative")

# English function words.
ENGLISH_STOP_WORDS = (
    "am", "can", "down", "from", "as", "be", "are", "too", "through", "does", "a", "but", "now", "some", "an", "we",
    "below", "against", "here", "did", "how", "yourselves", "was", "above", "him", "it", "which", "himself", "its",
    "most", "the", "re", "or", "while", "your", "if", "yours", "she", "her", "other", "any", "off", "few", "is", "of",
    "there", "than", "why", "has", "so", "in", "only", "have", "itself", "for", "under", "own", "were", "those", "out",
    "very", "until", "hers", "after", "up", "they", "their", "not", "doing", "no", "them", "where", "ourselves",
    "themselves", "our", "on", "that", "nor", "ours", "at", "again", "same", "over", "just", "because", "who",
    "before", "by", "more", "being", "had", "this", "with", "should", "what", "during", "herself", "and", "these",
    "such", "further", "do", "yourself", "his", "into", "once", "each", "all", "then", "both", "when", "he", "me",
    "whom", "i", "my", "you", "to", "myself", "about", "been", "will", "between",
)

# Network and link words that never count as keyphrases.
NETWORK_STOP_WORDS = (
    "bsky", "social", "bluesky", "sexy", "love", "youtube", "video", "videos", "twitch", "facebook", "exactly",
    "www", "com", "org",
)

# Display names of language codes; other codes show as they are.
LANGUAGE_NAMES = {
    "en": "English",
    "es": "Spanish",
    "fr": "French",
    "de": "German",
    "ja": "Japanese",
    "ko": "Korean",
    "zh": "Chinese",
    "pt": "Portuguese",
    "it": "Italian",
    "ru": "Russian",
    "ar": "Arabic",
    "tr": "Turkish",
    "pl": "Polish",
    "nl": "Dutch",
    "sv": "Swedish",
    "da": "Danish",
    "fi": "Finnish",
    "no": "Norwegian",
    "cs": "Czech",
    "hu": "Hungarian",
    "ro": "Romanian",
    "sk": "Slovak",
    "bg": "Bulgarian",
    "el": "Greek",
    "th": "Thai",
    "vi": "Vietnamese",
    "af": "Afrikaans",
    "so": "Somali",
    "id": "Indonesian",
    "unknown": "Unknown",
}
# --- End of fixed values ----------------------------------------------------

STOP_WORDS = ENGLISH_STOP_WORDS + NETWORK_STOP_WORDS

# Our own small defaults; pass bigger lists where they matter.
UNSAFE_WORDS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "stupid", "trash", "worthless")

POSITIVE_WORDS = (
    "amazing", "beautiful", "best", "bright", "calm", "delight", "enjoy", "excellent", "fun", "glad", "good", "great",
    "happy", "heal", "hope", "joy", "kind", "nice", "perfect", "pleasure", "rest", "shining", "thank", "thanks",
    "tender", "useful", "welcome", "win", "wonderful",
)
NEGATIVE_WORDS = UNSAFE_WORDS + (
    "angry", "awful", "bad", "broken", "cry", "fail", "hate", "horrible", "hurt", "lost", "poor", "sad", "terrible",
    "ugly", "worst", "wrong",
)
