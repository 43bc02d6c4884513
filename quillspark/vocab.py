"""Fixed values of the annotation model: label sets, key sets, thresholds and caps."""

from __future__ import annotations

# Controlled vocabularies.
RECITATION_STYLES = ("lament", "devotional", "celebratory", "reflective", "declarative")
EMOTIONS = ("grief", "longing", "devotion", "peace", "celebration", "resilience", "anger", "fear")
TONES = ("lament", "whisper", "declaration", "prayer", "wonder", "defiance", "tenderness")
TRANSLATION_QUALITIES = ("faithful", "partial", "lost")
ENTITY_CATEGORIES = (
    "DEITY", "SACRED_RIVER", "FESTIVAL", "MUSICAL_TRADITION",
    "DEVOTIONAL_CONCEPT", "REGIONAL_SYMBOL", "SOCIAL_CUSTOM", "MYTHOLOGICAL_EVENT",
)
VISUAL_PRIORITIES = ("essential", "supporting", "optional", "non_visual")
EXPRESSION_TYPES = (
    "metaphor", "simile", "idiom", "proverb", "personification",
    "symbolism", "metonymy", "allusion", "wordplay", "other",
)
CULTURAL_SPECIFICITY = ("CULTURE_SPECIFIC", "CULTURALLY_CONTEXTUAL", "CROSS_CULTURAL", "UNCERTAIN")
TRANSLATION_STATUSES = ("PRESERVED", "PARTIALLY_PRESERVED", "ALTERED", "LOST", "NOT_TRANSLATED", "UNCERTAIN")
VISUALIZATION_DIFFICULTY = ("LOW", "MEDIUM", "HIGH")
LOSS_SEVERITY = ("low", "medium", "high")
NOTE_REQUIRED_STATUSES = ("PARTIALLY_PRESERVED", "ALTERED", "LOST", "NOT_TRANSLATED")

# Marker words of the risk audit.
SPECIFICITY_MARKERS = (
    "caste", "widow", "dowry", "concubine", "slave", "militant", "massacre",
    "genocide", "suicide", "rape", "incest", "trafficking",
)
CULTURAL_MARKERS = (
    "temple", "shrine", "festival", "ritual", "deity", "god", "goddess",
    "pilgrimage", "scripture", "folk", "devotional", "mythological",
    "clergy", "priest", "monastery", "pagoda", "mosque", "church", "sufi",
)
SOCIAL_MARKERS = (
    "caste", "class", "peasant", "laborer", "aristocrat", "untouchable",
    "landlord", "servant", "slave", "dowry", "occupation",
)
RELIGIOUS_MARKERS = (
    "hindu", "muslim", "islam", "christian", "sikh", "buddhist", "sufi",
    "bhakti", "shaivite", "vaishnav", "quran", "bible", "gita", "namaz", "puja",
)
GENDER_MARKERS = (
    "widow", "bride", "groom", "husband", "wife", "mother-in-law",
    "son-in-law", "daughter-in-law", "bachelor", "spinster",
)
TENOR_MARKERS = ("trauma", "abuse", "caste", "oppression", "religion", "occupation")
STEREOTYPE_TENORS = ("trauma", "abuse", "caste", "oppression")
SCENERY_MARKERS = (
    "temple", "shrine", "veil", "headdress", "turban", "folk instrument",
    "drum", "flute", "sitar", "tabla", "landscape", "village", "countryside",
    "mountain", "desert", "forest", "riverbank",
)
EVIDENCE_CATEGORIES = ("DEITY", "MYTHOLOGICAL_EVENT")
EVIDENCE_MARKERS = ("god", "goddess", "deity", "myth", "legend")

# Thresholds and caps.
ALIGN_OK, ALIGN_RISK, ALIGN_MIN_COSINE = 0.75, 0.60, 0.45
MAX_PATHS, MAX_UNITS = 40, 25
PART_PATHS, PREFERRED_PARTS = 20, 3
SMALL_PLAN, MEDIUM_PLAN = 20, 79
TOKEN_TIERS = ((20, 4096), (30, 8192), (40, 24576))
TOP_K, TOP_THRESHOLD = 5, 0.6
MESSAGE_CAP = 500
SECRET_MARKERS = ("begin private key", "service_account", "refresh_token", "authorization:", "bearer ")
