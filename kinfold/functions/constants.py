"""Word lists and limits that results depend on."""

# Legal forms that are dropped from business names.
LEGAL_FORMS = (
    "inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "llc", "llp", "pvt", "private", "plc",
    "gmbh", "sarl", "sas", "sa", "bv", "nv", "spa", "srl", "holdings", "group", "enterprise", "enterprises",
)

# The shorter list of the single-file variant.
LEGAL_FORMS_SHORT = ("inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "llc", "llp", "pvt", "private", "plc", "gmbh", "sarl", "sas")

# Address words that never block.
ADDRESS_STOP_WORDS = (
    "road", "rd", "street", "st", "avenue", "ave", "boulevard", "blvd", "highway", "hwy", "lane", "ln", "drive", "dr",
    "court", "ct", "near", "opposite", "opp", "behind", "beside", "floor", "building", "bldg", "block", "plot", "suite",
    "ste", "apt", "apartment", "unit", "room", "rm", "sector", "phase", "cross", "main", "nagar", "roadways",
)

# Address abbreviations by token.
ABBREVIATIONS = {
    "rd": "road", "st": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "hwy": "highway", "dr": "drive",
    "ln": "lane", "pvt": "private", "ltd": "limited", "bldg": "building", "fl": "floor", "opp": "opposite", "nr": "near",
}

# The single-file variant's address stop words and its replacements, applied one after the other.
ADDRESS_STOP_SHORT = ("road", "rd", "street", "st", "near", "opposite", "opp", "behind", "beside", "floor", "building", "block", "plot")
REPLACEMENTS_SHORT = {
    " rd ": " road ", " st ": " street ", " ave ": " avenue ", " av ": " avenue ", " blvd ": " boulevard ",
    " hwy ": " highway ", " pvt ": " private ", " ltd ": " limited ",
}

# Tokens that are never salient.
GENERIC_TOKENS = (
    "company", "corporation", "limited", "private", "enterprises", "holding", "holdings", "group", "services", "solutions",
    "international", "india", "usa", "state", "city", "road", "street", "building",
)

# The order of the pair features.
FEATURES = (
    "country_exact", "name_ratio", "name_wratio", "name_jaccard", "name_containment", "name_len_diff", "name_token_overlap",
    "addr_ratio", "addr_jaccard", "addr_containment", "addr_len_diff", "addr_token_overlap", "same_postal_like",
)

# Limits of the in-memory blocker and its training.
MAX_NAME, MAX_ADDRESS, MAX_GRAM, MAX_TOTAL, MIN_NAME_TOKEN, MIN_ADDRESS_TOKEN, MAX_POSTINGS = 8, 8, 10, 30, 4, 5, 500
GRAM_INDEX_ABOVE, HARD_NEGATIVES, VALIDATION_SHARE = 5000, 12, 0.2
