"""Keyword lists, patterns, messages and formats that results must carry verbatim."""

# Every character Python's str.strip() and re's \s treat as white space (fixed values).
WHITESPACE = "".join(
    chr(code)
    for code in [
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    ]
)

# Event-type keyword groups, in reporting order (fixed values).
EVENT_KEYWORDS = {
    "academic": ["lecture", "seminar", "workshop", "study", "research", "academic", "class", "course"],
    "social": ["meetup", "party", "social", "gathering", "networking", "mixer"],
    "career": ["career", "job", "employment", "resume", "interview", "professional"],
    "sports": ["game", "match", "tournament", "sports", "athletics", "fitness"],
    "arts": ["art", "music", "theater", "performance", "exhibition", "creative"],
    "student_life": ["club", "organization", "student", "campus", "activity"],
}

# Location keywords (fixed values).
LOCATION_KEYWORDS = [
    "room", "hall", "building", "center", "theatre", "theater", "gym", "field",
    "library", "commons", "plaza", "quad", "classroom", "lab", "laboratory",
]

# Time-of-day tag -> words that imply it (fixed values).
DAYPART_WORDS = {
    "morning": ["morning", "am"],
    "afternoon": ["afternoon", "pm"],
    "evening": ["evening", "night"],
}
# Weekday tags, and the type of an event that no group fits (fixed values).
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
DEFAULT_EVENT_TYPE = "General Event"

# Time-mention patterns, in reporting order (fixed values).
TIME_PATTERNS = [
    r"\d{1,2}(?::\d{2})?\s*(?:AM|PM|am|pm)",
    r"\d{1,2}(?::\d{2})?\s*(?:to|-)\s*\d{1,2}(?::\d{2})?\s*(?:AM|PM|am|pm)",
    r"(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?"
    r"|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)\s+\d{1,2}(?:st|nd|rd|th)?",
    r"\d{1,2}/\d{1,2}/\d{2,4}",
]
LOCATION_TAIL = r"\s+[A-Za-z0-9-]+(?:\s+[A-Za-z0-9-]+)?"

# Detail checks: pattern whose absence is reported, and the sentence (fixed values).
DETAIL_CHECKS = [
    (r"contact|email|phone|@", "Add contact information for event inquiries."),
    (r"free|cost|\$|dollar|price|fee", "Specify if the event is free or add cost information."),
    (r"register|registration|sign[- ]?up|rsvp", "Add registration or RSVP information if required."),
]
# The texts that each of these patterns matches (fixed values).
DETAIL_WORDS = [
    ["@", "contact", "email", "phone"],
    ["$", "free", "cost", "dollar", "price", "fee"],
    ["rsvp", "register", "registration", "signup", "sign-up", "sign up"],
]

# Suggestion sentences (fixed values).
TITLE_SHORT = "Title is too short. Add more descriptive words."
TITLE_LONG = "Title is too long. Keep it under 70 characters for better visibility."
TITLE_NO_DATE = "Consider adding the date to the title."
TITLE_NO_NUMBER = "Consider adding date/time information in the title."
DESCRIPTION_SHORT = "Description is quite short. Add more details about the event."
DESCRIPTION_NO_TIME = "Add clear date and time information."
DESCRIPTION_NO_PLACE = "Add specific location information."
# Words whose absence is reported, by element; most tags of an event; their sentences (fixed values).
KEY_ELEMENTS = {
    "time": ["time", "am", "pm", "o'clock"],
    "location": ["room", "building", "hall", "center"],
    "contact": ["contact", "email", "phone", "information"],
}
MOST_TAGS = 10
KEY_ELEMENT_MISSING = "Add {element} information to the description."
KEYWORD_HINT = "Consider emphasizing these key terms: "
DETAILS_HEADING = "\n\nEvent Details:"
FOOTER = "\nFor more information, please check the campus website or contact the event organizer."

# Validation limits and messages (fixed values).
TITLE_MIN, TITLE_MAX, LOCATION_MAX, DESCRIPTION_MAX = 3, 200, 200, 5000
URL_PATTERN = (
    r"^https?://(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,6}\.?|localhost"
    r"|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?::\d+)?(?:/?|[/?]\S+)$"
)
# Accepted date layouts after the canonical one: (shape, Spark pattern, name used in the warning).
DATE_LAYOUTS = [
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/y", "%m/%d/%Y"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-y", "%d-%m-%Y"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "y/M/d", "%Y/%m/%d"),
]

# Duplicate reasons and threshold (fixed values).
SIMILARITY_THRESHOLD = 0.85
REASON_LINK = "Exact link match"
REASON_TITLE_DATE = "Title and date match"

# Bookable hours: one-hour slots starting 08:00 .. 18:00 (fixed values).
SLOT_HOURS = list(range(8, 19))
DAY_MICROS = 86_400_000_000
MINUTE_MICROS = 60_000_000
EVENT_MINUTES = 60

# Recommendation sentences (fixed values).
PEAK_ACTION = "Consider off-peak hours for better attendance"
PEAK_DETAILS = (
    "Event scheduled during peak hours. Consider early morning or late afternoon for less competition."
)
NO_VENUE_ACTION = "Find alternative venue"

# Category seed rows (fixed values).
SEED_CATEGORIES = [
    ("Academic", "Academic events and deadlines"),
    ("Sports", "Athletic events and competitions"),
    ("Arts", "Art exhibitions and performances"),
    ("Student Life", "Student activities and social events"),
    ("Career", "Career fairs and job opportunities"),
]

# English function words left out of key terms. A parameter of the keyword operator;
# this short list is only its default.
STOP_WORDS = (
    "a about above after again all also am an and any are as at be because been before being below "
    "between both but by can could did do does doing down during each few for from further had has "
    "have having he her here hers him his how i if in into is it its itself just me more most my no "
    "nor not now of off on once only or other our ours out over own same she should so some such than "
    "that the their theirs them then there these they this those through to too under until up very "
    "was we were what when where which while who whom why will with would you your yours"
).split()
