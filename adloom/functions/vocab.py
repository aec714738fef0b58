"""Vocabularies, synonym patterns and label tables that results must agree on.

Patterns are case-insensitive and written so that both Java and RE2 accept them.
"""

# ---- addresses ------------------------------------------------------------------------------

# keyword, country, country code; the first keyword found in a text wins
COUNTRIES = [
    ("USA", "United States", "US"),
    ("US", "United States", "US"),
    ("UNITED STATES", "United States", "US"),
    ("UK", "United Kingdom", "GB"),
    ("UNITED KINGDOM", "United Kingdom", "GB"),
    ("CANADA", "Canada", "CA"),
    ("INDIA", "India", "IN"),
    ("AUSTRALIA", "Australia", "AU"),
]

US_STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California",
    "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "DC": "District of Columbia", "FL": "Florida",
    "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa",
    "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri",
    "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey",
    "NM": "New Mexico", "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio",
    "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont",
    "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
}

# blanks that are missing after a ZIP code and after a state code: pattern, what to put
ADDRESS_GLUE = [(r"(\d{5})([A-Za-z])", "$1 $2"), (r"\b([A-Z]{2})([A-Z][a-z])", "$1 $2")]
ADDRESS_ZIP = r"\b(\d{5})(?:-\d{4})?\b"
ADDRESS_STATE_CODE = r",\s*([A-Z]{2})(?:[,\s]|$)"
# the city stands before its state code; these two enclose the code
ADDRESS_CITY = (r"([A-Za-z][A-Za-z ]{1,35}?),\s*", r"(?:[,\s]|$)")
ADDRESS_COUNTY = r"\b([A-Z][a-z][a-zA-Z]*(?:\s+[A-Za-z]+)*\s+County)\b"
# what an address below the title looks like, what is cut off its end, and its parts: pattern, group
ADDRESS_NEAR_TITLE = r",\s*[A-Z]{2}[,\s]|\b\d{5}\b"
ADDRESS_TAILS = [r"(?s)\s*\|.*", r"(?is)\s*View on Map.*"]
TITLE_ADDRESS = {
    "city": (r"([A-Za-z][A-Za-z ]{1,35}?),\s*([A-Z]{2})(?:[,\s]|$)", 1),
    "state": (r"([A-Za-z][A-Za-z ]{1,35}?),\s*([A-Z]{2})(?:[,\s]|$)", 2),
    "zipcode": (r"\b(\d{5})\b", 1),
    "county": (r"\b([A-Z][a-zA-Z]+(?:\s+[A-Za-z]+)*\s+County)\b", 1),
    "nearby_university": (r"(?i)(?:University|College)[^:]*?(?:from|:)\s*([^|\n,]{3,60})", 1),
}

# most local name first
LOCALITY_LEVELS = ["neighbourhood", "suburb", "city_district", "quarter", "village", "hamlet", "town", "city"]

# ---- closed vocabularies --------------------------------------------------------------------

PROPERTY_TYPES = {
    "single family home": "single_family_home",
    "apartment": "apartment",
    "condo": "condo",
    "town house": "townhouse",
    "townhouse": "townhouse",
    "homes": "homes",
    "home": "homes",
    "houses": "houses",
    "house": "houses",
    "shared room": "shared_room",
    "single room": "single_room",
    "paying guest": "paying_guest",
}

LANGUAGES = [
    "English", "Hindi", "Tamil", "Telugu", "Malayalam", "Gujarati", "Bengali", "Kannada", "Urdu", "Manipuri",
    "Marathi", "Nepali", "Oriya", "Punjabi", "Sanskrit", "Sindhi", "Santhali", "Maithili", "Dogri", "Assamese",
    "Konkani", "Kashmiri", "Other",
]
GENDERS = ["Male", "Female", "Any"]

# option labels of the retired document shape
LEGACY_OPTIONS = {
    "age_range": ["18 to 99 (Any)", "18 to 25", "18 to 50", "25 to 45", "40 to 55", "55 to 70", "70 plus"],
    "gender": GENDERS,
    "occupation": ["Students only allowed", "Professionals only allowed", "Don't mind/No preference", "Others"],
    "pets": ["No Pets", "Only Dogs", "Only Cats", "Any Pet is Ok"],
    "smoking": ["No Smoking", "Smoking is Ok", "Smoke outside only"],
    "vegetarian": ["Yes, Vegetarian mandatory", "No, Non-veg is ok", "Both"],
}

# slug, pattern; first match wins
OCCUPATION = [
    ("students_only", "student"),
    ("professionals_only", "professional"),
    ("no_preference", "don'?t mind|no preference"),
    ("others", "other"),
]
SMOKING = [
    ("no_smoking", "no smoking"),
    ("smoke_outside_only", "outside"),
    ("smoking_ok", "smoking is ok|smok.*ok"),
]
PETS = [("no_pets", "no pets"), ("only_dogs", "only dogs"), ("only_cats", "only cats"), ("any_pet_ok", "any pet")]
VEGETARIAN = [("vegetarian", "vegetarian mandatory|^veg$"), ("non_vegetarian", "non-?veg"), ("both", "both")]
AGE_RANGE = [
    ("18_to_25", r"18\s*to\s*25"),
    ("18_to_50", r"18\s*to\s*50"),
    ("25_to_45", r"25\s*to\s*45"),
    ("40_to_55", r"40\s*to\s*55"),
    ("55_to_70", r"55\s*to\s*70"),
    ("70_plus", r"70\s*plus"),
    ("18_to_99", r"18\s*to\s*99"),
]

AMENITIES = [
    ("gym_fitness_center", "gym|fitness"),
    ("swimming_pool", "pool"),
    ("car_park", r"\bcar\s?park|^parking$"),
    ("visitors_parking", "visitor.*parking"),
    ("power_backup", "power backup|generator"),
    ("garbage_disposal", "garbage disposal|trash chute"),
    ("private_lawn", "lawn|yard|garden"),
    ("water_heater_plant", "water heater"),
    ("security_system", "security"),
    ("laundry_service", "laundry"),
    ("elevator", "elevator|lift"),
    ("club_house", r"club\s?house"),
]

UTILITIES = [
    ("gas", r"\bgas\b"),
    ("internet_wifi", "wifi|internet"),
    ("cable_tv", r"cable|\btv\b"),
    ("trash_pickup", "trash pickup|garbage pickup"),
    ("sewer", "sewer"),
    ("ceiling_fan", "ceiling fan"),
    ("water", r"\bwater\b"),
    ("electricity", "electric"),
    ("room_heater", r"room heater|\bheater\b"),
    ("air_conditioner", r"\bac\b|air condition"),
    ("refrigerator", "refrigerator|fridge"),
    ("dishwasher", "dishwasher"),
    ("kitchen", "kitchen"),
    ("microwave", "microwave"),
    ("washer", r"\bwasher\b"),
    ("dryer", r"\bdryer\b"),
    ("ice_maker", "ice maker"),
    ("freezer", "freezer"),
    ("covered_parking", "covered parking"),
    ("garage", "garage"),
    ("ev_charging", "ev charg|electric vehicle"),
    ("wheelchair_access", "wheelchair"),
    ("doorman_concierge", "doorman|concierge"),
    ("package_lockers", "package locker"),
    ("bbq_grill_area", "bbq|grill"),
    ("playground", "playground"),
    ("pet_area_dog_park", "dog park|pet area"),
    ("balcony_patio", "balcony|patio"),
    ("smoke_detector", "smoke detector"),
    ("carbon_monoxide_detector", "carbon monoxide"),
    ("fire_extinguisher", "fire extinguisher"),
    ("intercom", "intercom"),
    ("smart_thermostat", "thermostat"),
    ("cctv", "cctv|camera"),
    ("window_coverings_blinds", "blinds|curtain"),
]

# allowed values of the output document; "Any" is the accepted default of the preference enums
ENUMS = {
    "status": ["active", "disable"],
    "adexpirystatus": ["active", "expiry"],
    "intent": ["find", "list"],
    "category": ["room", "property"],
    "mode": ["per_day", "per_week", "per_month", "per_year"],
    "furnishing": ["unfurnished", "furnished_with_bed", "semi_furnished", "fully_furnished"],
    "amenity": [slug for slug, _ in AMENITIES],
    "utility": [slug for slug, _ in UTILITIES],
    "property_type": [
        "single_family_home", "apartment", "condo", "townhouse", "homes", "houses", "shared_room", "single_room",
        "paying_guest", "others",
    ],
    "gender_preference": ["any", "male_only", "female_only"],
    "occupation": [slug for slug, _ in OCCUPATION] + ["Any"],
    "smoking": [slug for slug, _ in SMOKING] + ["Any"],
    "pets": [slug for slug, _ in PETS] + ["Any"],
    "vegetarian": [slug for slug, _ in VEGETARIAN] + ["Any"],
    "age_range": [slug for slug, _ in AGE_RANGE] + ["Any"],
    "preferred_gender": ["Male", "Female", "Any"],
    "yes_no": ["Yes", "No"],
    "seeker_gender": ["male", "female", "other"],
    "seeker_occupation": ["professional", "student", "other"],
    "language": LANGUAGES,
}

# ---- page labels ----------------------------------------------------------------------------

GRID_LABELS = {
    "ad type": "ad_type",
    "property": "property_category",
    "bedrooms": "bedrooms",
    "bathrooms": "bathrooms",
    "area": "area_sqft",
    "available from": "available_from",
    "expected rent": "rent",
    "rent": "rent",
    "price": "rent",
    "accommodates": "accommodates",
    "posted by": "posted_by",
    "room type": "room_type",
    "stay type": "stay_type",
    "accommodation type": "accommodation_type",
    "deposit": "deposit",
    "couples allowed": "couples_allowed",
}

# field, label as printed (a pattern where the site spells it two ways)
QUICK_FACTS = [
    ("available_from", "AVAILABLE FROM"),
    ("accommodates", "ACCOM+ODATES"),
    ("posted_by", "POSTED BY"),
    ("room_type", "ROOM TYPE"),
    ("rent", "EXPECTED RENT"),
    ("bedrooms", "BEDROOMS"),
    ("bathrooms", "BATHROOMS"),
    ("area_sqft", "AREA"),
    ("stay_type", "STAY TYPE"),
    ("accommodation_type", "ACCOM+ODATION TYPE"),
    ("deposit", "DEPOSIT"),
    ("couples_allowed", "COUPLES ALLOWED"),
]
# lines that end the overview text
QUICK_FACT_LINES = [
    "AVAILABLE FROM", "ACCOMODATES", "POSTED BY", "ROOM TYPE", "EXPECTED RENT", "BEDROOMS", "BATHROOMS", "AREA",
    "STAY TYPE", "ACCOMODATION TYPE", "DEPOSIT", "COUPLES ALLOWED",
]

# field, pattern; per item the first rule wins, over the items the last one
ADDITIONAL_INFO = [("smoking", "smoking"), ("veg_non_veg", "veg"), ("pets", "pet"), ("furnishing", "furnish")]
TENANT_PREFS = [
    ("alcohol", "alcohol"),
    ("occupation", "occupation|mind|prefer|student"),
    ("gender_preference", "male|female|any.*gender"),
    ("age_range", r"\d+\s+to\s+\d+|age"),
]

# the line "Posted on: … | AD ID: … | Posted by: …"
POSTED_LINE = {
    "posted_on": r"(?i)Posted\s+on[:\s]+([A-Za-z]+\.?\s+\d{1,2},?\s*\d{4})",
    "ad_id": r"(?i)AD\s+ID[:\s#]+(\d+)",
    "posted_by": r"(?i)Posted\s+by[:\s]+([^\n|<]{2,60}?)(?:\s*\||\n|$)",
}
POSTED_BY_REST = r"(?i)Posted\s+by[:\s]+([^\n]+)"
POSTED_BY_LABEL = r"(?i)^\s*posted\s+by[:\s]*$"
NEIGHBORHOOD_LINE = r"(?i)Nearby\s+Neighborhood[s]?[:\s]+([^\n]+)"
NEIGHBORHOOD_BREAK = "[,|]"
VERIFIED_PHRASE = r"(?i)(?:Phone|Mail|Email|Identity|Address)\s+Verified"
CONTACT_PHONE = r"(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}"
CONTACT_EMAIL = r"(?i)[\w.+\-]+@[\w\-]+\.[a-z]{2,}"

# ---- images ---------------------------------------------------------------------------------

IMAGE_REJECT = "logo|icon|banner|ad[_-]?img|sponsor|avatar|profile|badge|star|rating|pixel|tracker|beacon"
IMAGE_REJECT_LIVE = "logo|icon|banner|ad[_-]?img|sponsor|avatar|profile|badge|star|rating|pixel|tracker"
IMAGE_REJECT_LIVE_ALT = r"logo|icon|banner|ad\b|sponsor"
IMAGE_REJECT_STATIC = "logo|icon|banner|sponsor|avatar|profile|badge|star|rating"
IMAGE_REJECT_STATIC_ALT = "logo|icon|banner|sponsor"
IMAGE_REJECT_DETAILS = r"logo|icon|spinner|placeholder|blank\.gif|pixel|1x1|transparent"
MIN_IMAGE_SIDE = 80

# gallery containers in order of preference: kind, value
GALLERIES = [
    ("id", "photoDiv"),
    ("class", "roomimageblock"),
    ("class*", "photo-gallery"),
    ("class*", "listing-photo"),
    ("class*", "property-photo"),
    ("class*", "image-gallery"),
    ("class*", "gallery"),
    ("class*", "carousel"),
    ("class*", "slider"),
    ("class*", "swiper"),
    ("class*", "lightbox"),
    ("class*", "media"),
]
FOREIGN_SECTIONS = [
    "similar", "related", "explore", "nearby", "browse", "recommend", "sponsor", "advertisement", "other-listing",
    "more-listing",
]
# the page source is read with the first of these galleries only
N_STATIC_GALLERIES = 10
DETAIL_GALLERIES = [
    ("class*", "photo-gallery"), ("class*", "listing-photo"), ("class*", "property-photo"), ("class*", "image-gallery"),
    ("class*", "gallery"), ("class*", "carousel"), ("class*", "swiper"),
]
FOREIGN_TO_DETAILS = ["similar", "related", "explore", "nearby-listing", "browse", "recommend", "sponsor"]
# photo viewers that lie over a page
VIEWERS = [
    ("id", "fancybox-inner"), ("class", "fancybox-inner"), ("id", "fancybox-wrap"), ("class", "fancybox-wrap"),
    ("class", "fancybox-container"), ("class", "fancybox-slide"), ("id", "lightbox"), ("class", "lightbox"),
    ("class", "pswp"), ("class", "pswp__item"), ("class*", "gallery-popup"), ("class*", "photo-popup"),
    ("class*", "gallery-modal"), ("class*", "photo-modal"), ("class*", "image-viewer"), ("class*", "photo-viewer"),
    ("class*", "carousel-inner"), [("class", "modal"), ("class", "show")], [("class", "modal"), ("class", "in")],
]
BACKGROUND_URL = r"""url\(['"]?([^'")\s]+)['"]?\)"""
IMAGE_SOURCES = ["src", "data-src", "data-lazy-src", "data-original"]
PHOTO_URL_KEYS = ["url", "src", "imageUrl", "photoUrl", "original", "large", "medium", "thumb"]
PHOTO_ALT_KEYS = ["alt", "caption", "title", "description"]
PHOTO_LIST_KEYS = ["photos", "images", "imageUrls", "photoUrls", "gallery", "media", "pictures"]
AMENITY_LIST_KEYS = ["amenities", "facilities", "features", "houseFeatures", "roomFeatures", "utilities", "included"]

# ---- where JSON sits in a page ----------------------------------------------------------------

NEXT_DATA = [
    r"""(?s)<script[^>]*\sid=["']?__NEXT_DATA__["']?[^>]*>(.*?)</script>""",
    r"window\.__NEXT_DATA__\s*=\s*(\{[\s\S]*?\});\s*(?:window|</script>)",
    r"__NEXT_DATA__\s*=\s*(\{[\s\S]*?\})\s*;",
]
# what goes before and after the escaped name of a state variable
WINDOW_VAR = [
    (r"window\.", r"\s*=\s*(\{[\s\S]*?\});\s*(?:window|</script>)"),
    (r"window\.", r"\s*=\s*(\{[\s\S]*?\})\s*;"),
    (r"", r"\s*=\s*(\{[\s\S]*?\})\s*;"),
]
LINKED_DATA = r"""(?is)<script[^>]*type=["']?application/ld\+json["']?[^>]*>(.*?)</script>"""
ASSIGNMENTS = [
    r"(?:var|const|let)\s+\w+\s*=\s*(\{[\s\S]{10,}\})\s*;",
    r"window\.\w+\s*=\s*(\{[\s\S]{10,}\})\s*;",
    r"self\.\w+\s*=\s*(\{[\s\S]{10,}\})\s*;",
]

# ---- where an ad sits in page JSON ----------------------------------------------------------

PAGE_AD_KEYS = ["adDetails", "ad", "listing", "rentalAd", "adData", "postDetails", "post"]
FLAT_AD_KEYS = ["adDetails", "ad", "listing", "rentalAd", "adData", "data", "result", "postDetails"]

# JSON sources of one page, weakest first
SOURCE_ORDER = ["ld", "embedded", "firebase", "api", "initial_state", "next_data"]

STATIC_ASSETS = r"\.(js|css|png|jpg|svg|ico|woff|woff2|ttf)"

FAR_FUTURE = "2100-12-31"
DEFAULT_TIMEZONE = "America/New_York"
DEFAULT_DAYS = "7 days a week"
