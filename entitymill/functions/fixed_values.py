"""The word lists, codes and thresholds that results depend on."""

# --- contact keys ---------------------------------------------------------

TOLL_FREE_PREFIXES = ["800", "888", "877", "866", "855", "844", "833"]

WEBMAIL_DOMAINS = [
    "gmail.com", "yahoo.com", "hotmail.com", "aol.com", "outlook.com", "icloud.com",
    "comcast.net", "att.net", "bellsouth.net", "verizon.net", "msn.com", "live.com",
    "me.com", "mac.com", "sbcglobal.net", "cox.net", "earthlink.net", "charter.net",
    "optonline.net",
]

# --- company name suffixes, in the order they are taken off ----------------

LEGAL_SUFFIXES = [
    ", llc", ", inc.", ", inc", ", corp", ", ltd", " incorporated", " corporation",
    " contracting", " construction", " contractors", " enterprises", " solutions",
    " holdings", " associates", " services", " systems", " company", " limited",
    " l.l.c.", " group", " corp.", " corp", " inc.", " inc", " ltd.", " ltd", " llc",
    " co.", " co",
]

TRADE_SUFFIXES = [
    " llc", " inc", " corp", " co", " company", " ltd", " llp", " solar", " energy",
    " electric", " electrical", " hvac", " plumbing", " roofing", " services", " service",
    " solutions",
]

SHORT_SUFFIXES = [" llc", " inc", " corp", " co", " company", " ltd", " llp"]

UPPER_SUFFIX_PATTERNS = [
    r"\bINC\.?$", r"\bINCORPORATED$", r"\bLLC\.?$", r"\bL\.L\.C\.?$", r"\bCORP\.?$",
    r"\bCORPORATION$", r"\bLTD\.?$", r"\bLIMITED$", r"\bCO\.?$", r"\bCOMPANY$",
    r"\bDBA\b", r"\bD/B/A\b",
]

ANCHORED_SUFFIX_PATTERNS = [
    r"\s+llc\s*$", r"\s+inc\.?\s*$", r"\s+corp\.?\s*$", r"\s+ltd\.?\s*$", r"\s+co\.?\s*$",
    r"\s+company\s*$", r"\s+incorporated\s*$", r"\s+corporation\s*$", r"\s+limited\s*$",
    r"\s+l\.?l\.?c\.?\s*$",
]

CUT_ANYWHERE = [
    " llc", " inc", " inc.", " corp", " corp.", " co", " co.", " ltd", " ltd.", " company",
    ", llc", ", inc", ", inc.", " incorporated", " corporation", " enterprises", " services",
    " contracting", " construction", " contractors",
]

CUT_ANYWHERE_SHORT = [
    " llc", " inc", " inc.", " corp", " corp.", " co", " co.", " ltd", " ltd.", " company",
    ", llc", ", inc", ", inc.",
]

BUSINESS_NAME_WORDS = [
    "inc", "llc", "ltd", "corp", "company", "service", "services", "electric", "plumbing",
    "heating", "cooling", "hvac", "solar", "generator", "systems", "solutions", "group",
    "enterprises",
]

# --- licence codes ---------------------------------------------------------

LICENCE_CATEGORIES = {
    "FL": {
        "CAC": "HVAC", "CMC": "HVAC", "CPC": "PLUMBING", "CFC": "FIRE", "FRO": "ROOFING",
        "CCC": "ROOFING", "CGC": "GENERAL", "CBC": "BUILDING", "CUC": "UTILITY",
        "SCC": "SPECIALTY", "EC": "ELECTRICAL", "ER": "ELECTRICAL",
    },
    "CA": {
        "C10": "ELECTRICAL", "C-10": "ELECTRICAL", "C46": "SOLAR", "C-46": "SOLAR",
        "C-7": "LOW_VOLTAGE", "C20": "HVAC", "C-20": "HVAC", "C38": "REFRIGERATION",
        "C-38": "REFRIGERATION", "C-4": "BOILER", "C4": "BOILER", "C36": "PLUMBING",
        "C-36": "PLUMBING", "C16": "FIRE", "C-16": "FIRE", "HAZ": "HAZMAT",
        "ASB": "ASBESTOS",
    },
    "TX": {
        "A/C Contractor": "HVAC", "A/C Technician": "HVAC",
        "Electrical Contractor": "ELECTRICAL", "Master Electrician": "ELECTRICAL",
        "Residential Wireman": "ELECTRICAL",
        "Appliance Installation Contractor": "APPLIANCE", "Appliance Installer": "APPLIANCE",
    },
    "NYC": {"A": "ELECTRICAL", "P": "PLUMBING", "O": "HVAC", "F": "FIRE"},
}

REGISTRY_TYPE_NAMES = {
    "CA": {"C-10": "Electrical", "C-7": "LowVoltage", "C-20": "HVAC"},
    "FL": {"ER": "Electrical", "EL": "LowVoltage", "CAC": "HVAC"},
    "TX": {
        "Electrical Contractor": "Electrical", "A/C Contractor": "HVAC",
        "Electrical Sign Contractor": "Electrical", "Elevator Contractor": "Electrical",
        "Appliance Installation Contractor": "Electrical",
    },
}

CATEGORY_FLAGS = {
    "SOLAR": "has_solar", "ELECTRICAL": "has_electrical", "HVAC": "has_hvac",
    "PLUMBING": "has_plumbing", "ROOFING": "has_roofing", "REFRIGERATION": "has_hvac",
    "LOW_VOLTAGE": "has_electrical", "FIRE": "has_fire_protection",
    "GENERAL": "has_general_contractor", "BUILDING": "has_general_contractor",
}

CLASS_FLAGS = {
    "has_electrical": ["C10", "C-10"], "has_hvac": ["C20", "C-20"],
    "has_solar": ["C46", "C-46"], "has_plumbing": ["C36", "C-36"],
}

PARTNER_LICENCE_TOKENS = ["ELE", "HVAC", "SOL", "CONT", "PLUM"]

SREC_STATES = [
    "CA", "TX", "PA", "MA", "NJ", "FL", "NY", "OH", "MD", "DC", "DE", "NH", "RI", "CT", "IL",
]

# --- brands -----------------------------------------------------------------

BRAND_TYPE = {
    "Generac": "generator", "Briggs & Stratton": "generator", "Cummins": "generator",
    "Kohler": "generator", "Tesla": "battery", "Enphase": "solar", "SolarEdge": "solar",
    "SMA": "solar", "Carrier": "hvac", "Mitsubishi": "hvac", "York": "hvac",
    "Trane": "hvac", "Rheem": "hvac",
}

BRAND_FLAGS = {
    "Generac": ["has_generator"], "Briggs & Stratton": ["has_generator"],
    "Cummins": ["has_generator"], "Kohler": ["has_generator"],
    "Tesla": ["has_battery", "has_solar"], "Enphase": ["has_solar", "has_microinverters"],
    "SolarEdge": ["has_solar", "has_inverters"], "SMA": ["has_solar", "has_inverters"],
    "Carrier": ["has_hvac"], "Mitsubishi": ["has_hvac"], "York": ["has_hvac"],
    "Trane": ["has_hvac"], "Rheem": ["has_hvac"],
}

BRAND_CATEGORIES = {
    "hvac": ["Carrier", "Trane", "York", "Rheem", "Mitsubishi", "Mitsubishi Electric"],
    "solar": ["Enphase", "SolarEdge", "SMA", "Fronius", "GoodWe", "Growatt", "Sungrow",
              "ABB", "Delta", "Tigo"],
    "battery": ["Tesla", "SimpliPhi", "Sol-Ark", "SolArk"],
    "generator": ["Generac", "Briggs & Stratton", "Cummins", "Kohler"],
    "smart_panel": ["Schneider Electric", "Schneider"],
}

# --- scoring words ------------------------------------------------------------

COMMERCIAL_WORDS = ["commercial", "industrial", "business"]
RESIDENTIAL_WORDS = ["residential", "home", "house"]
MARKET_TIER_WORDS = ["elite", "premier", "platinum", "certified"]
SERVICE_TIER_WORDS = ["elite", "premier", "platinum"]
GENERATOR_WORDS = ["generac", "cummins", "briggs", "kohler"]
TRADE_WORDS = {
    "Mechanical": ["hvac", "heating", "cooling", "air conditioning", "ventilation", "plumbing"],
    "Electrical": ["electric", "electrical", "lighting", "wiring"],
    "Plumbing": ["plumbing", "plumber", "water", "pipe", "drain"],
    "Roofing": ["roof", "roofing", "roofer", "shingle", "solar roof"],
}
ALL_TRADE_PHRASES = ["all trades", "full service", "all phase", "complete", "total"]
MAINTENANCE_WORDS = [
    "maintenance", "service", "repair", "monitoring", "support", "warranty", "inspection",
    "preventive", "scheduled", "24/7", "emergency",
]

# --- capability words ---------------------------------------------------------

OPERATIONS_WORDS = ["operations", "maintenance", "service", "monitoring", "o&m", "o & m"]
FOUR_TRADE_WORDS = ["mep", "mechanical contractor", "full-service", "multi-trade"]
FIRE_SECURITY_WORDS = [
    "fire", "fire protection", "fire alarm", "sprinkler", "security", "low voltage",
    "low-voltage", "access control", "burglar", "alarm", "cctv", "surveillance",
    "life safety",
]

# --- tiers and stages ---------------------------------------------------------

TIER_FLOORS = [("PLATINUM", 80), ("GOLD", 60), ("SILVER", 40)]
LOWEST_TIER = "BRONZE"

FUNNEL_STAGES = [
    "RAW_LEAD", "ENRICHED", "CONTACTED", "RESPONDED", "DEMO_SET", "OPPORTUNITY",
    "CLOSED_WON", "CLOSED_LOST",
]
