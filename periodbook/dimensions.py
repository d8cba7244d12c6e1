"""Fixed values of the business model.

These labels, ids and rates have to equal the ones in the source tables for the
results to be right; they are stated plainly here and nowhere else.
"""

from __future__ import annotations

from decimal import Decimal

# --- fixed values: regions --------------------------------------------------

COMPANY = 999
MAIL_ORDER = 3
MAIL_ORDER_FRESH = 24  # folds into MAIL_ORDER
BAY_AREA = 1
LOS_ANGELES = 2
NEW_YORK = 7
CHICAGO = 15
MAIL_ORDER_TITLE = "MAIL ORDER"

# region id -> spellings used in the reported P&L sheet (lower case)
SHEET_REGIONS = {
    1: ["bay area"],
    999: ["consolidated", "total"],
    15: ["chicago", "midwest"],
    7: ["east coast", "new jersey"],
    23: ["florida"],
    3: ["mail order"],
    4: ["northwest", "seattle"],
    10: ["texas"],
    2: ["la"],
}

# region id -> warehouse names of the labour table
WAREHOUSE_REGIONS = {
    23: ["FL - Tampa"],
    10: ["TX - Houston"],
    4: ["WA - Seattle"],
    15: ["IL - Chicago"],
    2: ["LA - La Mirada"],
    7: ["NJ - Edison"],
    1: ["SF - Union City"],
}
LA_GREATER_WAREHOUSE = "LA - Greater"
CHECK_WAREHOUSE = "check"

LA_MIRADA = "LA - La Mirada"
CHICAGO_INVENTORY = "IL - Chicago"
NEW_YORK_INVENTORY = "NJ - New York"

# scorecard bucket -> sales region title
BUCKET_TITLES = {
    "sf": "SF Bay Area",
    "la": "LA - Greater",
    "ny": "New York",
    "sea": "Seattle",
    "tx": "Houston",
    "chi": "Chicago",
    "fl": "Tampa",
}
BUCKETS = (*BUCKET_TITLES, "mo")
MAIL_ORDER_TITLES = ("MAIL ORDER", "MOF")
SURVEY_MAIL_ORDER_TITLE = "MAIL ORDER - WEST"

# scorecard bucket -> "<id> - <title>" label
BUCKET_LABELS = {
    "sf": "1 - SF Bay Area",
    "la": "2 - LA - Greater",
    "sea": "4 - Seattle",
    "ny": "7 - New York",
    "tx": "10 - Houston",
    "chi": "15 - Chicago",
    "fl": "23 - Tampa",
}

# case-rate column suffix -> inventory prefix
INVENTORY_PREFIXES = {
    "fl": "FL",
    "chi": "IL",
    "la": "LA",
    "nj": "NJ",
    "sf": "SF",
    "tx": "TX",
    "sea": "WA",
}

# capacity and in-stock column suffix -> word in the region or warehouse title
CITY_WORDS = {"tx": "houston", "chi": "chicago", "fl": "tampa"}
STORAGE_PREFIXES = {"dry": "N", "frozen": "F", "ref": "R"}
STORAGE_DEPARTMENTS = {
    "dry": ("05", "06", "07", "09", "10", "11", "12", "14", "15", "16", "17", "20"),
    "frozen": ("03", "04", "08"),
    "ref": ("13",),
}

# pantry price region -> sales orgs served from it
PANTRY_PRICE_REGIONS = {
    16: [15, 17, 18, 20, 21, 23, 27, 28],
    3: [4, 8, 10, 13, 14, 19],
}

# --- fixed values: products, coupons, promotions -----------------------------

DIVISIONS = {
    "produce": "Produce",
    "protein": "Protein",
    "frozen": "Frozen",
    "dairy": "Dairy/Deli",
    "dry": "Dry Grocery",
    "gm": "GM & HBC",
}
DRY_DIVISION = "Dry Grocery"
PNL_BIZ_TYPES = ("grocery", "alcohol")
RESTAURANT_BIZ_TYPE = "restaurant"
NEW_USER_COUPONS = ("sign_up_coupon", "second_order_coupon")
SIGN_UP_COUPONS = ("sign_up_coupon", "order_share_sign_up_coupon")
PROMO_PRICE_TYPES = ("lightening", "sale")
VENDOR_REASONS = ("Vendor funded", "Boost Revenue - Vendor fund")
REFERRAL_POINTS = "p_user_referral"
FIRST_QUESTION = 1

# --- fixed values: web and app ------------------------------------------------

DEVICES = {"iOS": ["APP iOS"], "Android": ["APP Android"]}
OTHER_DEVICE = "Web"
LANGUAGES = {"Chinese": ["zh", "zh-Hant"], "English": ["en"]}
OTHER_LANGUAGE = "OTHER"
MAIL_ORGS = (3, 16)
GATE_SEGMENT = "Chinese"

# --- fixed values: rates ------------------------------------------------------

REBATE_RATE = Decimal("0.023")
SERVICE_RATE = 0.001
NEW_USER_COUPON_VALUE = 10
REFUND_SHARE_MAIL_ORDER = 0.5
REFUND_SHARE_LOCAL = 0.9
REFUND_SHARE_SCORECARD = 0.88
DELIVERY_UPLIFT = 1.01
LTV_SHARE_LOCAL = 0.1
LTV_SHARE_OTHER = 0.05
LTV_TAIL_WEEKS = 45
WINDOW_PAD_BEFORE = 300
WINDOW_PAD_AFTER = 900
LOCAL_ZONE = "America/Los_Angeles"
