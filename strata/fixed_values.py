"""Fixed values.

These literals must equal the source data's own spellings and the reference
marts' definitions for results to match; they are listed here plainly, in
their natural order, and used by name everywhere else.
"""

# --- fixed values: sales register header spellings -> canonical column -------
SALES_HEADER_SYNONYMS = {
    "Date of Sale (dd/mm/yyyy)": "date_of_sale_raw",
    "Address": "address",
    "County": "county",
    "Postal Code": "postal_code",
    "Eircode": "eircode",
    "Price (€)": "price_raw",
    "Price (\x80)": "price_raw",
    "Price (?)": "price_raw",
    "Not Full Market Price": "not_full_market_price",
    "VAT Exclusive": "vat_exclusive",
    "Description of Property": "property_description",
    "Property Size Description": "property_size",
}
# A price header in any other encoding accident still maps to price_raw.
SALES_HEADER_PATTERNS = {r"^Price \(.*\)$": "price_raw"}

# --- fixed values: characters removed before a money cast --------------------
RENT_MONEY_CHARS = r"[€,$\s]"
SALES_MONEY_CHARS = r"[€\x80?,\s]"
# the three bytes of a UTF-8 euro sign, decoded as latin-1
MISREAD_EURO = "\xe2\x82\xac"

# --- fixed values: month names in period labels such as "2005 January" ------
MONTHS = {
    "January": 1, "February": 2, "March": 3, "April": 4, "May": 5, "June": 6,
    "July": 7, "August": 8, "September": 9, "October": 10, "November": 11,
    "December": 12,
}

# --- fixed values: price index statistic labels -> pivot column -------------
PRICE_STATISTICS = {
    "Residential Property Price Index": "price_index",
    "Percentage Change over 1 month for Residential Property Price Index": "pct_change_1m",
    "Percentage Change over 3 months for Residential Property Price Index": "pct_change_3m",
    "Percentage Change over 12 months for Residential Property Price Index": "pct_change_12m",
}

# --- fixed values: property types kept in the gold price index --------------
KEY_PROPERTY_TYPES = [
    "National - all residential properties",
    "National - houses",
    "National - apartments",
    "Dublin - all residential properties",
    "Dublin - houses",
    "Dublin - apartments",
]
NATIONAL_ALL = "National - all residential properties"
DUBLIN_ALL = "Dublin - all residential properties"

# --- fixed values: headline rent filter -------------------------------------
RENT_ALL_BEDROOMS = "All bedrooms"
RENT_ALL_PROPERTY_TYPES = "All property types"

# --- fixed values: planning permission filter -------------------------------
PERMISSIONS_CONSTRUCTION = "New construction"
PERMISSIONS_STATISTIC = "Planning Permissions Granted for Communal Dwellings"
ESTIMATED_ANNUAL_NEED = 35000

# --- fixed values: sale class ------------------------------------------------
SALE_CLASS_NEEDLE = "new"
SALE_CLASS_NEW = "New"
SALE_CLASS_OTHER = "Second-Hand"

# --- fixed values: dataset codes and coverage -------------------------------
PRICE_INDEX_CODE = "HPM06"
PERMISSIONS_CODE = "BHA04"
RENTS_CODE = "RIA02"
SALES_CODE = "PSRA_PPR"
SALES_COVERAGE = "dublin"
SALES_COUNTY = "Dublin"
DUBLIN_NEEDLE = "dublin"

# --- fixed values: column name rules -----------------------------------------
# characters of a label that become "_" in a column name, and those that go
CUBE_NAME_BLANKS = " -/"
CSV_NAME_BLANKS = " "
NAME_DROPPED = "()"
# columns of a flat cube extract beside the label columns
EXTRACT_CODE_COLUMNS = [r"^C0.*V", r"^STATISTIC", r"^UNIT$", r"TLIST"]

# --- fixed values: parameter whitelists --------------------------------------
LOCATION_EXTRA_CHARS = " ,-"
TYPE_EXTRA_CHARS = " -"

# --- fixed values: source folders and table names ---------------------------
CUBE_SOURCES = {"house_price_index": PRICE_INDEX_CODE, "new_dwelling_completions": PERMISSIONS_CODE}
SILVER_PATHS = {
    "house_price_index": "cso/house_price_index",
    "new_dwelling_completions": "cso/new_dwelling_completions",
    "rent_by_county": "rtb/rent_by_county",
    "sales_register": "ppr/sales_register",
}
GOLD_TABLES = {
    "price": "gold_property_price_index",
    "rent": "gold_avg_rent_by_location_year",
    "perms": "gold_planning_permissions_trend",
    "sales": "gold_property_sales_dublin",
    "summary": "gold_housing_crisis_summary",
}

# --- fixed values: output columns of the views -------------------------------
SUMMARY_COLUMNS = ["year", "national_price_index", "national_price_yoy_pct", "dublin_price_index",
                   "avg_national_rent", "avg_dublin_rent", "new_communal_permissions",
                   "permissions_yoy_pct", "dublin_total_sales", "dublin_avg_sale_price",
                   "dublin_median_sale_price", "yoy_price_change_pct", "gold_updated"]
RENTS_COLUMNS = ["location", "year", "avg_monthly_rent", "min_monthly_rent", "max_monthly_rent",
                 "yoy_change_pct", "sample_count"]
PRICES_COLUMNS = ["period", "year", "month", "type_of_residential_property", "price_index",
                  "pct_change_1m", "pct_change_3m", "pct_change_12m"]
SALES_COLUMNS = ["year", "total_sales", "avg_price_eur", "median_price_eur", "min_price_eur",
                 "max_price_eur", "new_build_sales", "new_build_avg_price", "second_hand_sales",
                 "second_hand_avg_price", "yoy_price_change_pct", "county"]
