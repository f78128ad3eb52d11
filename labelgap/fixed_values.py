"""Names, patterns, word lists and thresholds that results depend on.

They are stated here once, as plain text, and passed to the operators as
default arguments, so every one of them can be replaced by the caller.
"""

# -- fixed values: population filter ----------------------------------------
BROAD_MARKET_PATTERN = "korea|kr"
STRICT_MARKET_PATTERN = "en:south-korea|en:kr|en:korea|south-korea"

PRODUCT_COLUMNS = [
    "code", "product_name", "brands", "brands_tags", "categories", "categories_tags",
    "countries_tags", "allergens_tags", "labels_tags", "nutriscore_grade", "nutriments",
]

# -- fixed values: nutrients (column -> names in order of preference) --------
NUTRIENT_SOURCES = {
    "energy_100g": ["energy-kcal", "energy"],
    "fat_100g": ["fat"],
    "saturated_fat_100g": ["saturated-fat"],
    "carbohydrates_100g": ["carbohydrates"],
    "sugars_100g": ["sugars"],
    "proteins_100g": ["proteins"],
    "sodium_100g": ["sodium"],
    "salt_100g": ["salt"],
}
KJ_PER_KCAL = 4.184
KILOJOULE_NAME = "energy"

# -- fixed values: missing-value handling ------------------------------------
MISSING = "missing"
NULL_KEY_TEXT = "None"
FILLED_CATEGORICAL_COLUMNS = ["nutriscore_grade", "categories_tags", "allergens_tags", "labels_tags"]
TAG_COLUMNS = [
    "categories_tags", "allergens_tags", "labels_tags", "brands_tags", "countries_tags", "ingredients_text",
]

# -- fixed values: category display groups (first hit in this order wins) ----
CATEGORY_GROUPS = {
    "snacks": "Snacks",
    "instant-noodles": "Instant Noodles",
    "ramen": "Instant Noodles",
    "beverages": "Beverages",
    "sauces": "Sauces",
    "condiments": "Sauces",
    "dairies": "Dairies",
    "meats-and-their-products": "Meat Products",
    "plant-based-foods-and-beverages": "Plant-based Foods",
    "breakfasts": "Breakfast Foods",
    "desserts": "Desserts",
}
UNKNOWN_CATEGORY = "Unknown"

# -- fixed values: flags by substring -----------------------------------------
ALLERGEN_PATTERNS = {
    "has_gluten": "gluten|wheat",
    "has_nuts": "nut|almond",
    "has_milk": "milk|lactose",
    "has_eggs": "egg",
    "has_soy": "soy",
    "has_fish": "fish",
    "has_shellfish": "shellfish|crustacean",
}
LABEL_PATTERNS = {
    "is_organic": "organic",
    "is_vegan": "vegan",
    "is_vegetarian": "vegetarian",
    "is_fair_trade": "fair-trade|fair_trade",
    "is_bio": "bio",
}

# -- fixed values: label languages --------------------------------------------
DOMESTIC_CODES = ["ko", "korean", "kr"]
EXPORT_CODES = ["en", "english"]
DOMESTIC_SCRIPT = "[가-힣]"
EXPORT_SCRIPT = "[A-Za-z]"

CASE_GAP = "Gap (내수용)"
CASE_COMPLIANT = "Compliant (수출/글로벌용)"
CASE_NO_DATA = "No Data (데이터 부족)"
CASE_EXPORT_ONLY = "English Only"
LANGUAGE_CASES = [CASE_GAP, CASE_COMPLIANT, CASE_NO_DATA, CASE_EXPORT_ONLY]
RISK_MARK = "Gap"

# -- fixed values: features and models -----------------------------------------
NUTRIENT_MARK = "_100g"
FLAG_PREFIXES = ["has_", "is_"]
CATEGORICAL_FEATURES = ["category_top", "nutriscore_grade"]
ID_COLUMNS = ["code"]
MODEL_NUTRIENTS = ["energy_100g", "fat_100g", "sugars_100g", "proteins_100g", "sodium_100g"]
DETECTOR_FEATURES = MODEL_NUTRIENTS + ["category_top"]
SEED = 42
N_TREES = 100
N_SYNTHETIC = 3000

# -- fixed values: documented cleaning options ----------------------------------
SPARSE_COLUMN_SHARE = 0.7
PHYSICAL_RANGES = {"energy_100g": (0.0, 900.0), "fat_100g": (0.0, 100.0)}

# -- fixed values: validation -----------------------------------------------------
PSI_BINS = 10
PSI_EMPTY_SHARE = 0.0001
KEY_PAIRS = [
    ("sugars_100g", "energy_100g"),
    ("fat_100g", "energy_100g"),
    ("sugars_100g", "fat_100g"),
]
PSI_BANDS = (0.1, 0.25)
CORRELATION_BANDS = (0.1, 0.2)
AUROC_BANDS = (0.55, 0.65)

# -- fixed values: risk bands -------------------------------------------------------
RISK_HIGH = 70.0
RISK_CAUTION = 40.0

# -- fixed values: label drafting -----------------------------------------------------
UNKNOWN_PRODUCT_NAME = "Unknown Snack"
UNKNOWN_CARD_NAME = "Unknown Product"
UNKNOWN_ALLERGENS = "Unknown (Infer from name)"
LABEL_GROUP = "Snacks"
LABEL_COUNT = 5
LABEL_JOIN_COLUMNS = [
    "energy_100g", "fat_100g", "saturated_fat_100g", "carbohydrates_100g", "sugars_100g",
    "proteins_100g", "sodium_100g", "allergens_tags",
]
REPORT_COLUMNS = ["original_code", "product_name_en", "serving_size", "calories_per_serving", "allergen_statement"]
# The drafting prompt; the three places in pointed brackets are filled in.
PROMPT_TEMPLATE = """
    Role: You are a Food Regulatory Expert specialized in US FDA compliance.
    Task: Convert the given Korean snack data into a JSON format for a US Nutrition Facts label.
    
    [Input Data]
    - Original Name: <<name>>
    - Category: Snack
    - Nutrition (per 100g): <<nutrition>>
    - Raw Allergen Tags: <<allergens>>
    
    [Target JSON Structure]
    {
      "product_name_en": "...",
      "serving_size": "30g",
      "calories_per_serving": "...",
      "nutrition_facts": { "total_fat": "...", "sodium": "...", "total_carbohydrate": "...", "protein": "..." },
      "allergen_statement": "Contains: ...",
      "marketing_claims": ["..."] 
    }
    """
