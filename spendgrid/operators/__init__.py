"""DataFrame operators: DataFrames and plain arguments in, DataFrame out."""

# Fixed values of the reference pipeline.
CATEGORIES = ("Makeup", "Skincare", "Fragrance", "Haircare", "Other")
TARGET_CATEGORIES = ("Makeup", "Skincare", "Fragrance", "Haircare")
FEATURE_CATEGORIES = ("Makeup", "Skincare", "Fragrance")
ENTITY_KEYS = ("elc_master_id", "consumer_id", "brand_id")
EXCLUDED_BRAND_CODES = ("CS", "PR", "CT")
CURRENCIES = ("USD", "CAD")
REGION = "noam"
PRODUCT_TYPE_CODE = "FERT"
DEFAULT_START_DATE = "2013-07-01"


def category_prefix(category: str) -> str:
    """'Makeup' -> 'makeup' (column name stem)."""
    return category.strip().lower().replace(" ", "_")
