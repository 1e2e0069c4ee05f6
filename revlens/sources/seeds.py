"""Default reference data (seeds) of the review warehouse.

These are the rows the warehouse ships as CSV seeds; they decide which
category group and which keyword subcategory a product gets, so they are
reproduced verbatim. Load your own with ``revlens.sources.io.read_seed`` and
the schemas below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlens.sources.fixtures import MAPPING_SCHEMA, RULES_SCHEMA

__all__ = ["MAPPING_SCHEMA", "RULES_SCHEMA", "CATEGORY_MAPPING", "SUBCATEGORY_RULES",
           "default_category_mapping", "default_subcategory_rules"]

# fixed values: main_category → (category_group, is_premium)
CATEGORY_MAPPING = [
    ("All Beauty", "Beauty", False),
    ("Premium Beauty", "Beauty", True),
]

# fixed values: subcategory keyword rules (lowercase regex alternations, priority)
SUBCATEGORY_RULES = [
    ("Hair Care", "hair shampoo|hair conditioner|hair mask|hair treatment|dry shampoo|scalp", 10),
    ("Hair Tools", "brush|comb|straightener|curler|blow dryer|flat iron", 10),
    ("Hair Color", "hair dye|hair color|hair colour|bleach|highlights", 10),
    ("Skincare", "moisturizer|face cream|serum|toner|cleanser|face wash|exfoliator|face mask", 10),
    ("Sun Care", "sunscreen|spf|sun block|tanning|self tan", 10),
    ("Body Care", "body lotion|body wash|shower gel|body oil|body scrub|deodorant", 10),
    ("Lip Products", "lipstick|lip gloss|lip balm|lip liner|lip mask", 10),
    ("Eye Makeup", "mascara|eyeliner|eye shadow|eyeshadow|eye liner|eye pencil", 10),
    ("Face Makeup", "foundation|concealer|blush|bronzer|highlighter|powder|primer", 10),
    ("Nail Care", "nail polish|nail file|nail clipper|manicure|pedicure|cuticle", 10),
    ("Fragrance", "perfume|cologne|fragrance|eau de|body spray|body mist", 10),
    ("Beauty Tools", "tweezer|sponge|applicator|mirror|scissors|razor", 5),
]


def default_category_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORY_MAPPING, MAPPING_SCHEMA)


def default_subcategory_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SUBCATEGORY_RULES, RULES_SCHEMA)
