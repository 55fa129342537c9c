"""Lookup seed (SRC5): the food major-group map, nine rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

GROUP_MAP_SCHEMA = T.StructType([
    T.StructField("food_code_major_group", T.LongType(), True),
    T.StructField("major_group_label", T.StringType(), True),
    T.StructField("protein_source_group", T.StringType(), True),
    T.StructField("classification_method", T.StringType(), True),
    T.StructField("classification_notes", T.StringType(), True),
])

# The food major-group map (leading digit of the 8-digit food
# code -> label, protein source group, method, note).
GROUP_MAP_ROWS = [
    (1, "Milk and milk products", "animal", "fndds_major_group_heuristic",
     "Dairy-coded foods are treated as animal-derived protein."),
    (2, "Meat poultry fish and mixtures", "animal", "fndds_major_group_heuristic",
     "Meat-centered food codes are treated as animal-derived protein."),
    (3, "Eggs", "animal", "fndds_major_group_heuristic",
     "Egg food codes are treated as animal-derived protein."),
    (4, "Legumes nuts and seeds", "plant", "fndds_major_group_heuristic",
     "Legume and nut food codes are treated as plant-derived protein."),
    (5, "Grain products", "plant", "fndds_major_group_heuristic",
     "Grain-coded foods are treated as plant-derived protein unless a richer mapping is added later."),
    (6, "Fruits", "plant", "fndds_major_group_heuristic",
     "Fruit-coded foods are treated as plant-derived protein."),
    (7, "Vegetables", "plant", "fndds_major_group_heuristic",
     "Vegetable-coded foods are treated as plant-derived protein."),
    (8, "Fats oils and salad dressings", "unclassified", "fndds_major_group_heuristic",
     "These foods are typically low-protein or source-ambiguous and remain unclassified."),
    (9, "Sugars sweets and beverages", "unclassified", "fndds_major_group_heuristic",
     "These foods mix plant and animal ingredients and remain unclassified in the initial seed."),
]
GROUP_MAP_MAX_ROWS = 64  # a leading digit has at most 10 values; generous bound

# Defaults for food codes without a mapping.
UNMAPPED_DEFAULTS = {
    "major_group_label": "Unknown",
    "protein_source_group": "unclassified",
    "classification_method": "fndds_major_group_heuristic",
    "classification_notes": "No major-group mapping was available for this food code.",
}

def group_map(spark: SparkSession) -> DataFrame:
    """The 9-row food group map as a DataFrame."""
    return spark.createDataFrame(GROUP_MAP_ROWS, GROUP_MAP_SCHEMA)


def read_group_map_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read the seed from a CSV on shared storage with its declared schema."""
    return spark.read.csv(path, header=True, schema=GROUP_MAP_SCHEMA)

