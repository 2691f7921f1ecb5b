"""Fixed facts about the two built-in data sets, and small driver-side descriptors.

Nothing here touches rows.  The rules that *use* these values live in
``granary.functions.rules``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: column names that carry a known type -------------------------------------

DATE_COLUMNS = (
    "acquisition_date", "available_date", "discontinued_date", "end_date", "expiration_date",
    "last_updated", "modified_date", "publication_date", "sell_by_date", "start_date",
)
DOUBLE_COLUMNS = (
    "adjusted_amount", "amount", "carbohydrate_value", "fat_value", "gram_weight", "loq", "max",
    "median", "min", "nutrient_nbr", "nutrient_value", "pct_weight", "percent_daily_value",
    "protein_value", "rank", "serving_size", "value",
)
LONG_COLUMNS = (
    "data_points", "food_group_id", "min_year_acquired", "seq_num", "sr_addmod_year",
    "wweia_category_code",
)
ID_COLUMNS = ("id", "fdc_id", "foodid")
TEXT_COLUMNS = ("gtin_upc", "ndb_number", "upc_code")
TEXT_TABLE_COLUMNS = (("food", "food_category_id"),)

# --- fixed values: keys -----------------------------------------------------------------------

ONE_ROW_PER_FOOD = ("branded_food", "foundation_food", "sr_legacy_food", "survey_fndds_food")
# table -> (key columns, whether the columns must be present for the key to apply)
TABLE_KEYS = {
    "acquisition_samples": (("fdc_id_of_sample_food", "fdc_id_of_acquisition_food"), False),
    "lab_method_code": (("lab_method_id", "code"), False),
    "lab_method_nutrient": (("lab_method_id", "nutrient_id"), False),
    "sub_sample_result": (("food_nutrient_id", "lab_method_id"), False),
    "market_acquisition": (("fdc_id", "acquisition_number"), True),
    "food_calorie_conversion_factor": (("food_nutrient_conversion_factor_id",), True),
    "food_protein_conversion_factor": (("food_nutrient_conversion_factor_id",), True),
}

# --- fixed values: bundle files ---------------------------------------------------------------

RECORD_COUNT_FILE = "all_downloaded_table_record_counts.csv"
RECORD_COUNT_TABLE = "Table"
RECORD_COUNT_ROWS = "Number of Records"

# --- fixed values: product export -------------------------------------------------------------

PRODUCT_EXPORT_URL = "https://static.openfoodfacts.org/data/en.openfoodfacts.org.products.csv.gz"
PRODUCT_KEY_FIELD = "code"
PRODUCT_TEXT_FIELDS = ("product_name", "brands", "categories", "quantity", "serving_size")
PRODUCT_TIME_FIELD = "last_modified_t"
NUTRIENT_SUFFIX = "_100g"
ENERGY_KJ_FIELD = "energy-kj_100g"
ENERGY_FIELD = "energy_100g"


@dataclass(frozen=True)
class NutrientField:
    """One wide nutrient header, the long key it becomes, its unit and its wide target column."""

    source_field: str
    nutrient_key: str
    unit: str
    wide_column: str


# fixed values: the minimal nutrient dimension, salt last because it is optional
NUTRIENT_FIELDS = (
    NutrientField("energy-kcal_100g", "energy_kcal", "kcal", "energy_kcal_100g"),
    NutrientField("energy-kj_100g", "energy_kj", "kJ", "energy_kj_100g"),
    NutrientField("energy_100g", "energy_kj", "kJ", "energy_kj_100g"),
    NutrientField("fat_100g", "fat", "g", "fat_100g"),
    NutrientField("saturated-fat_100g", "saturated_fat", "g", "saturated_fat_100g"),
    NutrientField("carbohydrates_100g", "carbohydrates", "g", "carbohydrates_100g"),
    NutrientField("sugars_100g", "sugars", "g", "sugars_100g"),
    NutrientField("fiber_100g", "fiber", "g", "fiber_100g"),
    NutrientField("proteins_100g", "protein", "g", "protein_100g"),
    NutrientField("sodium_100g", "sodium", "g", "sodium_100g"),
    NutrientField("salt_100g", "salt", "g", "salt_100g"),
)
SALT_FIELD = "salt_100g"
# fixed values: units known from the header alone, every other header has none
HEADER_UNITS = {"energy-kj_100g": "kJ", "energy_100g": "kJ", "energy-kcal_100g": "kcal"}

WIDE_NUTRIENT_COLUMNS = tuple(dict.fromkeys(f.wide_column for f in NUTRIENT_FIELDS))


def nutrient_fields(include_salt: bool = False) -> tuple[NutrientField, ...]:
    """The minimal nutrient dimension: ten fields, eleven with salt."""
    return tuple(f for f in NUTRIENT_FIELDS if include_salt or f.source_field != SALT_FIELD)


# --- target schemas of the product tables -----------------------------------------------------

PRODUCT_SCHEMA = T.StructType(
    [T.StructField("code_norm", T.StringType(), False), T.StructField("code_raw", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in PRODUCT_TEXT_FIELDS]
    + [T.StructField(PRODUCT_TIME_FIELD, T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in WIDE_NUTRIENT_COLUMNS]
)
NUTRIENT_SCHEMA = T.StructType(
    [
        T.StructField("code_norm", T.StringType(), False),
        T.StructField("nutrient_key", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("source_field", T.StringType()),
    ]
)
PROVENANCE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("imported_at", T.TimestampType(), False),
        T.StructField("source_url", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("file_sha256", T.StringType()),
        T.StructField("file_bytes", T.LongType()),
        T.StructField("delimiter", T.StringType()),
        T.StructField("nutrients_mode", T.StringType()),
    ]
)
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("code_total", T.LongType()),
        T.StructField("code_unique", T.LongType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("delimiter", T.StringType()),
        T.StructField("detected_delimiter", T.StringType()),
        T.StructField("duplicate_codes_count", T.LongType()),
        T.StructField("duplicate_codes_path", T.StringType()),
        T.StructField("duplicate_occurrences", T.LongType()),
        T.StructField("duplicate_samples", T.ArrayType(T.StringType())),
        T.StructField("duplicate_values", T.LongType()),
        T.StructField("duplicates_found", T.BooleanType()),
        T.StructField("file_bytes", T.LongType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("file_sha256", T.StringType()),
        T.StructField("format_version", T.LongType()),
        T.StructField("skipped_no_code", T.LongType()),
        T.StructField("sort_seconds", T.DoubleType()),
    ]
)


# --- references between tables ----------------------------------------------------------------


@dataclass(frozen=True)
class Edge:
    """``child.child_key`` refers to ``parent.parent_key``."""

    child: str
    child_key: str
    parent: str
    parent_key: str

    @property
    def name(self) -> str:
        return f"{self.child}.{self.child_key} -> {self.parent}.{self.parent_key}"


# fixed values: the five references that are checked by hand after an import
CHECKED_EDGES = (
    Edge("branded_food", "fdc_id", "food", "fdc_id"),
    Edge("food_nutrient", "fdc_id", "food", "fdc_id"),
    Edge("food_nutrient", "nutrient_id", "nutrient", "id"),
    Edge("food_portion", "fdc_id", "food", "fdc_id"),
    Edge("food_portion", "measure_unit_id", "measure_unit", "id"),
)
DOCUMENTED_EDGES = (
    Edge("food_nutrient", "derivation_id", "food_nutrient_derivation", "id"),
    Edge("food_nutrient_conversion_factor", "fdc_id", "food", "fdc_id"),
    Edge("food_calorie_conversion_factor", "food_nutrient_conversion_factor_id",
         "food_nutrient_conversion_factor", "id"),
    Edge("food_protein_conversion_factor", "food_nutrient_conversion_factor_id",
         "food_nutrient_conversion_factor", "id"),
    Edge("survey_fndds_food", "fdc_id", "food", "fdc_id"),
    Edge("survey_fndds_food", "wweia_category_code", "wweia_food_category", "wweia_food_category"),
    Edge("input_food", "fdc_id", "food", "fdc_id"),
    Edge("input_food", "fdc_id_of_input_food", "food", "fdc_id"),
    Edge("input_food", "retention_code", "retention_factor", "n_code"),
    Edge("foundation_food", "fdc_id", "food", "fdc_id"),
    Edge("sr_legacy_food", "fdc_id", "food", "fdc_id"),
    Edge("microbe", "foodid", "food", "fdc_id"),
)
SAMPLING_EDGES = (
    Edge("market_acquisition", "fdc_id", "food", "fdc_id"),
    Edge("acquisition_samples", "fdc_id_of_sample_food", "food", "fdc_id"),
    Edge("acquisition_samples", "fdc_id_of_acquisition_food", "food", "fdc_id"),
    Edge("agricultural_samples", "fdc_id", "food", "fdc_id"),
    Edge("sample_food", "fdc_id", "food", "fdc_id"),
    Edge("sub_sample_food", "fdc_id", "food", "fdc_id"),
    Edge("sub_sample_food", "fdc_id_of_sample_food", "food", "fdc_id"),
    Edge("sub_sample_result", "food_nutrient_id", "food_nutrient", "id"),
    Edge("sub_sample_result", "lab_method_id", "lab_method", "id"),
    Edge("lab_method_code", "lab_method_id", "lab_method", "id"),
    Edge("lab_method_nutrient", "lab_method_id", "lab_method", "id"),
    Edge("lab_method_nutrient", "nutrient_id", "nutrient", "id"),
    Edge("food_attribute", "fdc_id", "food", "fdc_id"),
    Edge("food_attribute", "food_attribute_type_id", "food_attribute_type", "id"),
)
ALL_EDGES = CHECKED_EDGES + DOCUMENTED_EDGES + SAMPLING_EDGES


# --- access paths for lookups -----------------------------------------------------------------


@dataclass(frozen=True)
class AccessPath:
    """A named lookup column of a table."""

    name: str
    table: str
    column: str


ACCESS_PATHS = (
    AccessPath("food_description_idx", "food", "description"),
    AccessPath("food_fdc_id_idx", "food", "fdc_id"),
    AccessPath("branded_food_gtin_upc_idx", "branded_food", "gtin_upc"),
    AccessPath("food_nutrient_fdc_id_idx", "food_nutrient", "fdc_id"),
    AccessPath("food_portion_fdc_id_idx", "food_portion", "fdc_id"),
    AccessPath("survey_fndds_food_food_code_idx", "survey_fndds_food", "food_code"),
    AccessPath("survey_fndds_food_wweia_category_code_idx", "survey_fndds_food",
               "wweia_category_code"),
)

# fixed values: the run events a job may record
BUNDLE_EVENTS = (
    "run_start", "schema_drop", "run_resume", "expected_rows_mismatch", "table_truncate",
    "table_start", "table_already_loaded", "table_resume", "dictionary_miss_table",
    "dictionary_miss_headers", "table_done", "table_error", "run_done",
)
PRODUCT_EVENTS = ("dialect", "preflight_done", "done")
LAYOUT_EVENTS = (
    "index_run_start", "index_skip_missing_table", "index_start", "index_done", "index_run_done",
)
