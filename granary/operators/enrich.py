"""Joins that label, extend, decode and match conformed tables, and lookups.

No join carries a broadcast hint: Spark broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits skewed partitions of the
sort-merge joins that remain.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import digits_key

Tables = Mapping[str, DataFrame]


def prefixed(df: DataFrame, prefix: str, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in (columns or df.columns)])


def label(
    df: DataFrame, dimension: DataFrame, on: Mapping[str, str], columns: Mapping[str, str]
) -> DataFrame:
    """Add columns of a dimension; rows without a match keep nulls.

    ``on`` maps a column of ``df`` to the key of the dimension, ``columns`` maps dimension columns
    to their new names.  Text meets a number under the number's type, by ``try_cast``; two kinds of
    numbers meet under their common type, so 1 is not 1.5.
    """
    keys = {f"_k{i}": (left, right) for i, (left, right) in enumerate(on.items())}
    small = dimension.select(
        *[F.col(right).alias(k) for k, (_, right) in keys.items()],
        *[F.col(c).alias(n) for c, n in columns.items()],
    )
    condition = [_equal(df[left], df, left, small[k], dimension, right)
                 for k, (left, right) in keys.items()]
    return df.join(small, condition, "left").drop(*keys)


def _equal(
    left: Column, left_df: DataFrame, left_name: str, right: Column, right_df: DataFrame, right_name: str
) -> Column:
    left_type = left_df.schema[left_name].dataType
    right_type = right_df.schema[right_name].dataType
    if left_type == right_type:
        return left == right
    if left_type.simpleString() == "string":
        return left.try_cast(right_type) == right
    if right_type.simpleString() == "string":
        return left == right.try_cast(left_type)
    return left == right  # two numbers meet under their common type


def extend(df: DataFrame, extensions: Mapping[str, DataFrame], key: str, kind: str) -> DataFrame:
    """Add the 1:1 extension that ``kind`` names; its columns get the extension's name as prefix."""
    out = df
    for name, extension in extensions.items():
        columns = {c: f"{name}_{c}" for c in extension.columns if c != key}
        own = extension.select(F.lit(name).alias("_kind"), *extension.columns)
        out = label(out, own, {key: key, kind: "_kind"}, columns)
    return out


def match_by_digits(
    left: DataFrame, left_code: str, right: DataFrame, right_key: str, columns: Mapping[str, str]
) -> DataFrame:
    """Rows of ``left`` whose code has the same digits as a key of ``right``.

    ``right_key`` is normalised already and unique, so the result is no longer than ``left``.
    Codes without digits never match.
    """
    keyed = left.withColumn("code_norm", digits_key(F.col(left_code))).where(F.col("code_norm") != "")
    target = right.select(
        F.col(right_key).alias("code_norm"), *[F.col(c).alias(n) for c, n in columns.items()]
    )
    return keyed.join(target, "code_norm")


def lookup(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows with one value; the filter is pushed to the scan (see ``sinks.layout``)."""
    return df.where(F.col(column) == F.lit(value))


def browse(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose text contains ``text``."""
    return df.where(F.col(column).contains(text))


# --- the documented joins of the food tables --------------------------------------------------


def labelled_nutrients(t: Tables) -> DataFrame:
    """Amounts with nutrient name and unit, and how each amount was derived."""
    named = label(
        t["food_nutrient"], t["nutrient"], {"nutrient_id": "id"},
        {"name": "nutrient_name", "unit_name": "nutrient_unit"},
    )
    return label(
        named, t["food_nutrient_derivation"], {"derivation_id": "id"},
        {"code": "derivation_code", "description": "derivation_description"},
    )


def labelled_portions(t: Tables) -> DataFrame:
    return label(t["food_portion"], t["measure_unit"], {"measure_unit_id": "id"}, {"name": "measure_unit"})


def extended_foods(t: Tables) -> DataFrame:
    """Foods with the columns of the data set that ``data_type`` names."""
    names = ("branded_food", "foundation_food", "sr_legacy_food", "survey_fndds_food")
    known = {n: t[n] for n in names if n in t}
    return extend(t["food"], known, "fdc_id", "data_type")


def conversion_factors(t: Tables) -> DataFrame:
    """Calorie and protein factors of each food, two hops from it."""
    key = "food_nutrient_conversion_factor_id"
    hop = label(t["food"].select("fdc_id", "description"), t["food_nutrient_conversion_factor"],
                {"fdc_id": "fdc_id"}, {"id": key})
    calories = label(hop, t["food_calorie_conversion_factor"], {key: key},
                     {c: c for c in ("protein_value", "fat_value", "carbohydrate_value")})
    return label(calories, t["food_protein_conversion_factor"], {key: key}, {"value": "nitrogen_value"})


def decoded_ingredient_values(t: Tables) -> DataFrame:
    return label(t["fndds_ingredient_nutrient_value"], t["fndds_derivation"],
                 {"derivation_code": "derivation_code"},
                 {"derivation_description": "derivation_description"})


def meal_components(t: Tables) -> DataFrame:
    """Ingredient foods of composite foods with their retention factor; ``food`` is joined twice."""
    food = {"description": "composite"}
    composite = label(t["input_food"], t["food"], {"fdc_id": "fdc_id"}, food)
    parts = label(composite, t["food"], {"fdc_id_of_input_food": "fdc_id"}, {"description": "ingredient"})
    return label(parts, t["retention_factor"], {"retention_code": "n_code"}, {"n_description": "retention"})


def categorised_surveys(t: Tables) -> DataFrame:
    return label(t["survey_fndds_food"], t["wweia_food_category"],
                 {"wweia_category_code": "wweia_food_category"},
                 {"wweia_food_category_description": "category"})


def categorised_foods(t: Tables) -> DataFrame:
    """Category names by number; foods whose category is a name keep that name."""
    named = label(t["food"], t["food_category"], {"food_category_id": "id"}, {"description": "category"})
    is_name = F.col("food_category_id").try_cast("bigint").isNull()
    return named.withColumn(
        "category", F.when(is_name, F.col("food_category_id")).otherwise(F.col("category"))
    )


def food_microbes(t: Tables) -> DataFrame:
    return label(t["microbe"], t["food"], {"foodid": "fdc_id"}, {"description": "description"})


def cross_source_matches(branded: DataFrame, products: DataFrame) -> DataFrame:
    """Branded foods whose barcode is in the product table."""
    return match_by_digits(branded, "gtin_upc", products, "code_norm",
                           {"product_name": "product_name", "brands": "product_brands"})


def nutrients_of(t: Tables, fdc_id: int) -> DataFrame:
    return lookup(labelled_nutrients(t), "fdc_id", fdc_id)


def portions_of(t: Tables, fdc_id: int) -> DataFrame:
    return lookup(labelled_portions(t), "fdc_id", fdc_id)
