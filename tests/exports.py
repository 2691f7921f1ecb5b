"""Small product exports."""

_PRODUCT_HEADER = ["code", "product_name", "brands", "categories", "quantity", "energy-kcal_100g", "fat_100g",
                   "proteins_100g", "carbohydrates_100g", "sugars_100g", "last_modified_t"]
TWO_PRODUCTS = [
    [_PRODUCT_HEADER[i] for i in (0, 1, 2, 5, 6, 7, 10)],
    ["00731", "Oat drink", "Mill & Co", "46", "1.5", "0.9", "1600000000"],
    ["00732", "Rye bread", "Mill & Co", "219", "1.2", "7.5", "1600000100"],
]
#: Three versions of one code: the oldest stamp, then two with one stamp of which the second has more cells.
SCORED = [
    _PRODUCT_HEADER,
    ["00731", "oldest", "Mill", "", "", "44", "1.4", "", "", "", "1600000000"],
    ["00731", "sparse", "Mill", "", "", "45", "1.6", "", "", "", "1600000900"],
    ["00731", "complete", "Mill", "Drinks", "1 l", "46", "1.5", "0.9", "6.7", "4.1", "1600000900"],
    ["00799", "single", "Other", "Bread", "750 g", "219", "1.2", "7.5", "40.1", "3.3", "1600000300"],
]


def write_rows(path, rows, sep="\t", bom=False):
    text = "".join(sep.join(r) + "\n" for r in rows)
    path.write_text(("\ufeff" if bom else "") + text, encoding="utf-8")
    return str(path)
