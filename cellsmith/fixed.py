"""Fixed values that must equal the cleaning contract's for right results.

These are data, not logic: the boolean vocabulary, the array-key list and the
sub-field map of the token texts, each kept as given, in the given order.
"""

# --- fixed values: boolean / array vocabulary --------------------------------
TRUE_WORDS = ["true", "有货", "自营", "现货", "0"]
# The last entry is the *number* 0, not the text "0"; it never equals a field
# text, so "0" is a true word and only a true word.
FALSE_WORDS = ["false", "无货", "休息中", "", "1", 0]
SPECIAL_BOOL_KEYS = ["营业状态", "brand_type", "status_desc", "sold_out"]
ARRAY_KEYS = [
    "categorys",
    "资质与折扣",
    "price",
    "店铺活动",
    "activity_ids",
    "welfare_info",
    "welfare_act_info",
    "specfoods",
    "促销活动",
    "营业执照",
    "营业时间",
    "活动",
    "资质与优惠",
    "折扣",
    "推荐菜",
    "地址",
    "opening_hours",
]

# --- fixed values: token sub-fields (source key -> clean name, type) ---------
# Used by the backfill job.
BACKFILL_SUBFIELDS = {
    "original_price": ("originalPrice", "double"),
    "packing_fee": ("packingFee", "double"),
    "recent_rating": ("recentRating", "float"),
    "promotion_stock": ("promotionStock", "int"),
    "price": ("currentPrice", "double"),
    "sold_out": ("isAvailable", "boolean"),
    "recent_popularity": ("recentPopularity", "int"),
    "item_id": ("productRawId", "String"),
    "stock": ("stock", "int"),
}

# Used by list cleaning of menu pages (same map, `sku_id` instead of `item_id`).
MENU_SUBFIELDS = {
    "original_price": ("originalPrice", "double"),
    "packing_fee": ("packingFee", "double"),
    "recent_rating": ("recentRating", "float"),
    "promotion_stock": ("promotionStock", "int"),
    "price": ("currentPrice", "double"),
    "sold_out": ("isAvailable", "boolean"),
    "recent_popularity": ("recentPopularity", "int"),
    "stock": ("stock", "int"),
    "sku_id": ("sku", "String"),
}

# --- fixed values: row-key regex of menu items and the family/qualifier names -
MENU_ROWKEY_REGEX = r"\sfood_id:(\d+)"
LATEST_FAMILY = "content"
DOWNLOAD_TIME_FAMILY = "downloadTime"

# --- fixed values: array columns with their own rendering --------------------
# List pages: the token-text array whose first element is split into sub-fields.
SUBFIELD_ARRAY_KEY = "specfoods"
# Detail pages: arrays of objects joined by "/" on one field of each object.
JOIN_FIELD_KEYS = {"flavors": "name", "supports": "description"}
TOKEN_SEPARATOR = "  "
