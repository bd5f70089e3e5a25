"""Word lists and constants that decide the results, kept verbatim."""

# Codes that mark lines which are not products.
NON_PRODUCT_CODES = [
    "AMAZONFEE", "BANK CHARGES", "C2", "DCGSSBOY", "DCGSSGIRL", "DOT", "gift_0001_", "PADS", "POST",
]

# Descriptions that mark stock adjustments, matched exactly.
# Two of them occur twice, and one ends in a blank and so cannot match trimmed text.
ADJUSTMENT_DESCRIPTIONS = [
    "check", "check?", "?", "??", "damaged", "found",
    "adjustment", "Amazon", "AMAZON", "amazon adjust",
    "Amazon Adjustment", "amazon sales", "Found", "FOUND",
    "found box", "Found by jackie ", "Found in w/hse", "dotcom",
    "dotcom adjust", "allocate stock for dotcom orders ta", "FBA",
    "Dotcomgiftshop Gift Voucher £100.00", "on cargo order",
    "wrongly sold (22719) barcode", "wrongly marked 23343",
    "dotcomstock", "rcvd be air temp fix for dotcom sit", "Manual",
    "John Lewis", "had been put aside", "for online retail_data orders",
    "taig adjust", "amazon", "incorrectly credited C550456 see 47",
    "returned", "wrongly coded 20713", "came coded as 20713",
    "add stock to allocate online orders", "Adjust bad debt",
    "alan hodge cant mamage this section", "website fixed",
    "did  a credit  and did not tick ret", "michel oops",
    "incorrectly credited C550456 see 47", "mailout", "test",
    "Sale error", "Lighthouse Trading zero invc incorr", "SAMPLES",
    "Marked as 23343", "wrongly coded 23343", "Adjustment",
    "rcvd be air temp fix for dotcom sit", "Had been put aside.",
]

# The sample order.
SAMPLE_ORDER = [
    "GREEN REGENCY TEACUP AND SAUCER",
    "SET OF 3 BUTTERFLY COOKIE CUTTERS",
    "JAM MAKING SET WITH JARS",
    "SET OF TEA COFFEE SUGAR TINS PANTRY",
    "SET OF 4 PANTRY JELLY MOULDS",
]

# Weekday names, Monday first.
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# Stand-in for an exact zero that must stay present.
TINY = 1e-6

# Lengths of the recommendation lists under evaluation.
LIST_SIZES = [1, 3, 5, 10, 15, 20]

# Bounds of a rating.
LOWEST_RATING = 1.0
HIGHEST_RATING = 5.0
