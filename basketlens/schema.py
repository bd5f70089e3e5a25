"""Fixed schemas of the input tables."""

from pyspark.sql import types as T

RAW_RETAIL = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.StringType()),
        T.StructField("Country", T.StringType()),
    ]
)

RATINGS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item", T.LongType()),
        T.StructField("rating", T.DoubleType()),
    ]
)
