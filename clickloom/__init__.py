"""Click-stream analytics on Spark: sessions, categories, page flows, products and ad clicks."""
