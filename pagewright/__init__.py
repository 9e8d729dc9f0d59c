"""Book-text analytics on Spark: OCR rows to checked, structured, published text."""
