"""Declared schemas of the stored tables (DDL strings, read with ``spark.read.schema``)."""

DOCUMENTS = (
    "doc_id string, file_name string, source_path string, bronze_path string, sha256 string, "
    "size_bytes long, source string, ingested_at string, status string, duplicate_of string, "
    "error_message string"
)
OCR = "doc_id string, text string, mean_conf double, n_words long"
IMAGE_QUALITY = "doc_id string, skew_angle double, blur_score double, processed_path string"
EXTRACTED = (
    "doc_id string, invoice_no string, invoice_date string, gstin string, vendor_id string, "
    "vendor_name string, vendor_match double, subtotal double, gst double, total double, "
    "mean_conf double, flags string, needs_review long"
)
TRUTH = (
    "file string, invoice_no string, vendor_id string, vendor_name string, gstin string, "
    "invoice_date string, subtotal double, gst double, total double, is_duplicate int, is_anomaly int"
)
SPLIT = "doc_id string, split string"
WORDS = "doc_id string, pos long, word string, conf string"
ENTITIES = "doc_id string, pos long, label string, text string"
CLASS_PREDICTIONS = "model string, condition string, seed string, label int, prediction int"
