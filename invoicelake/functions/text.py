"""Column expressions for invoice text: patterns, amounts, headers, printed forms. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The printed forms that extraction recognises.
AMOUNT = r"(?:Rs[.,]?)?\s*([\d,]+\.\d{2})"
INVOICE_NO = r"INV-\d{4}-\d{5}(?:-COPY)?"
INVOICE_DATE = r"\d{4}-\d{2}-\d{2}"
GSTIN = r"\b27[A-Z]{5}\d{4}[A-Z]1Z\d\b"
SUBTOTAL = r"SUBTOTAL\s*:?\s*"
GST = r"GST\s*18%\s*:?\s*"
TOTAL = r"(?<!SUB)TOTAL\s*:?\s*"
HEADING = r"TAX\s*INVOICE"
COPY_MARK = "-COPY"
WHITESPACE = " \t\n\x0b\f\r"

LINE_END = r"\n\r\x0B\f\x1C-\x1E\x85\u2028\u2029"


def first_of(text: Column, pattern: str) -> Column:
    return F.regexp_substr(text, F.lit(pattern))


def to_amount(printed: Column) -> Column:
    """``1,234.50`` -> 1234.5; NULL and anything that is not a number -> NULL."""
    return F.replace(printed, F.lit(","), F.lit("")).try_cast("double")


def first_amount(text: Column, label: str) -> Column:
    found = F.regexp_extract(text, f"(?i){label}{AMOUNT}", 1)
    return to_amount(F.nullif(found, F.lit("")))


def last_amount(text: Column, label: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(f"(?i){label}{AMOUNT}"), F.lit(1))
    return to_amount(F.try_element_at(found, F.lit(-1)))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def squeeze(text: Column) -> Column:
    """No whitespace, upper case: the form in which OCR output is searched."""
    return F.upper(F.regexp_replace(text, r"\s+", ""))


def vendor_header(text: Column) -> Column:
    """The first line without the heading, trimmed, lower case."""
    line = F.regexp_extract(text, f"^([^{LINE_END}]*)", 1)
    return F.lower(strip(F.regexp_replace(line, f"(?i){HEADING}", "")))


def printed_amount(amount: Column) -> Column:
    """Thousands separators and two decimals."""
    return F.format_number(amount, 2)


def without_copy_mark(number: Column) -> Column:
    return F.replace(number, F.lit(COPY_MARK), F.lit(""))
