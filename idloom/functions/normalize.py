"""Normalisation of identifiers, dates, phones and documents as Column expressions.

Everything is built from built-in functions, so it stays inside code generation and one scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Document type codes of source A and the type ids they stand for.
DOC_TYPE_CODES_A = {
    "1": 2, "2": 4, "3": 5, "4": 6, "5": 7, "6": 15, "7": 8, "9": 9, "10": 10, "11": 11, "12": 12,
    "13": 13, "14": 17, "15": 14, "16": 1, "17": 3, "18": 17, "19": 15, "20": 16, "47": 17,
    "51": 17, "52": 17, "90": 17, "99": 17, "100": 17, "101": 17, "289": 16, "412": 17,
    "732": 17, "735": 10, "1374": 17,
}
# Identity document types run from 1 to 17; 1 is the passport, 17 any other document.
DOC_TYPE_FIRST, DOC_TYPE_LAST, DOC_TYPE_PASSPORT, DOC_TYPE_OTHER = 1, 17, 1, 17
# Branch 7 of source B is business unit 3, every other branch is unit 2.
BRANCH_OF_UNIT_3 = 7
# Cyrillic letters and their Latin spelling.
LATIN = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z",
    "и": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r",
    "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh",
    "щ": "sch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}


def digits(x: Column) -> Column:
    """The ASCII digits of ``x``."""
    return F.regexp_replace(x, "[^0-9]", "")


def _filled(x: Column) -> Column:
    return x.isNotNull() & (x != "")


def norm_business_unit(filial: Column) -> Column:
    return F.when(filial == BRANCH_OF_UNIT_3, F.lit(3)).otherwise(F.lit(2))


def norm_doc_concat_b(series: Column, number: Column) -> Column:
    """Series and number without dashes and spaces; NULL if either is NULL."""
    def strip(x: Column) -> Column:
        return F.translate(x, "- ", "")
    return F.concat(strip(series), strip(number))


def norm_doc_number(x: Column) -> Column:
    """Digits as BIGINT; NULL without digits or beyond the BIGINT range."""
    return F.nullif(digits(x), F.lit("")).try_cast("bigint")


def doc_number_overflow(x: Column) -> Column:
    """True where ``x`` has digits that do not fit a BIGINT."""
    return F.coalesce(digits(x) != "", F.lit(False)) & norm_doc_number(x).isNull()


def doc_text_a(series: Column, number: Column) -> Column:
    """Series and number joined, a missing part counts as empty."""
    return F.concat_ws("", series, number)


def norm_doc_number_a(series: Column, number: Column) -> Column:
    return norm_doc_number(doc_text_a(series, number))


def norm_phone_b(phone1: Column, phone2: Column, phone3: Column) -> Column:
    """Digits of the first filled one of phone 3, phone 2, phone 1."""
    return digits(F.when(_filled(phone3), phone3).when(_filled(phone2), phone2).otherwise(phone1))


def norm_phone_a(x: Column) -> Column:
    """Digits, NULL if none; an 11-digit number starting with 8 gets the country code 7."""
    d = digits(x)
    return F.when(d.rlike("^8[0-9]{10}$"), F.concat(F.lit("7"), F.substring(d, 2, 10))).otherwise(
        F.nullif(d, F.lit("")))


def _ymd_ok(x: Column) -> Column:
    """Eight digits with month 01-12 and day 01-31."""
    return digits(x).rlike("^[0-9]{4}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])$")


def norm_date_a(x: Column) -> Column:
    """YYYYMMDD in any punctuation as a date, else NULL."""
    return F.when(_ymd_ok(x), F.try_to_date(digits(x), "yyyyMMdd"))


def impossible_date_a(x: Column) -> Column:
    """True for text that looks like a date but names no day of the calendar (30 February)."""
    return F.coalesce(_ymd_ok(x), F.lit(False)) & norm_date_a(x).isNull()


def norm_date_dmy(x: Column) -> Column:
    """Text D.M.Y as Y-M-D without padding; other text unchanged."""
    p = F.split(x, "[.]")
    return F.when(F.size(p) == 3, F.concat_ws("-", F.get(p, F.lit(2)), F.get(p, F.lit(1)), F.get(p, F.lit(0)))
                  ).otherwise(x)


def iso_date(x: Column) -> Column:
    """Y-M-D text as a date, with or without padding; NULL if it is none."""
    return F.when(x.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.try_to_date(x, "yyyy-M-d"))


def valid_iso_birthdate(x: Column) -> Column:
    return F.coalesce(iso_date(x).isNotNull(), F.lit(False))


def map_doc_type_a(code: Column) -> Column:
    """Type id of a source A code: blank is a passport, an unknown code is 'other'."""
    pairs = [F.lit(v) for kv in DOC_TYPE_CODES_A.items() for v in kv]
    return F.when(_filled(code), F.coalesce(
        F.try_element_at(F.create_map(*pairs), code), F.lit(DOC_TYPE_OTHER))
    ).otherwise(F.lit(DOC_TYPE_PASSPORT))


def map_doc_type_b(code: Column) -> Column:
    """Type id of a source B code: missing, zero or no number is a passport, out of range is 'other'."""
    text = F.trim(code.cast("string"))
    n = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))
    return (F.when(text.isNull() | ~text.rlike("^[+-]?[0-9]+$") | (n == 0), F.lit(DOC_TYPE_PASSPORT))
            .when(n.between(DOC_TYPE_FIRST, DOC_TYPE_LAST), n.cast("int"))
            .otherwise(F.lit(DOC_TYPE_OTHER)))


def clamp_doc_type(t: Column) -> Column:
    """A type id outside the known range becomes 'other'; NULL stays NULL."""
    return F.when(t.isNotNull() & ~t.between(DOC_TYPE_FIRST, DOC_TYPE_LAST), F.lit(DOC_TYPE_OTHER)).otherwise(t)


def default_doc_type(t: Column, number: Column) -> Column:
    """A number without a type is taken for a passport."""
    return F.when(t.isNull() & number.isNotNull(), F.lit(DOC_TYPE_PASSPORT)).otherwise(t)


def transliterate_name(x: Column) -> Column:
    """Lower-cased text with Cyrillic letters spelled in Latin."""
    out = F.lower(x)
    for letter, latin in LATIN.items():
        if len(latin) > 1:
            out = F.replace(out, F.lit(letter), F.lit(latin))
    # translate() drops the letters that have no counterpart, so those come last
    single = sorted((k for k, v in LATIN.items() if len(v) < 2), key=lambda k: LATIN[k] == "")
    return F.translate(out, "".join(single), "".join(LATIN[k] for k in single))
