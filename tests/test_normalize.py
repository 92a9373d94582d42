"""Golden cases of the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from idloom.functions import normalize as N
from idloom.operators import conform as C


def run(spark, values, f, kind="string"):
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    n = len(rows[0]) - 1
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"c{k} {kind}" for k in range(n)))
    return [r[0] for r in df.orderBy("i").select(f(*[F.col(f"c{k}") for k in range(n)])).collect()]


@pytest.mark.parametrize("text, ok", [
    *[(t, True) for t in ("1990-01-15", "2000-12-31", "1985-06-20", "2023-02-28", "2020-02-29", "1990-1-1",
                          "2000-02-29", "1900-01-01", "2100-12-31")],
    *[(t, False) for t in ("1990/01/15", "15-01-1990", "1990-13-01", "1990-01-32", "invalid", "", "90-01-15",
                           "2021-02-29", "1900-02-29")]])
def test_iso_birthdate(spark, text, ok):
    assert run(spark, [text], N.valid_iso_birthdate) == [ok]


def test_document_types(spark):
    assert run(spark, ["99", "88", "0", None, "abc", "5", "42", "-1", " 7 ", "99999999999999999999", "5.0"], N.map_doc_type_b) == \
        [17, 17, 1, 1, 1, 5, 17, 17, 7, 17, 1]
    assert run(spark, ["16", "17", "1", "289", "735", "1374", "777", "", None], N.map_doc_type_a) == [1, 3, 2, 16, 10, 17, 17, 1, 1]
    assert run(spark, [0, 1, 17, 18, None], N.clamp_doc_type, "int") == [17, 1, 17, 17, None]


def test_document_numbers(spark):
    assert run(spark, [("45 08", "123-456"), ("", ""), ("AB", ""), (None, "12"), (None, None)], N.norm_doc_number_a) == \
        [4508123456, None, None, 12, None]
    assert run(spark, [("45-08", "12 34"), (None, "12"), ("1", None)], N.norm_doc_concat_b) == ["45081234", None, None]
    assert run(spark, ["9223372036854775807", "9223372036854775808", "x"], N.norm_doc_number) == [9223372036854775807, None, None]
    assert run(spark, ["9223372036854775807", "9223372036854775808", "x", None], N.doc_number_overflow) == [False, True, False, False]


def test_phones(spark):
    assert run(spark, ["8 (912) 345-67-89", "none", "+7 900", "", None, "89123456789012"], N.norm_phone_a) == \
        ["79123456789", None, "7900", None, None, "89123456789012"]
    assert run(spark, [("1", "2", "3"), ("1", "2", ""), ("1", None, ""), (None, None, None), ("a", "", "")], N.norm_phone_b) == \
        ["3", "2", "1", None, ""]


def test_dates(spark):
    assert run(spark, ["19850515", "19901301", "1985", "1985-05-15", "20200231", "20200132", None], N.norm_date_a) == \
        [dt.date(1985, 5, 15), None, None, dt.date(1985, 5, 15), None, None, None]
    assert run(spark, ["20200231", "19901301", "19850515", None], N.impossible_date_a) == [True, False, False, False]
    assert run(spark, ["05.03.1980", "5.3.1980", "1980-03-05", "1.2", None], N.norm_date_dmy) == \
        ["1980-03-05", "1980-3-5", "1980-03-05", "1.2", None]
    assert run(spark, ["1980-3-5"], N.iso_date) == [dt.date(1980, 3, 5)]


def test_transliteration(spark):
    assert run(spark, ["Щукин Юрий", "Объезд", "Ёж", "Smith-Жук 7"], N.transliterate_name) == \
        ["schukin yuriy", "obezd", "ezh", "smith-zhuk 7"]


def test_flags_and_names(spark):
    row = spark.createDataFrame([("12345", 2, 2, "Иванов", "", None, 1, 4508, "a@b", None, "pw", "login")],
                                "hisnumber string, source int, businessunit int, lastname string, name string, surname string, "
                                "documenttypes int, document_number long, email string, telephone string, his_password string, login_email string")
    assert C.record_flags(row).first()[2:] == (True, True, True)
    from idloom.sources.dims import ref_dims
    assert C.display_names(row, ref_dims(spark)).first()["full_name"] == "Иванов"


def test_masking_is_by_name_and_nested(spark):
    df = spark.sql("SELECT 'x' AS password_a, '' AS api_key, CAST(NULL AS STRING) AS token, 'keep' AS login, "
                   "named_struct('his_password', 'y', 'n', 1) AS s, array(named_struct('secret', 'z')) AS a, 5 AS key_count")
    r = C.mask_credentials(df).first()
    assert (r.password_a, r.api_key, r.token, r.login, r.key_count) == ("********", "", None, "keep", 5)
    assert (r.s.his_password, r.s.n, r.a[0].secret) == ("********", 1, "********")


def test_text_passes_unchanged(spark):
    names = ["O'Connor", "José", "李", "Владимир", "محمد", "x" * 1000]
    raw = spark.createDataFrame([(f"{i}/A", n) for i, n in enumerate(names)], "hisnumber string, lastname string")
    for c in ("name", "surname", "birthdate", "documenttypes", "series", "number", "email", "telephone", "login_email"):
        raw = raw.withColumn(c, F.lit(""))
    out = C.validated(C.conform_a(raw.withColumns({"source": F.lit(1), "businessunit": F.lit(1)})))
    assert sorted(r.lastname for r in out.collect()) == sorted(names)
