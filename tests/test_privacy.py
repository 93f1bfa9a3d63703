import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from duebook.functions.privacy import last_four, pseudonym
from duebook.operators import privacy


def first(spark, column, value):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(column(F.col("v"))).first()[0]


def expected(value, pepper):
    digest = hmac.new(pepper.encode(), value.strip().lower().encode(), hashlib.sha256)
    return "px_" + digest.hexdigest()[:32]


@pytest.mark.parametrize("pepper", ["k", "p" * 64, "long" * 50, "zażółć"])
@pytest.mark.parametrize("value", ["80010112345", "  ABC123 ", "\tMixed Case\n", "\u00a0Łódź\u3000"])
def test_pseudonym_is_standard_hmac(spark, value, pepper):
    assert first(spark, lambda c: pseudonym(c, pepper), value) == expected(value, pepper)


@pytest.mark.parametrize("value", [None, "", "   ", "\t\n", "\u2003"])
def test_missing_id_stays_missing(spark, value):
    assert first(spark, lambda c: pseudonym(c, "k"), value) is None


def test_whitespace_set_is_complete():
    import sys

    from duebook.functions.privacy import WHITESPACE

    assert {c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()} == set(WHITESPACE)


def test_pseudonym_depends_on_pepper(spark):
    assert first(spark, lambda c: pseudonym(c, "a"), "1") != first(
        spark, lambda c: pseudonym(c, "b"), "1"
    )


@pytest.mark.parametrize(
    "value, masked",
    [("+48 600 700 800", "***0800"), ("12", "***"), ("1234", "***1234"), ("", "***"), (None, None)],
)
def test_last_four(spark, value, masked):
    assert first(spark, last_four, value) == masked


@pytest.fixture
def person(spark):
    return spark.createDataFrame(
        [("C1", "1", "Ann", "+48 600700800", "a@b.invalid", "Street 1", "00", "1990-01-01")],
        "case_reference string, national_id string, debtor_name string, debtor_phone string, "
        "debtor_email string, debtor_address string, postcode_area string, date_of_birth string",
    )


def test_policy_replaces_raw_columns_and_is_idempotent(person):
    once = privacy.apply_policy(person, "k")
    assert set(once.columns) == {
        "case_reference",
        "postcode_area",
        "national_id_pseudonym",
        "debtor_email_pseudonym",
        "debtor_phone_masked",
    }
    assert privacy.apply_policy(once, "k").collect() == once.collect()


def test_policy_ignores_absent_columns(person):
    assert privacy.apply_policy(person.select("case_reference"), "k").columns == ["case_reference"]


def test_write_guard(person):
    with pytest.raises(ValueError, match="national_id"):
        privacy.assert_no_personal_data(person.columns, "t")
    privacy.assert_no_personal_data(privacy.apply_policy(person, "k").columns, "t")


def test_registry_must_cover_suspicious_names():
    with pytest.raises(ValueError, match="debtor_mobile"):
        privacy.assert_registry_covers(["case_reference", "debtor_mobile"])
    privacy.assert_registry_covers(["debtor_phone", "product_name"], known_safe=["product_name"])


def test_suspicious_columns_in_the_catalog(spark, fresh_name):
    table = fresh_name("odd")
    spark.range(1).selectExpr("id", "'x' AS contact_email").write.saveAsTable(table)
    assert (table, "contact_email") in privacy.unregistered_columns(spark, "default")


def test_registry_defaults():
    treatments = {name: rule[0] for name, rule in privacy.REGISTRY.items()}
    assert treatments == {
        "national_id": "pseudonymise",
        "debtor_email": "pseudonymise",
        "debtor_phone": "mask_last4",
        "debtor_name": "redact",
        "debtor_address": "redact",
        "postcode_area": "keep",
        "date_of_birth": "redact",
    }


def test_masked_view_depends_on_groups(person, spark, fresh_name):
    table = fresh_name("people")
    privacy.apply_policy(person, "k").write.saveAsTable(table)
    stranger = privacy.create_masked_view(spark, table, fresh_name("v"), []).first()
    assert stranger["national_id_pseudonym"] is None
    assert stranger["debtor_phone_masked"] == "***0800"
    both = [privacy.PHONE_GROUP, privacy.PSEUDONYM_GROUP]
    insider = privacy.create_masked_view(spark, table, fresh_name("v"), both)
    assert insider.collect() == spark.table(table).collect()


def test_row_filter(spark):
    df = spark.createDataFrame([("ACME",), ("Beta",), (None,)], "client_id string")
    rights = spark.createDataFrame(
        [("a", "client-acme"), ("a", "client-acme"), ("b", "servicing-all-clients")],
        "principal string, group_name string",
    )

    def seen(who):
        return {r["client_id"] for r in privacy.visible_rows(df, rights, who).collect()}

    assert seen("a") == {"ACME"}
    assert seen("b") == {"ACME", "Beta", None}
    assert seen("c") == set()
