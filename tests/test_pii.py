"""Golden vectors and the jobs over personal columns."""

import base64

import pytest
from pyspark.sql import functions as F

from tallymark.functions import hashing, text
from tallymark.operators import pii
from tests.vectors import AES_KEY, HMAC_KEY, VECTORS

KEYS = pii.Keys(base64.b64decode(AES_KEY), base64.b64decode(HMAC_KEY))


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(list(VECTORS), "plaintext string, iv string, stored string, hmac string")


def test_golden_vectors(vectors):
    got = vectors.select(
        "*",
        F.lower(F.hex(hashing.encrypt(KEYS.aes, F.col("plaintext"), F.unhex("iv")))).alias("e"),
        hashing.decrypt(KEYS.aes, F.unhex("stored")).alias("d"),
        hashing.hmac_sha256(KEYS.hmac, F.col("plaintext")).alias("h"),
    ).collect()
    assert len(got) == 20
    for r in got:
        assert (r["e"], r["d"], r["h"]) == (r["stored"], r["plaintext"], r["hmac"])


def test_layout(vectors):
    r = vectors.select(pii.layout(F.unhex("stored")).alias("p"), "*").first()
    assert r["p"]["iv"] == r["iv"] and r["stored"] == r["iv"] + r["stored"][24:-32] + r["p"]["tag"]
    assert r["p"]["ciphertext_bytes"] == len(r["plaintext"].encode())


def people(spark):
    rows = [(1, "Ann", " Ann@X.org\t", "010-1234-5678"), (2, "Bob", "bob@x.org", "(010) 9"), (3, None, None, None)]
    return spark.createDataFrame(rows, "id bigint, name string, email string, phone string")


def test_protect_and_reveal(spark):
    stored = pii.protect(people(spark), KEYS)
    assert set(stored.columns) == {"id", "name_enc", "email_enc", "email_hash", "phone_enc", "phone_hash"}
    assert sorted(pii.reveal(stored, KEYS).select("id", "name", "email", "phone").collect()) == sorted(people(spark).collect())
    assert pii.round_trip(stored, KEYS).count() == 0
    assert pii.size_audit(stored).count() == 0


def test_round_trip_reports_damage(spark):
    stored = pii.protect(people(spark), KEYS)
    bad = stored.withColumn("email_enc", F.when(F.col("id") == 1, F.unhex(F.lit("00" * 40))).otherwise(F.col("email_enc"))).withColumn(
        "phone_hash", F.when(F.col("id") == 2, F.lit("0" * 64)).otherwise(F.col("phone_hash"))
    )
    assert {tuple(r) for r in pii.round_trip(bad, KEYS).collect()} == {(1, "email", "undecryptable"), (2, "phone", "hash differs")}


def test_lookup_ignores_case_and_space(spark):
    stored = pii.protect(people(spark), KEYS)
    asked = spark.createDataFrame([("ANN@x.ORG ",)], "email string")
    assert [r["id"] for r in pii.find_members(stored, KEYS, emails=asked).collect()] == [1]
    ids = spark.createDataFrame([(1,), (2,)], "id bigint")
    assert sorted(r["id"] for r in pii.find_members(stored, KEYS, ids, asked).collect()) == [1, 2]
    assert [r["name"] for r in pii.show_page(stored, KEYS, 2).collect()] == ["Ann", "Bob"]


def test_too_long_values_are_refused(spark):
    df = spark.createDataFrame([("x" * 229,)], "name string")
    with pytest.raises(Exception, match="too long"):
        pii.protect(df, KEYS, (pii.Field("name"),)).collect()


def test_keys_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("AES_KEY", AES_KEY)
    monkeypatch.setenv("HMAC_KEY", HMAC_KEY)
    assert pii.Keys.from_env() == KEYS
    monkeypatch.setenv("HMAC_KEY", "AAAA")
    with pytest.raises(ValueError):
        pii.Keys.from_env()
    monkeypatch.delenv("AES_KEY")
    with pytest.raises(KeyError):
        pii.Keys.from_env()


def test_normalisation_follows_unicode(spark):
    values = [" 　 A@B.c\x1f\n", "010-١٢ x9"]
    df = spark.createDataFrame([(v,) for v in values], "v string").coalesce(1)
    got = df.select(text.normalize_email(F.col("v")), text.normalize_phone(F.col("v"))).collect()
    import re

    assert [tuple(r) for r in got] == [(v.strip().lower(), re.sub(r"\D", "", v)) for v in values]


def test_codes(spark):
    alphabet = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"

    def code(n):
        digits = ""
        while n:
            n, d = divmod(n, 32)
            digits = alphabet[d] + digits
        return "CP" + digits.rjust(14, "0")

    ids = [0, 1, 31, 32, 1023, 3_000_000, 10**12 + 7]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").coalesce(1)
    assert [r[0] for r in df.select(text.issue_code(F.col("id"))).collect()] == [code(i) for i in ids]


def test_uniform_is_keyed(spark):
    df = spark.range(20_000).select(hashing.uniform(1, "s", F.col("id")).alias("u"), hashing.uniform(2, "s", F.col("id")).alias("w"))
    r = df.agg(F.min("u"), F.max("u"), F.avg("u"), F.corr("u", "w")).first()
    assert 0 <= r[0] and r[1] < 1 and abs(r[2] - 0.5) < 0.01 and abs(r[3]) < 0.03
