"""Protecting personal columns: encrypted value plus keyed blind index.

Key bytes appear in query plans as literals: set ``spark.sql.redaction.string.regex``
(for example ``(?i)binary|X'[0-9a-f]+'``) where plans are shown or logged.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark import contract as C
from tallymark.functions import hashing
from tallymark.functions.text import normalize_email, normalize_phone
from tallymark.operators import skew


@dataclass(frozen=True)
class Keys:
    aes: bytes
    hmac: bytes

    @staticmethod
    def from_env() -> "Keys":
        return Keys(hashing.key_from_env("AES_KEY"), hashing.key_from_env("HMAC_KEY"))


@dataclass(frozen=True)
class Field:
    """A personal column; ``normalize`` set means it also gets a blind index."""

    name: str
    normalize: Callable[[Column], Column] | None = None

    @property
    def enc(self) -> str:
        return f"{self.name}_enc"

    @property
    def hash(self) -> str:
        return f"{self.name}_hash"


MEMBER_FIELDS = (Field("name"), Field("email", normalize_email), Field("phone", normalize_phone))


def blind_index(keys: Keys, field: Field, plaintext: Column) -> Column:
    return hashing.hmac_sha256(keys.hmac, field.normalize(plaintext))


def protect(
    df: DataFrame,
    keys: Keys,
    fields: tuple[Field, ...] = MEMBER_FIELDS,
    ivs: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Replace each plain column by ``*_enc`` (and ``*_hash``).

    IVs are random unless given; give them for reproducible test data only.
    """
    added: dict[str, Column] = {}
    for f in fields:
        blob = hashing.encrypt(keys.aes, F.col(f.name), (ivs or {}).get(f.name))
        added[f.enc] = F.when(
            F.octet_length(f.name) <= C.MAX_ENCRYPTED_BYTES - C.IV_BYTES - C.TAG_BYTES, blob
        ).when(F.col(f.name).isNotNull(), F.raise_error(F.lit(f"{f.name}: encrypted value too long")))
        if f.normalize:
            added[f.hash] = blind_index(keys, f, F.col(f.name))
    return df.withColumns(added).drop(*[f.name for f in fields])


def reveal(df: DataFrame, keys: Keys, fields: tuple[Field, ...] = MEMBER_FIELDS) -> DataFrame:
    """Decrypt; a value that cannot be decrypted becomes NULL."""
    return df.withColumns({f.name: hashing.decrypt(keys.aes, F.col(f.enc)) for f in fields})


def round_trip(df: DataFrame, keys: Keys, fields: tuple[Field, ...] = MEMBER_FIELDS, key: str = "id") -> DataFrame:
    """Rows that do not decrypt, or whose plaintext does not hash to the index.

    key, field, problem (``undecryptable`` or ``hash differs``).
    """
    checks = []
    for f in fields:
        plain = hashing.decrypt(keys.aes, F.col(f.enc))
        problem = F.when(F.col(f.enc).isNotNull() & plain.isNull(), "undecryptable")
        if f.normalize:
            differs = F.lower(F.col(f.hash)) != blind_index(keys, f, plain)
            problem = problem.when(differs, "hash differs")
        checks.append(F.struct(F.lit(f.name).alias("field"), problem.alias("problem")))
    return (
        df.select(F.col(key), F.explode(F.array(*checks)).alias("c"))
        .select(key, "c.field", "c.problem")
        .where("problem IS NOT NULL")
    )


def find_by_plaintext(
    df: DataFrame, wanted: DataFrame, keys: Keys, field: Field, column: str = "plaintext"
) -> DataFrame:
    """Rows whose blind index equals that of one of the wanted plaintexts."""
    hashes = wanted.select(blind_index(keys, field, F.col(column)).alias(field.hash)).distinct()
    return skew.lookup_join(df, hashes, [field.hash], "left_semi")


def find_members(
    df: DataFrame, keys: Keys, ids: DataFrame | None = None, emails: DataFrame | None = None
) -> DataFrame:
    """Members with one of the ids or one of the e-mail addresses, by one semi join on tagged keys."""
    email = MEMBER_FIELDS[1]
    wanted = []
    if ids is not None:
        wanted.append(ids.select(F.lit("id").alias("_kind"), F.col("id").cast("bigint").cast("string").alias("_value")))
    if emails is not None:
        hashed = blind_index(keys, email, F.col(emails.columns[0]))
        wanted.append(emails.select(F.lit("email").alias("_kind"), hashed.alias("_value")))
    if not wanted:
        return df.limit(0)
    asked = reduce(DataFrame.unionByName, wanted).distinct()
    held = F.array(
        F.struct(F.lit("id").alias("kind"), F.col("id").cast("string").alias("value")),
        F.struct(F.lit("email").alias("kind"), F.col(email.hash).alias("value")),
    )
    tagged = df.withColumn("_key", F.explode(held)).withColumn("_kind", F.col("_key.kind")).withColumn("_value", F.col("_key.value")).drop("_key")
    found = skew.lookup_join(tagged, asked, ["_kind", "_value"], "left_semi")
    return found.select(df.columns).dropDuplicates(["id"])  # a member may be met by both


def show_page(df: DataFrame, keys: Keys, n: int = 5) -> DataFrame:
    """The first n members by id, decrypted: what a lookup screen shows."""
    return reveal(df.orderBy("id").limit(n), keys)


def layout(blob: Column) -> Column:
    """Parts of an encrypted value in hex: iv, tag and the ciphertext's size."""
    size = F.length(blob)
    return F.struct(
        F.lower(F.hex(F.substring(blob, 1, C.IV_BYTES))).alias("iv"),
        (size - C.IV_BYTES - C.TAG_BYTES).alias("ciphertext_bytes"),
        F.lower(F.hex(F.substring(blob, -C.TAG_BYTES, C.TAG_BYTES))).alias("tag"),
    )


def size_audit(df: DataFrame, fields: tuple[Field, ...] = MEMBER_FIELDS, key: str = "id") -> DataFrame:
    """Encrypted values outside 29..256 bytes: key, field, bytes."""
    sizes = F.array(*[F.struct(F.lit(f.name).alias("field"), F.length(f.enc).alias("bytes")) for f in fields])
    low, high = C.IV_BYTES + C.TAG_BYTES + 1, C.MAX_ENCRYPTED_BYTES
    return (
        df.select(F.col(key), F.explode(sizes).alias("s"))
        .select(key, "s.field", "s.bytes")
        .where(~F.col("bytes").between(low, high))
    )
