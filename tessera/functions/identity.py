"""Keyed identity functions as native column expressions: nothing leaves whole-stage codegen.

The key's pads are literals of the plan, so plans of these expressions are as secret as the key.
"""

from __future__ import annotations

import hashlib
import os
import stat
import warnings

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 64
MIN_KEY = 16
UNIT = "\x1f"
OFFSET_DAYS = 1095
BUCKETS = 1_000_000


def load_key(path: str, create: bool = False) -> bytes:
    """The key in a file; made (readable by its owner only) if missing and create is set."""
    if os.path.exists(path):
        with open(path, "rb") as f:
            key = f.read().strip()
        return check_key(bytes.fromhex(key.decode()) if all(c in b"0123456789abcdefABCDEF" for c in key) and len(key) >= 2 * MIN_KEY else key)
    if not create:
        raise FileNotFoundError(f"no key at {path}")
    warnings.warn(f"a new key is written to {path}; pseudonyms made with another key won't match", stacklevel=2)
    key = os.urandom(32)
    with open(path, "w") as f:
        f.write(key.hex())
    os.chmod(path, stat.S_IRUSR | stat.S_IWUSR)
    return key


def key_from_env(name: str) -> bytes:
    if name not in os.environ:
        raise KeyError(f"{name} is not set")
    return check_key(bytes.fromhex(os.environ[name]))


def check_key(key: bytes) -> bytes:
    if len(key) < MIN_KEY:
        raise ValueError(f"the key has {len(key)} bytes; {MIN_KEY} are the least")
    return key


def hmac_sha256(key: bytes, message: Column) -> Column:
    """Hex HMAC-SHA256 of a binary column."""
    k = (hashlib.sha256(key).digest() if len(key) > BLOCK else key).ljust(BLOCK, b"\0")
    inner, outer = (F.lit(bytearray(b ^ p for b in k)) for p in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 256))), 256)


def mac(key: bytes, domain: str, value: Column) -> Column:
    """HMAC of domain, a zero byte and the value: one key, independent functions."""
    return hmac_sha256(key, F.concat(F.lit(bytearray(domain.encode() + b"\0")), F.encode(value, "UTF-8")))


def normalise_identifier(c: Column) -> Column:
    return F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9]", ""))


def patient_pseudonym(key: bytes, national: Column, local: Column, site: Column) -> Column:
    """struct<pseudo_id, linked>: from the national id if there is one, else from site and local id."""
    nat, loc = normalise_identifier(national), normalise_identifier(local)
    linked = nat != ""
    value = F.when(linked, mac(key, "patient-national", nat)).otherwise(mac(key, "patient-local", F.concat(site, F.lit("|"), loc)))
    return F.struct(F.substring(value, 1, 16).alias("pseudo_id"), linked.alias("linked"))


def _number(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("decimal(20,0)")


def date_offset_days(key: bytes, pseudo_id: Column) -> Column:
    """-1 .. -1095, the same for all dates of a patient."""
    return (-(F.conv(F.substring(mac(key, "date-offset", pseudo_id), 1, 8), 16, 10).cast("long") % OFFSET_DAYS) - 1).cast("int")


def shift_date(date: Column, offset: Column) -> Column:
    return F.date_add(date, offset)


def shift_da(text: Column, offset: Column) -> Column:
    """An eight-digit date shifted; empty where it isn't one."""
    parsed = F.try_to_date(F.when(text.rlike(r"^\d{8}$"), text), "yyyyMMdd")
    return F.coalesce(F.date_format(F.date_add(parsed, offset), "yyyyMMdd"), F.lit(""))


def remap_uid(key: bytes, uid: Column) -> Column:
    """2.25. and the first 112 bits of the MAC as a decimal number."""
    h = mac(key, "uid", uid)
    high = F.conv(F.substring(h, 1, 14), 16, 10).cast("decimal(18,0)").cast("decimal(38,0)")
    low = F.conv(F.substring(h, 15, 14), 16, 10).cast("decimal(18,0)").cast("decimal(38,0)")
    return F.concat(F.lit("2.25."), (high * F.lit(1 << 56).cast("decimal(18,0)") + low).cast("decimal(38,0)").cast("string"))


def audit_mac(key: bytes, text: Column) -> Column:
    """A keyed digest of text found in an image: comparable, not readable."""
    return mac(key, "burned-in-audit", text)


def split_bucket(salt: Column | str, key: Column) -> Column:
    """0 .. 999999 from the first 64 bits of sha256(salt, unit separator, key)."""
    salt = F.lit(salt) if isinstance(salt, str) else salt
    return (_number(F.substring(F.sha2(F.concat(salt, F.lit(UNIT), key), 256), 1, 16)) % BUCKETS).cast("int")
