"""Functions against plain Python restatements of their rules."""

import datetime as dt
import hashlib
import hmac
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera import vocab
from tessera.functions import dates, identity
from tessera.functions import text as tx
from tessera.functions.mapping import RuleSet, is_unmapped

KEY = b"0123456789abcdef"


def mac(domain, value):
    return hmac.new(KEY, domain.encode() + b"\0" + value.encode(), hashlib.sha256).hexdigest()


def test_identity_matches_python(spark):
    values = ["", "a", "ABHA-12 34", "é-ü", "1.2.840.10008", "x" * 200]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    v = F.col("v")
    rows = df.select("v", identity.mac(KEY, "uid", v).alias("m"), identity.remap_uid(KEY, v).alias("u"), identity.date_offset_days(KEY, v).alias("d"), identity.split_bucket("s", v).alias("b"), identity.patient_pseudonym(KEY, v, F.lit("mrn"), F.lit("S")).alias("p")).collect()
    for r in rows:
        assert r.m == mac("uid", r.v)
        assert r.u == f"2.25.{int(mac('uid', r.v), 16) >> 144}"
        assert r.d == -(int(mac("date-offset", r.v)[:8], 16) % 1095) - 1
        assert r.b == int.from_bytes(hashlib.sha256(f"s\x1f{r.v}".encode()).digest()[:8], "big") % 1_000_000
        n = re.sub("[^A-Za-z0-9]", "", r.v).upper()
        assert (r.p.pseudo_id, r.p.linked) == ((mac("patient-national", n)[:16], True) if n else (mac("patient-local", "S|MRN")[:16], False))


def test_long_keys_are_hashed(spark):
    key = b"k" * 100
    got = spark.range(1).select(identity.hmac_sha256(key, F.encode(F.lit("x"), "UTF-8")).alias("m")).first().m
    assert got == hmac.new(key, b"x", hashlib.sha256).hexdigest()


def test_keys(tmp_path, monkeypatch):
    with pytest.raises(ValueError):
        identity.check_key(b"short")
    path = str(tmp_path / "key")
    with pytest.raises(FileNotFoundError):
        identity.load_key(path)
    with pytest.warns(UserWarning):
        key = identity.load_key(path, create=True)
    assert identity.load_key(path) == key
    monkeypatch.setenv("K", key.hex())
    assert identity.key_from_env("K") == key


def test_shifted_dates_keep_intervals_and_refuse_nonsense(spark):
    df = spark.createDataFrame([("20240131",), ("20240231",), ("2024",), (None,)], "t string")
    assert [r[0] for r in df.select(identity.shift_da(F.col("t"), F.lit(-31))).collect()] == ["20231231", "", "", ""]


def test_native_dates(spark):
    given = {"20240412": 1, "12-04-2024": 1, "12/4/2024": 1, "2024-04-12": 1, "12 Apr 2024": 1, "31-02-2024": 0, "": 0, "yesterday": 0}
    df = spark.createDataFrame([(k,) for k in given], "t string")
    for t, d in df.select("t", dates.parse_native_date(F.col("t"))).collect():
        assert d == (dt.date(2024, 4, 12) if given[t] else None)


def test_ages(spark):
    row = lambda b, a: spark.sql(f"SELECT DATE '{b}' AS b, DATE '{a}' AS a").select(dates.compute_age(F.col("b"), F.col("a"))).first()[0]
    assert (row("2000-01-01", "2000-12-30"), row("1900-01-01", "2020-01-01"), row("2021-01-01", "2020-01-01")) == (0, 89, None)
    got = spark.createDataFrame([(17,), (18,), (79,), (80,), (-1,), (None,)], "a int").select(dates.age_band(F.col("a"))).collect()
    assert [r[0] for r in got] == ["0-17", "18-39", "60-79", "80+", "unknown", "unknown"]


def test_rules(spark):
    r = RuleSet("U", {"PA": "PA", " pa": "AP"}, ((r"\bAP\b", "AP"), ("LAT", "LATERAL")))
    df = spark.createDataFrame([(" pa ",), ("chest ap supine",), ("LAT AP",), ("odd",), ("  ",), (None,)], "c string")
    got = df.select(r.resolve(F.col("c")).alias("x"), is_unmapped(r.resolve(F.col("c")), F.col("c")).alias("u")).collect()
    assert [(g.x.value, g.x.matched, g.u) for g in got] == [("PA", True, False), ("AP", True, False), ("AP", True, False), ("U", False, True), ("U", False, False), ("U", False, False)]
    with pytest.raises(re.error):
        RuleSet("U", patterns=(("(", "x"),))


def python_negated(sentence, start):
    """The rule, restated: a resolution anywhere, or a negation before the match that nothing ends."""
    if re.search("|".join(vocab.RESOLUTION_CUES), sentence, re.I):
        return True
    ends = [m.end() for m in re.finditer("|".join(vocab.NEGATION_CUES), sentence[:start], re.I)]
    return bool(ends) and not re.search("|".join(vocab.TERMINATION_CUES), sentence[ends[-1] : start], re.I)


def test_negation_matches_its_rule(spark):
    rng = random.Random(4)
    words = ["no", "not", "without", "but", "however", "the", "effusion", "clear of", "free of", "and", "has resolved", "though", "small", "ruled out", "yet", "nor"]
    cases = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 9))) + " effusion." for _ in range(400)]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = df.select("t", tx.finding_states(F.col("t"))["PLEURAL_EFFUSION"].alias("x")).collect()
    for t, x in got:
        said = [not python_negated(t, m.start()) for p in (r"pleural\s+effusion", r"\beffusion\b") if (m := re.search(p, t, re.I))][:1]
        assert x == said[0], t


@pytest.mark.parametrize(
    ("text", "findings", "denied"),
    [
        ("No pneumothorax. Cardiomegaly is present.", ["CARDIOMEGALY"], ["PNEUMOTHORAX"]),
        ("No effusion.\nThere is a pleural effusion.", ["PLEURAL_EFFUSION"], []),
        ("Calcified granuloma.", ["OTHER"], []),
        ("No granuloma. Lungs are clear.", ["NO_FINDING"], []),
        ("Nothing to say.", [], []),
        ("", [], []),
        (None, [], []),
        ("The pneumothorax has resolved.", [], ["PNEUMOTHORAX"]),
    ],
)
def test_labels(spark, text, findings, denied):
    x = spark.createDataFrame([(text,)], "t string").select(tx.extract_labels(F.col("t")).alias("x")).first().x
    assert ((x.findings or []), (x.denied or [])) == (findings, denied)


def test_sections(spark):
    text = "Name: X\nFINDINGS:\nOne.\n\n impression \nTwo.\nReported by Y\nlost\nFindings\nThree."
    got = spark.createDataFrame([(text,)], "t string").select(tx.sections(F.col("t")).alias("s"), tx.clinical_text(tx.sections(F.col("t"))).alias("c")).first()
    assert got.s == {"FINDINGS": "One.\n\nThree.", "IMPRESSION": "Two."}
    assert got.c == "One.\n\nThree.\nTwo."


def test_scrub(spark):
    text = "Patient Name: DOE^JANE\nAge/Sex: 95 / F\nMs Doe seen by Dr. Ravi Sharma, call +91 98765 43210 12, on 12-04-2024."
    x = spark.createDataFrame([(text,)], "t string").select(tx.scrub(F.col("t"), F.array(F.lit("DOE^JANE")), F.array(F.lit("0099")), F.array(F.lit("City Clinic")), F.lit(-10)).alias("x")).first().x
    assert x.text == "Patient Name: [ID]\nAge/Sex: 89+ / F\nMs Doe seen by [NAME], call [PHONE], on 02-04-2024."


def test_mesh(spark):
    df = spark.createDataFrame([("Thoracic Vertebrae/degenerative/mild",), ("",), ("Lung / Lung",)], "t string")
    assert [r[0] for r in df.select(tx.mesh_concepts(F.col("t"))).collect()] == [["thoracic vertebrae", "degenerative"], [], ["lung"]]
