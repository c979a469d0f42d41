"""The text queries read whole texts: small tables against brute force."""

import collections
import datetime
import re

import pytest

from tessera.plans import catalogue

FAR = "filler words here " * 60  # past every length that a query once stopped at


@pytest.fixture
def tables(spark, tmp_path):
    """Writes tables and returns their folder."""

    def write(**rows):
        for name, (data, schema) in rows.items():
            spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def docs(*texts, lang="en"):
    return [(i * 10, t, lang) for i, t in enumerate(texts)], "doc_id long, text string, lang string"


def test_findings_after_the_first_400_characters(spark, tables):
    """Document 0 and the others get the planted denial of a pneumothorax, twice; far text may override it or add to it."""
    d = tables(documents=docs(FAR, FAR + ". Large pneumothorax.", FAR + ". No pleural effusion."))
    states = {(r.doc_id, r.finding): r.present for r in catalogue.QUERIES["text_negation"](spark, d).collect()}
    assert states == {(0, "PNEUMOTHORAX"): False, (10, "PNEUMOTHORAX"): True, (20, "PNEUMOTHORAX"): False, (20, "PLEURAL_EFFUSION"): False}
    found = {r.doc_id: (r.findings, r.denied) for r in catalogue.QUERIES["text_findings"](spark, d).collect()}
    assert found == {0: ("", "PNEUMOTHORAX"), 10: ("PNEUMOTHORAX", ""), 20: ("", "PLEURAL_EFFUSION,PNEUMOTHORAX")}


def test_literals_after_the_first_300_characters(spark, tables):
    texts = ["an Orchid " + FAR + "orchid. Orchids", "a b c " * 60 + "Tulip tulip, end", "a b"]
    got = {r.doc_id: r.scrubbed for r in catalogue.QUERIES["text_scrub_literals"](spark, tables(documents=docs(*texts))).collect()}
    for i, t in enumerate(texts):
        word = next((w for w in t.split(" ") if re.fullmatch(r"\w{4,}", w)), None)
        assert got[i * 10] == (re.sub(rf"(?i)(?<!\w){word}(?!\w)", "[ID]", t) if word else t)
    assert got[0].endswith("[ID]. Orchids") and got[10].endswith("[ID] [ID], end")


def test_a_word_before_a_line_end_is_no_whole_token(spark, tables):
    """SQL's full match takes `other` here, not the word with its line end."""
    got = [r.scrubbed for r in catalogue.QUERIES["text_scrub_literals"](spark, tables(documents=docs("word\n other word, Other"))).collect()]
    assert got == ["word\n [ID] word, [ID]"]


def test_placeholders_after_the_first_80_characters(spark, tables):
    got = [r.normal for r in catalogue.QUERIES["placeholder_normalise"](spark, tables(documents=docs(FAR + "XXXX, XXXX. XXXX  end"))).collect()]
    assert got == ["XXXX " + FAR + "XXXX end"]


def test_literals_of_more_than_60_characters(spark, tables):
    item = "An Opening Of Many Words " * 4 + "and its end"
    d = tables(documents=docs(FAR + item.lower(), FAR + item[:80]), benchmark=([(7, item), (8, "none")], "item_id long, text string"))
    assert [tuple(r) for r in catalogue.QUERIES["phi_substring_theta"](spark, d).collect()] == [(7, 0)]


def test_scrub_reads_the_documents(spark, tables):
    """Labelled fields, literals, doctors, phones and dates of the document go, beside the seven of the header."""
    far = "Name: ROE^RICHARD\nDr. Anil Kumar saw jane on 2024-05-06, call 98765 43210. MRN 0012345"
    got = {r.doc_id: (r.scrubbed, r.n) for r in catalogue.QUERIES["text_scrub"](spark, tables(documents=docs(FAR + "\n" + far, "plain", None))).collect()}
    head = "Patient Name: [ID]\nMRN : [ID]\nSeen by [NAME] on {} and {}.\nAge/Sex: 89+ F\n[NAME] was [INSTITUTION] en\n"
    day = lambda i, *d: (datetime.date(*d) + datetime.timedelta(i - 500)).strftime("%d-%m-%Y")
    heads = [head.format(day(i, 2024, 4, 12), day(i, 2024, 3, 3)) for i in (0, 10, 20)]
    assert got[0] == (heads[0] + FAR + f"\nName: [ID]\n[NAME] saw [NAME] on {day(0, 2024, 5, 6)}, call [PHONE]. MRN [ID]", 13)
    assert got[10] == (heads[1] + "plain", 7) and got[20] == (heads[2], 7)


def test_terms_of_all_languages(spark, tables):
    texts = ["the the cat", "le café, l'été", "für Öl 3x", "слово the", None]
    rows = [(i, t, lang) for i, (t, lang) in enumerate(zip(texts, ("en", "fr", "de", None, "en")))]
    want = collections.Counter(w for t in texts if t for w in re.findall(r"[^\W\d_]+", t.lower()))
    got = {r.term: r.n for r in catalogue.QUERIES["topk_terms"](spark, tables(documents=(rows, "doc_id long, text string, lang string"))).collect()}
    assert got == want
