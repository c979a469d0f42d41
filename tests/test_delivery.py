"""End to end over a synthetic delivery: nothing identifying survives, truth is found again."""

import os
import shutil

import numpy as np
import pytest
import yaml
from pyspark.sql import functions as F

from tessera import synth, vocab
from tessera.operators import deid, pixels, qc
from tessera.plans import delivery
from tessera.sources import dicom, files

KEY = b"0123456789abcdef"
SITES = {
    "SITE_A": {"site_id": "SITE_A", "view_position": {"map": {"PA": "PA"}}, "laterality": {}, "sex": {"map": {"M": "M", "F": "F"}}, "labels": {"source": "image_comments", "separator": ";", "map": {"Cardiomegaly": "CARDIOMEGALY"}}},
    "SITE_B": {"site_id": "SITE_B", "view_position": {"patterns": [{"match": r"\bAP\b", "value": "AP"}]}, "sex": {"map": {"MALE": "M"}}, "labels": {"source": "sidecar_csv", "separator": "|", "sidecar_file": "labels.csv", "sidecar_key_column": "accession_no", "sidecar_value_column": "findings_codes", "map": {"NAD": "NO_FINDING", "CM": "CARDIOMEGALY", "PE": "PLEURAL_EFFUSION", "PTX": "PNEUMOTHORAX"}}},
    "SITE_C": {"site_id": "SITE_C", "view_position": {"map": {"P->A": "PA"}}, "sex": {"map": {"1": "M", "2": "F"}}, "labels": {"source": "report"}},
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("delivery"))
    synth.generate(d, patients=9, px=128)
    a = f"{d}/SITE_A/images/"
    names = sorted(os.listdir(a))
    shutil.copy(a + names[0], a + "ZZ_copy.dcm")
    open(a + "ZZ_text.dcm", "w").write("hello")
    e = dicom.read(open(a + names[0], "rb").read())
    e = [x for x in e if not x[0].startswith("0002")]
    change = lambda tag, v: dicom.write([(t, vr, v if t == tag else o) for t, vr, o in e])
    open(a + "ZZ_ct.dcm", "wb").write(change("00080060", "CT"))
    open(a + "ZZ_head.dcm", "wb").write(change("00180015", "HEAD"))
    open(a + "ZZ_anon.dcm", "wb").write(change("00100020", ""))
    open(a + "ZZ_nopx.dcm", "wb").write(dicom.write([x for x in e if x[0] != dicom.PIXELS] + [("00080051", "LO", "x")]))
    return d


@pytest.fixture(scope="module")
def rules(tmp_path_factory):
    d = tmp_path_factory.mktemp("sites")
    for name, spec in SITES.items():
        (d / f"{name}.yaml").write_text(yaml.safe_dump(spec))
    return delivery.Rules.of(files.load_sites(str(d)))


@pytest.fixture(scope="module")
def known(spark, root):
    good, bad = delivery.ingest_delivery(spark, f"file://{root}")
    return delivery.identify(good, KEY).cache(), bad.cache()


def test_quarantine_reasons(known):
    got = {(r.source_path.rsplit("/", 1)[1], r.reason) for r in known[1].collect()}
    assert got == {("ZZ_copy.dcm", "DUPLICATE_CONTENT"), ("ZZ_text.dcm", "NOT_DICOM"), ("ZZ_ct.dcm", "WRONG_MODALITY"), ("ZZ_head.dcm", "WRONG_BODY_PART"), ("ZZ_anon.dcm", "MISSING_REQUIRED_TAG"), ("ZZ_nopx.dcm", "NO_PIXEL_DATA")}
    assert known[0].count() == 11 and known[0].where("report IS NULL").count() == 0


def test_patients_link_across_sites_by_national_id_only(known):
    n = known[0].groupBy("pseudo_id").agg(F.count_distinct("site_id").alias("k"), F.max("linked").alias("l")).where("k > 1").collect()
    assert len(n) == 1 and n[0].l


def test_no_identifier_survives(spark, root, known):
    after = delivery.header_after(spark, f"file://{root}", known[0], KEY).cache()
    truth = synth.generate(str(root) + "-again", patients=9, px=16)
    lits = spark.createDataFrame([(v,) for v in truth["phi_values"]] + [("NESTED NAME",), ("DR WHO",)], "v string")
    assert deid.substring_hits(after.where("value IS NOT NULL"), "value", lits, "v").count() == 0
    empty = ["00100030", "00101000", "00080050", "0008103E", "00204000", "00080090"]
    need = {"00120062": "YES", "00280301": "NO"}
    assert deid.leftovers(after, empty, need).count() == 0
    before = dicom.attributes(dicom.scan(spark, f"file://{root}")).where("tag IS NOT NULL").withColumnRenamed("source_path", "object_id")
    kinds = {r.kind for r in deid.leftovers(before, empty, need).select("kind").distinct().collect()}
    assert kinds == {"attribute_present", "private_or_overlay", "marker_missing"}  # the check can fail
    assert after.where(F.size("path") > 0).where("tag = '00081155'").where(~F.col("value").startswith("2.25.")).count() == 0


def test_pixels(spark, root, known):
    rows = delivery.clean_images(spark, f"file://{root}", known[0]).collect()
    assert len(rows) == 11
    for r in rows:
        burned = "/SITE_B/" in r.source_path
        area = sum(b.w * b.h for b in r.regions)
        assert area > 0 if burned else area < 0.01 * r.rows * r.columns, r.source_path
        a = np.frombuffer(r.pixels, "<u2").reshape(r.rows, r.columns)
        assert a[r.rows // 2, r.columns // 2] > a[-1, -1] > 0  # polarity is upright everywhere
        if burned:
            assert not (a > 3500).any()


def test_reports_and_tables(spark, root, known, rules):
    reports = delivery.process_reports(known[0]).cache()
    text = " ".join(r.text for r in reports.collect())
    assert "Menon" not in text and "MRN0" not in text and "89+" in text
    tables = delivery.harmonise(spark, known[0], reports, rules, f"file://{root}")
    assert {k: tables[k].count() for k in ("studies", "series", "instances")} == {"studies": 11, "series": 11, "instances": 11}
    truth = {(s["accession"]): set(s["findings"]) for s in synth.generate(str(root) + "-again", patients=9, px=16)["studies"]}
    acc = {r.study_uid: r.AccessionNumber for r in known[0].select("study_uid", "AccessionNumber").collect()}
    found = {a: set() for a in truth}
    for r in tables["labels"].where("source = 'REPORT_RULE' AND present AND finding != 'NO_FINDING'").collect():
        found[acc[r.study_uid]].add(r.finding)
    assert found == truth
    odd = {(r.site_id, r.field, r.value) for r in tables["unmapped"].collect()}
    assert ("SITE_B", "sex", "FEMALE") in odd and all(f != "view_position" for _, f, _ in odd)
    native = {d for (d,) in known[0].select(F.to_date("StudyDate", "yyyyMMdd")).where("StudyDate != ''").collect()}
    assert not native & {r.study_date for r in tables["studies"].collect()}
    for name in ("patients", "studies", "series", "labels"):
        assert qc.invalid(tables[name], name).where("n_bad > 0").count() == 0
        qc.validate(tables[name], name).count()
    report = delivery.quality(tables, known[1]).cache()
    got = {r.check: r.passed for r in report.collect()}
    assert got["study_patient_integrity"] and got["photometric_interpretation_uniform"] and not got["all_values_mapped"]
    assert qc.passed(report) and not qc.passed(report, strict=True)
    assert qc.markdown(report).splitlines()[2].endswith("| NO |")
    s = delivery.assign_splits(tables, "v1")
    assert s.groupBy("pseudo_patient_id").count().where("count > 1").count() == 0 and set(r.split for r in s.collect()) <= set(vocab.SPLITS)
    assert delivery.assign_splits(tables, "v1", stratified=True).count() == s.count()


def test_all_identifiers_of_the_header_leave_the_report(spark):
    tags = {"PatientName": "ROE^RICHARD", "ReferringPhysicianName": "Menon^Priya", "PerformingPhysicianName": "Kumar^Anil", "NameOfPhysiciansReadingStudy": "Shah^Rekha", "PatientID": "MRN77", "OtherPatientIDs": "ABHA99", "AccessionNumber": "ACC55", "PatientTelephoneNumbers": "555-123", "InstitutionName": "Sunrise Hospital", "InstitutionAddress": "12 Lake Road", "StationName": "XR7"}
    assert set(tags) <= set(dicom.KEYWORDS)
    said = "FINDINGS:\n" + ". ".join(v.replace("^", " ") for v in tags.values())
    row = {"study_uid": "1", "site_id": "A", "source_path": "p", "report": said, "offset": -5} | tags
    text = delivery.process_reports(spark.createDataFrame([row]).withColumn("offset", F.col("offset").cast("int"))).first().text
    assert not [w for v in tags.values() for w in v.split("^") if w in text] and "[INSTITUTION]" in text


def test_pixel_results_and_all_findings_are_checked(spark, root, known, rules):
    reports = delivery.process_reports(known[0])
    tables = delivery.harmonise(spark, known[0], reports, rules, f"file://{root}")
    rows = tables["instances"].select("relative_path", "pixel_redacted", "photometric_interpretation").collect()
    done = {r.source_path: len(r.regions) > 0 for r in delivery.clean_images(spark, f"file://{root}", known[0]).collect()}
    assert {r.relative_path: r.pixel_redacted for r in rows} == done and any(done.values())
    assert {r.photometric_interpretation for r in rows} == {"MONOCHROME2"}
    bare = delivery.harmonise(spark, known[0], reports, rules, "x", images=spark.createDataFrame([], "source_path string, regions array<int>"))
    assert {r[0] for r in bare["instances"].select("photometric_interpretation").collect()} == {"MONOCHROME1", "MONOCHROME2"}
    # 40 studies a stratum, all fractures in one of two
    studies = spark.createDataFrame([(f"s{i}", f"p{i}", "A", None, "CHEST") for i in range(80)], "study_uid string, pseudo_patient_id string, site_id string, study_date date, body_part string")
    patients = spark.createDataFrame([(f"p{i}", "MF"[i % 2], 50) for i in range(80)], "pseudo_id string, sex string, age_years int")
    labels = spark.createDataFrame([(f"s{i}", "FRACTURE", True) for i in range(0, 80, 2)], "study_uid string, finding string, present boolean")
    report = delivery.quality(tables | {"studies": studies, "patients": patients, "labels": labels}, known[1])
    got = {r.check: (r.n_bad, r.passed) for r in report.collect()}
    assert got["finding_prevalence_parity"] == (1, False) and got["pixel_redaction_recorded"][0] == sum(done.values())


def test_sites_without_rules_are_named(spark, known, rules):
    part = delivery.Rules({"SITE_A": rules.view["SITE_A"]}, rules.laterality, rules.sex, {})
    with pytest.raises(Exception, match="configs/sites/site_"):
        delivery.harmonise(spark, known[0], delivery.process_reports(known[0]), part, "")["studies"].collect()


def test_site_files_are_checked(tmp_path):
    (tmp_path / "a.yaml").write_text("site_id: A\nodd: 1\n")
    with pytest.raises(ValueError, match="unknown keys"):
        files.load_sites(str(tmp_path))
    (tmp_path / "a.yaml").write_text("site_id: A\n")
    (tmp_path / "b.yaml").write_text("site_id: A\n")
    with pytest.raises(ValueError, match="twice"):
        files.load_sites(str(tmp_path))


def test_components_and_otsu():
    m = np.zeros((6, 9), bool)
    m[1, 1:3] = m[2, 3:5] = m[5, 0] = True
    assert sorted(pixels.components(m)) == [(0, 5, 1, 1), (1, 1, 4, 2)]
    a = np.array([[0, 0, 10, 200, 210, 205]], np.uint8)
    assert 10 <= pixels.otsu(a) < 200
    assert pixels.is_clean(np.ones((2, 2)), np.array([[0, 1], [1, 1]])) and not pixels.is_clean(np.ones((2, 2)), np.ones((2, 2)))
