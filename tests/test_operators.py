"""Operators on hand-made rows: each rule seen to hold and to fail."""

import datetime as dt
import json
import os

import pytest
import yaml
from pyspark.sql import functions as F

from tessera import cli
from tessera.operators import access, agreement, audit, equity, ingest, interop, qc, release, splits
from tessera.sources import files
from tessera.streaming import stateless
from tests.test_delivery import SITES

KEY = b"0123456789abcdef"


def test_kappa(spark):
    cells = [("chance", 25, 25, 25, 25), ("perfect", 50, 0, 0, 50), ("all", 9, 0, 0, 0), ("none", 0, 0, 0, 0), ("hand", 20, 5, 10, 15)]
    got = {r.label: r for r in agreement.kappa(spark.createDataFrame(cells, "label string, tp long, fp long, fn long, tn long")).collect()}
    assert got["chance"].kappa == 0 and got["perfect"].kappa == 1 and got["all"].kappa == 0 and got["none"].kappa == 0
    assert got["hand"].kappa == pytest.approx(0.4) and got["perfect"].band == "almost perfect" and got["all"].band == "insufficient support" and got["hand"].band == "slight" or got["hand"].band == "fair"
    pooled = {r.label: r.tp for r in agreement.with_total(spark.createDataFrame(cells, "label string, tp long, fp long, fn long, tn long"), "label").collect()}
    assert pooled["pooled"] == 104


def test_label_pairs_need_the_same_documents(spark):
    a = spark.createDataFrame([(1, ["x"]), (2, [])], "d long, labels array<string>")
    assert agreement.label_pairs(a, a, "d", ["x"]).count() == 2
    with pytest.raises(Exception, match="only one side"):
        agreement.label_pairs(a, a.where("d = 1"), "d", ["x"]).collect()


def test_parity_needs_two_large_strata(spark):
    rates = spark.createDataFrame([("a", 40, "F", 4, 0.1), ("b", 40, "F", 20, 0.5), ("c", 10, "F", 10, 1.0), ("a", 40, "G", 0, 0.0)], "stratum string, n_studies long, finding string, n long, rate double")
    got = equity.parity_gaps(rates).collect()
    assert [(r.finding, r.high, r.low) for r in got] == [("F", "b", "a")] and got[0].gap == pytest.approx(0.4)


def test_weights_keep_the_total(spark):
    n = spark.createDataFrame([("a", 90), ("b", 10), ("c", 0), ("d", 1)], "stratum string, n long")
    t = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "stratum string, target double")
    got = {r.stratum: r for r in equity.weights(n, t, cap=3.0).collect()}
    assert set(got) == {"a", "b", "d"} and got["d"].weight == 0 and got["b"].capped == 3.0 and got["b"].was_capped
    assert sum(got[s].weight * k for s, k in (("a", 90), ("b", 10), ("d", 1))) == pytest.approx(101)
    with pytest.raises(Exception, match="positive sum"):
        equity.weights(n, t.limit(0)).collect()


def test_splits(spark):
    ids = spark.range(20000).select(F.col("id").cast("string").alias("p"))
    of = lambda df, salt: df.select("p", splits.assign(F.col("p"), salt).alias("split"))
    share = {r.split: r.share for r in splits.proportions(of(ids, "s")).collect()}
    assert abs(share["train"] - 0.8) < 0.01 and abs(share["val"] - 0.1) < 0.01
    assert splits.churn(of(ids.limit(500), "s"), of(ids, "s"), "p").first().moved == 0
    assert splits.churn(of(ids, "s"), of(ids, "t"), "p").first().moved > 1000
    with pytest.raises(ValueError):
        splits.assign(F.lit("x"), "s", (0.5, 0.1, 0.1))
    assert [r.n for r in splits.proportions(of(ids.limit(0), "s")).orderBy("split").collect()] == [0, 0, 0]


def test_audit_chain_sees_every_kind_of_tampering(spark):
    rows = spark.createDataFrame([("a", i, f"p{i}") for i in range(6)] + [("b", 1, "q")], "log string, i int, p string")
    chain = audit.build(rows, "log", "i", F.col("p")).withColumn("line", F.col("seq")).cache()
    assert audit.verify(chain).count() == 0
    kinds = lambda df: {r.problem for r in audit.verify(df).collect()}
    assert kinds(chain.withColumn("payload", F.when((F.col("seq") == 3) & (F.col("log") == "a"), "x").otherwise(F.col("payload")))) == {"contents"}
    assert kinds(chain.where("NOT (log = 'a' AND seq = 3)")) == {"sequence", "previous_hash"}
    assert kinds(chain.withColumn("line", F.when(F.col("seq") == 2, 3).when(F.col("seq") == 3, 2).otherwise(F.col("seq")))) == {"sequence", "previous_hash"}
    assert kinds(chain.where("NOT (log = 'a' AND seq = 6)")) == set()  # only the expected head shows a cut tail
    heads = chain.groupBy("log").agg(F.max_by("entry_hash", "seq").alias("head"))
    assert [r.log for r in audit.truncated(chain.where("NOT (log = 'a' AND seq = 6)"), heads).collect()] == ["a"]


def test_roles(spark):
    df = spark.createDataFrame([(1, "secret")], "id long, text string")
    with pytest.raises(access.AccessDenied, match="open to: curator"):
        access.view(df, "modeller", "reports")
    for table in access.ALLOWED["curator"]:  # an auditor sees no row of any table
        with pytest.raises(access.AccessDenied):
            access.view(df, "auditor", table)
    with pytest.raises(access.AccessDenied):
        access.view(df, "nobody", "labels")
    assert access.LEAST == "auditor"
    assert access.view(df, "modeller", "studies", hidden=("text",)).columns == ["id"]


def test_release_digests_depend_on_contents_only(spark):
    df = spark.createDataFrame([(f"p{i}", f"{i:x}") for i in range(50)], "path string, sha256 string")
    for f in (release.digest, release.digest_tree):
        a, b = f(df, ["path", "sha256"]).first(), f(df.repartition(7), ["path", "sha256"]).first()
        assert a == b and a.n == 50
        assert f(df.withColumn("sha256", F.lit("0")), ["path", "sha256"]).first().digest != a.digest
        assert f(df.limit(0), ["path", "sha256"]).first().n == 0


def test_first_wins_ties_and_nulls(spark):
    df = spark.createDataFrame([("s", "b", "h"), ("s", "a", "h"), ("r", "z", "h"), ("s", "c", None), ("s", "d", None)], "site string, path string, sha string")
    got = {r.path: r.first_path for r in ingest.first_wins(df, "sha", ["site", "path"], "path").collect()}
    assert got == {"z": None, "a": "z", "b": "z", "c": None, "d": "c"}


def test_classifier_gate_comes_after_deduplication(spark):
    df = spark.createDataFrame([("s", "a", "h"), ("s", "b", "h"), ("s", "c", "i")], "site_id string, source_path string, sha256 string")
    odd = F.struct(F.lit("HEAD").alias("body_part"), F.when(F.col("sha256") == "h", 0.95).otherwise(0.5).alias("confidence"))
    good, bad = ingest.ingest(df, F.lit(None).cast("struct<reason:string,detail:string>"), classify=odd)
    assert [r.source_path for r in good.collect()] == ["c"]
    assert {(r.source_path, r.reason) for r in bad.collect()} == {("a", "BODY_PART_UNVERIFIED"), ("b", "DUPLICATE_CONTENT")}


def test_duplicate_examples(spark):
    df = spark.createDataFrame([(i, "x" if i < 9 else f"y{i}") for i in range(12)], "id long, h string")
    r = qc.duplicate_digests(df, "h", "id").collect()
    assert [(x.digest, x.n, x.examples) for x in r] == [("x", 9, [0, 1, 2, 3, 4])]


def test_validation(spark):
    df = spark.createDataFrame([("0123456789abcdef", "M", 120)], "pseudo_id string, sex string, age_years int")
    assert {r.column: r.n_bad for r in qc.invalid(df, "patients").collect()} == {"pseudo_id": 0, "sex": 0, "age_years": 1}
    with pytest.raises(Exception, match="age_years"):
        qc.validate(df, "patients").collect()
    with pytest.raises(ValueError, match="odd"):
        qc.validate(df.withColumn("odd", F.lit(1)), "patients", {"pseudo_id", "sex", "age_years"})


def test_resources(spark):
    s = spark.createDataFrame([("1.2", "p", "DX", dt.date(2020, 1, 2)), ("1.3", "p", "DX", None)], "study_uid string, pseudo_patient_id string, modality string, study_date date")
    ser = spark.createDataFrame([("1.2.1", "1.2", "PA")], "series_uid string, study_uid string, view_position string")
    ins = spark.createDataFrame([("1.2.1", "9"), ("1.2.1", "8")], "series_uid string, sop_uid string")
    lab = spark.createDataFrame([("1.2", "NODULE", "REPORT_RULE", True), ("1.2", "FRACTURE", "REPORT_RULE", False)], "study_uid string, finding string, source string, present boolean")
    rep = spark.createDataFrame([("1.2", {"FINDINGS": "secret prose", "IMPRESSION": " Nodule. "})], "study_uid string, sections map<string,string>")
    obs = interop.observations(lab, s)
    img = {r.study_uid: json.loads(r.resource) for r in interop.imaging_studies(s, ser, ins).collect()}
    assert img["1.2"]["series"][0]["instance"][0]["uid"] == "8" and img["1.2"]["series"][0]["description"] == "Chest postero-anterior" and "started" not in img["1.3"]
    assert [r.id for r in obs.orderBy("idx").collect()] == ["s1-2-obs-0", "s1-2-obs-1"]
    d = interop.diagnostic_reports(rep, s, obs).first()
    assert json.loads(d.resource)["conclusion"] == "Nodule." and "secret" not in d.resource and d.n_results == 2
    assert "Patient\"" not in d.resource and interop.entries(interop.imaging_studies(s, ser, ins), obs, interop.diagnostic_reports(rep, s, obs)).count() == 5


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "b")], "z long, a string")
    files.write_jsonl(df, str(tmp_path / "j"))
    assert files.read_jsonl(spark, str(tmp_path / "j"), "a string, z long").first() == ("b", 1)
    assert files.read_jsonl(spark, str(tmp_path / "none"), "a string").count() == 0
    (tmp_path / "s.csv").write_text("k,v,w\na,1,x\nb,2,x\na,3,x\n,4,x\n")
    assert sorted(files.read_sidecar(spark, str(tmp_path / "s.csv"), "k", "v").collect()) == [("a", "3"), ("b", "2")]
    assert files.read_sidecar(spark, str(tmp_path / "none.csv"), "k", "v").count() == 0
    (tmp_path / "c").mkdir()
    body = lambda uid, t: f'<rec><uId id="{uid}"/><MedlineCitation><Article><Abstract><AbstractText Label="FINDINGS">{t}</AbstractText></Abstract></Article></MedlineCitation><MeSH><major>Lung/x</major></MeSH></rec>'
    (tmp_path / "c" / "1.xml").write_text(body("1", "Clear."))
    (tmp_path / "c" / "2.xml").write_text(body("2", " "))
    r = files.read_corpus(spark, str(tmp_path / "c"), "rec").collect()
    assert [x.sections for x in r] == [{"FINDINGS": "Clear."}] and r[0].terms == ["Lung/x"]
    files.write_schemas({"t": df}, str(tmp_path / "schemas"))
    assert json.load(open(tmp_path / "schemas" / "t.json"))["additionalProperties"] is False


def test_streams_equal_batches(spark, tmp_path):
    rows = spark.createDataFrame([(i % 7, f"h{i % 5}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(60)], "p long, h string, at timestamp")
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    s = stateless.read_parquet_stream(spark, str(tmp_path / "in"), rows.schema, 1)
    stateless.run_available(stateless.pseudonymised(s, KEY, "p", "v1"), str(tmp_path / "out"), str(tmp_path / "ck"))
    batch = stateless.pseudonymised(rows, KEY, "p", "v1")
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(out.select(*batch.columns).collect()) == sorted(batch.collect())
    stateless.run_available(stateless.first_seen(stateless.read_parquet_stream(spark, str(tmp_path / "in"), rows.schema, 1), "h", "at", "30 days"), str(tmp_path / "o2"), str(tmp_path / "ck2"))
    assert spark.read.parquet(str(tmp_path / "o2")).count() == 5


def test_commands_end_to_end(spark, tmp_path):
    sites = tmp_path / "sites"
    sites.mkdir()
    for name, spec in SITES.items():
        (sites / f"{name}.yaml").write_text(yaml.safe_dump(spec))
    run = lambda *a: cli.main([*a, "--work", str(tmp_path / "w")])
    assert run("synth", "--source", str(tmp_path / "d")) == 0
    for c in ("ingest", "deid", "reports"):
        assert run(c) == 0
    assert run("harmonize", "--sites", str(sites)) == 0
    assert run("catalog") == 0 and run("qc") == 0 and run("qc", "--strict") == 1
    assert run("release", "--stratified") == 0 and run("export-fhir") == 0 and run("schema") == 0 and run("docs") == 0 and run("summary") == 0
    assert run("verify") == 0
    log = tmp_path / "w" / "audit.jsonl"
    log.write_text(log.read_text().replace('"accepted', '"accept', 1).replace("ingest", "INGEST", 1))
    assert run("verify") == 1
    assert os.path.exists(tmp_path / "w" / "qc.md")
