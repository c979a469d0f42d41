"""Command line: python -m tessera.cli COMMAND --work DIR [...]. Each command reads what the one before wrote."""

from __future__ import annotations

import argparse
import hashlib
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import synth
from tessera.functions import identity
from tessera.operators import access, audit, interop, qc, release
from tessera.plans import delivery
from tessera.session import get_spark
from tessera.sources import files

TABLES = ("patients", "studies", "series", "instances", "labels", "unmapped")
COMMANDS = ("synth", "ingest", "deid", "reports", "harmonize", "catalog", "qc", "release", "export-fhir", "verify", "schema", "docs", "summary")


class Work:
    """Paths under one work folder, and the append-only audit log."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        os.makedirs(root, exist_ok=True)

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def log(self, stage: str, **counts: int) -> None:
        lines = open(self.path("audit.jsonl"), encoding="utf-8").read().splitlines() if os.path.exists(self.path("audit.jsonl")) else []
        last = json.loads(lines[-1])["entry_hash"] if lines else audit.GENESIS
        payload = json.dumps({"counts": counts, "stage": stage}, sort_keys=True, separators=(",", ":"))
        entry = {"seq": len(lines) + 1, "payload": payload, "previous_hash": last, "entry_hash": hashlib.sha256(f"{last}\n{payload}".encode()).hexdigest()}
        with open(self.path("audit.jsonl"), "a", encoding="utf-8") as f:
            f.write(json.dumps(entry, sort_keys=True) + "\n")

    def chain_problems(self) -> DataFrame:
        rows = files.read_jsonl(self.spark, self.path("audit.jsonl"), "seq int, payload string, previous_hash string, entry_hash string")
        return audit.verify(rows.withColumn("log", F.lit("audit")).withColumn("line", F.col("seq")))


def _tables(w: Work) -> dict[str, DataFrame]:
    return {t: w.get(f"canonical/{t}") for t in TABLES}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tessera", description=__doc__)
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("--work", required=True, help="work folder")
    p.add_argument("--source", help="delivery folder (remembered by ingest)")
    p.add_argument("--sites", help="folder of site rules")
    p.add_argument("--key", help="key file")
    p.add_argument("--release", default="v1")
    p.add_argument("--role", default=access.LEAST, choices=sorted(access.ALLOWED))
    p.add_argument("--strict", action="store_true")
    p.add_argument("--stratified", action="store_true")
    p.add_argument("--seed", type=int, default=7)
    a = p.parse_args(argv)
    spark = get_spark("tessera")
    spark.sparkContext.setLogLevel("ERROR")
    w = Work(spark, a.work)
    memo = w.path("source.json")
    if a.source:
        with open(memo, "w", encoding="utf-8") as f:
            json.dump({"source": a.source}, f)
    source = json.load(open(memo, encoding="utf-8"))["source"] if os.path.exists(memo) else None
    if a.command in ("ingest", "deid", "harmonize", "synth") and not source:
        p.error("no delivery is known; give --source")
    root = f"file://{os.path.abspath(source)}" if source and "://" not in source else source

    if a.command == "synth":
        print(len(synth.generate(source, a.seed)["studies"]), "studies")
    elif a.command == "ingest":
        good, bad = delivery.ingest_delivery(spark, root)
        good, bad = w.put(good, "accepted"), w.put(bad, "quarantine")
        w.log("ingest", accepted=good.count(), quarantined=bad.count())
        bad.groupBy("reason").count().orderBy("reason").show(truncate=False)
    elif a.command == "deid":
        key = identity.load_key(a.key or w.path("key.hex"), create=True)
        known = w.put(delivery.identify(w.get("accepted"), key), "known")
        w.put(delivery.header_after(spark, root, known, key), "headers")
        images = w.put(delivery.clean_images(spark, root, known), "images")
        w.log("deid", objects=known.count(), redacted=images.where(F.size("regions") > 0).count())
    elif a.command == "reports":
        r = w.put(delivery.process_reports(w.get("known")), "reports")
        w.log("reports", reports=r.count(), redactions=r.agg(F.sum("redaction_count")).first()[0] or 0)
    elif a.command == "harmonize":
        rules = delivery.Rules.of(files.load_sites(a.sites))
        for name, df in delivery.harmonise(spark, w.get("known"), w.get("reports"), rules, root, w.get("images")).items():
            w.put(df, f"canonical/{name}")
        w.log("harmonize", unmapped=w.get("canonical/unmapped").count())
    elif a.command == "catalog":
        files.write_catalog(_tables(w), w.path("catalog"))
        access.table_counts(_tables(w)).show()
    elif a.command == "qc":
        report = w.put(delivery.quality(_tables(w), w.get("quarantine")), "qc")
        with open(w.path("qc.md"), "w", encoding="utf-8") as f:
            f.write(qc.markdown(report))
        print(qc.markdown(report))
        return 0 if qc.passed(report, a.strict) else 1
    elif a.command == "release":
        s = w.put(delivery.assign_splits(_tables(w), a.release, a.stratified), f"releases/{a.release}/splits")
        images = w.get("images").select(F.col("source_path").alias("path"), F.sha2("pixels", 256).alias("sha256"), F.octet_length("pixels").cast("long").alias("size_bytes"))
        m = w.put(images, f"releases/{a.release}/manifest")
        d = release.digest_tree(m, ["path", "sha256", "size_bytes"]).first()
        with open(w.path(f"releases/{a.release}/release.json"), "w", encoding="utf-8") as f:
            json.dump({"digest": d.digest, "n": d.n, "salt": a.release, "strategy": "stratified" if a.stratified else "global"}, f, sort_keys=True)
        w.log("release", entries=d.n, patients=s.count())
    elif a.command == "export-fhir":
        t = _tables(w)
        obs = interop.observations(t["labels"], t["studies"])
        rep = interop.diagnostic_reports(w.get("reports").select("study_uid", "sections"), t["studies"], obs)
        every = interop.entries(interop.imaging_studies(t["studies"], t["series"], t["instances"]), obs, rep)
        every.orderBy("study_uid", "part", "idx").select("full_url", "resource").write.mode("overwrite").json(w.path("fhir"))
    elif a.command == "verify":
        bad = w.chain_problems().count()
        for name in sorted(os.listdir(w.path("releases"))) if os.path.isdir(w.path("releases")) else []:
            meta = json.load(open(w.path(f"releases/{name}/release.json"), encoding="utf-8"))
            m = w.get(f"releases/{name}/manifest")
            have = w.get("images").select(F.col("source_path").alias("path"), F.sha2("pixels", 256).alias("sha256"))
            bad += int(release.digest_tree(m, ["path", "sha256", "size_bytes"]).first().digest != meta["digest"]) + release.verify_files(m, have).count()
        print("problems:", bad)
        return int(bad > 0)
    elif a.command == "schema":
        files.write_schemas(_tables(w), w.path("schemas"))
    elif a.command == "docs":
        for name, df in _tables(w).items():
            print(f"{name}: {', '.join(f'{c} {t}' for c, t in df.dtypes)}")
    elif a.command == "summary":
        t = _tables(w)
        access.cohort_summary(t["studies"], t["patients"].withColumnRenamed("pseudo_id", "pseudo_patient_id").select("pseudo_patient_id", "sex"), "pseudo_patient_id", "study_uid", "site_id", "sex").orderBy("site", "sex").show()
        if "studies" in access.ALLOWED[a.role]:
            access.view(t["studies"], a.role, "studies", hidden=("study_date",)).show(5)
    return 0


if __name__ == "__main__":
    sys.exit(main())
