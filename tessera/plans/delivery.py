"""The whole path of a delivery: ingest, de-identify, reports, harmonise, check, release; each step a lazy DataFrame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import dates, identity
from tessera.functions import text as tx
from tessera.functions.mapping import RuleSet
from tessera.operators import deid, equity, harmonize, ingest, pixels, qc, splits
from tessera.sources import dicom, files

#: What the header knows to look for in the prose.
NAMES = ("PatientName", "ReferringPhysicianName", "PerformingPhysicianName", "NameOfPhysiciansReadingStudy")
IDS = ("PatientID", "OtherPatientIDs", "AccessionNumber", "PatientTelephoneNumbers")
INSTITUTIONS = ("InstitutionName", "InstitutionAddress", "StationName")
REQUIRED = ("SOPInstanceUID", "StudyInstanceUID", "SeriesInstanceUID", "PatientID")


@dataclass
class Rules:
    view: dict[str, RuleSet]
    laterality: dict[str, RuleSet]
    sex: dict[str, RuleSet]
    labels: dict[str, dict]  # site -> {source, separator, map, sidecar_*}

    @classmethod
    def of(cls, sites: dict[str, dict]) -> Rules:
        return cls(*({s: r[k] for s, r in sites.items()} for k in ("view_position", "laterality", "sex", "labels")))


def ingest_delivery(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantine): headers of objects in scope with the report beside them; the rest with its reason."""
    objects = dicom.scan(spark, root)
    # both outputs come from one parse; headers are small beside the objects
    h = dicom.headers(objects, keep=("source_path", "site_id", "stem", "sha256", "size_bytes")).persist()
    rule = ingest.reject({k: F.col(k) for k in REQUIRED}, F.col("Modality"), F.col("BodyPartExamined"), F.col("has_pixels"))
    unread = F.struct(F.when(F.col("error") == "not a DICOM file", "NOT_DICOM").otherwise("UNREADABLE").alias("reason"), F.col("error").alias("detail"))
    good, bad = ingest.ingest(h, F.when(F.col("error").isNotNull(), unread).otherwise(rule))
    reports = files.read_reports(spark, root).select("site_id", "stem", F.col("text").alias("report"))
    return ingest.pair_by_stem(good, reports), bad


def identify(accepted: DataFrame, key: bytes) -> DataFrame:
    """accepted with pseudo_id, linked, offset and remapped uids."""
    who = identity.patient_pseudonym(key, F.col("OtherPatientIDs"), F.col("PatientID"), F.col("site_id"))
    rows = accepted.withColumn("_who", who).withColumn("pseudo_id", F.col("_who.pseudo_id")).withColumn("linked", F.col("_who.linked")).drop("_who")
    rows = rows.withColumn("offset", identity.date_offset_days(key, F.col("pseudo_id")))
    for name, k in (("study_uid", "StudyInstanceUID"), ("series_uid", "SeriesInstanceUID"), ("sop_uid", "SOPInstanceUID")):
        rows = rows.withColumn(name, identity.remap_uid(key, F.col(k)))
    return rows


def header_after(spark: SparkSession, root: str, known: DataFrame, key: bytes) -> DataFrame:
    """object_id, path, tag, vr, value: what each accepted object's header holds after the profile."""
    a = dicom.attributes(dicom.scan(spark, root)).where("tag IS NOT NULL").withColumnRenamed("source_path", "object_id")
    own = known.select(F.col("source_path").alias("object_id"), "pseudo_id", "offset")
    kept = deid.apply_profile(a.join(own, "object_id"), key).select("object_id", "path", "tag", "vr", "value")
    marks = deid.markers(own.select("object_id")).select("object_id", F.array().cast("array<string>").alias("path"), "tag", F.lit("LO").alias("vr"), "value")
    return kept.unionByName(marks)


def clean_images(spark: SparkSession, root: str, known: DataFrame) -> DataFrame:
    """source_path, rows, columns, pixels and regions of accepted images, upright and without burned-in text."""
    return pixels.clean(dicom.images(dicom.scan(spark, root)).join(known.select("source_path"), "source_path"))


def process_reports(known: DataFrame) -> DataFrame:
    """study_uid, site_id, text, sections, findings, denied, redaction_count of objects with a report."""
    rows = known.where("report IS NOT NULL")
    names = F.array(*NAMES, *[F.replace(n, F.lit("^"), F.lit(" ")) for n in NAMES])
    x = tx.scrub(F.col("report"), names, F.array(*IDS), F.array(*INSTITUTIONS), F.col("offset"))
    rows = rows.withColumn("_x", x).select("study_uid", "site_id", "source_path", F.col("_x.text").alias("text"), F.col("_x.n").alias("redaction_count"))
    rows = rows.withColumn("sections", tx.sections(F.col("text")))
    rows = rows.withColumn("_l", tx.extract_labels(tx.clinical_text(F.col("sections"))))
    return rows.select("study_uid", "site_id", "source_path", "text", "sections", F.col("_l.findings").alias("findings"), F.col("_l.denied").alias("denied_findings"), "redaction_count")


def harmonise(spark: SparkSession, known: DataFrame, reports: DataFrame, rules: Rules, root: str, images: DataFrame | None = None) -> dict[str, DataFrame]:
    """The canonical tables, and unmapped: values no rule maps. Study dates are the shifted ones.

    images: what clean_images gave, made from root if not given; an instance without a cleaned image keeps its
    header's photometric interpretation, and whether it was redacted is null.
    """
    facts = deid.facts(known).join(known.select("source_path", "pseudo_id", "offset", "study_uid", "series_uid", "sop_uid", "sha256", "PatientBirthDate", "PhotometricInterpretation"), "source_path")
    facts = harmonize.require_sites(facts, rules.view)
    for native, table, out in (("view_native", rules.view, "view_position"), ("laterality_native", rules.laterality, "laterality"), ("sex_native", rules.sex, "sex")):
        facts = harmonize.resolve_column(facts, native, table, out)
    day = dates.parse_native_date(F.col("study_date_native"))
    facts = facts.withColumn("study_date", identity.shift_date(day, F.col("offset"))).withColumn("age_years", dates.compute_age(dates.parse_native_date(F.col("PatientBirthDate")), day))
    rows = facts.select(F.col("pseudo_id").alias("pseudo_patient_id"), "study_uid", "series_uid", "sop_uid", "site_id", F.col("source_path").alias("relative_path"), "sha256", "sex", "age_years", "study_date", "modality", "body_part", "view_position", "laterality")
    out = harmonize.entities(rows)
    out["patients"] = out["patients"].withColumnRenamed("pseudo_patient_id", "pseudo_id")
    if images is None and root:
        images = clean_images(spark, root, known)
    seen = facts.select("source_path", F.upper(tx.strip(F.col("PhotometricInterpretation"))).alias("_header"))
    seen = seen.join(images.select("source_path", (F.size("regions") > 0).alias("pixel_redacted")), "source_path", "left") if images is not None else seen.withColumn("pixel_redacted", F.lit(None).cast("boolean"))
    upright = F.col("pixel_redacted").isNotNull() & (F.col("_header") == "MONOCHROME1")  # clean() turned these
    seen = seen.select(F.col("source_path").alias("relative_path"), F.when(upright, "MONOCHROME2").otherwise(F.col("_header")).alias("photometric_interpretation"), "pixel_redacted")
    out["instances"] = out["instances"].join(seen, "relative_path", "left")
    channels = [reports.select("study_uid", F.explode("findings").alias("finding"), F.lit("REPORT_RULE").alias("source"), F.lit(None).cast("string").alias("native"), F.lit(True).alias("present"))]
    denied = reports.select("study_uid", F.explode("denied_findings").alias("finding"), F.lit("REPORT_RULE").alias("source"), F.lit(None).cast("string").alias("native"), F.lit(False).alias("present"))
    channels.append(denied)
    unmapped = [harmonize.unmapped(facts, {"view_position": "view_native", "laterality": "laterality_native", "sex": "sex_native"})]
    for site, spec in rules.labels.items():
        own = facts.where(F.col("site_id") == site)
        if spec.get("source") == "image_comments":
            own = own.withColumn("_native", F.col("labels_native"))
        elif spec.get("source") == "sidecar_csv":
            side = files.read_sidecar(spark, f"{root}/{site}/{spec['sidecar_file']}", spec["sidecar_key_column"], spec["sidecar_value_column"])
            own = own.join(side.select(F.col(spec["sidecar_key_column"]).alias("accession_key"), F.col(spec["sidecar_value_column"]).alias("_native")), "accession_key", "left")
        else:
            continue
        tokens = harmonize.label_tokens(own, "_native", spec["separator"], spec["map"], ["study_uid", "site_id"])
        channels.append(tokens.select("study_uid", "finding", F.lit("SITE_STRUCTURED").alias("source"), "native", F.lit(True).alias("present")))
        unmapped.append(ingest.counts_by(tokens.where("NOT matched").select("site_id", F.lit("label").alias("field"), F.col("native").alias("value")), "site_id", "field", "value"))
    out["labels"] = harmonize.label_union(*channels)
    out["unmapped"] = unmapped[0]
    for u in unmapped[1:]:
        out["unmapped"] = out["unmapped"].unionByName(u)
    return out


def quality(tables: dict[str, DataFrame], quarantine: DataFrame) -> DataFrame:
    """The check report of a cohort."""
    j = tables["studies"].join(tables["patients"], F.col("pseudo_patient_id") == F.col("pseudo_id"))
    cohort = j.select(F.col("study_uid").alias("study"), F.col("pseudo_patient_id").alias("patient"), equity.stratum_key(F.col("site_id"), F.col("sex"), F.col("age_years")).alias("stratum"))
    strata = equity.strata(cohort)
    present = tables["labels"].where("present").select(F.col("study_uid").alias("study"), "finding")
    found = sorted(r["finding"] for r in present.select("finding").distinct().collect())  # as many as the vocabulary has
    rates = equity.prevalence(cohort, present, found)
    return qc.report(qc.standard_checks(tables | {"quarantine": quarantine, "strata": strata, "gaps": equity.parity_gaps(rates)}))


def assign_splits(tables: dict[str, DataFrame], salt: str, stratified: bool = False) -> DataFrame:
    p = tables["patients"]
    if not stratified:
        return p.select(F.col("pseudo_id").alias("pseudo_patient_id"), splits.assign(F.col("pseudo_id"), salt).alias("split"))
    site = tables["studies"].groupBy("pseudo_patient_id").agg(F.min("site_id").alias("site"))
    j = p.join(site, F.col("pseudo_id") == F.col("pseudo_patient_id"), "left")
    key = equity.stratum_key(F.coalesce("site", F.lit("UNKNOWN")), F.col("sex"), F.col("age_years"))
    return j.select(F.col("pseudo_id").alias("pseudo_patient_id"), splits.assign_stratified(F.col("pseudo_id"), key, salt).alias("split"))
