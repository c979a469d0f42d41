"""Interchange: imaging studies, observations and reports as nested JSON resources, joined instead of scanned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import vocab
from tessera.operators.ingest import numbered


def resource_id(uid: Column) -> Column:
    return F.substring(F.concat(F.lit("s"), F.translate(uid, ".", "-")), 1, 64)


def subject(patient: Column) -> Column:
    return F.struct(F.struct(F.lit("urn:tessera:patient").alias("system"), patient.alias("value")).alias("identifier"))


def imaging_studies(studies: DataFrame, series: DataFrame, instances: DataFrame) -> DataFrame:
    """study_uid, n_series, n_instances, resource."""
    sop = F.struct(F.lit("urn:ietf:rfc:3986").alias("system"), F.lit("urn:oid:1.2.840.10008.5.1.4.1.1.1").alias("code"))
    by_series = instances.groupBy("series_uid").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(F.col("sop_uid").alias("uid"), sop.alias("sopClass")))).alias("instance"))
    views = F.create_map(*[F.lit(x) for k, (_, text) in vocab.VIEW_CODES.items() for x in (k, f"Chest {text}")])
    said = F.try_element_at(views, "view_position")
    site = F.when(said.isNotNull(), F.struct(F.lit(vocab.SNOMED).alias("system"), F.lit("51185008").alias("code"), F.lit("Thoracic structure").alias("display")))
    rows = series.join(by_series, "series_uid", "left").join(studies.select("study_uid", "modality"), "study_uid")
    entry = F.struct(F.col("series_uid").alias("uid"), F.struct(F.lit(vocab.DICOM_DCM).alias("system"), F.col("modality").alias("code")).alias("modality"), F.coalesce("n", F.lit(0)).alias("numberOfInstances"), F.coalesce("instance", F.array()).alias("instance"), site.alias("bodySite"), said.alias("description"))
    grouped = rows.groupBy("study_uid").agg(F.count("*").alias("n_series"), F.sum(F.coalesce("n", F.lit(0))).cast("long").alias("n_instances"), F.array_sort(F.collect_list(entry), lambda a, b: F.when(a["uid"] < b["uid"], -1).when(a["uid"] > b["uid"], 1).otherwise(0)).alias("series"))
    j = studies.join(grouped, "study_uid", "left")
    n_s, n_i = F.coalesce("n_series", F.lit(0)).cast("long"), F.coalesce("n_instances", F.lit(0)).cast("long")
    body = F.struct(
        resource_id(F.col("study_uid")).alias("id"),
        F.array(F.struct(F.lit("urn:dicom:uid").alias("system"), F.concat(F.lit("urn:oid:"), "study_uid").alias("value"))).alias("identifier"),
        F.array(F.struct(F.lit(vocab.DICOM_DCM).alias("system"), F.col("modality").alias("code"))).alias("modality"),
        n_i.alias("numberOfInstances"),
        n_s.alias("numberOfSeries"),
        F.lit("ImagingStudy").alias("resourceType"),
        F.col("series").alias("series"),
        F.date_format("study_date", "yyyy-MM-dd").alias("started"),
        F.lit("available").alias("status"),
        subject(F.col("pseudo_patient_id")).alias("subject"),
    )
    return j.select("study_uid", n_s.alias("n_series"), n_i.alias("n_instances"), F.to_json(body).alias("resource"))


def observations(labels: DataFrame, studies: DataFrame) -> DataFrame:
    """study_uid, idx, id, code, resource: a row a finding, numbered by finding within the study."""
    codes = F.create_map(*[x for k, (s, c, d) in vocab.FINDING_CODES.items() for x in (F.lit(k), F.struct(F.lit(s).alias("system"), F.lit(c).alias("code"), F.lit(d).alias("display")))])
    ways = F.create_map(*[F.lit(x) for kv in vocab.METHOD_DISPLAY.items() for x in kv])
    rows = numbered(labels, ["study_uid"], ["finding", "source"]).join(studies.select("study_uid", "pseudo_patient_id"), "study_uid")
    rows = rows.withColumn("code", codes[F.col("finding")]).withColumn("id", F.concat(resource_id(F.col("study_uid")), F.lit("-obs-"), F.col("idx").cast("string")))
    body = F.struct(
        F.array(F.struct(F.array(F.struct(F.lit("imaging").alias("code"), F.lit("http://terminology.hl7.org/CodeSystem/observation-category").alias("system"))).alias("coding"))).alias("category"),
        F.struct(F.array("code").alias("coding")).alias("code"),
        F.col("id"),
        F.struct(F.array(F.struct(F.col("source").alias("code"), ways[F.col("source")].alias("display"), F.lit(vocab.LOCAL_SYSTEM + "/method").alias("system"))).alias("coding")).alias("method"),
        F.lit("Observation").alias("resourceType"),
        F.lit("final").alias("status"),
        subject(F.col("pseudo_patient_id")).alias("subject"),
        F.col("present").alias("valueBoolean"),
    )
    return rows.select("study_uid", "idx", "id", F.col("code.code").alias("code"), F.to_json(body).alias("resource"))


def diagnostic_reports(reports: DataFrame, studies: DataFrame, obs: DataFrame) -> DataFrame:
    """study_uid, n_results, resource: of studies with a report; the conclusion is the impression, never other prose."""
    ids = obs.groupBy("study_uid").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "id"))), lambda x: F.struct(F.concat(F.lit("Observation/"), x["id"]).alias("reference"))).alias("result"))
    j = reports.join(studies.select("study_uid", "pseudo_patient_id", "study_date"), "study_uid").join(ids, "study_uid", "left")
    rid = resource_id(F.col("study_uid"))
    body = F.struct(
        F.array(F.struct(F.array(F.struct(F.lit("CR").alias("code"), F.lit("Radiology").alias("display"), F.lit(vocab.DICOM_DCM).alias("system"))).alias("coding"))).alias("category"),
        F.struct(F.array(F.struct(F.lit("30746-2").alias("code"), F.lit("Chest X-ray study").alias("display"), F.lit(vocab.LOINC).alias("system"))).alias("coding")).alias("code"),
        F.nullif(F.trim(F.coalesce(F.col("sections")["IMPRESSION"], F.lit(""))), F.lit("")).alias("conclusion"),
        F.date_format("study_date", "yyyy-MM-dd").alias("effectiveDateTime"),
        F.concat(rid, F.lit("-report")).alias("id"),
        F.array(F.struct(F.concat(F.lit("ImagingStudy/"), rid).alias("reference"))).alias("imagingStudy"),
        F.lit("DiagnosticReport").alias("resourceType"),
        F.coalesce("result", F.array()).alias("result"),
        F.lit("final").alias("status"),
        subject(F.col("pseudo_patient_id")).alias("subject"),
    )
    return j.select("study_uid", F.size(F.coalesce("result", F.array())).cast("long").alias("n_results"), F.to_json(body).alias("resource"))


def entries(studies: DataFrame, obs: DataFrame, reports: DataFrame) -> DataFrame:
    """study_uid, part, idx, full_url, resource: in the order a bundle lists them."""
    part = lambda df, n, kind, idx, rid: df.select("study_uid", F.lit(n).alias("part"), idx.alias("idx"), F.concat(F.lit(f"urn:uuid:{kind}-"), rid).alias("full_url"), "resource")
    rid = resource_id(F.col("study_uid"))
    return part(studies, 0, "imagingstudy", F.lit(0), rid).unionByName(part(obs, 1, "observation", F.col("idx"), F.col("id"))).unionByName(part(reports, 2, "diagnosticreport", F.lit(0), F.concat(rid, F.lit("-report"))))
