"""De-identification of header attributes held one a row, and checks of what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import vocab
from tessera.functions import identity
from tessera.functions.text import first_nonempty, strip

DUMMY = "ANONYMISED"
NOT_LETTERS = r"[^\p{L}]+"


def dropped_group(group: Column) -> Column:
    """Private (odd), overlay and curve groups."""
    return (group % 2 == 1) | group.between(0x6000, 0x60FF) | group.between(0x5000, 0x50FF)


def actions(tag: Column) -> Column:
    """What the profile does with an eight-digit tag; null: it stays."""
    out = F.lit(None).cast("string")
    for action, tags in vocab.TAG_ACTIONS.items():
        out = F.when(F.upper(tag).isin(*tags), F.lit(action)).otherwise(out)
    return out


def apply_profile(elements: DataFrame, key: bytes) -> DataFrame:
    """elements (object_id, path, tag, vr, value, pseudo_id, offset), at any depth of nesting, after the profile.

    path is the list of sequence tags above the element: an element under a removed sequence goes with it.
    """
    group = F.conv(F.substring("tag", 1, 4), 16, 10).cast("int")
    rows = elements.where(~dropped_group(group))
    above = F.exists("path", lambda t: F.coalesce(actions(t) == "REMOVE", F.lit(False)) | dropped_group(F.conv(F.substring(t, 1, 4), 16, 10).cast("int")))
    rows = rows.where(~above).withColumn("_a", actions(F.col("tag"))).where(~F.col("_a").eqNullSafe(F.lit("REMOVE")))
    value = (
        F.when(F.col("_a") == "BLANK", "")
        .when(F.col("_a") == "DUMMY", DUMMY)
        .when(F.col("_a") == "PSEUDO", F.col("pseudo_id"))
        .when((F.col("_a") == "UID") & (F.coalesce("value", F.lit("")) != ""), identity.remap_uid(key, F.col("value")))
        .when(F.col("_a") == "SHIFT", identity.shift_da(F.coalesce("value", F.lit("")), F.col("offset")))
        .otherwise(F.col("value"))
    )
    return rows.withColumn("value", value).drop("_a")


def markers(ids: DataFrame) -> DataFrame:
    """object_id, tag, value: what a de-identified object says about itself."""
    said = [("00120062", "YES"), ("00280301", "NO"), ("00120063", "\\".join(vocab.METHODS)), ("00120064", "\\".join(c for c, _ in vocab.METHOD_CODES))]
    return ids.select("object_id", F.explode(F.array(*[F.struct(F.lit(t).alias("tag"), F.lit(v).alias("value")) for t, v in said])).alias("x")).select("object_id", "x.*")


def facts(header: DataFrame) -> DataFrame:
    """A site's clinical values, read before redaction. header: a row an object, a column a keyword."""
    h = F.col
    return header.select(
        "source_path",
        "site_id",
        first_nonempty(h("ViewPosition"), h("SeriesDescription")).alias("view_native"),
        strip(F.coalesce(h("Laterality"), F.lit(""))).alias("laterality_native"),
        strip(F.coalesce(h("ImageComments"), F.lit(""))).alias("labels_native"),
        first_nonempty(h("StudyDate"), h("ContentDate"), h("AcquisitionDate"), h("PrivateDate")).alias("study_date_native"),
        strip(F.coalesce(h("PatientSex"), F.lit(""))).alias("sex_native"),
        F.upper(strip(F.coalesce(h("BodyPartExamined"), F.lit("")))).alias("body_part"),
        F.upper(strip(F.coalesce(h("Modality"), F.lit("")))).alias("modality"),
        strip(F.coalesce(h("AccessionNumber"), F.lit(""))).alias("accession_key"),
    )


def uid_map(rows: DataFrame, key: bytes, columns: dict[str, str]) -> DataFrame:
    """kind, original, remapped: each distinct identifier of the columns {kind: column}."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("original")) for k, c in columns.items()]))
    return rows.select(each.alias("x")).select("x.*").where("original IS NOT NULL").distinct().withColumn("remapped", identity.remap_uid(key, F.col("original")))


def leftovers(elements: DataFrame, must_be_empty: list[str], needed: dict[str, str]) -> DataFrame:
    """object_id, kind, detail: attributes that must be empty, private and overlay elements, missing markers.

    The list is an argument: the verifier doesn't share the table that redaction uses.
    """
    group = F.conv(F.substring("tag", 1, 4), 16, 10).cast("int")
    full = elements.where(F.upper("tag").isin(*must_be_empty) & (F.trim(F.coalesce("value", F.lit(""))) != "")).select("object_id", F.lit("attribute_present").alias("kind"), F.col("tag").alias("detail"))
    private = elements.where(dropped_group(group)).select("object_id", F.lit("private_or_overlay").alias("kind"), F.col("tag").alias("detail"))
    ids = elements.select("object_id").distinct()
    want = ids.select("object_id", F.explode(F.create_map(*[F.lit(x) for kv in needed.items() for x in kv])).alias("tag", "want"))
    have = elements.where(F.size("path") == 0).select("object_id", "tag", F.col("value").alias("_v"))
    bad = want.join(have, ["object_id", "tag"], "left").where(~F.col("want").eqNullSafe(F.col("_v"))).select("object_id", F.lit("marker_missing").alias("kind"), F.col("tag").alias("detail"))
    return full.unionByName(private).unionByName(bad)


def substring_hits(values: DataFrame, text: str, literals: DataFrame, literal: str, least: int = 5, most: int = 20_000) -> DataFrame:
    """values joined with every literal of `least` or more characters that its text contains, whatever the case.

    A literal with a whole word inside (other characters than letters on both sides) can only be in texts with that
    word, so its longest one is joined first; texts are searched for the others one by one. Literals are broadcast after
    a count that proves them few; more raise.
    """
    own = literals.select(F.upper(literal).alias("_lit")).where(F.length("_lit") >= least).distinct()
    n = own.count()
    if n > most:
        raise ValueError(f"{n} literals; {most} can be broadcast. Cut them into parts")
    words = F.split("_lit", NOT_LETTERS)
    inside = F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0)))
    longest = F.array_max(F.transform(inside, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    own = own.select("_lit", F.nullif(longest, F.lit("")).alias("_word"))
    rows = values.withColumn("_upper", F.upper(text))
    found = F.contains(F.col("_upper"), F.col("_lit"))
    by_word = rows.withColumn("_w", F.explode(F.array_distinct(F.split("_upper", NOT_LETTERS)))).join(F.broadcast(own.where("_word IS NOT NULL")), F.col("_w") == F.col("_word")).where(found)
    others = rows.join(F.broadcast(own.where("_word IS NULL")), found)
    out = [*values.columns, F.col("_lit").alias("literal")]
    return by_word.select(*out).unionByName(others.select(*out))
