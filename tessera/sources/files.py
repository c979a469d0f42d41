"""Text, JSON lines, CSV sidecars, XML corpora, rule files and table sinks."""

from __future__ import annotations

import json
import os

import yaml
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.mapping import RuleSet
from tessera.operators import ingest


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of a JSON-lines path; none if it isn't there."""
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    try:
        return spark.read.schema(kind).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return _empty(spark, kind)
        raise


def write_jsonl(df: DataFrame, path: str) -> None:
    """Keys in order, so equal rows are equal lines."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def read_reports(spark: SparkSession, root: str) -> DataFrame:
    """source, site_id, stem, text of <root>/<site>/reports/*.txt, a row a file."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt").withColumn("source", F.input_file_name())
    at = r"/([^/]+)/reports/(?:.*/)?([^/]+)\.txt$"
    return files.select("source", F.regexp_extract("source", at, 1).alias("site_id"), F.regexp_extract("source", at, 2).alias("stem"), F.col("value").alias("text")).where("site_id != ''")


def read_sidecar(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """key, value: the last row of each key in file order; none if the file isn't there."""
    kind = T.StructType([T.StructField(key, T.StringType()), T.StructField(value, T.StringType())])
    try:
        rows = spark.read.option("header", True).csv(path).select(key, value, F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return _empty(spark, kind)
        raise
    return ingest.last_wins(rows.withColumn("_o", F.struct("_b", "_i")), key, value, "_o")


def read_corpus(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """uid, sections (map), terms: reports of an XML corpus; those without text go."""
    kind = "uId struct<_id:string>, MedlineCitation struct<Article:struct<Abstract:struct<AbstractText:array<struct<_Label:string,_VALUE:string>>>>>, MeSH struct<major:array<string>,automatic:array<string>>"
    rows = spark.read.format("xml").option("rowTag", row_tag).option("recursiveFileLookup", True).schema(kind).load(path)
    parts = F.filter(F.coalesce("MedlineCitation.Article.Abstract.AbstractText", F.array()), lambda x: F.trim(F.coalesce(x["_VALUE"], F.lit(""))) != "")
    out = rows.select(F.col("uId._id").alias("uid"), F.map_from_entries(F.transform(parts, lambda x: F.struct(F.upper(x["_Label"]), F.trim(x["_VALUE"])))).alias("sections"), F.concat(F.coalesce("MeSH.major", F.array()), F.coalesce("MeSH.automatic", F.array())).alias("terms"))
    return out.where(F.coalesce(F.col("sections")["FINDINGS"], F.col("sections")["IMPRESSION"]).isNotNull())


SITE_KEYS = {"site_id", "description", "view_position", "laterality", "sex", "labels", "date_formats"}


def load_sites(folder: str) -> dict[str, dict]:
    """Site rules by id from every YAML file, in name order; unknown keys, repeated ids and bad patterns raise."""
    out: dict[str, dict] = {}
    for name in sorted(os.listdir(folder)):
        if not name.endswith(".yaml"):
            continue
        with open(os.path.join(folder, name), encoding="utf-8") as f:
            spec = yaml.safe_load(f)
        if set(spec) - SITE_KEYS:
            raise ValueError(f"{name}: unknown keys {sorted(set(spec) - SITE_KEYS)}")
        if spec["site_id"] in out:
            raise ValueError(f"{name}: {spec['site_id']} is configured twice")
        rules = {}
        for field, default in (("view_position", "UNKNOWN"), ("laterality", "NA"), ("sex", "U")):
            s = spec.get(field) or {}
            rules[field] = RuleSet(s.get("default", default), {str(k): v for k, v in (s.get("map") or {}).items()}, tuple((p["match"], p["value"]) for p in s.get("patterns") or []))
        out[spec["site_id"]] = rules | {"labels": spec.get("labels") or {}, "date_formats": spec.get("date_formats") or []}
    return out


def json_schema(name: str, kind: T.StructType) -> dict:
    """JSON Schema 2020-12 of a table's rows; extra fields are forbidden."""

    def of(t: T.DataType) -> dict:
        if isinstance(t, T.StructType):
            return {"type": "object", "properties": {f.name: of(f.dataType) for f in t.fields}, "required": [f.name for f in t.fields if not f.nullable], "additionalProperties": False}
        if isinstance(t, T.ArrayType):
            return {"type": "array", "items": of(t.elementType)}
        if isinstance(t, T.MapType):
            return {"type": "object", "additionalProperties": of(t.valueType)}
        names = {T.StringType: "string", T.BooleanType: "boolean", T.IntegerType: "integer", T.LongType: "integer", T.DoubleType: "number", T.FloatType: "number"}
        return {"type": "string", "format": "date"} if isinstance(t, T.DateType) else {"type": names.get(type(t), "string")}

    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": name} | of(kind)


def write_schemas(tables: dict[str, DataFrame], folder: str) -> None:
    os.makedirs(folder, exist_ok=True)
    for name, df in sorted(tables.items()):
        with open(os.path.join(folder, f"{name}.json"), "w", encoding="utf-8") as f:
            f.write(json.dumps(json_schema(name, df.schema), indent=2, sort_keys=True) + "\n")


def write_catalog(tables: dict[str, DataFrame], path: str) -> None:
    """Each table as Parquet under path; studies and labels are laid out by site or source for pruning."""
    layout = {"studies": "site_id", "labels": "source"}
    for name, df in tables.items():
        w = df.write.mode("overwrite")
        (w.partitionBy(layout[name]) if name in layout and layout[name] in df.columns else w).parquet(f"{path}/{name}")


def write_jdbc(tables: dict[str, DataFrame], url: str, properties: dict[str, str] | None = None) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").jdbc(url, name, properties=properties or {})
