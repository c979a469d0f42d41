"""Identity, mapping, ingest, joins, splits and catalogue queries over the fixture tables.

customer stands for patients, orders for studies (their priority for the site), lineitem for series and
instances, part for labels, documents for report text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import dates, identity
from tessera.functions.mapping import RuleSet, is_unmapped
from tessera.operators import access, equity, harmonize, ingest, splits
from tessera.operators.deid import uid_map
from tessera.plans.registry import KEY, Tables, query, sql_band, sql_bucket, sql_mac, sql_split

SEX = RuleSet("U", {"BUILDING": "M", "machinery": "F", " AUTOMOBILE ": "O", "BUILDING ": "F"})
VIEW = RuleSet("UNKNOWN", {"A": "AP", "R": "PA"})
SIDE = RuleSet("NA", {"O": "L", "f": "R"})
TYPE = RuleSet("UNKNOWN", patterns=((r"\bPROMO", "PA"), ("SMALL|MEDIUM", "AP"), ("ECONOMY", "LATERAL"), ("O", "OBLIQUE")))
SEX_SQL = "CASE WHEN upper(trim(c_mktsegment)) = 'BUILDING' THEN 'M' WHEN upper(trim(c_mktsegment)) = 'MACHINERY' THEN 'F' WHEN upper(trim(c_mktsegment)) = 'AUTOMOBILE' THEN 'O' ELSE 'U' END"
AGE_SQL = "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey % 95 AS INTEGER) END"
NAT_SQL = "CASE WHEN c_custkey % 3 = 0 THEN 'ab-' || CAST(c_custkey AS VARCHAR) ELSE '' END"


def national():
    return F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("ab-"), F.col("c_custkey").cast("string"))).otherwise("")


def age():
    return F.when(F.col("c_custkey") % 11 == 0, F.lit(None)).otherwise(F.col("c_custkey") % 95).cast("int")


PSEUDO_SQL = f"substr(CASE WHEN {NAT_SQL} <> '' THEN {sql_mac('patient-national', f'upper(regexp_replace({NAT_SQL}, ' + chr(39) + '[^A-Za-z0-9]' + chr(39) + ', ' + chr(39) * 2 + ', ' + chr(39) + 'g' + chr(39) + '))')} ELSE {sql_mac('patient-local', chr(39) + 'SITE_A|' + chr(39) + ' || CAST(c_custkey AS VARCHAR)')} END, 1, 16)"


def pseudonym():
    return identity.patient_pseudonym(KEY, national(), F.col("c_custkey").cast("string"), F.lit("SITE_A"))


@query(f"SELECT c_custkey, {PSEUDO_SQL} AS pseudo_id, {NAT_SQL} <> '' AS linked FROM customer")
def pseudonym_patients(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", pseudonym().alias("x")).select("c_custkey", "x.pseudo_id", "x.linked")


def _studies(t: Tables) -> DataFrame:
    """study, patient, site, sex, age, stratum."""
    c = t.customer.select("c_custkey", SEX.resolve(F.col("c_mktsegment"))["value"].alias("sex"), age().alias("age"))
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    return j.select(F.col("o_orderkey").alias("study"), F.col("o_custkey").alias("patient"), F.col("o_orderpriority").alias("site"), "sex", "age", equity.stratum_key(F.col("o_orderpriority"), F.col("sex"), F.col("age")).alias("stratum"), F.to_date("o_orderdate").alias("study_date"))


STUDIES = f"studies AS (SELECT o_orderkey AS study, o_custkey AS patient, o_orderpriority AS site, {SEX_SQL} AS sex, {AGE_SQL} AS age, o_orderpriority || ' | ' || ({SEX_SQL}) || ' | ' || ({sql_band(AGE_SQL)}) AS stratum, CAST(o_orderdate AS DATE) AS study_date FROM orders JOIN customer ON o_custkey = c_custkey)"


@query(f"WITH {STUDIES}, p AS (SELECT c_custkey, {PSEUDO_SQL} AS pid FROM customer) SELECT {sql_split(sql_bucket(chr(39) + 'v1' + chr(39), 'pid'))} AS split, stratum, count(DISTINCT patient) AS n_patients, count(*) AS n_studies FROM studies JOIN p ON patient = c_custkey GROUP BY 1, 2")
def flagship_split_strata(t: Tables) -> DataFrame:
    p = t.customer.select(F.col("c_custkey").alias("patient"), pseudonym()["pseudo_id"].alias("pid"))
    j = _studies(t).join(p, "patient")
    return j.groupBy(splits.assign(F.col("pid"), "v1").alias("split"), "stratum").agg(F.count_distinct("patient").alias("n_patients"), F.count("*").alias("n_studies"))


@query(f"SELECT c_custkey, -CAST(CAST(('0x' || substr({sql_mac('date-offset', 'CAST(c_custkey AS VARCHAR)')}, 1, 8)) AS BIGINT) % 1095 AS INTEGER) - 1 AS days FROM customer")
def date_offset(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", identity.date_offset_days(KEY, F.col("c_custkey").cast("string")).alias("days"))


OFFSET_SQL = f"(-CAST(CAST(('0x' || substr({sql_mac('date-offset', 'CAST(o_custkey AS VARCHAR)')}, 1, 8)) AS BIGINT) % 1095 AS INTEGER) - 1)"


@query(f"SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + {OFFSET_SQL} AS DATE) AS shifted, strftime(CAST(o_orderdate AS DATE) + {OFFSET_SQL}, '%Y%m%d') AS da FROM orders")
def shift_study_dates(t: Tables) -> DataFrame:
    off = identity.date_offset_days(KEY, F.col("o_custkey").cast("string"))
    return t.orders.select("o_orderkey", identity.shift_date(F.to_date("o_orderdate"), off).alias("shifted"), identity.shift_da(F.date_format("o_orderdate", "yyyyMMdd"), off).alias("da"))


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS changed FROM (SELECT lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p FROM orders) WHERE p IS NOT NULL")
def interval_preservation(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    d = F.to_date("o_orderdate")
    rows = t.orders.withColumn("s", identity.shift_date(d, identity.date_offset_days(KEY, F.col("o_custkey").cast("string"))))
    gaps = rows.select(F.datediff(d, F.lag(d).over(w)).alias("a"), F.datediff("s", F.lag("s").over(w)).alias("b")).where("a IS NOT NULL")
    return gaps.agg(F.count("*").alias("n"), F.count_if(F.col("a") != F.col("b")).alias("changed"))


UID_SQL = lambda v: f"'2.25.' || CAST(CAST(('0x' || substr({sql_mac('uid', v)}, 1, 28)) AS HUGEINT) AS VARCHAR)"


@query(f"SELECT o_orderkey, {UID_SQL('CAST(o_orderkey AS VARCHAR)')} AS uid FROM orders")
def uid_remap(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", identity.remap_uid(KEY, F.col("o_orderkey").cast("string")).alias("uid"))


@query(f"WITH m AS (SELECT 'study' AS kind, CAST(l_orderkey AS VARCHAR) AS original FROM lineitem UNION SELECT 'series', CAST(l_suppkey AS VARCHAR) FROM lineitem UNION SELECT 'sop', CAST(l_partkey AS VARCHAR) FROM lineitem) SELECT kind, original, {UID_SQL('original')} AS remapped FROM m")
def uid_map_unpivot(t: Tables) -> DataFrame:
    return uid_map(t.lineitem, KEY, {"study": "l_orderkey", "series": "l_suppkey", "sop": "l_partkey"})


@query("WITH d AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, DATE '1910-01-01' + CAST(o_custkey * 37 % 36000 AS INTEGER) AS birth FROM orders), a AS (SELECT o_orderkey, CASE WHEN d - birth >= 0 THEN CAST(least((d - birth) // 365, 89) AS INTEGER) END AS age FROM d) SELECT o_orderkey, age, " + sql_band("age") + " AS band, printf('%03dY', age) AS age_text FROM a")
def age_cap_band(t: Tables) -> DataFrame:
    birth = F.date_add(F.lit("1910-01-01").cast("date"), (F.col("o_custkey") * 37 % 36000).cast("int"))
    rows = t.orders.select("o_orderkey", dates.compute_age(birth, F.to_date("o_orderdate")).alias("age"))
    return rows.select("o_orderkey", "age", dates.age_band(F.col("age")).alias("band"), dates.age_string(F.col("age")).alias("age_text"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed FROM orders")
def parse_multi_format_date(t: Tables) -> DataFrame:
    k, d = F.col("o_orderkey") % 6, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(d, "yyyyMMdd")).when(k == 1, F.date_format(d, "d-M-yyyy")).when(k == 2, F.date_format(d, "dd/MM/yyyy")).when(k == 3, F.date_format(d, "yyyy-MM-dd")).when(k == 4, F.date_format(d, "d MMM yyyy")).otherwise("31-02-2001")
    return t.orders.select("o_orderkey", dates.parse_native_date(text).alias("parsed"))


@query(f"SELECT c_custkey, {SEX_SQL} AS value, upper(trim(c_mktsegment)) IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') AS matched FROM customer")
def map_value_sex(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", SEX.resolve(F.col("c_mktsegment")).alias("x")).select("c_custkey", "x.*")


@query("SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'AP' WHEN 'R' THEN 'PA' ELSE 'UNKNOWN' END AS view_position, CASE l_linestatus WHEN 'O' THEN 'L' WHEN 'F' THEN 'R' ELSE 'NA' END AS laterality FROM lineitem")
def map_value_view_laterality(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", VIEW.resolve(F.col("l_returnflag"))["value"].alias("view_position"), SIDE.resolve(F.col("l_linestatus"))["value"].alias("laterality"))


TYPE_SQL = "CASE WHEN regexp_matches(p_type, '(?i)\\bPROMO') THEN 'PA' WHEN regexp_matches(p_type, '(?i)SMALL|MEDIUM') THEN 'AP' WHEN regexp_matches(p_type, '(?i)ECONOMY') THEN 'LATERAL' WHEN regexp_matches(p_type, '(?i)O') THEN 'OBLIQUE' END"


@query(f"SELECT p_partkey, coalesce({TYPE_SQL}, 'UNKNOWN') AS value, ({TYPE_SQL}) IS NOT NULL AS matched FROM part")
def map_pattern_ordered(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", TYPE.resolve(F.col("p_type")).alias("x")).select("p_partkey", "x.*")


@query("SELECT 'SITE_A' AS site_id, field, value, count(*) AS n FROM (SELECT 'sex' AS field, c_mktsegment AS value FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')) GROUP BY ALL UNION ALL SELECT 'SITE_A', 'view', l_returnflag, count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'R') GROUP BY ALL")
def unmapped_counts(t: Tables) -> DataFrame:
    sites = {"SITE_A": {"sex": SEX, "view": VIEW}}
    a = harmonize.resolve_column(t.customer.withColumn("site_id", F.lit("SITE_A")), "c_mktsegment", {s: r["sex"] for s, r in sites.items()}, "sex")
    b = harmonize.resolve_column(t.lineitem.withColumn("site_id", F.lit("SITE_A")), "l_returnflag", {s: r["view"] for s, r in sites.items()}, "view")
    return harmonize.unmapped(a, {"sex": "c_mktsegment"}).unionByName(harmonize.unmapped(b, {"view": "l_returnflag"}))


WORDS = {"red": "NODULE", "blue": "FRACTURE", "Green ": "ATELECTASIS", "part": "NO_FINDING"}


@query("WITH k AS (SELECT p_partkey, trim(unnest(string_split(p_name, ' '))) AS native FROM part) SELECT p_partkey, native, CASE upper(native) WHEN 'RED' THEN 'NODULE' WHEN 'BLUE' THEN 'FRACTURE' WHEN 'GREEN' THEN 'ATELECTASIS' WHEN 'PART' THEN 'NO_FINDING' ELSE 'OTHER' END AS finding, upper(native) IN ('RED', 'BLUE', 'GREEN', 'PART') AS matched FROM k WHERE native <> ''")
def label_tokens_to_findings(t: Tables) -> DataFrame:
    return harmonize.label_tokens(t.part, "p_name", " ", WORDS, ["p_partkey"])


@query("WITH u AS (SELECT doc_id AS study_uid, 'OTHER' AS finding, 'RADIOLOGIST' AS source, 'toxic' AS native, toxic = 1 AS present FROM labels UNION ALL SELECT doc_id, 'NODULE', 'SITE_STRUCTURED', lang, lang = 'en' FROM documents UNION ALL SELECT doc_id, 'NODULE', 'REPORT_RULE', NULL, contains(text, 'no') FROM documents) SELECT study_uid, finding, source, min(native) AS native, bool_or(present) AS present FROM u GROUP BY 1, 2, 3")
def label_union_channels(t: Tables) -> DataFrame:
    a = t.labels.select(F.col("doc_id").alias("study_uid"), F.lit("OTHER").alias("finding"), F.lit("RADIOLOGIST").alias("source"), F.lit("toxic").alias("native"), (F.col("toxic") == 1).alias("present"))
    b = t.documents.select(F.col("doc_id").alias("study_uid"), F.lit("NODULE").alias("finding"), F.lit("SITE_STRUCTURED").alias("source"), F.col("lang").alias("native"), (F.col("lang") == "en").alias("present"))
    c = t.documents.select(F.col("doc_id").alias("study_uid"), F.lit("NODULE").alias("finding"), F.lit("REPORT_RULE").alias("source"), F.contains("text", F.lit("no")).alias("present"))
    return harmonize.label_union(a, b, c)


@query("SELECT l_orderkey, l_linenumber, s.v AS value FROM lineitem LEFT JOIN (SELECT p_brand AS k, arg_max(p_type, p_partkey) AS v FROM part WHERE trim(p_brand) <> '' GROUP BY 1) s ON s.k = 'Brand#' || CAST(l_suppkey % 30 AS VARCHAR)")
def sidecar_join_last_wins(t: Tables) -> DataFrame:
    sidecar = ingest.last_wins(t.part, "p_brand", "p_type", "p_partkey").select(F.col("p_brand").alias("k"), F.col("p_type").alias("value"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.concat(F.lit("Brand#"), (F.col("l_suppkey") % 30).cast("string")).alias("k"))
    return rows.join(sidecar, "k", "left").select("l_orderkey", "l_linenumber", "value")


@query("SELECT o_orderkey, coalesce(nullif(trim(CASE WHEN o_orderkey % 2 = 0 THEN '  ' ELSE o_orderstatus END), ''), nullif(trim(o_orderpriority), ''), '') AS first FROM orders")
def facts_first_nonempty(t: Tables) -> DataFrame:
    from tessera.functions.text import first_nonempty

    return t.orders.select("o_orderkey", first_nonempty(F.when(F.col("o_orderkey") % 2 == 0, "  ").otherwise(F.col("o_orderstatus")), F.col("o_orderpriority")).alias("first"))


REJECT_SQL = "CASE WHEN l_orderkey % 17 = 0 THEN 'MISSING_REQUIRED_TAG' WHEN l_linenumber % 5 = 0 THEN 'MISSING_REQUIRED_TAG' WHEN l_returnflag <> 'A' AND l_returnflag <> 'R' THEN 'WRONG_MODALITY' WHEN l_suppkey % 7 = 0 THEN 'WRONG_BODY_PART' WHEN l_quantity < 3 THEN 'NO_PIXEL_DATA' END"
DETAIL_SQL = "CASE WHEN l_orderkey % 17 = 0 THEN 'SOPInstanceUID' WHEN l_linenumber % 5 = 0 THEN 'PatientID' WHEN l_returnflag <> 'A' AND l_returnflag <> 'R' THEN l_returnflag WHEN l_suppkey % 7 = 0 THEN 'HEAD' WHEN l_quantity < 3 THEN '' END"


def _rejection():
    tags = {"SOPInstanceUID": F.when(F.col("l_orderkey") % 17 != 0, "x"), "PatientID": F.when(F.col("l_linenumber") % 5 == 0, "").otherwise("y")}
    part = F.when(F.col("l_suppkey") % 7 == 0, "head").otherwise("")
    return ingest.reject(tags, F.col("l_returnflag"), part, F.col("l_quantity") >= 3, modalities=("A", "R"))


@query(f"SELECT l_orderkey, l_linenumber, {REJECT_SQL} AS reason, {DETAIL_SQL} AS detail FROM lineitem")
def ingest_reject_cascade(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", _rejection().alias("r")).select("l_orderkey", "l_linenumber", "r.*")


@query(f"SELECT {REJECT_SQL} AS reason, count(*) AS n FROM lineitem WHERE ({REJECT_SQL}) IS NOT NULL GROUP BY 1")
def quarantine_reasons(t: Tables) -> DataFrame:
    return ingest.counts_by(t.lineitem.select(_rejection()["reason"].alias("reason")).where("reason IS NOT NULL"), "reason")


@query("SELECT doc_id, CASE WHEN row_number() OVER w > 1 THEN first_value(doc_id) OVER w END AS first_path FROM documents WINDOW w AS (PARTITION BY sha256(text) ORDER BY source, doc_id)")
def ingest_first_wins_dedup(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "source", F.sha2("text", 256).alias("sha256"))
    return ingest.first_wins(rows, "sha256", ["source", "doc_id"], "doc_id").select("doc_id", "first_path")


@query("WITH d AS (SELECT doc_id, source, sha256(text) AS h, CASE WHEN n_chars < 30 THEN 'NO_PIXEL_DATA' END AS r FROM documents), f AS (SELECT doc_id, source, r, CASE WHEN r IS NULL THEN row_number() OVER (PARTITION BY h, r IS NULL ORDER BY source, doc_id) END AS k, first_value(doc_id) OVER (PARTITION BY h, r IS NULL ORDER BY source, doc_id) AS first FROM d) SELECT doc_id, source, coalesce(r, 'DUPLICATE_CONTENT') AS reason, CASE WHEN r IS NULL THEN 'identical to ' || CAST(first AS VARCHAR) ELSE '' END AS detail FROM f WHERE r IS NOT NULL OR k > 1")
def ingest_quarantine(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "source", "n_chars", F.sha2("text", 256).alias("sha256"))
    rule = ingest.reject({}, F.lit("DX"), F.lit(""), F.col("n_chars") >= 30)
    return ingest.ingest(rows, rule, order=("source", "doc_id"))[1]


@query("SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def pair_report_left(t: Tables) -> DataFrame:
    return ingest.pair_by_stem(t.documents.select("doc_id"), t.labels, ("doc_id",))


@query("SELECT o_custkey, arg_min(o_orderstatus, struct_pack(a := o_orderpriority, b := o_orderkey)) AS status, arg_min(o_totalprice, struct_pack(a := o_orderpriority, b := o_orderkey)) AS price FROM orders GROUP BY 1")
def entities_first_wins(t: Tables) -> DataFrame:
    return ingest.first_of(t.orders, ["o_custkey"], ["o_orderpriority", "o_orderkey"], ["o_orderstatus", "o_totalprice"]).select("o_custkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))


@query(f"SELECT c_custkey, {sql_bucket(chr(39) + 'v1' + chr(39), 'CAST(c_custkey AS VARCHAR)')} AS bucket FROM customer")
def split_bucket(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", identity.split_bucket("v1", F.col("c_custkey").cast("string")).alias("bucket"))


B_SQL = sql_bucket("'v1'", "CAST(c_custkey AS VARCHAR)")


@query(f"SELECT c_custkey, {sql_split(B_SQL)} AS split FROM customer")
def split_assign(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", splits.assign(F.col("c_custkey").cast("string"), "v1").alias("split"))


FIRST_SITE = f"fs AS (SELECT c_custkey, coalesce(min(o_orderpriority), 'UNKNOWN') || ' | ' || ({SEX_SQL.replace('c_mktsegment', 'any_value(c_mktsegment)')}) || ' | ' || ({sql_band(AGE_SQL.replace('c_custkey', 'customer.c_custkey'))}) AS stratum FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)"


def _patient_strata(t: Tables) -> DataFrame:
    site = t.orders.groupBy("o_custkey").agg(F.min("o_orderpriority").alias("site"))
    j = t.customer.join(site, F.col("c_custkey") == F.col("o_custkey"), "left")
    return j.select("c_custkey", equity.stratum_key(F.coalesce("site", F.lit("UNKNOWN")), SEX.resolve(F.col("c_mktsegment"))["value"], age()).alias("stratum"))


@query(f"WITH {FIRST_SITE} SELECT c_custkey, stratum FROM fs")
def strata_key(t: Tables) -> DataFrame:
    return _patient_strata(t)


@query(f"WITH {FIRST_SITE} SELECT c_custkey, stratum, {sql_split(sql_bucket(chr(39) + 'v1' + chr(39) + ' || chr(31) || stratum', 'CAST(c_custkey AS VARCHAR)'))} AS split FROM fs")
def split_stratified(t: Tables) -> DataFrame:
    return _patient_strata(t).withColumn("split", splits.assign_stratified(F.col("c_custkey").cast("string"), F.col("stratum"), "v1"))


@query(f"WITH a AS (SELECT {sql_split(B_SQL)} AS split FROM customer), s AS (SELECT unnest(['train', 'val', 'test']) AS split) SELECT s.split, count(a.split) AS n, count(a.split) / (SELECT count(*) FROM a) AS share FROM s LEFT JOIN a ON s.split = a.split GROUP BY 1")
def split_proportions(t: Tables) -> DataFrame:
    return splits.proportions(t.customer.select(splits.assign(F.col("c_custkey").cast("string"), "v1").alias("split")))


@query(f"SELECT {sql_split(B_SQL.replace('c_custkey', 'o_custkey'))} AS split, count(*) AS n FROM orders GROUP BY 1")
def studies_per_split(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_custkey").alias("o_custkey"), splits.assign(F.col("c_custkey").cast("string"), "v1").alias("split"))
    return t.orders.join(a, "o_custkey").groupBy("split").agg(F.count("*").alias("n"))


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS moved FROM customer WHERE c_custkey % 2 = 0")
def split_growth_stability(t: Tables) -> DataFrame:
    of = lambda df: df.select("c_custkey", splits.assign(F.col("c_custkey").cast("string"), "v1").alias("split"))
    return splits.churn(of(t.customer.where("c_custkey % 2 = 0")), of(t.customer), "c_custkey")


@query("SELECT 'patients' AS name, count(*) AS n FROM customer UNION ALL SELECT 'studies', count(*) FROM orders UNION ALL SELECT 'series', count(*) FROM lineitem UNION ALL SELECT 'reports', count(*) FROM documents UNION ALL SELECT 'labels', count(*) FROM labels")
def catalog_stats(t: Tables) -> DataFrame:
    return access.table_counts({"patients": t.customer, "studies": t.orders, "series": t.lineitem, "reports": t.documents, "labels": t.labels})


@query("SELECT o_orderpriority AS site, count(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1")
def studies_per_site(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderpriority").alias("site")).agg(F.count_distinct("o_orderkey").alias("n"))


@query(f"WITH {STUDIES} SELECT site, sex, count(DISTINCT study) AS n_studies, count(DISTINCT patient) AS n_patients FROM studies GROUP BY 1, 2")
def cohort_summary_view(t: Tables) -> DataFrame:
    s = _studies(t)
    return access.cohort_summary(s.select("study", "patient", "site"), t.customer.select(F.col("c_custkey").alias("patient"), SEX.resolve(F.col("c_mktsegment"))["value"].alias("sex")), "patient", "study", "site", "sex")


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def role_modeller_view(t: Tables) -> DataFrame:
    return access.view(t.documents, "modeller", "studies", hidden=("text",))


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1")
def role_auditor_view(t: Tables) -> DataFrame:
    return ingest.counts_by(t.documents, "source")


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'")
def site_filter_listing(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("SELECT CASE WHEN CAST(coalesce(nullif(regexp_replace(source, '[^0-9]', '', 'g'), ''), '0') AS BIGINT) % 2 = 0 THEN 'dev' ELSE 'heldout' END AS fold, count(*) AS n FROM documents GROUP BY 1")
def fold_filter(t: Tables) -> DataFrame:
    number = F.coalesce(F.nullif(F.regexp_replace("source", "[^0-9]", ""), F.lit("")), F.lit("0")).cast("long")
    return t.documents.groupBy(F.when(number % 2 == 0, "dev").otherwise("heldout").alias("fold")).agg(F.count("*").alias("n"))


@query("SELECT CAST(count(*) AS BIGINT) AS n_bad FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') AND trim(c_mktsegment) <> ''")
def unmapped_predicate(t: Tables) -> DataFrame:
    return t.customer.where(is_unmapped(SEX.resolve(F.col("c_mktsegment")), F.col("c_mktsegment"))).agg(F.count("*").alias("n_bad"))
