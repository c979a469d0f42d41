"""Quality control, equity, agreement, release, audit, interchange and pixel queries over the fixture tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera import vocab
from tessera.functions import text as tx
from tessera.operators import agreement, audit, equity, ingest, interop, pixels, qc, release
from tessera.plans.cohort_queries import STUDIES, _studies
from tessera.plans.registry import Tables, query


@query("SELECT 'study_patient' AS kind, count(*) AS n FROM orders WHERE o_custkey % 7 = 0 UNION ALL SELECT 'series_study', count(*) FROM lineitem WHERE l_orderkey % 5 = 0 UNION ALL SELECT 'study_series', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber > 2)")
def qc_orphans(t: Tables) -> DataFrame:
    n = lambda kind, df: df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
    a = qc.orphans(t.orders, "o_custkey", t.customer.where("c_custkey % 7 != 0"), "c_custkey")
    b = qc.orphans(t.lineitem, "l_orderkey", t.orders.where("o_orderkey % 5 != 0"), "o_orderkey")
    c = qc.orphans(t.orders, "o_orderkey", t.lineitem.where("l_linenumber > 2"), "l_orderkey")
    return n("study_patient", a).unionByName(n("series_study", b)).unionByName(n("study_series", c))


@query("WITH d AS (SELECT d.doc_id, quality, toxic, lang, text FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id), c AS (SELECT count(*) AS n, count_if(quality IS NULL) AS q, count_if(lang <> 'en') AS l, count_if(length(text) < 100) AS s FROM d) SELECT unnest(['quality', 'not_english', 'short']) AS field, unnest([q, l, s]) AS n_bad, n AS n_total, unnest([q, l, s]) / n AS fraction FROM c")
def qc_missing_fields(t: Tables) -> DataFrame:
    rows = ingest.pair_by_stem(t.documents, t.labels, ("doc_id",))
    return qc.missing(rows, {"quality": F.col("quality").isNull(), "not_english": F.col("lang") != "en", "short": F.length("text") < 100})


@query("SELECT sha256(text) AS digest, count(*) AS n, list_slice(list_sort(list(doc_id)), 1, 5) AS examples FROM documents GROUP BY text HAVING count(*) > 1")
def qc_duplicate_digest(t: Tables) -> DataFrame:
    return qc.duplicate_digests(t.documents.select("doc_id", F.sha2("text", 256).alias("h")), "h", "doc_id")


@query("SELECT l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY 1")
def qc_uniform_value(t: Tables) -> DataFrame:
    return ingest.counts_by(t.lineitem.select(F.col("l_returnflag").alias("value")), "value")


@query("SELECT o_orderpriority AS site, count_if(l_returnflag = 'A') AS n_ap, count(*) AS n, count_if(l_returnflag = 'A') / count(*) AS fraction FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def qc_view_balance(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_returnflag").join(t.orders.select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
    return qc.view_balance(rows, "o_orderpriority", F.col("l_returnflag") == "A")


def _labels(t: Tables) -> DataFrame:
    """study, finding: a part's type labels the study that holds it."""
    return t.lineitem.select(F.col("l_orderkey").alias("study"), "l_partkey").join(t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("finding")), "l_partkey").select("study", "finding")


@query("WITH s AS (SELECT o_orderpriority AS site, count(*) AS n_studies FROM orders GROUP BY 1) SELECT o_orderpriority AS site, p_type AS finding, count(*) AS n_labels, any_value(n_studies) AS n_studies, 100 * count(*) / any_value(n_studies) AS percent FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN s ON s.site = o_orderpriority GROUP BY 1, 2")
def qc_label_prevalence(t: Tables) -> DataFrame:
    studies = t.orders.select(F.col("o_orderkey").alias("study"), "o_orderpriority")
    return qc.label_prevalence(_labels(t), studies, "study", "o_orderpriority", "finding")


@query("SELECT o_custkey AS patient, count(DISTINCT o_orderpriority) AS n_sites FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1")
def qc_cross_site(t: Tables) -> DataFrame:
    return qc.cross_site(t.orders, "o_custkey", "o_orderpriority")


@query("SELECT unnest(['study_patient_integrity', 'study_date_present', 'sex_resolved', 'no_duplicate_text', 'label_prevalence_recorded']) AS \"check\", unnest(['fail', 'warn', 'warn', 'warn', 'info']) AS severity, unnest([a, b, c, d, e]) AS n_bad, unnest([o, o, u, k, e2]) AS n_total, unnest([a = 0, b = 0, c = 0, d = 0, true]) AS passed FROM (SELECT (SELECT count(*) FROM orders WHERE o_custkey % 7 = 0) AS a, (SELECT count(*) FROM orders WHERE o_orderdate IS NULL) AS b, (SELECT count(*) FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')) AS c, (SELECT count(*) - count(DISTINCT text) FROM documents) AS d, CAST(0 AS BIGINT) AS e, (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM customer) AS u, (SELECT count(*) FROM documents) AS k, (SELECT count(*) FROM labels) AS e2)")
def qc_report_all_checks(t: Tables) -> DataFrame:
    from tessera.plans.cohort_queries import SEX

    bad = qc.orphans(t.orders, "o_custkey", t.customer.where("c_custkey % 7 != 0"), "c_custkey")
    docs = t.documents.select(F.sha2("text", 256).alias("h")).agg((F.count("h") - F.count_distinct("h")).alias("n_bad"), F.count("*").alias("n_total"))
    return qc.report([
        qc.count_check("study_patient_integrity", "fail", bad, t.orders),
        qc.count_check("study_date_present", "warn", t.orders.where("o_orderdate IS NULL"), t.orders),
        qc.count_check("sex_resolved", "warn", t.customer.where(SEX.resolve(F.col("c_mktsegment"))["value"] == "U"), t.customer),
        qc.Check("no_duplicate_text", "warn", docs),
        qc.count_check("label_prevalence_recorded", "info", t.labels.limit(0), t.labels),
    ])


@query(f"WITH {STUDIES} SELECT stratum, count(DISTINCT patient) AS n_patients, count(DISTINCT study) AS n_studies FROM studies GROUP BY 1")
def equity_strata(t: Tables) -> DataFrame:
    return equity.strata(_studies(t))


@query(f"WITH {STUDIES}, s AS (SELECT stratum, count(DISTINCT study) AS n_studies FROM studies GROUP BY 1) SELECT stratum, n_studies FROM s WHERE n_studies < 30")
def equity_underrepresented(t: Tables) -> DataFrame:
    return equity.strata(_studies(t)).where(F.col("n_studies") < equity.FEWEST).select("stratum", "n_studies")


@query(f"WITH {STUDIES} SELECT count_if(sex = 'U') AS missing_sex, count_if(age IS NULL) AS missing_age FROM studies")
def equity_missing_demographics(t: Tables) -> DataFrame:
    return _studies(t).agg(F.count_if(F.col("sex") == "U").alias("missing_sex"), F.count_if(F.col("age").isNull()).alias("missing_age"))


TYPES = ["STANDARD", "SMALL", "MEDIUM", "LARGE", "ECONOMY", "PROMO", "NEVER"]
RATES = f"""{STUDIES}, lab AS (SELECT DISTINCT l_orderkey AS study, p_type AS finding FROM lineitem JOIN part ON l_partkey = p_partkey),
size AS (SELECT stratum, count(DISTINCT study) AS n_studies FROM studies GROUP BY 1),
has AS (SELECT stratum, finding, count(*) AS n FROM studies JOIN lab ON studies.study = lab.study GROUP BY 1, 2),
grid AS (SELECT stratum, n_studies, f.finding FROM size, (SELECT unnest([{', '.join(repr(x) for x in TYPES)}]) AS finding) f),
rates AS (SELECT g.stratum, g.n_studies, g.finding, coalesce(h.n, 0) AS n, coalesce(h.n, 0) / g.n_studies AS rate FROM grid g LEFT JOIN has h ON h.stratum = g.stratum AND h.finding = g.finding)"""


@query(f"WITH {RATES} SELECT stratum, n_studies, finding, n, rate FROM rates")
def equity_prevalence(t: Tables) -> DataFrame:
    return equity.prevalence(_studies(t), _labels(t), TYPES)


@query(f"WITH {RATES} SELECT finding, max(rate) - min(rate) AS gap, arg_min(stratum, struct_pack(r := -rate, o := -n_studies, s := stratum)) AS high, arg_min(stratum, struct_pack(r := rate, o := -n_studies, s := stratum)) AS low FROM rates WHERE n_studies >= 30 GROUP BY 1 HAVING count(*) >= 2")
def equity_parity_gap(t: Tables) -> DataFrame:
    return equity.parity_gaps(equity.prevalence(_studies(t), _labels(t), TYPES))


@query(f"WITH {STUDIES}, c AS (SELECT stratum, count(*) AS n FROM studies GROUP BY 1), j AS (SELECT stratum, n, CASE WHEN n % 3 = 0 THEN 0.0::DOUBLE ELSE CAST(length(stratum) AS DOUBLE) END AS target FROM c), w AS (SELECT stratum, (target / sum(target) OVER ()) / (n / sum(n) OVER ()) AS weight FROM j) SELECT stratum, weight, least(weight, 10.0::DOUBLE) AS capped, weight > 10.0 AS was_capped FROM w")
def equity_weights(t: Tables) -> DataFrame:
    counts = _studies(t).groupBy("stratum").agg(F.count("*").alias("n"))
    targets = counts.where("n % 3 != 0").select("stratum", F.length("stratum").cast("double").alias("target"))
    return equity.weights(counts, targets)


def _pairs(t: Tables) -> DataFrame:
    """doc_id, label, p, t: a rule over text against two annotated labels."""
    d = t.documents.select("doc_id", "lang", F.contains("text", F.lit("idiot")).alias("a"), (F.col("n_chars") > 600).alias("b")).join(t.labels, "doc_id")
    each = F.array(F.struct(F.lit("toxic").alias("label"), F.col("a").alias("p"), (F.col("toxic") == 1).alias("t")), F.struct(F.lit("quality").alias("label"), F.col("b").alias("p"), (F.col("quality") == 1).alias("t")))
    return d.select("doc_id", "lang", F.explode(each).alias("x")).select("doc_id", "lang", "x.*")


PAIRS = "pairs AS (SELECT d.doc_id, lang, 'toxic' AS label, contains(text, 'idiot') AS p, toxic = 1 AS t FROM documents d JOIN labels l ON d.doc_id = l.doc_id UNION ALL SELECT d.doc_id, lang, 'quality', n_chars > 600, quality = 1 FROM documents d JOIN labels l ON d.doc_id = l.doc_id), cells AS (SELECT label, count_if(p AND t) AS tp, count_if(p AND NOT t) AS fp, count_if(NOT p AND t) AS fn, count_if(NOT p AND NOT t) AS tn FROM pairs GROUP BY 1), every AS (SELECT * FROM cells UNION ALL SELECT 'pooled', sum(tp), sum(fp), sum(fn), sum(tn) FROM cells)"


@query(f"WITH {PAIRS} SELECT label, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn FROM every")
def contingency_tables(t: Tables) -> DataFrame:
    return agreement.with_total(agreement.contingency(_pairs(t), ["label"], F.col("p"), F.col("t")), "label")


KAPPA = "k AS (SELECT label, CAST(tp + fn AS BIGINT) AS support, (tp + tn) / (tp + fp + fn + tn) AS observed, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / ((tp + fp + fn + tn) * (tp + fp + fn + tn)) AS expected, (tp + fn) / (tp + fp + fn + tn) AS prevalence FROM every)"


@query(f"WITH {PAIRS}, {KAPPA}, v AS (SELECT *, CASE WHEN expected < 1 THEN (observed - expected) / (1 - expected) ELSE 0.0 END AS kappa FROM k) SELECT label, kappa, observed, expected, support, prevalence, CASE WHEN support < 30 THEN 'insufficient support' WHEN kappa >= 0.81 THEN 'almost perfect' WHEN kappa >= 0.61 THEN 'substantial' WHEN kappa >= 0.41 THEN 'moderate' WHEN kappa >= 0.21 THEN 'fair' WHEN kappa >= 0.01 THEN 'slight' ELSE 'poor' END AS band FROM v")
def kappa_by_label_and_pooled(t: Tables) -> DataFrame:
    table = agreement.with_total(agreement.contingency(_pairs(t), ["label"], F.col("p"), F.col("t")), "label")
    return agreement.kappa(table).select("label", "kappa", "observed", "expected", "support", "prevalence", "band")


@query(f"WITH {PAIRS} SELECT label, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM every")
def prf_micro(t: Tables) -> DataFrame:
    table = agreement.with_total(agreement.contingency(_pairs(t), ["label"], F.col("p"), F.col("t")), "label")
    return agreement.scores(table).select("label", "precision", "recall", "f1")


@query(f"WITH {PAIRS} SELECT avg(CASE WHEN tp + fn > 0 THEN CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END END) AS macro_f1 FROM cells")
def prf_macro(t: Tables) -> DataFrame:
    s = agreement.scores(agreement.contingency(_pairs(t), ["label"], F.col("p"), F.col("t")))
    return s.agg(F.avg(F.when(F.col("tp") + F.col("fn") > 0, F.col("f1"))).alias("macro_f1"))


@query("WITH d AS (SELECT d.doc_id, contains(text, 'idiot') = (toxic = 1) AND (n_chars > 600) = (quality = 1) AS same FROM documents d JOIN labels l ON d.doc_id = l.doc_id) SELECT count_if(same) AS n_exact, count(*) AS n FROM d")
def exact_match(t: Tables) -> DataFrame:
    per = _pairs(t).groupBy("doc_id").agg(F.bool_and(F.col("p") == F.col("t")).alias("same"))
    return per.agg(F.count_if("same").alias("n_exact"), F.count("*").alias("n"))


@query("WITH p AS (SELECT d.doc_id, list_filter(['toxic', 'quality'], lambda x: (x = 'toxic' AND contains(text, 'idiot')) OR (x = 'quality' AND n_chars > 600)) AS pred, list_filter(['toxic', 'quality'], lambda x: (x = 'toxic' AND toxic = 1) OR (x = 'quality' AND quality = 1)) AS truth FROM documents d JOIN labels l ON d.doc_id = l.doc_id) SELECT label, count_if(list_contains(pred, label)) AS n_pred, count_if(list_contains(truth, label)) AS n_true FROM p, (SELECT unnest(['toxic', 'quality']) AS label) GROUP BY 1")
def label_sets_full_outer(t: Tables) -> DataFrame:
    d = t.documents.join(t.labels, "doc_id")
    pick = lambda a, b: F.array_compact(F.array(F.when(a, F.lit("toxic")), F.when(b, F.lit("quality"))))
    pred = d.select("doc_id", pick(F.contains("text", F.lit("idiot")), F.col("n_chars") > 600).alias("labels"))
    true = d.select("doc_id", pick(F.col("toxic") == 1, F.col("quality") == 1).alias("labels"))
    return agreement.label_pairs(pred, true, "doc_id", ["toxic", "quality"]).groupBy("label").agg(F.count_if("p").alias("n_pred"), F.count_if("t").alias("n_true"))


@query("WITH d AS (SELECT d.doc_id, contains(text, 'that') AS truth, contains(text, 'the') AS pred, lang <> 'en' AS oov FROM documents d) SELECT unnest(['strict', 'adjusted']) AS kind, unnest([count_if(truth AND pred), count_if(truth AND pred AND NOT oov)]) AS tp, unnest([count_if(pred AND NOT truth), count_if(pred AND NOT truth AND NOT oov)]) AS fp, unnest([count_if(truth AND NOT pred), count_if(truth AND NOT pred AND NOT oov)]) AS fn FROM d")
def normal_detection_strict_adjusted(t: Tables) -> DataFrame:
    d = t.documents.select(F.contains("text", F.lit("that")).alias("t"), F.contains("text", F.lit("the")).alias("p"), (F.col("lang") != "en").alias("oov"))
    both = d.select("t", "p", F.explode(F.when(F.col("oov"), F.array(F.lit("strict"))).otherwise(F.array(F.lit("strict"), F.lit("adjusted")))).alias("kind"))
    return agreement.contingency(both, ["kind"], F.col("p"), F.col("t")).select("kind", "tp", "fp", "fn")


@query("WITH w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS term FROM part) SELECT term, count(*) AS mentions, count(DISTINCT p_partkey) AS studies FROM w WHERE term NOT IN ('red', 'blue') GROUP BY 1")
def vocabulary_coverage(t: Tables) -> DataFrame:
    w = t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("term")).where(~F.col("term").isin("red", "blue"))
    return w.groupBy("term").agg(F.count("*").alias("mentions"), F.count_distinct("p_partkey").alias("studies"))


@query("WITH w AS (SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS term FROM documents WHERE lang = 'en') SELECT term, count(*) AS n FROM w WHERE term <> '' GROUP BY 1 ORDER BY n DESC, term LIMIT 20")
def topk_terms(t: Tables) -> DataFrame:
    w = t.documents.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("term")).where("term != ''")
    return w.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(20)


@query("SELECT count(*) AS n, sha256('[' || string_agg('{\"path\":\"documents/' || doc_id || '\",\"sha256\":\"' || sha256(text) || '\",\"size_bytes\":' || octet_length(encode(text)) || '}', ',' ORDER BY 'documents/' || doc_id) || ']') AS digest FROM documents")
def manifest_digest(t: Tables) -> DataFrame:
    rows = t.documents.select(F.concat(F.lit("documents/"), F.col("doc_id").cast("string")).alias("path"), F.sha2("text", 256).alias("sha256"), F.octet_length("text").alias("size_bytes"))
    return release.digest(rows, ["path", "sha256", "size_bytes"])


@query("SELECT 'doc/' || doc_id AS path, sha256(text) AS sha256, octet_length(encode(text)) AS size_bytes, CAST(doc_id AS VARCHAR) AS sop_uid, NULL::VARCHAR AS study_uid FROM documents UNION ALL SELECT 'item/' || item_id, sha256(text), octet_length(encode(text)), NULL, CAST(item_id AS VARCHAR) FROM benchmark")
def release_manifest(t: Tables) -> DataFrame:
    of = lambda df, key, kind, uid: df.select(F.concat(F.lit(f"{kind}/"), F.col(key).cast("string")).alias("path"), F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("size_bytes"), F.col(key).cast("string").alias(uid))
    return release.manifest(of(t.documents, "doc_id", "doc", "sop_uid"), of(t.benchmark, "item_id", "item", "study_uid")).select("path", "sha256", "size_bytes", "sop_uid", "study_uid")


@query("SELECT 'd/' || doc_id AS path, CASE WHEN doc_id % 10 = 3 THEN 'missing' WHEN doc_id % 10 = 4 THEN 'changed' END AS problem FROM documents WHERE doc_id % 10 IN (3, 4)")
def release_verify_files(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", F.concat(F.lit("d/"), F.col("doc_id").cast("string")).alias("path"), F.sha2("text", 256).alias("sha256"))
    files = rows.where("doc_id % 10 != 3").withColumn("sha256", F.when(F.col("doc_id") % 10 == 4, "0").otherwise(F.col("sha256")))
    return release.verify_files(rows.select("path", "sha256"), files.select("path", "sha256"))


AUDIT_SQL = "base AS (SELECT user_id AS log, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq, event_type || '|' || CAST(event_id AS VARCHAR) AS payload FROM events)"


@query(f"WITH RECURSIVE {AUDIT_SQL}, chain AS (SELECT log, seq, payload, repeat('0', 64) AS previous_hash, sha256(repeat('0', 64) || chr(10) || payload) AS entry_hash FROM base WHERE seq = 1 UNION ALL SELECT b.log, b.seq, b.payload, c.entry_hash, sha256(c.entry_hash || chr(10) || b.payload) FROM chain c JOIN base b ON b.log = c.log AND b.seq = c.seq + 1) SELECT log, CAST(seq AS INTEGER) AS seq, payload, previous_hash, entry_hash FROM chain")
def audit_chain_build(t: Tables) -> DataFrame:
    return audit.build(t.events, "user_id", "event_id", F.concat("event_type", F.lit("|"), F.col("event_id").cast("string")))


@query("SELECT user_id AS log, CAST(seq AS INTEGER) AS seq, 'contents' AS problem FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq FROM events) WHERE seq = 2")
def audit_chain_verify(t: Tables) -> DataFrame:
    chain = audit_chain_build(t).withColumn("line", F.col("seq")).withColumn("payload", F.when(F.col("seq") == 2, "edited").otherwise(F.col("payload")))
    return audit.verify(chain)


@query("SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber) - 1 AS idx FROM lineitem")
def observation_index(t: Tables) -> DataFrame:
    return ingest.numbered(t.lineitem, ["l_orderkey"], ["l_partkey", "l_linenumber"]).select("l_orderkey", "l_partkey", F.col("idx").cast("long").alias("idx"))


def _fhir(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    s = t.orders.select(F.concat(F.lit("1.2."), F.col("o_orderkey").cast("string")).alias("study_uid"), F.col("o_custkey").cast("string").alias("pseudo_patient_id"), F.lit("DX").alias("modality"), F.to_date("o_orderdate").alias("study_date"))
    li = t.lineitem.withColumn("study_uid", F.concat(F.lit("1.2."), F.col("l_orderkey").cast("string")))
    uid = F.concat("study_uid", F.lit("."), F.col("l_returnflag"))
    ser = li.select(uid.alias("series_uid"), "study_uid", F.when(F.col("l_returnflag") == "A", "AP").otherwise("UNKNOWN").alias("view_position")).distinct()
    ins = li.select(uid.alias("series_uid"), F.concat(uid, F.lit("."), F.col("l_linenumber").cast("string"), F.lit("."), F.col("l_partkey").cast("string"), F.lit("."), F.col("l_suppkey").cast("string")).alias("sop_uid"))
    names = F.create_map(*[F.lit(x) for kv in zip(TYPES, vocab.FINDINGS) for x in kv])
    lab = _labels(t).select(F.concat(F.lit("1.2."), F.col("study").cast("string")).alias("study_uid"), names[F.col("finding")].alias("finding")).distinct().withColumn("source", F.lit("REPORT_RULE")).withColumn("present", F.lit(True))
    rep = t.documents.select(F.concat(F.lit("1.2."), F.col("doc_id").cast("string")).alias("study_uid"), F.create_map(F.lit("IMPRESSION"), F.col("lang")).alias("sections"))
    return s, ser, ins, lab, rep


@query("SELECT '1.2.' || o_orderkey AS study_uid, count(DISTINCT l_returnflag) AS n_series, count(l_orderkey) AS n_instances, 's1-2-' || o_orderkey AS id FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def fhir_imaging_study(t: Tables) -> DataFrame:
    s, ser, ins, _, _ = _fhir(t)
    out = interop.imaging_studies(s, ser, ins)
    return out.select("study_uid", "n_series", "n_instances", F.get_json_object("resource", "$.id").alias("id"))


CODE_SQL = "CASE p_type " + " ".join(f"WHEN '{a}' THEN '{vocab.FINDING_CODES[b][1]}'" for a, b in zip(TYPES, vocab.FINDINGS)) + " END"
NAME_SQL = "CASE p_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in zip(TYPES, vocab.FINDINGS)) + " END"


@query(f"WITH l AS (SELECT DISTINCT l_orderkey, {NAME_SQL} AS f, {CODE_SQL} AS code FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey), n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY f) - 1 AS idx FROM l) SELECT '1.2.' || l_orderkey AS study_uid, 's1-2-' || l_orderkey || '-obs-' || idx AS id, code, true AS value FROM n")
def fhir_observation(t: Tables) -> DataFrame:
    s, _, _, lab, _ = _fhir(t)
    return interop.observations(lab, s).select("study_uid", F.get_json_object("resource", "$.id").alias("id"), "code", (F.get_json_object("resource", "$.valueBoolean") == "true").alias("value"))


@query("WITH l AS (SELECT l_orderkey, count(DISTINCT p_type) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1) SELECT '1.2.' || doc_id AS study_uid, coalesce(n, 0) AS n_results, lang AS conclusion, strftime(o_orderdate, '%Y-%m-%d') AS effective FROM documents JOIN orders ON o_orderkey = doc_id LEFT JOIN l ON l_orderkey = doc_id")
def fhir_diagnostic_report(t: Tables) -> DataFrame:
    s, _, _, lab, rep = _fhir(t)
    out = interop.diagnostic_reports(rep, s, interop.observations(lab, s))
    return out.select("study_uid", "n_results", F.get_json_object("resource", "$.conclusion").alias("conclusion"), F.get_json_object("resource", "$.effectiveDateTime").alias("effective"))


@query("SELECT count(*) AS n, count(DISTINCT full_url) AS n_urls FROM (SELECT 'i' || o_orderkey AS full_url FROM orders UNION ALL SELECT 'o' || l_orderkey || p_type FROM (SELECT DISTINCT l_orderkey, p_type FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey) UNION ALL SELECT 'r' || doc_id FROM documents JOIN orders ON o_orderkey = doc_id)")
def fhir_entries(t: Tables) -> DataFrame:
    s, ser, ins, lab, rep = _fhir(t)
    obs = interop.observations(lab, s)
    every = interop.entries(interop.imaging_studies(s, ser, ins), obs, interop.diagnostic_reports(rep, s, obs))
    return every.agg(F.count("*").alias("n"), F.count_distinct("full_url").alias("n_urls"))


Q = "list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000) AS INTEGER))"


def _px():
    return F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000).cast("int"))


@query(f"WITH p AS (SELECT vec_id, {Q} AS px FROM embeddings) SELECT vec_id, list_transform(px, lambda x: CASE WHEN list_max(px) > list_min(px) THEN CAST(floor((x - list_min(px)) / (list_max(px) - list_min(px)) * 255) AS INTEGER) ELSE 0 END) AS px FROM p")
def pixel_window_u8(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", _px().alias("px")).select("vec_id", pixels.window_u8(F.col("px")).alias("px"))


@query(f"SELECT vec_id, list_transform({Q}, lambda x: 4095 - least(greatest(x, 0), 4095)) AS px FROM embeddings")
def pixel_invert(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", pixels.invert(_px(), F.lit(12)).alias("px"))


@query("SELECT vec_id, list_transform(embedding, lambda x, i: CASE WHEN (i - 1) // 8 >= 2 AND (i - 1) // 8 < 5 AND (i - 1) % 8 >= 1 AND (i - 1) % 8 < 6 THEN 0.0::DOUBLE ELSE CAST(x AS DOUBLE) END) AS px FROM embeddings")
def pixel_redact_boxes(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", pixels.redact_box(F.col("embedding"), 8, (1, 2, 6, 5)).alias("px"))


@query("WITH a AS (SELECT vec_id, label, len(list_filter(embedding, lambda x: x > 0)) AS area FROM embeddings) SELECT label, CAST(sum(area) AS BIGINT) AS total, min(area) AS least, max(area) AS most, list_sort(list(area))[CAST(floor(count(*) / 2) AS INTEGER) + 1] AS middle FROM a GROUP BY 1")
def redaction_area_stats(t: Tables) -> DataFrame:
    a = t.embeddings.select("label", F.size(F.filter("embedding", lambda x: x > 0)).cast("long").alias("area"))
    return a.groupBy("label").agg(F.sum("area").alias("total"), F.min("area").alias("least"), F.max("area").alias("most"), agreement.upper_median(F.collect_list("area")).alias("middle"))


@query("SELECT event_type, quantile_cont(value, 0.5) AS median, min(value) AS slowest, max(value) AS fastest, max(value) / min(value) AS spread, min(value) >= 0.5 AS meets FROM events GROUP BY 1")
def benchmark_stats(t: Tables) -> DataFrame:
    low, high = F.min("value"), F.max("value")
    spread = F.when(low != 0, high / low).otherwise(high * F.pow(low, F.lit(-1)))  # by zero: infinite, NaN for 0 / 0
    return t.events.groupBy("event_type").agg(F.percentile("value", 0.5).alias("median"), low.alias("slowest"), high.alias("fastest"), spread.alias("spread"), (low >= 0.5).alias("meets"))


@query("SELECT field, value, count(*) AS n FROM (SELECT unnest(['returnflag', 'linestatus', 'size']) AS field, unnest([l_returnflag, l_linestatus, CASE WHEN l_quantity > 40 THEN '' ELSE CAST(CAST(l_quantity AS INTEGER) % 4 AS VARCHAR) END]) AS v FROM lineitem), LATERAL (SELECT CASE WHEN v = '' THEN '<empty>' ELSE v END AS value) GROUP BY 1, 2")
def survey_histogram(t: Tables) -> DataFrame:
    each = {"returnflag": F.col("l_returnflag"), "linestatus": F.col("l_linestatus"), "size": F.when(F.col("l_quantity") > 40, "").otherwise((F.col("l_quantity").cast("int") % 4).cast("string"))}
    rows = t.lineitem.select(F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.when(c == "", "<empty>").otherwise(c).alias("value")) for k, c in each.items()])).alias("x")).select("x.*")
    return ingest.counts_by(rows, "field", "value")


@query("SELECT doc_id, n_prior FROM (SELECT doc_id, count(*) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n_prior FROM documents)")
def prior_studies(t: Tables) -> DataFrame:
    w = Window.partitionBy("source").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    return t.documents.select("doc_id", F.count("*").over(w).alias("n_prior"))


@query("SELECT item_id, doc_id FROM benchmark JOIN documents ON contains(upper(documents.text), upper(substr(benchmark.text, 1, 60))) AND length(benchmark.text) >= 5")
def phi_substring_theta(t: Tables) -> DataFrame:
    from tessera.operators.deid import substring_hits

    lits = t.benchmark.select("item_id", F.col("text").alias("lit"))
    hits = substring_hits(t.documents.select("doc_id", "text"), "text", lits, "lit")
    back = lits.where(F.length("lit") >= 5).select("item_id", F.upper("lit").alias("literal"))
    return hits.join(back, "literal").select("item_id", "doc_id")


@query("SELECT doc_id, CASE WHEN regexp_matches(url, '(?i)(\\d{1,4}[-/.]\\d{1,2}[-/.]\\d{1,4})|(\\b\\d{8}\\b)|\\b(JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)\\w*\\b') THEN 'DATE_LIKE' WHEN regexp_matches(url, '(?i)^\\W*((L|R|LT|RT|LEFT|RIGHT|AP|PA|SUPINE|ERECT|PORT|PORTABLE)\\W*)+$') THEN 'LATERALITY_MARKER' WHEN regexp_matches(url, '(?i)\\b[A-Z]{0,4}\\d{5,}\\b') THEN 'ACCESSION_LIKE' WHEN regexp_matches(url, '\\b[A-Z][a-z]+\\s*,\\s*[A-Z][a-z]+\\b|\\b[A-Z][A-Z]+\\s+[A-Z][A-Z]+\\b') THEN 'NAME_LIKE' ELSE 'OTHER_TEXT' END AS category FROM (SELECT page_id AS doc_id, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN 'ERECT PA' WHEN 2 THEN 'AB' || (100000 + page_id) WHEN 3 THEN 'DOE JANE' ELSE '12-0' || (page_id % 9 + 1) || '-2024' END AS url FROM pages)")
def text_ocr_category(t: Tables) -> DataFrame:
    k = F.col("page_id") % 5
    text = F.when(k == 0, F.col("url")).when(k == 1, "ERECT PA").when(k == 2, F.concat(F.lit("AB"), (100000 + F.col("page_id")).cast("string"))).when(k == 3, "DOE JANE").otherwise(F.concat(F.lit("12-0"), (F.col("page_id") % 9 + 1).cast("string"), F.lit("-2024")))
    return t.pages.select(F.col("page_id").alias("doc_id"), tx.text_category(text).alias("category"))
