"""Text queries over documents, conversations and pages. RE2 has no lookaround: where a rule needs it, SQL marks ends first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import vocab
from tessera.functions import text as tx
from tessera.plans.registry import Tables, query


def sq(pattern: str) -> str:
    """A pattern as an SQL string literal."""
    return "'" + pattern.replace("'", "''") + "'"


SENTENCES = r"list_filter(list_transform(string_split(regexp_replace(regexp_replace(t, '([.;:])\s+', '\1' || chr(1), 'g'), '\n+', chr(1), 'g'), chr(1)), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '')"


@query(f"WITH d AS (SELECT doc_id, text AS t FROM documents) SELECT doc_id, len({SENTENCES}) AS n, array_to_string({SENTENCES}, '|') AS joined FROM d")
def text_sentence_split(t: Tables) -> DataFrame:
    s = tx.sentences(F.col("text"))
    return t.documents.select("doc_id", F.size(s).cast("long").alias("n"), F.array_join(s, "|").alias("joined"))


#: Sentences put after each document, so that every rule has cases in every table.
CASES = (
    "No evidence of pneumothorax.",
    "The heart is mildly enlarged but no pleural effusion.",
    "There is no consolidation; however a small effusion is seen.",
    "The left apical pneumothorax has resolved.",
    "Lungs are clear of focal disease, pneumothorax, or effusion.",
    "Calcified granuloma in the right apex.",
    "No nodule. Bibasilar atelectasis.",
    "The lungs are well expanded and clear.",
    "Negative for fracture, though a nodular density remains.",
    "Fibrocavitary changes, post-primary infection not excluded.",
)


def _report(t: Tables):
    pick = F.element_at(F.array(*[F.lit(c) for c in CASES]), (F.col("doc_id") % len(CASES) + 1).cast("int"))
    also = F.element_at(F.array(*[F.lit(c) for c in CASES]), (F.col("doc_id") * 7 % len(CASES) + 1).cast("int"))
    return t.documents.select("doc_id", F.concat("text", F.lit(".\n"), pick, F.lit(" "), also).alias("t"))


REPORT = "d AS (SELECT doc_id, substr(text, 1, 400) || '.' || chr(10) || c[doc_id % 10 + 1] || ' ' || c[doc_id * 7 % 10 + 1] AS t FROM documents, (SELECT [" + ", ".join(sq(c) for c in CASES) + "] AS c))"
NEG, TERM, RES = ("(?:" + "|".join(x) + ")" for x in (vocab.NEGATION_CUES, vocab.TERMINATION_CUES, vocab.RESOLUTION_CUES))


def _sql_states() -> str:
    """doc_id, finding, present for each finding that a sentence mentions."""
    rows = []
    for f, ps in vocab.FINDING_PATTERNS.items():
        before = "CASE " + " ".join(f"WHEN regexp_matches(s, {sq('(?i)' + p)}) THEN regexp_extract(s, {sq('(?is)^(.*?)' + '(?:' + p + ')')}, 1)" for p in ps) + " END"
        rows.append(f"SELECT doc_id, '{f}' AS finding, s, {before} AS b FROM s")
    every = " UNION ALL ".join(rows)
    after = f"regexp_replace(b, {sq('(?is)^.*' + NEG)}, '')"
    denied = f"regexp_matches(s, {sq('(?i)' + RES)}) OR (regexp_matches(b, {sq('(?i)' + NEG)}) AND NOT regexp_matches({after}, {sq('(?i)' + TERM)}))"
    return f"s AS (SELECT doc_id, unnest({SENTENCES}) AS s FROM d), m AS ({every}), st AS (SELECT doc_id, finding, bool_or(NOT ({denied})) AS present FROM m WHERE b IS NOT NULL GROUP BY 1, 2)"


@query(f"WITH {REPORT}, {_sql_states()} SELECT doc_id, finding, present FROM st")
def text_negation(t: Tables) -> DataFrame:
    return _report(t).select("doc_id", F.explode(tx.finding_rows(F.col("t"))).alias("x")).select("doc_id", "x.*").where("present IS NOT NULL")


OTHER_BEFORE = lambda p: f"regexp_extract(s, {sq('(?is)^(.*?)(?:' + p + ')')}, 1)"


def _sql_labels() -> str:
    after = lambda b: f"regexp_replace({b}, {sq('(?is)^.*' + NEG)}, '')"
    other = " OR ".join(f"(regexp_matches(s, {sq('(?i)' + p)}) AND NOT (regexp_matches({OTHER_BEFORE(p)}, {sq('(?i)' + NEG)}) AND NOT regexp_matches({after(OTHER_BEFORE(p))}, {sq('(?i)' + TERM)})))" for p in vocab.OTHER_PATTERNS)
    normal = sq("(?i)(?:" + "|".join(vocab.NORMAL_PATTERNS) + ")")
    return (
        f"o AS (SELECT doc_id, bool_or(NOT regexp_matches(s, {sq('(?i)' + RES)}) AND ({other})) AS other FROM s GROUP BY 1), "
        f"l AS (SELECT d.doc_id, coalesce(list_sort(list(finding) FILTER (present)), []) AS pos, coalesce(list_sort(list(finding) FILTER (NOT present)), []) AS neg, any_value(coalesce(other, false)) AS other, any_value(regexp_matches(t, {normal})) AS normal FROM d LEFT JOIN st ON st.doc_id = d.doc_id LEFT JOIN o ON o.doc_id = d.doc_id GROUP BY 1)"
    )


@query(f"WITH {REPORT}, {_sql_states()}, {_sql_labels()} SELECT doc_id, array_to_string(CASE WHEN len(pos) > 0 THEN pos WHEN other THEN ['OTHER'] WHEN normal THEN ['NO_FINDING'] ELSE [] END, ',') AS findings, array_to_string(neg, ',') AS denied FROM l")
def text_findings(t: Tables) -> DataFrame:
    x = _report(t).select("doc_id", tx.extract_labels(F.col("t")).alias("x"))
    return x.select("doc_id", F.array_join("x.findings", ",").alias("findings"), F.array_join("x.denied", ",").alias("denied"))


@query("WITH d AS (SELECT conv_id, string_agg(CASE role WHEN 'user' THEN 'FINDINGS:' WHEN 'assistant' THEN 'impression' ELSE 'CLINICAL HISTORY' END || chr(10) || replace(text, chr(10), ' '), chr(10) ORDER BY turn, role, text) || chr(10) || 'Reported by nobody' || chr(10) || 'lost' AS t FROM conversations GROUP BY 1), l AS (SELECT conv_id, generate_subscripts(x, 1) AS i, unnest(x) AS line FROM (SELECT conv_id, string_split(t, chr(10)) AS x FROM d)), h AS (SELECT *, CASE WHEN regexp_matches(line, '(?i)^\\s*(?:FINDINGS|OBSERVATIONS?)\\s*:?\\s*$') THEN 'FINDINGS' WHEN regexp_matches(line, '(?i)^\\s*(?:IMPRESSION|CONCLUSION|OPINION|ADVICE)\\s*:?\\s*$') THEN 'IMPRESSION' WHEN regexp_matches(line, '(?i)^\\s*(?:INDICATION|CLINICAL\\s+HISTORY|HISTORY)\\s*:?\\s*$') THEN 'INDICATION' WHEN regexp_matches(line, '(?i)^\\s*Reported\\s+by\\b') THEN '-' END AS mark FROM l), s AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY i) AS sec FROM h) SELECT conv_id, sec AS section, regexp_replace(string_agg(line, chr(10) ORDER BY i), '^\\s+|\\s+$', '', 'g') AS body FROM s WHERE mark IS NULL AND sec IS NOT NULL AND sec <> '-' GROUP BY 1, 2 HAVING regexp_replace(string_agg(line, chr(10) ORDER BY i), '^\\s+|\\s+$', '', 'g') <> ''")
def text_sections(t: Tables) -> DataFrame:
    head = F.when(F.col("role") == "user", "FINDINGS:").when(F.col("role") == "assistant", "impression").otherwise("CLINICAL HISTORY")
    line = F.concat(head, F.lit("\n"), F.replace("text", F.lit("\n"), F.lit(" ")))
    rows = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", line.alias("l")))).alias("x"))
    whole = F.concat(F.array_join(F.col("x.l"), "\n"), F.lit("\nReported by nobody\nlost"))
    return rows.select("conv_id", F.explode(tx.sections(whole)).alias("section", "body"))


@query("WITH d AS (SELECT conv_id, array_to_string(list(replace(text, chr(10), ' ') ORDER BY turn, role, text) FILTER (role = 'user'), chr(10)) AS f, array_to_string(list(replace(text, chr(10), ' ') ORDER BY turn, role, text) FILTER (role = 'assistant'), chr(10)) AS i FROM conversations GROUP BY 1) SELECT conv_id, concat_ws(chr(10), nullif(trim(f), ''), nullif(trim(i), '')) AS clinical FROM d")
def text_clinical(t: Tables) -> DataFrame:
    head = F.when(F.col("role") == "user", "FINDINGS:").when(F.col("role") == "assistant", "impression").otherwise("CLINICAL HISTORY")
    line = F.concat(head, F.lit("\n"), F.replace("text", F.lit("\n"), F.lit(" ")))
    rows = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", line.alias("l")))).alias("x"))
    return rows.select("conv_id", tx.clinical_text(tx.sections(F.array_join(F.col("x.l"), "\n"))).alias("clinical"))


PHONE_SQL = vocab.PHONE


@query(f"SELECT doc_id, len(regexp_extract_all(text, {sq(PHONE_SQL)})) AS n, regexp_replace(text, {sq(PHONE_SQL)}, '[PHONE]', 'g') AS scrubbed FROM documents")
def text_scrub_phone(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.regexp_count("text", F.lit(vocab.PHONE)).cast("long").alias("n"), F.regexp_replace("text", vocab.PHONE, "[PHONE]").alias("scrubbed"))


HEADER = "Patient Name: DOE^JANE\nMRN : 0012345\nSeen by Dr. Priya Menon on 12-04-2024 and 3 Mar 2024.\nAge/Sex: 93 F\n"
OFF_SQL = "CAST(doc_id % 400 AS INTEGER) - 500"


@query(f"SELECT doc_id, 'Patient Name: [ID]' || chr(10) || 'MRN : [ID]' || chr(10) || 'Seen by [NAME] on ' || strftime(DATE '2024-04-12' + ({OFF_SQL}), '%d-%m-%Y') || ' and ' || strftime(DATE '2024-03-03' + ({OFF_SQL}), '%d-%m-%Y') || '.' || chr(10) || 'Age/Sex: 89+ F' || chr(10) || '[NAME] was [INSTITUTION] ' || lang AS scrubbed, CAST(7 AS INTEGER) AS n FROM documents")
def text_scrub(t: Tables) -> DataFrame:
    own = [F.coalesce(c, F.lit("")) for c in ("lang", "text")]
    text = F.concat(F.lit(HEADER + "Jane was Sunrise "), own[0], F.lit("\n"), own[1])
    x = tx.scrub(text, F.array(F.lit("DOE^JANE")), F.array(F.lit("0012345")), F.array(F.lit("Sunrise")), (F.col("doc_id") % 400).cast("int") - 500)
    return t.documents.select("doc_id", x.alias("x")).select("doc_id", F.col("x.text").alias("scrubbed"), "x.n")


@query(r"WITH d AS (SELECT doc_id, list_filter(string_split(substr(text, 1, 300), ' '), lambda w: regexp_full_match(w, '\w{4,}')) AS toks, substr(text, 1, 300) AS t FROM documents), f AS (SELECT doc_id, t, CASE WHEN len(toks) > 0 THEN toks[1] END AS w FROM d) SELECT doc_id, CASE WHEN w IS NULL THEN t ELSE regexp_replace(regexp_replace(t, '(?i)(^|[^\w\x{80}-\x{10FFFF}])' || w || '($|[^\w\x{80}-\x{10FFFF}])', '\1[ID]\2', 'g'), '(?i)(^|[^\w\x{80}-\x{10FFFF}])' || w || '($|[^\w\x{80}-\x{10FFFF}])', '\1[ID]\2', 'g') END AS scrubbed FROM f")
def text_scrub_literals(t: Tables) -> DataFrame:
    toks = F.filter(F.split("text", " "), lambda w: w.rlike(r"^\w{4,}\z"))
    word = F.when(F.size(toks) > 0, F.slice(toks, 1, 1)).otherwise(F.array().cast("array<string>"))
    return t.documents.select("doc_id", tx.redact_literals(F.col("text"), word, "[ID]")["text"].alias("scrubbed"))


@query(r"WITH u AS (SELECT page_id, list_filter(list_transform(string_split(regexp_replace(url, '^\w+://', ''), '/'), lambda x: lower(trim(x))), lambda x: x <> '') AS p FROM pages) SELECT page_id, p[1] AS head, array_to_string(list_distinct([p[1]] || list_filter(p[2:], lambda x: x NOT IN ('right', 'left', 'mild', 'acute'))), '|') IS NOT NULL AS has_concepts, CAST(len(list_distinct([p[1]] || p[2:])) AS INTEGER) AS n FROM u")
def mesh_concepts(t: Tables) -> DataFrame:
    u = F.regexp_replace("url", r"^\w+://", "")
    return t.pages.select("page_id", tx.head_term(u).alias("head"), tx.mesh_concepts(u).isNotNull().alias("has_concepts"), F.size(tx.mesh_concepts(u)).alias("n"))


@query(r"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace('XXXX, XXXX ' || substr(text, 1, 80), '(?:XXXX[\s,.]*){2,}', 'XXXX '), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS normal FROM documents")
def placeholder_normalise(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", tx.normalise_redactions(F.concat(F.lit("XXXX, XXXX "), F.col("text"))).alias("normal"))
