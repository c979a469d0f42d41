"""Text operators of report prose as native expressions over arrays of sentences."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera import vocab
from tessera.functions.dates import parse_native_date

SPACE = r"[\s\u001c-\u001f\u0085   ]"


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends (trim() takes spaces only)."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def first_nonempty(*cs: Column) -> Column:
    """The first value that isn't blank, stripped; else the empty string."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in cs], F.lit(""))


def normalise_spaces(c: Column) -> Column:
    return F.regexp_replace(F.upper(strip(c)), r"\s+", " ")


def normalise_redactions(c: Column) -> Column:
    """Runs of XXXX become one; white space collapses."""
    return strip(F.regexp_replace(F.regexp_replace(c, r"(?:XXXX[\s,.]*){2,}", "XXXX "), r"\s+", " "))


def _cut(c: Column) -> Column:
    return F.split(F.coalesce(c, F.lit("")), r"(?<=[.;:])\s+|\n+")


def sentences(c: Column) -> Column:
    """Pieces between sentence ends and line ends, stripped, without blanks."""
    return F.filter(F.transform(_cut(c), strip), lambda s: s != "")


def any_of(patterns: tuple[str, ...], flags: str = "(?i)") -> str:
    return flags + "(?:" + "|".join(patterns) + ")"


def negated(sentence: Column, before: Column, negations: tuple[str, ...] = vocab.NEGATION_CUES, resolutions: tuple[str, ...] = vocab.RESOLUTION_CUES) -> Column:
    """Whether a match after the text `before` is denied in its sentence: a resolution anywhere, or a negation
    before it without a termination in between."""
    cue = "(?:" + "|".join(negations) + ")"
    after = F.regexp_replace(before, rf"(?is)^.*{cue}", "")
    scope = before.rlike(f"(?is){cue}") & ~after.rlike(any_of(vocab.TERMINATION_CUES))
    return (sentence.rlike(any_of(resolutions)) | scope) if resolutions else scope


def _first_match(sentence: Column, patterns: tuple[str, ...]) -> Column:
    """The text before the match of the first pattern that matches; null if none does."""
    out = F.lit(None).cast("string")
    for p in reversed(patterns):
        at = F.regexp_instr(sentence, F.lit(f"(?i){p}"))
        out = F.when(at > 0, F.substring(sentence, F.lit(1), at - 1)).otherwise(out)
    return out


def needed(pattern: str) -> set[str]:
    """Lower-case ASCII pieces, one of which is in every match of the pattern; empty if there are none."""

    def of(parsed) -> set[str]:
        options, run = [], ""
        for op, arg in [*parsed, (None, None)]:
            if op is re._constants.LITERAL and arg < 128:
                run += chr(arg).lower()
                continue
            options, run = [*options, {run}], ""
            if op is re._constants.SUBPATTERN:
                options.append(of(arg[-1]))
            elif op is re._constants.BRANCH:
                each = [of(x) for x in arg[1]]
                options.append(set().union(*each) if all(each) else set())
            elif op is re._constants.MAX_REPEAT and arg[0] > 0:
                options.append(of(arg[2]))
        return max((o for o in options if o and "" not in o), key=lambda o: min(map(len, o)), default=set())

    return of(re._parser.parse(pattern))


def _pieces(patterns: tuple[str, ...]) -> list[str]:
    """Pieces, one of which is in every match of any of the patterns; empty if a pattern needs none."""
    each = [needed(p) for p in patterns]
    every = set().union(*each) if all(each) else set()
    return sorted(x for x in every if not any(y in x for y in every if y != x))


def let(value: Column, f) -> Column:
    """f of the value, which is computed once however often f names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def mentions(text: Column, patterns: tuple[str, ...]) -> Column:
    """array<struct<s, low>>: sentences that may match a pattern, in order, as they are and in lower case.

    Pieces are sought in the whole text first, so that most texts and sentences meet few of them and no pattern.
    """
    pieces = _pieces(patterns)
    pair = lambda s: F.struct(strip(s).alias("s"), F.lower(s).alias("low"))
    split = F.transform(_cut(text), pair)
    if not pieces:
        return F.filter(split, lambda x: x["s"] != "")
    have = lambda low: F.array_compact(F.array(*[F.when(F.contains(low, F.lit(p)), F.lit(p)) for p in pieces]))
    # strip only what is kept: a piece has no white space at its ends
    some = lambda found: F.transform(F.filter(_cut(text), lambda s: let(F.lower(s), lambda low: F.exists(found, lambda p: F.contains(low, p)))), pair)
    return let(let(F.lower(text), have), lambda found: F.when(F.size(found) > 0, some(found)).otherwise(F.array().cast("array<struct<s:string,low:string>>")))


def _matches(x: Column, patterns: tuple[str, ...]) -> Column:
    """Whether a sentence of mentions() matches any of the patterns."""
    pieces, found = _pieces(patterns), x["s"].rlike(any_of(patterns))
    return reduce(lambda a, b: a | b, [F.contains(x["low"], F.lit(p)) for p in pieces]) & found if pieces else found


def finding_rows(text: Column, patterns: dict[str, tuple[str, ...]] | None = None, legacy: bool = False) -> Column:
    """array<struct<finding, present>>: true (asserted somewhere), false (only denied) or null (not mentioned)."""
    table = dict(vocab.FINDING_PATTERNS)
    if legacy:
        table |= vocab.LEGACY_FINDING_PATTERNS
    table = patterns or table
    cues, ends = (vocab.LEGACY_NEGATION_CUES, ()) if legacy else (vocab.NEGATION_CUES, vocab.RESOLUTION_CUES)

    def state(parts: Column, ps: tuple[str, ...]) -> Column:
        said = lambda x: let(_first_match(x["s"], ps), lambda before: ~negated(x["s"], before, cues, ends))
        return F.array_max(F.transform(F.filter(parts, lambda x: _matches(x, ps)), said))

    rows = lambda parts: F.array(*[F.struct(F.lit(f).alias("finding"), state(parts, ps).alias("present")) for f, ps in table.items()])
    return let(mentions(text, tuple(p for ps in table.values() for p in ps)), rows)


def finding_states(text: Column, patterns: dict[str, tuple[str, ...]] | None = None, legacy: bool = False) -> dict[str, Column]:
    """By finding: true (asserted somewhere), false (only denied) or null (not mentioned)."""
    rows = finding_rows(text, patterns, legacy)
    return {f: rows[i]["present"] for i, f in enumerate(patterns or vocab.FINDING_PATTERNS)}


def has_other(text: Column) -> Column:
    """An abnormality outside the vocabulary, not denied in its sentence."""
    said = lambda x, p: F.coalesce(_matches(x, (p,)) & ~let(_first_match(x["s"], (p,)), lambda before: negated(x["s"], before)), F.lit(False))
    return F.exists(mentions(text, vocab.OTHER_PATTERNS), lambda x: reduce(lambda a, b: a | b, [said(x, p) for p in vocab.OTHER_PATTERNS]))


def extract_labels(text: Column, legacy: bool = False) -> Column:
    """struct<findings, denied>: sorted arrays. OTHER only without a positive finding, NO_FINDING only without either."""
    normal = text.rlike(any_of(vocab.LEGACY_NORMAL_PATTERNS if legacy else vocab.NORMAL_PATTERNS))
    rest = F.when(normal, F.array(F.lit("NO_FINDING"))).otherwise(F.array().cast("array<string>"))
    if not legacy:
        rest = F.when(has_other(text), F.array(F.lit("OTHER"))).otherwise(rest)

    def labels(rows: Column) -> Column:
        pick = lambda want: F.array_sort(F.transform(F.filter(rows, lambda r: r["present"] == F.lit(want)), lambda r: r["finding"]))
        return let(pick(True), lambda pos: F.struct(F.when(F.size(pos) > 0, pos).otherwise(rest).alias("findings"), pick(False).alias("denied")))

    return let(finding_rows(text, legacy=legacy), labels)


def sections(text: Column) -> Column:
    """map<section, body>: whole-line headings switch, closing lines end, text outside sections goes."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085  ]")
    heading = F.lit(None).cast("string")

    def name(line: Column) -> Column:
        out = F.lit(None).cast("string")
        for s in reversed(vocab.SECTIONS):
            out = F.when(line.rlike(rf"(?i)^\s*(?:{vocab.HEADINGS[s]})\s*:?\s*$"), F.lit(s)).otherwise(out)
        return out

    empty = F.array().cast("array<struct<s:string,line:string>>")
    start = F.struct(heading.alias("now"), empty.alias("out"))

    def step(acc: Column, line: Column) -> Column:
        head, end = name(line), line.rlike("(?i)" + vocab.TRAILER)
        now = F.coalesce(head, F.when(~end, acc["now"]))
        keep = head.isNull() & ~end & acc["now"].isNotNull()
        return F.struct(now.alias("now"), F.when(keep, F.concat(acc["out"], F.array(F.struct(acc["now"].alias("s"), line.alias("line"))))).otherwise(acc["out"]).alias("out"))

    rows = F.aggregate(lines, start, step)["out"]
    body = lambda s: strip(F.array_join(F.transform(F.filter(rows, lambda r: r["s"] == s), lambda r: r["line"]), "\n"))
    return F.map_filter(F.map_from_arrays(F.array(*map(F.lit, vocab.SECTIONS)), F.array(*[body(s) for s in vocab.SECTIONS])), lambda k, v: v != "")


def clinical_text(sections_map: Column) -> Column:
    """Findings and impression only: other sections state suspicions or other examinations."""
    return F.array_join(F.array_compact(F.array(sections_map["FINDINGS"], sections_map["IMPRESSION"])), "\n")


def text_category(c: Column) -> Column:
    out = F.lit("OTHER_TEXT")
    for name, p in reversed(vocab.TEXT_CATEGORIES):
        out = F.when(c.rlike(p), F.lit(name)).otherwise(out)
    return out


def head_term(c: Column) -> Column:
    return F.lower(strip(F.element_at(F.split(c, "/"), 1)))


def mesh_concepts(c: Column) -> Column:
    """Head and qualifiers that name something, in order, once each."""
    parts = F.filter(F.transform(F.split(c, "/"), lambda p: F.lower(strip(p))), lambda p: p != "")
    rest = F.filter(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), lambda p: ~p.isin(*vocab.MESH_MODIFIERS))
    return F.when(F.size(parts) > 0, F.array_distinct(F.concat(F.slice(parts, 1, 1), rest))).otherwise(F.array().cast("array<string>"))


def redact_literals(text: Column, literals: Column, placeholder: str) -> Column:
    """struct<text, n>: literals of three or more characters and their words of four or more go, longest first."""
    values = F.filter(F.transform(literals, lambda x: strip(F.coalesce(x, F.lit("")))), lambda x: F.length(x) >= 3)
    words = F.filter(F.flatten(F.transform(values, lambda x: F.split(x, r"[\s^,]+"))), lambda w: (F.length(w) >= 4) & ~w.rlike(r"^\d+$"))
    tokens = F.array_sort(F.array_distinct(F.concat(values, words)), lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0))
    pattern = lambda t: F.concat(F.lit(r"(?iU)(?<!\w)\Q"), t, F.lit(r"\E(?!\w)"))
    return F.aggregate(tokens, F.struct(text.alias("text"), F.lit(0).alias("n")), lambda acc, t: F.struct(F.regexp_replace(acc["text"], pattern(t), F.lit(placeholder)).alias("text"), (acc["n"] + F.regexp_count(acc["text"], pattern(t))).alias("n")))


def cap_age(text: Column) -> Column:
    """On an age/sex line the first number, if over 89, becomes 89+."""
    line = F.regexp_extract(text, vocab.AGE_SEX, 0)
    years = F.try_to_number(F.nullif(F.regexp_extract(F.regexp_extract(text, vocab.AGE_SEX, 2), r"(\d{1,3})", 1), F.lit("")), F.lit("999"))
    capped = F.regexp_replace(text, r"(?im)^(\s*Age\s*/?\s*Sex\s*:[^\d\n]*)\d{1,3}", "$189+")
    return F.when((line != "") & (years > 89), capped).otherwise(text)


def shift_dates(text: Column, offset: Column | None) -> Column:
    """Every date shifted by the offset, as dd-MM-yyyy; [DATE] without an offset or where it can't be read."""
    rest, found = F.split(text, vocab.DATE, -1), F.regexp_extract_all(text, F.lit(vocab.DATE), 1)
    shift = (lambda d: F.coalesce(F.date_format(F.date_add(parse_native_date(d), offset), "dd-MM-yyyy"), F.lit("[DATE]"))) if offset is not None else lambda d: F.lit("[DATE]")
    new = F.concat(F.transform(found, shift), F.array(F.lit("")))
    return F.array_join(F.zip_with(rest, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def scrub(text: Column, names: Column, ids: Column, institutions: Column, offset: Column | None = None) -> Column:
    """struct<text, n>: labelled fields, literals, doctors, phones, dates, in this order; n counts replacements."""
    t0 = F.coalesce(text, F.lit(""))
    n = F.regexp_count(t0, F.lit(vocab.LABELLED_FIELDS))
    t = cap_age(F.regexp_replace(t0, vocab.LABELLED_FIELDS, "$1 [ID]"))
    for literals, mark in ((ids, "[ID]"), (institutions, "[INSTITUTION]"), (names, "[NAME]")):
        r = redact_literals(t, literals, mark)
        t, n = r["text"], n + r["n"]
    for p, mark in ((vocab.DOCTOR, "[NAME]"), (vocab.PHONE, "[PHONE]")):
        n, t = n + F.regexp_count(t, F.lit(p)), F.regexp_replace(t, p, mark)
    n, t = n + F.regexp_count(t, F.lit(vocab.DATE)), shift_dates(t, offset)
    return F.struct(F.regexp_replace(t, vocab.REPEATED, "$1").alias("text"), n.cast("int").alias("n"))
