"""Steps that a plan takes once, however many results use them."""

import re

import pytest
from pyspark.sql import functions as F

from tessera import vocab
from tessera.functions import text as tx
from tessera.operators import deid
from tessera.plans import catalogue


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(("name", "most"), [("text_negation", 1), ("text_findings", 2)])
def test_a_text_is_split_once_for_all_findings(spark, tmp_path, name, most):
    """text_findings once more, for abnormalities outside the vocabulary."""
    spark.createDataFrame([(0, "a")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert 1 <= optimized(catalogue.QUERIES[name](spark, str(tmp_path))).count("split(") <= most


def test_needed_pieces_are_in_every_match():
    assert tx.needed(r"\bheart\s+(?:size\s+)?is\s+(?:\w+\s+){0,3}enlarged") == {"enlarged"}
    assert tx.needed(r"(?:catheter|tube)\s+(?:tip|is\s+seen)") == {"catheter", "tube"}
    assert tx.needed(r"koch'?s?\b") == {"koch"} and tx.needed(r"\bo?edema\b") == {"edema"}
    assert tx.needed(r"\w+\s*") == set() and tx.needed(r"(?:ab)?|c") == set()
    assert tx._pieces(("ab", r"\w+")) == [] and tx._pieces(("ab", "cabd")) == ["ab"]
    for p in (p for ps in (*vocab.FINDING_PATTERNS.values(), vocab.OTHER_PATTERNS) for p in ps):
        assert tx.needed(p)


def test_patterns_without_needed_pieces(spark):
    df = spark.createDataFrame([("x 12. y",), ("no 12",), ("",), (None,)], "t string")
    got = df.select(tx.finding_states(F.col("t"), {"N": (r"\d+",)})["N"].alias("x")).collect()
    assert [r.x for r in got] == [True, False, None, None]


def test_states_equal_a_search_of_every_sentence(spark):
    texts = ["PLEURAL\teffusion; No\nedema", "Koch's. not koch", "Pneumothorax has resolved: no mass. CABG", "the lungs are clear", "nodule\u0085. No well-circumscribed  opacity but fracture", "effuſion", None]
    got = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", F.explode(tx.finding_rows(F.col("t"))).alias("r")).select("i", "r.*").where("present IS NOT NULL").collect()

    def brute():
        cue = lambda cs, s: re.search("(?:" + "|".join(cs) + ")", s, re.I | re.A)
        for i, t in enumerate(texts):
            for f, ps in vocab.FINDING_PATTERNS.items():
                said = []
                for s in re.split(r"(?<=[.;:])\s+|\n+", t or ""):
                    m = next((m for p in ps if (m := re.search(p, s, re.I | re.A))), None)
                    if m:
                        before = s[: m.start()]
                        last = [x.end() for x in re.finditer("|".join(vocab.NEGATION_CUES), before, re.I | re.A)]
                        said.append(not (cue(vocab.RESOLUTION_CUES, s) or (last and not cue(vocab.TERMINATION_CUES, before[last[-1] :]))))
                if said:
                    yield i, f, any(said)

    assert {tuple(r) for r in got} == set(brute())


def test_literals_are_joined_by_a_word_inside(spark):
    """Equal to a search of every text for every literal, odd ones included, without meeting every text."""
    texts = ["see Dr. Ann-Marie Oak, ward 7", "DR. ANN-MARIE OAKS", "anne marie oak", "x12345y", "straße am see weg", "STRASSE AM SEE WEG", "(alpha) beta", "alphabeta", "a b c d", "a b c d", "", None]
    lits = ["Ann-Marie Oak", "12345", "straße am see", "(alpha) ", "alpha", "A B C", "Marie", ". Ann-", "oak", "b c d", None]
    values = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    df = deid.substring_hits(values, "t", spark.createDataFrame([(x,) for x in lits], "v string"), "v")
    want = sorted((i, x.upper()) for i, t in enumerate(texts) for x in lits if t and x and len(x.upper()) >= 5 and x.upper() in t.upper())
    assert sorted((r.i, r.literal) for r in df.collect()) == want and len(want) == 17
    assert df.columns == ["i", "t", "literal"] and "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()
