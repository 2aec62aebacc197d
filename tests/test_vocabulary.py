"""Fixed code lists, drug patterns, and the scalar expressions."""

import re
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortloom.functions import drugs, expressions, vocabulary
from cohortloom.operators.medications import classify_medications
from oracle_values import CONDITION_CODES, DRUG_PATTERNS, SURGERY_CODES


def test_bypass_codes():
    codes = vocabulary.BYPASS_CODES
    assert len(codes) == len(set(codes)) == 273
    assert len(SURGERY_CODES) == 273 and sorted(codes) == sorted(SURGERY_CODES)
    assert [len(x) for x in (vocabulary.BYPASS_CPT, vocabulary.BYPASS_ICD9, vocabulary.BYPASS_ICD10)] == [16, 9, 248]
    assert {"0210093", "02100ZF", "0210344", "02103D4", "02104D4", "02134ZF", "021249W"} <= set(codes)
    assert not {"02100ZW", "0210044", "02103Z3", "02104ZW"} & set(codes)


def test_drug_patterns_are_whole():
    assert sum(len(c.patterns()) for c in drugs.DRUG_CLASSES) == 300
    own = [(c.label, c.brand, c.generic) for c in drugs.DRUG_CLASSES]
    assert own == list(DRUG_PATTERNS)


def test_covered_patterns_are_left_off():
    patterns = ["%sacubitril%valsartan%", "%valsartan%", "x_y%", "%_b%", "Esmolol", "%smo%", "%%smo%", "%"]
    assert expressions.uncovered(patterns) == ["%valsartan%", "x_y%", "%_b%", "%smo%", "%"]
    assert expressions.uncovered(["a%b", "%a%b%", "a%b"]) == ["a%b", "%a%b%"]


def test_condition_order_is_the_matrix_order():
    names = [rule.name for rule in vocabulary.HISTORY_CONDITIONS]
    assert names == [
        "smoking", "copd", "prior_af", "hypertension", "diabetes", "mitralValve", "hf", "myo",
    ]


def test_condition_codes_are_whole():
    rules = {r.name: r for r in (vocabulary.AF_OUTCOME, *vocabulary.HISTORY_CONDITIONS)}
    for name, system, kind, codes in CONDITION_CODES:
        own = [
            b.codes if kind == "code" else b.bases or b.base_between
            for b in rules[name].branches
            if system is None or system in b.code_sets
        ]
        assert codes in own, (name, system, kind)


# Names that a longer pattern of the class would match, and one that no pattern does.
NAMED = [
    (None, "Captopril / Hydrochlorothiazide", {"ACE inhibitors"}),
    (None, "1 ML Enalaprilat", {"ACE inhibitors"}),
    (None, "enalaprilat anhydrous", {"ACE inhibitors"}),
    (None, "Perindopril Erbumine", {"ACE inhibitors"}),
    (None, "quinaprilat", {"ACE inhibitors"}),
    (None, "ramiprilat", {"ACE inhibitors"}),
    (None, "benazeprilat", {"ACE inhibitors"}),
    (None, "perindoprilat", {"ACE inhibitors"}),
    (None, "Fosinopril Sodium", {"ACE inhibitors"}),
    (None, "Losartan Potassium", {"ACE inhibitors"}),
    (None, "Saralasin Acetate", {"ACE inhibitors"}),
    (None, "Hydrochlorothiazide / telmisartan", {"ACE inhibitors", "angiotensin II receptor blockers"}),
    (None, "candesartan cilexetil", {"ACE inhibitors", "angiotensin II receptor blockers"}),
    (None, "trandolapril / Verapamil", {"ACE inhibitors"}),
    (None, "Amlodipine / Perindopril", {"ACE inhibitors"}),
    (None, "aliskiren / valsartan", {"ACE inhibitors"}),
    (None, "Amlodipine / Hydrochlorothiazide / valsartan", {"ACE inhibitors"}),
    (None, "Felodipine / Ramipril", {"ACE inhibitors"}),
    (None, "sacubitril / valsartan", {"ACE inhibitors"}),
    (None, "nebivolol / valsartan", {"ACE inhibitors", "beta_blocker"}),
    ("Lotensin", None, set()),
    (None, "Lotensin", {"ACE inhibitors"}),
    (None, "Felodipine / Metoprolol", {"beta_blocker"}),
    (None, "Atenolol / Nifedipine", {"beta_blocker"}),
    (None, "Timolol", {"beta_blocker"}),
    (None, "Clonidine", {"beta_blocker"}),
    (None, "Clonidine Hydrochloride", set()),
    (None, "Doxazosin", {"beta_blocker"}),
    ("timolol maleate ophthalmic solution", None, {"beta_blocker"}),
    ("Kerlone;Betoptic;Betoptic S;Betoptic Pilo", None, {"beta_blocker"}),
    ("Lopressor;Lopressor HCT;Toprol;Dutoprol;Kapspargo", None, {"beta_blocker"}),
    ("Inderal;InnoPran;Hemangeol oral", None, {"beta_blocker"}),
    ("Inderal oral", None, set()),
    ("Betoptic", None, set()),
    ("Betoptic S", None, {"beta_blocker"}),
    ("Hemangeol", None, {"beta_blocker"}),
    ("Hemangeol 4 MG", None, set()),
    ("Lescol XL", None, {"statin"}),
    ("simvastatin", None, {"statin"}),
    (None, "simvastatin", set()),
    (None, "cerivastatin", {"statin"}),
    ("cerivastatin", None, set()),
    ("Benicar", None, set()),
    (None, "Benicar", {"angiotensin II receptor blockers"}),
    (None, "azilsartan", {"angiotensin II receptor blockers"}),
    (None, "azilsartan medoxomil", {"ACE inhibitors", "angiotensin II receptor blockers"}),
    (None, "St. Joseph Adult Aspirin", {"Asprin"}),
    (None, "Tri-Buffered Aspirin", {"Asprin"}),
    (None, "Bayer Plus Extra Strength", {"Asprin"}),
    (None, "Acetylsalicylic Acid", {"Asprin"}),
    (None, "Acid Acetylsalicylic", set()),
    (None, "Aspir-low", {"Asprin"}),
    ("Aspirin", None, set()),
    (None, "Hydrochlorothiazide / Triamterene", {"ARA"}),
    (None, "Amiloride Hydrochloride / Hydrochlorothiazide", {"ARA"}),
    ("Carospir;Aldactone;Aldactazide", None, {"ARA"}),
    ("Dyazide", None, {"ARA"}),
    ("Celebrex", None, {"cyclooxygenase-2 inhibitors"}),
    (None, "Celecoxib", set()),
    ("acetaminophen", "acetaminophen", set()),
    (None, None, set()),
]


@pytest.mark.parametrize("spelling", [str, str.upper, str.lower])
def test_drug_classes(spark, spelling):
    respelled = [
        (n, b and spelling(b), g and spelling(g)) for n, (b, g, _) in enumerate(NAMED, start=1)
    ]
    frame = spark.createDataFrame(
        respelled, "medication_key long, medication_name string, generic_name string"
    )
    found = {n: set() for n in range(1, len(NAMED) + 1)}
    for row in classify_medications(frame, drugs.DRUG_CLASSES).collect():
        found[row.medication_key].add(row.med_class)
    assert found == {n: expected for n, (_, _, expected) in enumerate(NAMED, start=1)}


def test_year_boundaries(spark):
    frame = spark.createDataFrame(
        [(date(2000, 12, 31), date(2001, 1, 1)), (date(2000, 1, 1), date(2000, 12, 31))],
        "a date, b date",
    )
    years = frame.select(expressions.year_boundaries(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in years] == [1, 0]


def test_int_date_key(spark):
    frame = spark.createDataFrame([(20150131,), (None,)], "k int")
    assert [r[0] for r in frame.select(expressions.int_date_key(F.col("k"))).collect()] == [
        date(2015, 1, 31),
        None,
    ]


def like(text: str, pattern: str) -> bool:
    """LIKE without an escape character."""
    parts = {"%": ".*", "_": "."}
    return re.fullmatch("".join(parts.get(c) or re.escape(c) for c in pattern), text, re.S) is not None


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    texts=st.lists(st.text(alphabet="abA .%;\n\\_", max_size=8) | st.none(), min_size=1, max_size=20),
    patterns=st.lists(st.text(alphabet="abA .%_;\\", max_size=5), min_size=1, max_size=16, unique=True),
    case_sensitive=st.booleans(),
)
def test_pattern_lists_of_any_length_mean_the_same(spark, texts, patterns, case_sensitive):
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    found = frame.select("n", expressions.like_any(F.col("t"), patterns, case_sensitive).alias("m"))
    fold = (lambda x: x) if case_sensitive else str.lower
    expected = {
        n: None if t is None else any(like(fold(t), fold(p)) for p in patterns)
        for n, t in enumerate(texts)
    }
    assert {r.n: r.m for r in found.collect()} == expected
