"""Scalar operators against tables of cases."""

import pytest
from pyspark.sql import functions as F

from retort import schemas
from retort.functions import metrics as m
from retort.functions import text as t


def run(spark, cases, *columns):
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, " + ", ".join(f"c{k} string" for k in range(len(cases[0]))))
    return [tuple(r) for r in rows.orderBy("i").select(*columns).collect()]


def one(spark, cases, column):
    return [r[0] for r in run(spark, [c if isinstance(c, tuple) else (c,) for c in cases], column)]


def test_er_to_ee(spark):
    cases = {"95:5": "90%", "95/5": "90%", "95:5 e.r.": "90%", "95:5 (1S, 5R, 6S)": "90%", ">99:1": ">98%", "≥97.5:2.5": ">=95%", "96:4/88:12": None, "syn 96:4; anti 89:11": None, "N/A": None, "0:0": None, "> 10:90": None, "60.5：39.5": "21%"}
    assert one(spark, list(cases), m.ee_text(F.col("c0"))) == list(cases.values())


def test_er_statuses(spark):
    cases = {"95:5": "converted_exact", ">99:1": "converted_threshold", "96:4; 88:12": "ambiguous_multiple_ratios", "high": "invalid_format", "N/A": "explicitly_unreported", None: "explicitly_unreported", "0:0": "invalid_ratio", ">1:9": "invalid_qualified_ratio"}
    assert one(spark, list(cases), m.parse_er(F.col("c0"))["status"]) == list(cases.values())


def test_existing_ee_is_kept(spark):
    convert = m.convert_er(F.col("c0"), F.col("c1"))
    assert run(spark, [("88%", "95:5"), (None, "95:5"), ("N/A", "95:5"), ("", "not reported")], convert["ee"], convert["er"], convert["status"]) == [("88%", "95:5", "existing_ee"), ("90%", "95:5", "converted_exact"), ("N/A", "95:5", "existing_ee"), (None, None, "no_er")]


def test_percentages(spark):
    cases = {"92%": 92.0, "> 99 %": 99.0, "92％ yield": 92.0, "50% and 60%": None, "120%": None, " ≥ 45 ": 45.0, "45 mg": None, "": None, None: None, "1.5.3%": None}
    assert one(spark, list(cases), m.parse_percentage(F.col("c0"))) == list(cases.values())


def test_ratios(spark):
    assert one(spark, ["  >20:1 dr  ", "dr = 95:5", "N/A", "dr"], m.clean_ratio(F.col("c0"), "dr")) == [">20:1", "95:5", None, None]
    assert one(spark, ["91:9", "high dr", "91:9 dr x", ">20:1", "trace", None], m.whole_ratio(F.col("c0"))) == [True, False, False, True, False, False]
    assert one(spark, ["((92%))", "(a)(b)", " (x) ", "(" * 12 + "7" + ") " * 12, "((a)", "()", "(", "", None], m.peel_parentheses(F.col("c0"))) == ["92%", "a)(b", "x", "7", "(a", "", "(", "", None]


def test_target_filter(spark):
    passes = m.target_passes(*[F.col(f"c{i}") for i in range(4)])
    cases = [("92%", None, None, None), ("-5%", None, "95:5", None), ("trace", None, None, None), (None, None, "95:5 er", None), (None, None, None, "91:9"), (None, None, None, "high dr"), (None, "-", None, "91:9"), ("", "", "", "")]
    assert [r[0] for r in run(spark, cases, passes)] == [True, False, False, True, True, False, False, False]


@pytest.mark.parametrize(("objective", "expected"), [(m.COMBINED, ["eligible", "missing_or_invalid_ee", "ambiguous_er_without_ee", "missing_or_invalid_yield", "missing_or_invalid_ee"]), (m.YIELD_ONLY, ["has_ee", "eligible", "ambiguous_er_without_ee", "missing_or_invalid_yield", "invalid_ee"])])
def test_eligibility(spark, objective, expected):
    cases = [("80%", "90%", None), ("80%", "n.d.", ""), ("80%", None, "95:5/1:2"), ("trace", "90%", None), ("80%", "good", None)]
    assert [r[0] for r in run(spark, cases, m.eligibility(F.col("c0"), F.col("c1"), F.col("c2"), objective))] == expected


def test_unknown_objective_is_an_error(spark):
    with pytest.raises(ValueError, match="speed"):
        m.eligibility(F.lit("1"), F.lit("1"), F.lit("1"), "speed")


def test_metric_extraction(spark):
    text = F.col("c0")
    cases = ["obtained in 92% yield, 95% ee", "dr: >20:1", "er = 97:3", "85%", "95% ee"]
    assert one(spark, cases, m.extract_metric(text, "yield")) == ["92%", "", "", "85%", ""]
    assert one(spark, cases, m.extract_metric(text, "ee"))[0] == "95%"
    assert one(spark, cases, m.extract_metric(text, "dr"))[1] == ">20:1"
    assert one(spark, cases, m.extract_metric(text, "er"))[2] == "97:3"


def test_clean_text(spark):
    cases = {" a  b ": "a b", "None": "", "NULL ": "", "not specified": "", None: "", "a\n\tb": "a b", "unknown": "unknown"}
    assert one(spark, list(cases), t.clean_text(F.col("c0"))) == list(cases.values())


def test_symbols_and_names(spark):
    assert one(spark, ["(3-k)", " 3K ", None], t.normalize_symbol(F.col("c0"))) == ["3k", "3k", ""]
    assert one(spark, ["CuI (5 mol%), 2.0 equiv", "toluene, 3 mL", "a/b"], t.main_token(F.col("c0"))) == ["CuI", "toluene", "a"]
    assert one(spark, ["c1ccccc1", "benzene", "CC(=O)O", "3a", "", "CCO"], t.looks_like_smiles(F.col("c0"))) == [True, False, True, False, False, True]
    assert one(spark, ["Step 2", "2", "0", "two", "step 03"], t.step_number(F.col("c0"))) == [2, 2, None, None, 3]
    assert one(spark, ["a/b/Paper_X_si_0123abcd.json", "paper.pdf"], t.paper_key(F.col("c0"))) == ["paper_x", "paper"]


def test_series_labels(spark):
    label = t.underspecified_label(F.col("c0"), F.col("c1"))
    assert [r[0] for r in run(spark, [("3", "3k"), ("3j", "3k"), ("3", "4k"), ("x", "3k"), ("3", "3")], label)] == [True, False, False, False, False]


def test_grouping_text_folds_punctuation_only(spark):
    cases = ["25 °C, (dry)", "25 °C dry", "2 hours; 3 μL", "2 h 3 uL", "Pd2(dba)3, 5 mol %x"]
    assert one(spark, cases, t.grouping_text(F.col("c0"))) == ["25 degc dry", "25 degc dry", "2 h 3 ul", "2 h 3 ul", "pd2 dba 3 5 mol%x"]
    assert one(spark, ["Pd2(dba)3, x"], t.grouping_text(F.col("c0"), "name")) == ["pd2(dba)3 x"]


def test_pages(spark):
    assert one(spark, ["p. 3, 12 and 3", "0", ""], t.page_numbers(F.col("c0"))) == [[3, 12], [], []]
    assert one(spark, ["--- Page 2 ---\nx\n--- Page 1 ---"], t.marked_pages(F.col("c0"))) == [[1, 2]]
    assert one(spark, ["The product was isolated in 90% yield", "nothing here"], t.page_score(F.col("c0"))) == [4, 0]


def test_formulas(spark):
    assert one(spark, ["K2CO3 and Xx9 in CH2Cl2, NaOH", "He said", "2NaHCO3 aq"], t.formula_candidates(F.col("c0"))) == [["CH2Cl2", "K2CO3"], [], ["NaHCO3"]]
    assert one(spark, ['```json\n{"a": 1}\n```'], t.strip_fence(F.col("c0"))) == ['{"a": 1}']


def test_spaces_and_compounds_as_written_before(spark):
    spaces = [chr(i) for i in range(0x3100) if i != 0xD800]
    rows = spark.createDataFrame([(w + x + "a" + w + "b" + x + w + " c" + w + x,) for w in spaces for x in ("", " ", "\n")], "v string")
    ends = F.regexp_replace("v", r"(?U)^\s+|\s+$", "")
    assert not rows.filter(~t.strip(F.col("v")).eqNullSafe(ends) | ~t.squeeze(F.col("v")).eqNullSafe(F.regexp_replace(ends, r"(?U)\s+", " "))).count()
    given = {"name": F.lit("n"), "step": F.lit(3), "substituents": F.array(F.lit("s"), F.lit(None).cast("string"))}
    parsed = F.from_json(F.to_json(F.struct(*[v.alias(k) for k, v in given.items()])), schemas.COMPOUND)
    assert spark.range(1).select(schemas.compound(**given).alias("a"), parsed.alias("b")).filter("a = b or to_json(a) = to_json(b)").count() == 1
