"""Yields, excesses and ratios: parsing, conversion, eligibility and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from retort.functions import vocab
from retort.functions.text import clean_text, one_of, strip

# What a number, a ratio and a percentage look like.
_NUMBER = r"\d+(?:\.\d+)?"
_RATIO = rf"(?i)\A\s*(>=|>|≥)?\s*({_NUMBER})\s*[:：/]\s*({_NUMBER})\s*(?:e\.?\s*r\.?)?\s*(?:\(\s*\d+[a-z]?[RSEZ](?:\s*,\s*\d+[a-z]?[RSEZ])*\s*\))?\s*\z"
_SIGN = "[<>≥≤~]?"
_PERCENT = rf"[<>≥≤~]?\s*{_NUMBER}\s*%?"
_PAIR = rf"[<>≥≤~]?\s*{_NUMBER}\s*[:/]\s*[<>≥≤~]?\s*{_NUMBER}"
# Patterns by metric, in the order in which they are tried.
METRIC_PATTERNS = {
    "yield": (rf"(?i)({_PERCENT})\s*(?:yield|isolated)", rf"(?i)yield\s*[:=]?\s*({_PERCENT})", rf"(?i)\A([<>≥≤~]?\s*{_NUMBER}\s*%)\z"),
    "ee": (rf"(?i)({_PERCENT})\s*ee", rf"(?i)ee\s*[:=]?\s*({_PERCENT})"),
    "er": (rf"(?i)er\s*[:=]?\s*({_PAIR})", rf"(?i)({_PAIR})\s*er"),
    "dr": (rf"(?i)dr\s*[:=]?\s*({_PAIR})", rf"(?i)({_PAIR})\s*dr"),
}
TARGET_CUE = (
    r"(?i)(?:\b\d{1,3}(?:\.\d+)?\s*%(?:\s*\([^)]{1,80}\))?\s*(?:yield|ee|e\.e\.)\b|\byield\s*\d{1,3}(?:\.\d+)?\s*%"
    rf"|\b(?:er|dr)\s*[:=]?\s*{_SIGN}\s*{_NUMBER}\s*[:/]\s*{_NUMBER}|{_SIGN}\s*{_NUMBER}\s*[:/]\s*{_NUMBER}\s*\b(?:er|dr)\b)"
)
COMBINED, YIELD_ONLY = "combined_ee_yield", "yield_only"


def parse_percentage(value: Column) -> Column:
    """The number of a text with just one percentage, or of a bare number, if it is between 0 and 100; else null."""
    text = F.replace(strip(value), F.lit("％"), F.lit("%"))
    found = F.regexp_extract_all(text, F.lit(rf"(?<![\d.])(?:[<>≤≥~≈]\s*)?({_NUMBER})\s*%"), 1)
    bare = F.nullif(F.regexp_extract(text, rf"\A[<>≤≥~≈]?\s*({_NUMBER})\z", 1), F.lit(""))
    number = F.when(F.size(found) == 1, F.try_element_at(found, F.lit(1))).when(F.size(found) == 0, bare).try_cast("double")
    return F.when(number.between(0, 100), number)


def parse_er(er: Column) -> Column:
    """struct<ee double, threshold boolean, status> of an enantiomeric ratio; ee is null where the status says why."""
    text = strip(er)
    major, minor = F.regexp_extract(text, _RATIO, 2).try_cast("double"), F.regexp_extract(text, _RATIO, 3).try_cast("double")
    qualified = F.regexp_extract(text, _RATIO, 1) != ""
    several = F.size(F.regexp_extract_all(text, F.lit(rf"({_NUMBER}\s*[:：]\s*{_NUMBER})"), 1)) > 1
    status = (
        F.when(one_of(er, vocab.UNREPORTED), "explicitly_unreported")
        .when(major.isNull() & several, "ambiguous_multiple_ratios")
        .when(major.isNull(), "invalid_format")
        .when(major + minor <= 0, "invalid_ratio")
        .when(qualified & (major < minor), "invalid_qualified_ratio")
        .when(qualified, "converted_threshold")
        .otherwise("converted_exact")
    )
    ee = F.when(status.startswith("converted"), F.abs(major - minor) / (major + minor) * 100)
    return F.struct(ee.alias("ee"), qualified.alias("threshold"), status.alias("status"))


def ee_text(er: Column) -> Column:
    """The excess as it is written: "90%", ">98%"; whole numbers without decimals, others with one."""
    parsed, text = parse_er(er), strip(er)
    sign = F.regexp_extract(text, _RATIO, 1)
    sign = F.when(sign == "≥", ">=").otherwise(sign)
    number = F.when(parsed["ee"] == F.floor(parsed["ee"]), F.format_string("%.0f", parsed["ee"])).otherwise(F.format_string("%.1f", F.bround(parsed["ee"].cast("decimal(38,30)"), 1).cast("double")))
    return F.when(parsed["ee"].isNotNull(), F.concat(sign, number, F.lit("%")))


def convert_er(ee: Column, er: Column) -> Column:
    """struct<ee, er, status>: an excess is derived from the ratio only where none is given by the merge's vocabulary."""
    status = F.when(one_of(er, vocab.MERGE_EMPTY), "no_er").when(~one_of(ee, vocab.MERGE_EMPTY), "existing_ee").otherwise(parse_er(er)["status"])
    given = F.when(~one_of(ee, vocab.MERGE_EMPTY), ee)
    return F.struct(F.when(status.startswith("converted"), ee_text(er)).otherwise(given).alias("ee"), F.when(~one_of(er, vocab.MERGE_EMPTY), er).alias("er"), status.alias("status"))


def clean_ratio(value: Column, metric: str) -> Column:
    """A ratio without its own name around it: ">20:1 dr" and "dr = 95:5"; null for words that mean nothing."""
    text = F.regexp_replace(F.regexp_replace(strip(value), rf"(?i)\A\s*{metric}\b\s*(?:=|:)?\s*", ""), rf"(?i)\s+{metric}\b\s*\z", "")
    return F.when(~one_of(value, vocab.METRIC_EMPTY), F.nullif(strip(text), F.lit("")))


def peel_parentheses(value: Column) -> Column:
    """Without the brackets around the whole text, however many pairs, and without white space between them."""
    text = strip(value)
    count = lambda run, sign: F.char_length(F.regexp_replace(F.regexp_extract(text, run, 0), rf"[^{sign}]", ""))
    pairs = F.least(count(r"\A[\s(]*", r"("), count(r"[\s)]*\z", r")"))
    cut = lambda sign, n: F.char_length(F.call_function("substring_index", text, F.lit(sign), n)) + 1
    head, tail = cut("(", pairs), cut(")", -pairs)
    return strip(F.when(pairs > 0, F.substring(text, head + 1, F.char_length(text) - head - tail)).otherwise(text))


def number_or_ratio(value: Column) -> Column:
    """Whether the text begins with a number or a ratio."""
    return F.coalesce(F.lower(strip(value)).rlike(rf"(?i)\A{_SIGN}\s*{_NUMBER}"), F.lit(False))


def whole_ratio(value: Column) -> Column:
    """Whether the whole text is a ratio."""
    full = strip(value).rlike(rf"(?i)\A{_SIGN}\s*{_NUMBER}\s*[:/]\s*{_SIGN}\s*{_NUMBER}(?:\s*(?:er|dr))?\z")
    return F.coalesce(full, F.lit(False)) & ~one_of(value, vocab.TARGET_PLACEHOLDERS)


def reported(value: Column) -> Column:
    return ~one_of(value, ("", *vocab.TARGET_PLACEHOLDERS))


def target_passes(yield_: Column, ee: Column, er: Column, dr: Column) -> Column:
    """Whether a reaction has a usable outcome: a negative yield or excess rules it out, any of the four lets it in."""
    negative = F.coalesce(strip(yield_).startswith("-"), F.lit(False)) | F.coalesce(strip(ee).startswith("-"), F.lit(False))
    return ~negative & (reported(yield_) | reported(ee) | number_or_ratio(er) | whole_ratio(dr))


def eligibility(yield_: Column, ee: Column, er: Column, objective: str) -> Column:
    """`eligible`, or the first reason why not, for an objective."""
    y, e = parse_percentage(yield_), parse_percentage(ee)
    silent = lambda v: one_of(v, vocab.UNREPORTED)
    reason = F.when(y.isNull(), "missing_or_invalid_yield")
    if objective == COMBINED:
        return reason.when(e.isNull() & ~silent(er), "ambiguous_er_without_ee").when(e.isNull(), "missing_or_invalid_ee").otherwise("eligible")
    if objective == YIELD_ONLY:
        return reason.when(e.isNotNull(), "has_ee").when(~silent(ee), "invalid_ee").when(~silent(er), "ambiguous_er_without_ee").otherwise("eligible")
    raise ValueError(f"unknown objective {objective!r}; known are {COMBINED} and {YIELD_ONLY}")


def score(yield_: Column, ee: Column, er: Column, objective: str) -> Column:
    """Mean of yield and excess, or the yield alone; null where not eligible."""
    y, e = parse_percentage(yield_), parse_percentage(ee)
    return F.when(eligibility(yield_, ee, er, objective) == "eligible", (y + e) / 2 if objective == COMBINED else y)


def legacy_score(yield_: Column, ee: Column) -> Column:
    """Mean of what is there; null if nothing is."""
    y, e = parse_percentage(yield_), parse_percentage(ee)
    return F.coalesce((y + e) / 2, y, e)


def extract_metric(text: Column, metric: str) -> Column:
    """The first value of a metric in free text, by the metric's patterns in order; "" if none. A text that names other
    metrics only has no yield."""
    text = clean_text(text)
    found = F.coalesce(*[F.nullif(strip(F.regexp_extract(text, p, 1)), F.lit("")) for p in METRIC_PATTERNS[metric]], F.lit(""))
    if metric != "yield":
        return found
    return F.when(~F.lower(text).contains("yield") & text.rlike(r"(?i)\b(?:ee|er|dr)\b"), F.lit("")).otherwise(found)


def target_cue(text: Column) -> Column:
    """Whether a passage names an outcome: a percentage of yield or excess, or a labelled ratio."""
    return F.coalesce(text, F.lit("")).rlike(TARGET_CUE)


def labelled_value(text: Column, label: str) -> Column:
    """What follows "label:" up to the next comma or semicolon."""
    return strip(F.regexp_extract(text, rf"(?i){label}\s*[:=]\s*([^;,]+)", 1))


def extract_temperature(text: Column) -> Column:
    return strip(F.regexp_extract(text, r"(?i)(-?\d+\s*(?:°C|C)\b|room temperature|rt\b)", 1))


def extract_time(text: Column) -> Column:
    return F.regexp_extract(text, r"(?i)(\d+(?:\.\d+)?\s*(?:h|hour|hours|min|minutes)\b)", 1)


def extract_amount(text: Column) -> Column:
    return F.regexp_extract(clean_text(text), r"(?i)(\d+(?:\.\d+)?\s*(?:mol%|equiv|mmol|mg|g|ml))", 1)
