"""Text normalisers as column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from retort.functions import vocab

#: White space as Unicode has it, the non-breaking space included.
_SPACES = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_RUN = r"(?U)\s+"
_QUANTITY = r"mol\s*%|equiv|mmol|mol|m|mg|g|ml"


def one_of(value: Column, words: Iterable[str]) -> Column:
    """Whether the trimmed value is one of the words, case aside; never null."""
    return F.coalesce(F.lower(strip(value)).isin(*words), F.lit(True) if "" in words else F.lit(False))


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(_SPACES))


def squeeze(value: Column) -> Column:
    return F.regexp_replace(strip(value), _RUN, " ")


def clean_text(value: Column, empty: Iterable[str] = vocab.KG_EMPTY) -> Column:
    """Trimmed and single-spaced; "" for null and for the words that mean nothing.

    The value stands in it once: normalisers are nested, and each repetition would double the plan.
    """
    words = "|".join(re.escape(w) for w in empty if w)
    return F.coalesce(F.regexp_replace(F.regexp_replace(strip(value), rf"(?i)\A(?:{words})\z", ""), _RUN, " "), F.lit(""))


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with the value computed once however often f names it: inside lambdas Spark computes each mention anew."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def clean_list(values: Column, glue: str = ", ", empty: Iterable[str] = vocab.KG_EMPTY) -> Column:
    """The cleaned items of an array that are left, joined."""
    cleaned = F.transform(values, lambda v: clean_text(v, empty))
    return F.coalesce(F.array_join(F.filter(cleaned, lambda v: v != ""), glue), F.lit(""))


def first_text(*values: Column) -> Column:
    """The first that isn't empty after cleaning, else "". Values behind it aren't cleaned, and each stands in it once."""
    some = lambda v: F.get(F.filter(F.array(clean_text(v)), lambda x: x != ""), F.lit(0))
    return F.coalesce(*[some(v) for v in values], F.lit(""))


def normalize_iupac(value: Column) -> Column:
    """Lower-cased, all dashes one, single-spaced."""
    return F.translate(F.lower(clean_text(value)), "‐‑‒–—−", "------")


def normalize_symbol(value: Column) -> Column:
    return F.regexp_replace(F.lower(clean_text(value)), "[^a-z0-9]+", "")


def strip_amounts(value: Column) -> Column:
    """Without quantities, in brackets or bare, and without the notes that mark doubt about a label."""
    text = F.regexp_replace(clean_text(value), rf"(?i)\([^)]*(?:{_QUANTITY}|yield|ee|er|dr|isolated)[^)]*\)", "")
    text = F.regexp_replace(text, rf"(?i)\b\d+(?:\.\d+)?\s*(?:{_QUANTITY}|%)\b", "")
    text = F.regexp_replace(text, r"(?i)\b(?:the label maybe wrong|please check the image again)\b", "")
    return clean_text(F.btrim(text, F.lit(" ,;")))


def main_token(value: Column) -> Column:
    return clean_text(F.split(strip_amounts(value), "[,;/]", 2)[0])


def is_uncertain(value: Column) -> Column:
    text = F.lower(clean_text(value))
    found = F.lit(False)
    for words in vocab.UNCERTAIN:
        found = found | text.contains(words)
    return found


def looks_like_smiles(value: Column) -> Column:
    text = clean_text(value)
    body = text.rlike(r"[/\\=#\[\]@+]") | text.rlike(r"[cnops]\d") | text.rlike(r"\d.*[cnops]|[cnops].*\d")
    plain = (F.char_length(text) >= 3) & text.rlike(r"\A[BCNOFPSIclbrH0-9().-]+\z")
    return (text != "") & ~text.contains(" ") & (body | plain)


def looks_like_symbol(value: Column) -> Column:
    return clean_text(value).rlike(r"\A[0-9][a-zA-Z0-9]{0,4}\z")


def is_obvious_generic(name: Column) -> Column:
    """Whether a name stands for a class of compounds and not for one."""
    text = F.lower(strip(name))
    some = F.lit(False)
    for part in vocab.GENERIC_PARTS:
        some = some | text.contains(part)
    return F.coalesce((text != "") & (text.isin(*vocab.OBVIOUS_GENERIC) | (F.char_length(text) < 20) & some), F.lit(False))


def quick_class(name: Column) -> Column:
    """`Q2` for a label or a class of compounds, of which a provider needn't be asked; else null."""
    return F.when(F.coalesce(strip(name).rlike(r"\A[0-9][a-zA-Z0-9]{0,4}\z"), F.lit(False)) | is_obvious_generic(name), "Q2")


def paper_key(source: Column) -> Column:
    """The stem of a path, without "_si" and a trailing eight-digit hash, lower-cased."""
    stem = F.regexp_replace(F.element_at(F.split(clean_text(source), r"[/\\]"), -1), r"\.[^.]*$", "")
    return F.lower(F.regexp_replace(F.regexp_replace(stem, r"(?i)_si(?=_|$)", ""), r"(?i)_[0-9a-f]{8}$", ""))


def paper_name(explicit: Column, source: Column, fallback: Column) -> Column:
    stem = F.regexp_replace(F.element_at(F.split(first_text(source, fallback), "/"), -1), r"(?<=.)\.[^.]*$", "")
    return F.coalesce(F.nullif(clean_text(explicit), F.lit("")), F.replace(stem, F.lit("_si"), F.lit("")))


def reliable_name(name: Column, symbol: Column, label: Column) -> Column:
    """The name, unless it is only the compound's symbol or a generic word."""
    plain = lambda text: F.regexp_replace(F.lower(text), "[^a-z0-9]+", "")  # noqa: E731  normalize_symbol() of a cleaned text
    own = lambda x: (x["mark"] != "") & (plain(x["text"]) == normalize_symbol(x["mark"]))
    both = F.struct(clean_text(name).alias("text"), first_text(symbol, label).alias("mark"))
    return bound(both, lambda x: F.when(own(x) | F.lower(x["text"]).isin(*vocab.GENERIC_NAMES), F.lit("")).otherwise(x["text"]))


def step_number(value: Column, zero: bool = False) -> Column:
    """A positive step of "2" or "Step 2", else null; one caller also takes 0."""
    step = F.nullif(F.regexp_extract(strip(value.cast("string")), r"(?i)\A(?:step\s*)?(\d+)(?:\.0+)?\z", 1), F.lit("")).try_cast("int")
    return step if zero else F.when(step > 0, step)


def effective_role(refined: Column, original: Column, default: str | None = vocab.TERMINAL_ROLE) -> Column:
    """The refined role unless unknown, else the original one, else the default."""
    role = lambda v: F.nullif(F.replace(F.lower(clean_text(v)), F.lit("_"), F.lit(" ")), F.lit(""))
    return F.coalesce(F.nullif(role(refined), F.lit("unknown")), role(original), F.lit(default))


def direct_role(role: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in vocab.DIRECT_ROLES.items() for x in pair])
    text = F.replace(F.lower(clean_text(role)), F.lit("_"), F.lit(" "))
    return F.coalesce(F.try_element_at(known, text), text)


def page_numbers(value: Column, allowed: Column | None = None) -> Column:
    """The distinct positive numbers in a text, ascending; only the allowed ones if given."""
    pages = F.array_sort(F.array_distinct(F.filter(F.transform(F.regexp_extract_all(value, F.lit(r"(\d+)"), 1), lambda p: p.try_cast("int")), lambda p: p > 0)))
    return pages if allowed is None else F.array_sort(F.array_intersect(pages, allowed))


def marked_pages(text: Column) -> Column:
    """The pages that "--- Page N ---" lines name."""
    pages = F.transform(F.regexp_extract_all(text, F.lit(r"--- Page\s+(\d+)\s+---"), 1), lambda p: p.try_cast("int"))
    return F.array_sort(F.array_distinct(F.filter(pages, lambda p: p > 0)))


def grouping_text(value: Column, mode: str = "condition") -> Column:
    """A key under which spellings of one condition meet: units, dashes and punctuation are folded, nothing is inferred.

    In `name` mode brackets stay, as they belong to chemical names.
    """
    text = F.translate(F.lower(strip(value)), "μµ–—−，；：（）", "uu---,;:()")
    text = F.replace(text, F.lit("°"), F.lit("deg"))

    def units(text: Column) -> Column:
        for pattern, unit in (
            (r"\bhours?\b|\bhrs?\b", "h"),
            (r"\bminutes?\b|\bmins?\b", "min"),
            (r"\bmicrolit(?:er|re)s?\b|\bu\s*l\b", "ul"),
            (r"\bdeg\s*c\b", "degc"),
            (r"\bmol\s*%\b", "mol%"),
        ):
            text = F.regexp_replace(text, pattern, unit)
        return text

    # Most texts hold no unit, and one look tells so; the text is the one element of an array, so that it is made once.
    text = F.transform(F.array(text), lambda x: F.when(x.rlike(r"hour|hr|min|microlit|u\s*l|deg|mol"), units(x)).otherwise(x))[0]
    marks = ",;:" if mode == "name" else "()[]{},;:"
    text = F.translate(text, marks, " " * len(marks))
    return F.coalesce(squeeze(text), F.lit(""))


def underspecified_label(known: Column, label: Column) -> Column:
    """Whether `known` ("3") lacks only the letters of `label` ("3k")."""
    number = lambda v: F.regexp_extract(F.lower(strip(v)), r"\A(\d+)[a-z]*\z", 1)
    letters = lambda v: F.regexp_extract(F.lower(strip(v)), r"\A\d+([a-z]*)\z", 1)
    return F.coalesce((number(known) != "") & (number(known) == number(label)) & (letters(known) == "") & (letters(label) != ""), F.lit(False))


def trailing_symbol(name: Column) -> Column:
    """struct<name, symbol> of "benzaldehyde (3a)"; only numeric labels count as symbols."""
    pattern = r"\A(.*?)\s*\((\d+[a-z]?)\)\s*\z"
    symbol = F.regexp_extract(name, pattern, 2)
    return F.struct(F.when(symbol != "", F.regexp_extract(name, pattern, 1)).otherwise(name).alias("name"), F.nullif(symbol, F.lit("")).alias("symbol"))


def page_score(text: Column) -> Column:
    """Three for each quantitative word, one for each word of the trade; a page of 3 or more is relevant.

    Words are folded over as an array: written out, they would outgrow what one method may hold and leave compiled code.
    """
    weighed = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(n).alias("n")) for words, n in ((vocab.QUANTITATIVE_WORDS, 3), (vocab.CHEMISTRY_WORDS, 1)) for w in words])
    count = lambda page, x: (F.octet_length(page) - F.octet_length(F.replace(page, x["w"], F.lit("")))) / F.octet_length(x["w"])
    score = lambda page: F.aggregate(weighed, F.lit(0), lambda done, x: done + (x["n"] * count(page, x)).cast("int"))
    # The page is the one element of an array, so that it is lower-cased once and not for each word.
    return F.transform(F.array(F.lower(F.coalesce(text, F.lit("")))), score)[0]


def join_pages(pages: Column) -> Column:
    """One text of many: words cut by a hyphen at a line's end are made whole, single line breaks become spaces."""
    text = F.array_join(pages, "\n")
    return F.regexp_replace(F.regexp_replace(text, r"-\n(?=\w)", ""), r"(?<!\n)\n(?!\n)", " ")


def strip_fence(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?i)\A\s*```(?:json)?|```\s*\z", ""))


def safe_stem(text: Column) -> Column:
    """A file name of a text: harmless characters, and eight digits of its hash."""
    return F.concat(F.substring(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), 1, 50), F.lit("_"), F.substring(F.md5(text.cast("binary")), 1, 8))


def formula_candidates(text: Column) -> Column:
    """Distinct runs of elements and counts, white space between them aside, that their parts rebuild: every part an element,
    no count above 32 and at least one given."""
    spaced = F.regexp_extract_all(text, F.lit(r"(?<![A-Za-z])((?:[A-Z][a-z]?(?:\s*\d+)?\s*){2,})(?![a-z])"), 1)
    joined = F.transform(spaced, lambda f: F.regexp_replace(f, r"\s+", ""))
    found = F.filter(joined, lambda f: F.array_join(F.regexp_extract_all(f, F.lit(r"([A-Z][a-z]?\d*)"), 1), "") == f)
    known = F.array(*[F.lit(e) for e in vocab.ELEMENTS])
    parts = lambda f: F.regexp_extract_all(f, F.lit(r"([A-Z][a-z]?)\d*"), 1)
    counts = lambda f: F.regexp_extract_all(f, F.lit(r"(\d+)"), 1)
    return F.array_sort(
        F.array_distinct(F.filter(found, lambda f: F.forall(parts(f), lambda e: F.array_contains(known, e)) & (F.size(counts(f)) > 0) & F.forall(counts(f), lambda n: n.try_cast("int") <= 32)))
    )
