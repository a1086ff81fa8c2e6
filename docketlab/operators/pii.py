"""Pages with sensitive content: cards, security numbers, birth dates, penal terms and pages with few words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.similarity import luhn_ok
from ..functions.text import _text, low_words

# Shapes of card numbers (one kind of separator in each), brands by digits, birth-date labels, dates that
# may follow, and penal terms.
CARD_GROUPS = ((4, 4, 4, 4), (4, 6, 5), (4, 4, 4, 2), (6, 6, 2))
CARD_LENGTHS = (16, 15, 14)
BRANDS = (
    ("Visa", "4", 16), ("Mastercard", "5[1-5]|222[1-9]|22[3-9][0-9]|2[3-6][0-9]{2}|27[01][0-9]|2720", 16), ("American Express", "34|37", 15),
    ("Discover", "6011|65|64[4-9]", 16), ("Diners Club", "36|38", 14), ("JCB", "352[8-9]|35[3-8][0-9]", 16),
)
BIRTH_LABELS = (
    r"\bdate\s+of\s+birth\s*:?", r"\bbirth\s+date\s*:?", r"\bbirthdate\s*:?", r"\bd\.?\s*o\.?\s*b\.?\s*:?", r"\bdob\b\s*:?", r"\bdate\s+of\s+birth\s*\(?.*?\)?\s*:?", r"\bbirth\s*date\s*\(?.*?\)?\s*:?",
    r"\bborn\s+on\s*:?", r"\bborn\b\s*:?", r"\bdate\s+born\s*:?", r"\bpatient\s+(?:date\s+of\s+)?birth\s*:?", r"\bsubject\s+(?:date\s+of\s+)?birth\s*:?", r"\bvictim\s+(?:date\s+of\s+)?birth\s*:?",
    r"\bwitness\s+(?:date\s+of\s+)?birth\s*:?", r"\bdt\.?\s+of\s+birth\s*:?", r"\bbirth\s+dt\.?\s*:?",
)
_MONTH = "(?:january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)"
_DAY, _YEAR, _SEP, _OPT = r"(?:0?[1-9]|[12][0-9]|3[01])(?:st|nd|rd|th)?", r"(?:19|20)\d{2}", r"[\s\-/.,]+", r"[\s\-/.,]*"
BIRTH_DATES = (
    rf"\d{{1,2}}{_SEP}\d{{1,2}}{_SEP}{_YEAR}", rf"{_YEAR}{_SEP}\d{{1,2}}{_SEP}\d{{1,2}}", rf"\d{{1,2}}{_SEP}\d{{1,2}}{_SEP}\d{{2}}", rf"{_MONTH}{_SEP}{_DAY}{_OPT},{_OPT}{_YEAR}", rf"{_DAY}{_SEP}{_MONTH}{_OPT},{_OPT}{_YEAR}",
    rf"{_MONTH}{_SEP}{_DAY}{_SEP}{_YEAR}", rf"{_DAY}{_SEP}{_MONTH}{_SEP}{_YEAR}", rf"{_MONTH}{_OPT},{_OPT}{_YEAR}", rf"{_MONTH}{_SEP}{_YEAR}",
)
PENAL_TERMS = (
    r"368(?:\(b\))?(?: -)? elder abuse", "corporal injury cohabitant/spouse", "battery on a spouse", "kidnap to commit sex crime", r"220(?:\(a\))?(?: -)? sexual assault", "human sex trafficking",
    r"243\.4(?:\([acde]\))?(?: -)? sexual battery", "rape", "prostitution", "child sex abuse", "incest", "sodomy", "oral copulation with minors/forced", "lewd acts with children", "sexual penetration",
    "repeated sexual abuse of a child", "possession of child pornography", "indecent exposure",
)
WINDOW, LATEST = 25, 5


def card_candidates(c) -> Column:
    """Digits of everything shaped like a card number."""
    t = _text(c)
    shapes = [r"\b" + sep.join(rf"\d{{{n}}}" for n in groups) + r"\b" for groups in CARD_GROUPS for sep in (r"\s", "-", r"\.")] + [rf"\b\d{{{n}}}\b" for n in CARD_LENGTHS]
    found = F.concat(*[F.regexp_extract_all(t, F.lit(p), F.lit(0)) for p in shapes])
    return F.transform(found, lambda x: F.regexp_replace(x, r"[\s.\-]", ""))


def card_brand(c) -> Column:
    out = F.lit(None).cast("string")
    for name, prefix, n in reversed(BRANDS):
        out = F.when((F.length(c) == n) & c.rlike(f"^(?:{prefix})"), name).otherwise(out)
    return out


def cards(c) -> Column:
    """(number, brand) structs of valid card numbers in a text."""
    return F.transform(F.filter(card_candidates(c), lambda x: card_brand(x).isNotNull() & luhn_ok(x)), lambda x: F.struct(x.alias("number"), card_brand(x).alias("brand")))


def has_card(c) -> Column:
    # The cheap test keeps the patterns away from most texts.
    return F.when(_text(c).rlike(r"\d{4}"), F.exists(card_candidates(c), lambda x: card_brand(x).isNotNull() & luhn_ok(x))).otherwise(False)


def has_ssn(c) -> Column:
    return (F.length(_text(c)) >= 15) & _text(c).rlike(r"\d{3}-\d{2}-\d{4}")


def has_birth_date(c) -> Column:
    """A birth label, and a date whose first place is up to five characters after it (one line break at most between).

    As only a pattern's first match after a label counts, the patterns may not match before the place allowed: a lazy
    gap before each date finds its first place, and the gap is bounded.
    """
    t, lazy = _text(c), [label.replace(".*?", "[^\n]*?") for label in BIRTH_LABELS]
    after = F.concat(*[F.regexp_extract_all(t, F.lit(rf"(?is){label}(?=(.{{0,{WINDOW}}}))"), F.lit(1)) for label in lazy])
    follows = [_follows(rf"(?is)^((?:(?!{date}).){{0,{LATEST}}}){date}") for date in BIRTH_DATES]
    # Labels are looked for once for all kinds of dates, and a stretch after several of them is tested once.
    out = F.exists(F.array_distinct(after), lambda x: reduce(lambda a, b: a | b, [f(x) for f in follows]))
    return F.when(t.rlike(r"(?i)birth|born|\bd\.?\s*o\.?\s*b"), out).otherwise(False)


def _follows(pattern: str):
    """Test of a stretch of text: a date by the pattern, with one line break at most before it."""

    def test(x: Column) -> Column:
        return (F.length(F.trim(x)) >= 3) & x.rlike(pattern) & (F.regexp_count(F.regexp_extract(x, pattern, 1), F.lit("\n")) <= 1)

    return test


def has_penal_term(c) -> Column:
    return _text(c).rlike("(?i)" + "|".join(PENAL_TERMS))


#: Reasons in the order in which they are reported.
CLASSIFIERS = {"dob": has_birth_date, "card": has_card, "ssn": has_ssn}


def flagged_pages(pages: DataFrame, file_col: str, page_col: str, text_col: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """``file, page, reasons`` for each page with a reason; ``extra`` adds flags from elsewhere, which come first."""
    flags = (extra or {}) | {k: f(text_col) for k, f in CLASSIFIERS.items()}
    reasons = F.array_compact(F.array(*[F.when(flag, F.lit(k)) for k, flag in flags.items()]))
    return pages.select(F.col(file_col).alias("file"), F.col(page_col).alias("page"), reasons.alias("reasons")).where(F.size("reasons") > 0)


def file_report(flagged: DataFrame) -> DataFrame:
    """``file, pages, structured``: the pages of each file in order, and as JSON with their reasons."""
    entry = F.struct("page", F.col("reasons").alias("classifiers"))
    return flagged.groupBy("file").agg(F.array_join(F.array_sort(F.collect_set(F.col("page").cast("long"))).cast("array<string>"), ", ").alias("pages"), F.to_json(F.array_sort(F.collect_list(entry))).alias("structured"))


def penal_files(pages: DataFrame, file_col: str, text_col: str) -> DataFrame:
    """Whether any of a file's pages has a penal term."""
    return pages.groupBy(F.col(file_col).alias("file")).agg(F.max(has_penal_term(text_col)).alias("penal"))


def image_page_candidates(pages: DataFrame, text_col: str, threshold: int = 20) -> DataFrame:
    """Pages of few words, which a scorer of images would look at; its score is joined as a column."""
    return pages.where(low_words(text_col, threshold))
