"""String functions on columns: case keys, identifiers, person and agency names, paths and text clean-up."""

from __future__ import annotations

import re
from string import Template

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def case_key(c) -> Column:
    """Lower case without any white space; null becomes empty."""
    return F.regexp_replace(F.lower(_text(c)), r"\s+", "")


def case_id(c) -> Column:
    """Upper case letters and digits alone, without leading zeros of each run of digits."""
    return F.regexp_replace(F.regexp_replace(F.upper(F.trim(_text(c))), "[^A-Z0-9]", ""), r"(?<![0-9])0+(?=[0-9])", "")


def _set(values: Column) -> Column:
    return F.array_sort(F.array_distinct(values))


def case_id_set(values) -> Column:
    return _set(F.filter(F.transform(F.coalesce(_col(values), F.array().cast("array<string>")), case_id), lambda x: x != ""))


# Titles that person names lose anywhere. After an abbreviation's point a boundary is needed, so "Sgt. X"
# keeps "Sgt.", while "Sgt.X" does not.
TITLE_WORDS = ("Officer", r"Off\.", r"Ofc\.", "Detective", r"Det\.", "Sergeant", r"Sgt\.", "Lieutenant", r"Lt\.", "Corporal", r"Cpl\.", "Chief", "Sheriff", "Deputy", r"Mr\.", r"Mrs\.", r"Ms\.", r"Dr\.")


def person_name(c) -> Column:
    """Lower case without titles and punctuation, single spaces."""
    bare = F.regexp_replace(F.trim(_text(c)), r"(?iU)\b(?:" + "|".join(TITLE_WORDS) + r")\b", "")
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(bare), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def person_name_set(values) -> Column:
    return _set(F.filter(F.transform(F.coalesce(_col(values), F.array().cast("array<string>")), person_name), lambda x: F.length(x) >= 2))


def metadata_case_id(c) -> Column:
    return F.replace(F.upper(F.trim(_text(c))), F.lit("_"), F.lit("-"))


# Titles that a metadata name may begin with.
LEADING_TITLES = ("officer", "det.", "detective", "sgt.", "sergeant", "lt.", "lieutenant", "cpl.", "corporal", "chief", "sheriff", "deputy")


def metadata_name(c) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.trim(_text(c))), "^(?:" + "|".join(map(re.escape, LEADING_TITLES)) + ") ", ""))


# Ranks of several words in order of precedence, and single words that are no part of a name.
RANKS = (
    "Police Officer III+1", "Police Officer III", "Police Officer II", "Police Officer I", "Police Officer", "Fish and Wildlife Officer", "BART Officer", "K-9 Handler", "K-9 Officer", "K9 Handler", "K9 Officer",
    "Deputy U.S. Marshal", "U.S. Marshal", "S. Marshal", "RPD Officer", "RPD Sergeant", "Corrections Officer", "Correctional Officer", "Sr. DSO", "Sr. Officer", "Sr. Deputy", "Sergeant I", "DSO", "DO",
    "Police Department K-9 Officer", "Police Department Officers", "Desert Hot Springs Police Officer", "South Gate Police Officer", "Bluff Police Sergeant", "Chapman University Public Safety Officer", "Security Guard",
)
RANK_WORDS = (
    "Officer Sergeant Detective Corporal Deputy LAPD Traffic Unnamed Senior Lieutenant Correctional Director PSO K9 Special CHP Security Recruit CO DSOs SDSO SOIs "
    "Investigator DPO USBP Reserve Custody JIO DJCO Sheriff Does Additional Per Sacramento Responding CD FTO Agent First Chief Field Deputies Parole Four Hemet "
    "SACMCTF Assistant Team CA Other Supervisor Tactical Captain The Placer Acting PCO Detention RSO District SDPO Orange MCSO SPD Explorer Master E3 JTO Unidentified SWAT "
    "California Inspector SOT Three President Sgt Unit FBI Probation Warden Elk Patrol Unspecified MTA Ranger PCSO CSI OIC State Unknown COIV RCPD DPC five "
    "Supervising Claremont Two Group Main Cal Game Right Antioch SAPD Officers Canine METRO MPD Anaheim Trainee San Stockton Initial DA PO Jailer Uniformed SEB "
    'Cover Fire Detentions National Red Park Multiple Branch "Redacted" Sgt. Lt. Cpl. Det. Ofc. S/O P/O D/S FNU LNU II III IV El PC Constable Dep. Marshal Leader '
    "Specialist Counselor Witness"
).split()


def strip_rank(c) -> Column:
    """Without the first rank of several words that the name begins with, or else without a first word that is a rank."""
    name = F.trim(_text(c))
    long = r"(?i)^(?:" + "|".join(re.escape(r.lower()) for r in RANKS) + r") \s*"
    first = F.lower(F.substring_index(name, " ", 1))
    rest = F.when(F.instr(name, " ") > 0, F.regexp_replace(name, "^[^ ]* ", "")).otherwise("")
    return F.when(name.rlike(long), F.trim(F.regexp_replace(name, long, ""))).when(first.isin(sorted({w.lower() for w in RANK_WORDS})), rest).otherwise(name)


def clean_name(c) -> Column:
    """Without badge and other numbers, placeholders for unknown names, brackets with content, and a last comma or point."""
    out = F.trim(_text(c))
    for pattern in (r"#[0-9]+", r"\b[0-9]+\.?[0-9]*\b", r"(?i)\bFNU\b", r"(?i)\bLNU\b", r"\[.*?\]", r"\(.*?\)"):
        out = F.regexp_replace(out, pattern, "")
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(out, r"\s+", " ")), r"[,.]\s*$", ""))


def clean_officer_name(c) -> Column:
    return strip_rank(clean_name(strip_rank(c)))


# Words of names that are none, and patterns at the beginning of such strings.
NO_NAMES = ("redacted", "unknown", "not provided", "unidentified", "unnamed")
GROUP_WORDS = ("officers", "detectives", "deputies", "personnel", "agents", "does 1", "does through", "referred to as", "division officers", "team members", "response team", "pd detectives", "pd officers", "staff members")
NO_NAME_PATTERNS = (r"\w\.\s+\w+$", r"[A-Z]\.\s", r",\s*[A-Z]\.$", r"on\s+\w+$", r"[0-9]+\s+\w+$", r"involved\s+in", r"exact\s+", r"'s\s+team$")


def invalid_name(c) -> Column:
    name = F.trim(_text(c))
    words = F.lower(name)
    out = (name == "") | ~(F.contains(name, F.lit(" ")) | F.contains(name, F.lit(","))) | name.rlike(r"^[#0-9.\s]+$") | words.rlike(r"^k-?9\s+")
    for w in (*NO_NAMES, *GROUP_WORDS):
        out = out | F.contains(words, F.lit(w))
    return out | name.rlike("(?i)^(?:" + "|".join(NO_NAME_PATTERNS) + ")")


def complete_name(c) -> Column:
    """Whether a cleaned name has a space or a comma."""
    return F.trim(_text(c)).rlike(r"[ ,]")


def split_names(c) -> Column:
    """Array of the names in a string that lists them by comma, else by "and" (then in lower case), else by slash."""
    name = F.trim(_text(c))
    parts = F.when(F.contains(name, F.lit(",")), F.split(name, ",")).when(F.contains(F.lower(name), F.lit(" and ")), F.split(F.lower(name), " and ")).when(F.contains(name, F.lit("/")), F.split(name, "/")).otherwise(F.array(name))
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def name_parts(c) -> Column:
    """Struct of first, middle and last name and suffix, without points."""
    name = F.trim(F.regexp_replace(_text(c), r"\s+", " "))
    suffix = F.regexp_extract(name, r"(?i)\s+(Jr\.?|Sr\.?|III|II|IV)$", 1)
    rest = F.regexp_replace(name, r"(?i)\s+(Jr\.?|Sr\.?|III|II|IV)$", "")
    parts = F.split(rest, " ")
    n = F.size(parts)
    initial_last = (n == 2) & (F.length(F.element_at(parts, -1)) == 1)
    first = F.when(n >= 2, F.element_at(parts, 1)).otherwise("")
    middle = F.when(initial_last, F.element_at(parts, -1)).when(n > 2, F.array_join(F.slice(parts, 2, F.greatest(n - 2, F.lit(1))), " ")).otherwise("")
    last = F.when(initial_last, "").otherwise(F.element_at(parts, -1))
    bare = lambda x: F.replace(x, F.lit("."), F.lit(""))
    return F.struct(bare(first).alias("first_name"), bare(middle).alias("middle_name"), bare(last).alias("last_name"), bare(suffix).alias("suffix"))


def kept_name_row(first, last) -> Column:
    """Rows without a first name stay only if the last name has three spaces or more."""
    return (_text(first) != "") | (F.regexp_count(_text(last), F.lit(" ")) >= 3)


def mention_uid(*columns) -> Column:
    return F.sha2(F.concat_ws("|", *[F.trim(_text(c)) for c in columns]), 256)


def legacy_uid(*columns) -> Column:
    return F.sha1(F.lower(F.concat(*[_text(c) for c in columns])))


def prompt_key(*columns) -> Column:
    """Key under which a completion is cached."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def strip_fences(c) -> Column:
    return F.trim(F.regexp_replace(F.trim(_text(c)), r"^```[a-zA-Z]*\s*|\s*```$", ""))


# Phrases that summaries lose.
_NOTHING = r"No (?:responding|investigating) agencies identified on this page\.?\s*\n?"
_SCRUB = (
    (r"Updated summary:\s*", ""),
    (r"(?i)(?:RESPONDING|INVESTIGATING) AGENCIES:\s*\n\s*" + _NOTHING, ""),
    ("(?i)" + _NOTHING, ""),
    (r"(?i)No other agencies are explicitly named or described with investigative or responding roles on this page\.?\s*\n?", ""),
    (r"(?i)RESPONDING AGENCIES:\s*\n\s*(?=\n|INVESTIGATING|$)", ""),
    (r"(?i)INVESTIGATING AGENCIES:\s*\n\s*(?=\n|RESPONDING|$)", ""),
    (r"\n{3,}", "\n\n"),
)


def scrub_summary(c) -> Column:
    out = _text(c)
    for pattern, by in _SCRUB:
        out = F.regexp_replace(out, pattern, by)
    return F.regexp_replace(out, r"^\s+|\s+$", "")


def word_count(c) -> Column:
    return F.regexp_count(_text(c), F.lit(r"\S+"))


def low_words(c, threshold: int = 20) -> Column:
    return word_count(c) <= threshold


def meaningful_summary(c) -> Column:
    """Whether a summary says more than that there is nothing to say."""
    return (F.trim(_text(c)) != "") & ~F.lower(_text(c)).rlike("no officer|no civilian|no case|no date")


def _directories(c) -> Column:
    parts = F.filter(F.split(_text(c), "/"), lambda x: x != "")
    return F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))


def shared_depth(a, b) -> Column:
    """Leading directories that two paths have in common."""
    return common_depth(_directories(a), _directories(b))


def common_depth(x: Column, y: Column) -> Column:
    """Leading elements that two arrays of directories have in common."""
    n = F.least(F.size(x), F.size(y))
    same = F.zip_with(F.slice(x, 1, n), F.slice(y, 1, n), lambda p, q: p == q)
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(n).cast("int")


def directory_at(c, depth: int) -> Column:
    """The directory ``depth`` levels above the file's own."""
    x = _directories(c)
    return F.array_join(F.slice(x, 1, F.greatest(F.size(x) - depth, F.lit(0))), "/")


def full_path(path, name) -> Column:
    return F.when(F.endswith(_text(path), _text(name)), _text(path)).otherwise(F.concat(_text(path), F.lit("/"), _text(name)))


def extension(c) -> Column:
    return F.regexp_extract(F.lower(_text(c)), r"(\.[^.]*)$", 1)


# Words of agencies that are not law enforcement, and of those that are.
NOT_POLICE = ("district attorney", "attorney general", "public defender", "coroner", "medical examiner", " da ", " me ", "office of the da")
POLICE = ("police", "sheriff", "marshal", "patrol", "highway patrol", "probation", "corrections", "department of public safety", "public safety")


def _any_of(c: Column, words) -> Column:
    return c.rlike("|".join(map(re.escape, words)))


def is_law_enforcement(c) -> Column:
    return _any_of(F.lower(_text(c)), POLICE)


def is_not_law_enforcement(c) -> Column:
    padded = F.concat(F.lit(" "), F.lower(F.trim(_text(c))), F.lit(" "))
    return ~_any_of(padded, POLICE) & _any_of(padded, NOT_POLICE)


def guard_blocks(agencies, registry_agency) -> Column:
    """Whether all of an array's agencies are none of law enforcement while the registry's agency is."""
    return (F.size(_col(agencies)) > 0) & F.forall(_col(agencies), is_not_law_enforcement) & is_law_enforcement(registry_agency)


def tristate(c) -> Column:
    """TRUE, FALSE or UNCLEAR from what people write."""
    v = F.upper(F.trim(_text(c)))
    return F.when(v.isin("TRUE", "YES", "Y", "1", "T"), "TRUE").when(v.isin("FALSE", "NO", "N", "0", "F"), "FALSE").otherwise("UNCLEAR")


DOCUMENT_BREAK = "\n\n===== DOCUMENT BREAK =====\n\n"


def joined(texts, separator: str = DOCUMENT_BREAK) -> Column:
    return F.array_join(_col(texts), separator)


def render(template: str, **columns) -> Column:
    """``template`` with each ``$name`` replaced by the column of that name; unknown names stay."""
    out, at = [], 0
    for m in Template.pattern.finditer(template):
        name = m["named"] or m["braced"]
        if m["escaped"] is None and name not in columns:
            continue
        out += [F.lit(template[at : m.start()]), F.lit("$") if m["escaped"] is not None else _text(columns[name])]
        at = m.end()
    return F.concat(*out, F.lit(template[at:]))


def agency_list_text(c) -> Column:
    """"['a', 'b']" as "a, b"; other strings as they are."""
    return F.coalesce(F.array_join(F.from_json(_col(c), "array<string>"), ", "), _col(c))


def without_unnamed(c) -> Column:
    return F.array_join(F.filter(F.transform(F.split(_text(c), ","), lambda x: F.trim(x)), lambda x: (x != "") & ~F.contains(F.lower(x), F.lit("unnamed"))), ", ")


def drive_id(c) -> Column:
    return F.regexp_extract(_text(c), r"/d/([A-Za-z0-9_-]+)", 1)


def citations(values) -> Column:
    """"file p. n" of an array of (file, page) structs, joined by semicolons."""
    return F.array_join(F.transform(_col(values), lambda x: F.format_string("%s p. %d", x["file"], x["page"])), "; ")


def truncated(c, n: int = 2000) -> Column:
    return F.when(F.length(_text(c)) > n, F.concat(F.substring(_text(c), 1, n), F.lit("..."))).otherwise(_text(c))


def agency_key(c) -> Column:
    return F.trim(F.replace(F.lower(_text(c)), F.lit("_"), F.lit(" ")))
